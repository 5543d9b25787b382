"""SimHash near-duplicates: Golay-decoded segment keys find all fingerprints within three bits.

A 64-bit fingerprint is cut into four 16-bit segments. Three differing bits leave at least one
segment equal, and then a following segment (cyclically) differs in at most two bits: were it
three, all other segments would be equal and the next equal segment serves instead. A segment is
padded to a word of the perfect (23,12) Golay code. Decoding the word and each word one bit away
gives one to six codewords; two words at most two bits apart share a codeword, because a word
between them is one bit from both. (equal segment, codeword of the next) is therefore a key that
any linked pair shares, and no pair within three bits is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cache, reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Words, arrow_rows, blocks, discard, materialise, mix, text_bytes
from .components import components

WORDS, SEED, BITS = 3, 42, 3
#: Above so many distinct fingerprints, keys also take the codeword of the segment after the next.
DEEP_FROM = 1 << 24
_GENERATOR = 0b110001110101


def fingerprint(text: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """SimHash of a lower-cased text: bit i is set if it is set in over half of its shingles' XXH64."""
    tokens = text.split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    size = min(words, len(tokens))
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    n = len(tokens) - size + 1
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        spans = zip(starts[at : min(n, at + (1 << 16))].tolist(), ends[at + size - 1 : min(n, at + (1 << 16)) + size - 1].tolist(), strict=True)
        h = np.array([digest(joined[a:b], seed) for a, b in spans], ">u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


@cache
def golay_keys() -> tuple[np.ndarray, np.ndarray]:
    """For each 16-bit segment: its codeword numbers (65,536 rows of six, repeats filled up) and how many differ."""
    def remainder(word: np.ndarray) -> np.ndarray:
        for bit in range(22, 10, -1):
            word = np.where(word >> bit & 1, word ^ (_GENERATOR << (bit - 11)), word)
        return word

    errors = np.array([sum(1 << b for b in places) for k in range(4) for places in combinations(range(23), k)])
    pattern = np.zeros(2048, np.int64)
    pattern[remainder(errors)] = errors
    segments = np.arange(1 << 16) << 7
    near = segments[:, None] ^ np.concatenate(([0], 1 << np.arange(7, 23)))
    codeword = np.sort((near ^ pattern[remainder(near)]) >> 11, axis=1)
    fresh = np.ones_like(codeword, bool)
    fresh[:, 1:] = codeword[:, 1:] != codeword[:, :-1]
    count = fresh.sum(axis=1)
    keys = np.sort(np.where(fresh, codeword, 1 << 20), axis=1)[:, : count.max()]
    return keys.astype(np.int64), count


def keys_of(fingerprints: np.ndarray, deep: bool) -> tuple[np.ndarray, np.ndarray]:
    """All (key, fingerprint) rows: four equal segments, each with the codewords of the next one (or two)."""
    codes, count = golay_keys()
    width = codes.shape[1]
    segment = [(fingerprints >> np.uint64(16 * i) & np.uint64(0xFFFF)).astype(np.int64) for i in range(4)]
    keys, owners = [], []
    for i in range(4):
        stem = (i << 16 | segment[i])[:, None] << 12
        one = stem | codes[segment[(i + 1) % 4]]
        valid = np.arange(width) < count[segment[(i + 1) % 4]][:, None]
        if deep:
            after = segment[(i + 2) % 4]
            one = (one[:, :, None] << 12) | codes[after][:, None, :]
            valid = valid[:, :, None] & (np.arange(width) < count[after][:, None])[:, None, :]
        keys.append(one[valid])
        owners.append(np.repeat(fingerprints, valid.reshape(len(fingerprints), -1).sum(axis=1)))
    return np.concatenate(keys), np.concatenate(owners)


def forest(members: np.ndarray, bits: int = BITS) -> list[tuple[int, int]]:
    """Links that span the components of ``members``: each one found is taken out, so dense groups cost few scans."""
    rest, links = members, []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            near = np.bitwise_count(rest ^ queue[0]) <= bits
            found = rest[near]
            links += [(queue[0], x) for x in found]
            queue = queue[1:] + list(found)
            rest = rest[~near]
    return links


def links_of_runs(key: np.ndarray, owner: np.ndarray, bits: int = BITS, small: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Links within each run of equal keys: small runs by shifted comparison of whole arrays, larger ones by ``forest``."""
    edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    length = np.diff(edge)
    left, right = [], []
    few = np.repeat(length <= small, length)
    for d in range(1, min(small, int(length.max(initial=0)))):
        at = np.flatnonzero((key[d:] == key[:-d]) & few[d:])
        at = at[np.bitwise_count(owner[at] ^ owner[at + d]) <= bits]
        left.append(owner[at])
        right.append(owner[at + d])
    for k in np.flatnonzero(length > small):
        if pairs := forest(owner[edge[k] : edge[k + 1]], bits):
            a, b = np.array(pairs, np.uint64).T
            left.append(a)
            right.append(b)
    none = np.zeros(0, np.uint64)
    return np.concatenate(left or [none]), np.concatenate(right or [none])


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, seed: int = SEED) -> DataFrame:
    """(id, fp): the fingerprint of every whole text; null and blank texts have fingerprint 0."""
    kind = docs.schema[id_col].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches):
            fps = np.array([fingerprint(x.lower(), words, seed) for x in text_bytes(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), _signed(fps)], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind.simpleString()}, fp long")


def fingerprint_links(classes: DataFrame, bits: int = BITS, deep: bool | None = None) -> DataFrame:
    """(a, b) links that span the components of distinct fingerprints ``fp`` at ``bits`` or fewer differing bits.

    Rows are dealt by key and read in key order; a run of equal keys holds fingerprints of eight bytes each,
    never texts, and gives at most one link per member of a large run.
    """
    if not 0 <= bits <= BITS:
        raise ValueError(f"bits must be 0 to {BITS}")
    deep = classes.count() > DEEP_FROM if deep is None else deep

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, 1 << 14):
            key, owner = keys_of(batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64), deep)
            yield pa.RecordBatch.from_arrays([pa.array(key), _signed(owner)], ["key", "fp"])

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out(rows: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            a, b = links_of_runs(*(np.concatenate(x) for x in zip(*rows, strict=True)), bits)
            return pa.RecordBatch.from_arrays([_signed(a), _signed(b)], ["a", "b"])

        for batch in batches:
            key = batch.column("key").to_numpy()
            fp = batch.column("fp").to_numpy().view(np.uint64)
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1]))  # the last run may go on in the next batch
            if held and (cut or key[0] != held[-1][0][-1]):
                done = [*held, (key[:cut], fp[:cut])]
                held = []
                yield out(done)
            elif cut:
                yield out([(key[:cut], fp[:cut])])
            held.append((key[cut:], fp[cut:]))
        if held:
            yield out(held)

    rows = classes.select("fp").mapInArrow(emit, "key long, fp long")
    dealt = rows.repartition(F.col("key")).sortWithinPartitions("key")
    return dealt.mapInArrow(verify, "a long, b long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, seed: int = SEED, bits: int = BITS) -> DataFrame:
    """One row per input row: id, fingerprint (16 lower-case hex digits), component_id.

    Lower-cases A-Z, takes words between ASCII white space and shingles of ``words`` of them, repeats
    included (fewer words: the whole sequence; null, empty or blank text: fingerprint zero, which links like any
    other). Fingerprints link at ``bits`` or fewer differing bits. component_id is the smallest id reachable over
    links, itself included; null ids are passed over, so a group of null ids only has a null component_id.
    Repeated rows and repeated ids all stay. Extra columns are not read. An empty table gives an empty result.
    """
    prints = materialise(fingerprints(docs, id_col, text_col, words, seed), "fingerprints")
    classes = materialise(prints.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    found = components(fingerprint_links(classes, bits))
    rooted = classes.join(found, classes.fp == found.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialise(rooted.join(smallest, "root").select("fp", "component_id"), "named")
    joined = prints.join(named, "fp")
    return joined.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# --- similarity of shingle sets: longer fingerprints, the same keys, and a check of the whole fingerprint

#: Words of a shingle and least Jaccard similarity of sets of shingles; bits of a fingerprint, and of its part that pairs are first compared on.
COPY_WORDS, SIMILARITY, LONG_BITS, FIRST_BITS = 5, 0.8, 1024, 128
#: Share of pairs at the threshold that keys bring together, and fingerprints per key that the length of keys aims at.
KEY_RECALL, PER_KEY = 0.995, 4
#: Room that a pair at the threshold has before its sets are compared: standard deviations of the number of differing bits.
SLACK = 3
#: From so many shingles on, sets differ in bits as sets of that size do; smaller ones differ in more.
LARGE_SET = 128
#: Tables that first links are looked for in; all tables follow for what is still apart.
FIRST_TABLES = 4
#: Tables whose keys are dealt at once, which bounds the disk that keys take whatever the number of tables.
PASS_TABLES = 6
#: Bits of a second fingerprint, of texts that have near ones only, that pairs are told apart by before their sets are compared.
WIDE_BITS = 3072
_MIXES = np.random.default_rng(23).integers(1, 1 << 63, LONG_BITS // 64, dtype=np.uint64)
_WIDE_MIXES = np.random.default_rng(24).integers(1, 1 << 63, WIDE_BITS // 64, dtype=np.uint64)


def differing_share(similarity: float) -> float:
    """Expected share of differing bits between sets of one size at a Jaccard similarity."""
    return float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)


def _halves(n: int) -> np.ndarray:
    """P(k of n fair bits are set)."""
    return np.array([comb(n, k) for k in range(n + 1)], object).astype(float) / 2.0**n


@cache
def differing_most(similarity: float) -> np.ndarray:
    """For sets of 0 to ``LARGE_SET`` shingles: the most that the expected share of differing bits is at the threshold, over the sizes of the other, larger set."""
    most = np.zeros(LARGE_SET + 1)
    for n in range(1, LARGE_SET + 1):
        for m in range(n, int(n / similarity + 1e-9) + 1):
            both = int(np.ceil(similarity * (n + m) / (1 + similarity) - 1e-9))
            if both > n:
                continue
            common, one, other = (_halves(k) for k in (both, n - both, m - both))
            # For k set bits among the common shingles, the chance that each set has its bit.
            need = lambda size, k, own: np.array([own[max(0, size // 2 + 1 - x) :].sum() for x in k])
            k = np.arange(both + 1)
            p, q = need(n, k, one), need(m, k, other)
            most[n] = max(most[n], float((common * (p * (1 - q) + q * (1 - p))).sum()))
    return np.maximum.accumulate(most[::-1])[::-1]


def loose_cut(bits: int, similarity: float, n: np.ndarray | int = LARGE_SET, slack: float = SLACK) -> np.ndarray:
    """Most differing bits of a pair whose shingle sets are compared, where the smaller set has ``n`` shingles: ``slack`` deviations over what is expected."""
    share = differing_most(similarity)[np.minimum(n, LARGE_SET)]
    return np.floor(bits * share + slack * np.sqrt(bits * share * (1 - share))).astype(np.int64)


def shingle_sets(texts: list[bytes], words: int = COPY_WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each lower-cased text; fewer words make one shingle, none an empty set."""
    block = Words(texts)
    shingles, _ = block.shingles(words)
    for first, end in zip(block.first[:-1].tolist(), block.first[1:].tolist(), strict=True):
        if end - first >= words:
            yield np.unique(shingles[first : end - words + 1])
        else:
            yield np.array([int(np.bitwise_xor.reduce(mix(block.hash[first:end] + np.arange(1, end - first + 1, dtype=np.uint64)))) ], np.uint64) if end > first else np.zeros(0, np.uint64)


def long_fingerprints(sets: Iterable[np.ndarray], mixes: np.ndarray = _MIXES) -> list[tuple[bytes, int, int]]:
    """A SimHash of ``LONG_BITS`` bits (or as many as ``mixes`` make) of each set of hashes, none set for an empty one, a digest of the set and its size."""
    out = []
    for h in sets:
        counts = np.zeros(64 * len(mixes), np.int64)
        for at in range(0, len(h), 4096):
            many = mix(h[at : at + 4096, None] ^ mixes)
            counts += np.unpackbits(many.view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
        out.append((np.packbits(counts * 2 > len(h)).tobytes(), int(mix(h).sum(dtype=np.uint64).view(np.int64)), len(h)))
    return out


def key_plan(n: int, similarity: float = SIMILARITY) -> tuple[int, int]:
    """(exact bits, tables) for n fingerprints: keys grow with the logarithm of n, and tables make up for what longer keys miss.

    Tables share segments, so at 16 exact bits no number of them would reach 0.99.
    """
    p = differing_share(similarity)
    codes = golay_keys()[1].mean()
    exact = min(15, max(8, int(np.ceil(np.log2(max(n, 1) * codes / PER_KEY))) - 12))
    coded = sum(comb(16, k) * p**k * (1 - p) ** (16 - k) for k in range(3))
    together = coded * (1 - p) ** exact
    return exact, int(np.ceil(np.log(1 - KEY_RECALL) / np.log(1 - together)))


def similarity_keys(words: np.ndarray, exact: int, tables: int, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(key, row) of every table from ``first`` up to ``tables``: the codewords of one 16-bit segment with ``exact`` bits of another, of rows of 64-bit words.

    The other segment is the next one; tables beyond the number of segments take the one after it, and so on.
    """
    codes, count = golay_keys()
    segments = np.ascontiguousarray(words).view(np.uint16).astype(np.int64)
    n, many = segments.shape
    keys, rows = [], []
    for t in range(first, tables):
        own, after = segments[:, t % many], segments[:, (t + 1 + t // many) % many]
        valid = np.arange(codes.shape[1]) < count[own][:, None]
        stem = ((t << 16) | (after & ((1 << exact) - 1)))[:, None] << 12
        keys.append((stem | codes[own])[valid])
        rows.append(np.repeat(np.arange(n), valid.sum(axis=1)))
    return np.concatenate(keys), np.concatenate(rows)


#: Longest run of equal keys that is compared by shifting whole arrays; longer ones are compared in tiles of so many pairs.
SMALL_RUN, TILE = 16, 1 << 21


def runs_of(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of every run of equal keys."""
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return start, np.diff(np.append(start, len(key)))


def with_neighbours(key: np.ndarray, label: np.ndarray, x: np.ndarray, y: np.ndarray, cut: int, small: int = SMALL_RUN, tile: int = TILE, asked: np.ndarray | None = None) -> np.ndarray:
    """Whether each position, of those ``asked`` for, shares its run of equal keys with one of another label whose (x, y) words differ in ``cut`` or fewer bits."""
    start, length = runs_of(key)
    out = np.zeros(len(key), bool)
    asked = np.ones(len(key), bool) if asked is None else asked
    few = np.repeat(length <= small, length)
    for d in range(1, min(small, int(length.max(initial=0)))):
        at = np.flatnonzero((key[d:] == key[:-d]) & few[d:] & (label[d:] != label[:-d]) & (asked[d:] | asked[:-d]))
        at = at[np.bitwise_count(x[at] ^ x[at + d]).astype(np.int16) + np.bitwise_count(y[at] ^ y[at + d]) <= cut]
        out[at] = out[at + d] = True
    for k in np.flatnonzero(length > small):
        a, b = start[k], start[k] + length[k]
        step = max(1, tile // (b - a))
        own = a + np.flatnonzero(asked[a:b])
        for at in range(0, len(own), step):
            one = own[at : at + step]
            near = np.bitwise_count(x[one, None] ^ x[a:b]).astype(np.int16) + np.bitwise_count(y[one, None] ^ y[a:b]) <= cut
            out[one] |= (near & (label[one, None] != label[a:b])).any(axis=1)
    return out & asked


@dataclass(frozen=True)
class Near:
    """What a pair of fingerprints must meet before its sets are compared: differing bits of the last two words and of all, by size, and sizes."""

    prints: np.ndarray
    size: np.ndarray
    first_cut: int
    cuts: np.ndarray
    similarity: float

    def pairs(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of the pairs (i, j) that meet it."""
        x, y = self.prints[:, -2], self.prints[:, -1]
        less = np.minimum(self.size[i], self.size[j])
        fit = np.bitwise_count(x[i] ^ x[j]).astype(np.int16) + np.bitwise_count(y[i] ^ y[j]) <= self.first_cut
        fit &= less >= self.similarity * np.maximum(self.size[i], self.size[j]) - 1e-9
        i, j, less = i[fit], j[fit], less[fit]
        close = np.zeros(len(i), bool)
        for at in range(0, len(i), 1 << 15):
            part = slice(at, at + (1 << 15))
            close[part] = np.bitwise_count(self.prints[i[part]] ^ self.prints[j[part]]).sum(axis=1) <= self.cuts[np.minimum(less[part], LARGE_SET)]
        return i[close], j[close]

    def between(self, one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of all pairs of two lists of positions that meet it."""
        x, y = self.prints[:, -2], self.prints[:, -1]
        i, j = np.nonzero(np.bitwise_count(x[one][:, None] ^ x[other]).astype(np.int16) + np.bitwise_count(y[one][:, None] ^ y[other]) <= self.first_cut)
        return self.pairs(one[i], other[j])


def spanning_pairs(key: np.ndarray, near: Near) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Near pairs that span each run of equal keys: every position found is taken out, so that a dense group gives a pair per member."""
    start, length = runs_of(key)
    for k in np.flatnonzero(length > 1):
        rest = np.arange(start[k], start[k] + length[k])
        while len(rest) > 1:
            queue, rest = [rest[0]], rest[1:]
            while queue and len(rest):
                i, j = near.between(np.array(queue[:1]), rest)
                yield i, j
                queue = queue[1:] + list(j)
                rest = np.setdiff1d(rest, j, assume_unique=True)


def apart_pairs(key: np.ndarray, label: np.ndarray, near: Near, small: int = SMALL_RUN, tile: int = TILE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All near pairs of different labels within runs of equal keys: small runs by shifting whole arrays, larger ones in tiles."""
    start, length = runs_of(key)
    few = np.repeat(length <= small, length)
    for d in range(1, min(small, int(length.max(initial=0)))):
        at = np.flatnonzero((key[d:] == key[:-d]) & few[d:] & (label[d:] != label[:-d]))
        yield near.pairs(at, at + d)
    for k in np.flatnonzero(length > small):
        a, b = start[k], start[k] + length[k]
        _, name, count = np.unique(label[a:b], return_inverse=True, return_counts=True)
        most = name == count.argmax()
        order = a + np.concatenate((np.flatnonzero(~most), np.flatnonzero(most)))  # members of the commonest label need no comparison among them
        step = max(1, tile // (b - a))
        odd = int((~most).sum())
        for at in range(0, odd, step):
            i, j = near.between(order[at : min(odd, at + step)], order[at:])
            differ = label[i] != label[j]
            yield i[differ], j[differ]


@cache
def _apart_codes() -> tuple[np.ndarray, np.ndarray]:
    """Codewords of every segment twice, with fillers that are equal to none of the other."""
    codes, count = golay_keys()
    valid = np.arange(codes.shape[1]) < count[:, None]
    return np.where(valid, codes, -1), np.where(valid, codes, -2)


def meets_first(key: np.ndarray, prints: np.ndarray, i: np.ndarray, j: np.ndarray, exact: int) -> np.ndarray:
    """Whether ``key[i]`` is the first of all keys that the fingerprints i and j share: by table, then by codeword."""
    ours, theirs = _apart_codes()
    segments = np.ascontiguousarray(prints).view(np.uint16)
    many, table, first = segments.shape[1], key[i] >> 28, np.ones(len(i), bool)
    for t in range(int(table.max(initial=-1)) + 1):
        at = np.flatnonzero(first & (t <= table))
        after = (t + 1 + t // many) % many
        at = at[(segments[i[at], after] ^ segments[j[at], after]) & ((1 << exact) - 1) == 0]
        own = ours[segments[i[at], t % many]]
        shared = (own[:, :, None] == theirs[segments[j[at], t % many]][:, None, :]).any(axis=2)
        least = np.where(shared, own, 1 << 20).min(axis=1, initial=1 << 20)
        first[at[(least < 1 << 20) & ((t < table[at]) | (least < (key[i[at]] & 0xFFF)))]] = False
    return first


def whole_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of batches in key order as tables that no run of equal keys crosses."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        at = int(np.searchsorted(key, key[-1]))  # the last run may go on in the next batch
        if held and key[0] != held[-1].column("key")[-1].as_py():
            yield pa.Table.from_batches(held)
            held = []
        if at:
            yield pa.Table.from_batches([*held, batch.slice(0, at)])
            held = []
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = COPY_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(id, component_id) per row: groups over links between texts whose sets of word shingles are similar.

    Golay keys bring texts together: a 16-bit segment's codewords with some bits of another segment, in as many tables as
    ``key_plan`` says. Texts that share a key with a text of close fingerprint go on; their whole fingerprints meet by the same
    keys, and pairs too far apart in bits or sizes are passed over. The shingle sets of all others are compared whole, so no
    pair below ``similarity`` is linked. This is done for pairs that span the runs of a few tables first, and then
    for all pairs of all tables whose ends are not in one group yet, so that a large group of copies gives few pairs and no link between
    groups is left out. Ids are expected to be unique and not null; the component is named by its least id. Equal sets
    are one class, so copies make no pairs. Null and wordless texts have the empty set and group together. Extra columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches):
            texts = [x.lower() for x in text_bytes(batch.column("text"))]
            prints = [p for a, b in blocks(texts) for p in long_fingerprints(shingle_sets(texts[a:b], words))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array([p[k] for p in prints], t) for k, t in enumerate((pa.binary(), pa.int64(), pa.int64())))], ["id", "fp", "digest", "size"])

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, 256):
            texts = [x.lower() for x in text_bytes(batch.column("text"))]
            found = [h for a, b in blocks(texts) for h in shingle_sets(texts[a:b], words)]
            wide = [w for w, _, _ in long_fingerprints(found, _WIDE_MIXES)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([len(h) for h in found], pa.int64()), pa.array(wide, pa.binary()), pa.array([h.tobytes() for h in found], pa.binary())], ["node", "size", "wide", "shingles"])

    prints = materialise(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp binary, digest long, size long"), "prints")
    classes = materialise(prints.groupBy("fp", "digest", "size").agg(F.min("id").alias("least")).withColumn("node", F.monotonically_increasing_id()), "classes")
    first_cut = int(loose_cut(FIRST_BITS, similarity, 1))
    sizes = np.arange(LARGE_SET + 1)
    cuts, likely, wide_cuts = loose_cut(LONG_BITS, similarity, sizes), loose_cut(LONG_BITS, similarity, sizes, 0), loose_cut(WIDE_BITS, similarity, sizes)
    exact, tables = key_plan(classes.count(), similarity)

    def words_of(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
        return np.frombuffer(b"".join(batch.column("fp").to_pylist()), np.uint64).reshape(batch.num_rows, -1)

    def in_passes(upto: int, one: Callable[[int, int], DataFrame], tag: str, done: list[DataFrame]) -> list[DataFrame]:
        """``one(first, end)`` of a few tables at a time, each written and added to ``done`` before the next, so that only the keys of one pass lie on disk."""
        for at in range(0, upto, PASS_TABLES):
            done.append(materialise(one(at, min(upto, at + PASS_TABLES)), tag))
        return done

    def with_near(rows: DataFrame, labels: tuple[str, ...]) -> DataFrame:
        """Nodes of rows (node, fp, labels) that share a key with one of another label (of another node, where labels is empty) and of near first bits.

        Nodes found in a pass are looked for no more: in later ones they are only what others are near to.
        """

        def flag(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in whole_runs(batches):
                has = with_neighbours(table["key"].to_numpy(), table[(*labels, "node")[0]].to_numpy(), *(table[c].to_numpy().view(np.uint64) for c in ("x", "y")), first_cut, asked=table["asked"].to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(table["node"].to_numpy()[has]))], ["node"])

        def flagged(first: int, end: int) -> DataFrame:
            def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in arrow_rows(batches, 1 << 13):
                    if batch.num_rows:
                        words64 = words_of(batch)
                        key, row = similarity_keys(words64, exact, end, first)
                        of = pa.array(row)
                        yield pa.RecordBatch.from_arrays([pa.array(key), *(batch.column(c).take(of) for c in ("node", *labels)), _signed(words64[row, -2]), _signed(words64[row, -1]), batch.column("asked").take(of)], ["key", "node", *labels, "x", "y", "asked"])

            known = reduce(DataFrame.union, found).withColumn("asked", F.lit(False)) if found else None
            asking = rows.join(known, "node", "left") if found else rows.withColumn("asked", F.lit(True))
            keyed = asking.select("node", *labels, "fp", F.coalesce("asked", F.lit(True)).alias("asked")).mapInArrow(emit, ", ".join(f"{c} long" for c in ("key", "node", *labels, "x", "y")) + ", asked boolean")
            return keyed.repartition(F.col("key")).sortWithinPartitions("key", "node").mapInArrow(flag, "node long").distinct()

        found: list[DataFrame] = []
        in_passes(tables, flagged, "near", found)
        return reduce(DataFrame.union, found)

    chosen = materialise(classes.join(with_near(classes, ()), "node").select("node", "least", "size", "fp"), "chosen")
    texts = docs.select(F.col(id_col).alias("least"), F.col(text_col).alias("text"))
    compared = materialise(texts.join(chosen.select("node", "least"), "least").select("node", "text").mapInArrow(sets, "node long, size long, wide binary, shingles binary"), "sets")

    def pairs_of(rows: DataFrame, upto: int, pick: str) -> DataFrame:
        """Near pairs among rows (node, label, size, fp) that meet in the first ``upto`` tables."""

        def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in whole_runs(batches):
                key, node, label, size = (table[c].to_numpy() for c in ("key", "node", "label", "size"))
                near = Near(words_of(table), size, first_cut, likely if pick == "span" else cuts, similarity)
                found = spanning_pairs(key, near) if pick == "span" else apart_pairs(key, label, near)
                if pick == "apart":  # every pair comes from one key
                    found = ((i[one], j[one]) for i, j in found for one in [meets_first(key, near.prints, i, j, exact)])
                two = [np.sort(np.stack((node[i], node[j]), 1), axis=1) for i, j in found if len(i)]
                if two:
                    each = np.unique(np.concatenate(two), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(each[:, 0]), pa.array(each[:, 1])], ["a", "b"])

        def met(first: int, end: int) -> DataFrame:
            def emit_whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in arrow_rows(batches, 1 << 10):
                    if batch.num_rows:
                        key, row = similarity_keys(words_of(batch), exact, end, first)
                        yield pa.RecordBatch.from_arrays([pa.array(key), *batch.take(pa.array(row)).columns], ["key", *batch.schema.names])

            keyed = rows.select("node", "label", "size", "fp").mapInArrow(emit_whole, "key long, node long, label long, size long, fp binary")
            return keyed.repartition(F.col("key")).sortWithinPartitions("key", "node").mapInArrow(meet, "a long, b long")

        pairs = reduce(DataFrame.union, in_passes(upto, met, "met", []))
        return pairs.distinct() if pick == "span" else pairs

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, 256):
            keep = []
            for p, q in zip(batch.column("p"), batch.column("q"), strict=True):
                one, other = (np.frombuffer(x.as_buffer(), np.uint64) for x in (p, q))
                both = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(both >= similarity * (len(one) + len(other) - both) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def close(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, 1 << 12):
            p, q = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in ("p", "q"))
            less = np.minimum(np.minimum(batch.column("m").to_numpy(), batch.column("n").to_numpy()), LARGE_SET)
            yield batch.select(["a", "b"]).filter(pa.array(np.bitwise_count(p ^ q).sum(axis=1) <= wide_cuts[less]))

    def linked(pairs: DataFrame) -> DataFrame:
        """Pairs whose sets are similar; those far apart in the wide fingerprint are passed over, so that few sets move."""
        wide = lambda end, name, size: compared.select(F.col("node").alias(end), F.col("wide").alias(name), F.col("size").alias(size))
        told = pairs.join(wide("a", "p", "m"), "a").join(wide("b", "q", "n"), "b").select("a", "b", "p", "q", "m", "n")
        left = materialise(told.mapInArrow(close, "a long, b long"), "close")
        side = lambda end, name: compared.select(F.col("node").alias(end), F.col("shingles").alias(name))
        return left.join(side("a", "p"), "a").join(side("b", "q"), "b").select("a", "b", "p", "q").mapInArrow(verify, "a long, b long")

    links = materialise(linked(pairs_of(chosen.withColumn("label", F.col("node")), min(tables, FIRST_TABLES), "span")), "first")
    found = components(links)
    labelled = chosen.join(found.withColumnRenamed("node", "k"), F.col("node") == F.col("k"), "left").withColumn("label", F.coalesce("component", "node"))
    labelled = materialise(labelled.select("node", "label", "size", "fp"), "labelled")
    discard(chosen)
    contested = materialise(labelled.join(with_near(labelled, ("label",)), "node").select("node", "label", "size", "fp"), "contested")
    more = materialise(linked(pairs_of(contested, tables, "apart")), "more")
    discard(compared, labelled, contested)
    if not more.isEmpty():
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    rooted = classes.join(found.withColumnRenamed("node", "k"), F.col("node") == F.col("k"), "left").select("fp", "digest", "least", F.coalesce("component", "node").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialise(rooted.join(smallest, "root").select("fp", "digest", "component_id"), "named")
    discard(classes)
    return prints.join(named, ["fp", "digest"]).select(F.col("id").alias(id_col), "component_id")
