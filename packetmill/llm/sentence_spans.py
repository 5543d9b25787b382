"""Substring deduplication by sliding sentence spans: runs of sentences that occur before lose their later places.

Sentences end at marks and line ends. Every run of ``sentences`` consecutive sentences is hashed, however short. So that
passages which start or end within long sentences are found too, sentences are also cut before chosen words: of every
``piece`` consecutive words of a sentence the one of least hash. Those cuts depend on nearby words only, so a passage is cut in the same
places wherever it stands, but for fewer than ``piece`` words at its start and at most ``piece`` at its end. From every
piece on, and back from every piece that ends a sentence, the shortest run of at least ``sentences`` pieces and ``least_words``
words is hashed as well. Hashes meet in one aggregation over the corpus; the first place of each, by document and
position, stays, and what every other place covers goes. A second scan hashes again and hands on runs that a bitmap of repeated hashes
does not rule out, so that no run is written but those. With the default parameters a passage of more than 50 words that stands
twice holds at least three whole pieces of 28 words together, so that its later places always lose some.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Words, arrow_rows, bitmap_of, blocks, in_bitmap, materialise, mix, stable_numbers, text_bytes

SENTENCES, LEAST_WORDS, PIECE = 3, 28, 12
#: Bits of the bitmap of repeated hashes that goes to the executors (8 MB), whatever their number.
BITMAP = 1 << 26
_CUT = re.compile(rb"(?:[.!?]+[ \t\r\x0b\x0c]+|[ \t\r\x0b\x0c]*\n\s*)")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))


def sentence_starts(text: bytes) -> list[int]:
    """Byte offsets of sentences: after a mark that ends one and white space, and after line ends."""
    return sorted({0, *(m.end() for m in _CUT.finditer(text))} - {len(text)}) if text else []


def piece_cuts(block: Words, texts: list[bytes], piece: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of the block that begin a piece, the byte in their text where it begins, and whether it begins a sentence; a wordless sentence belongs to the piece before it.

    Of equal hashes in a window the last word counts, so that repeated words make short pieces.
    """
    n = len(block.hash)
    at = np.full(n, -1, np.int64)
    for t, text in enumerate(texts):
        if block.first[t] == block.first[t + 1]:
            continue
        starts = np.array(sentence_starts(text))
        word = np.searchsorted(block.start, starts + block.offset[t])
        inside = word < block.first[t + 1]
        at[word[inside]] = starts[inside]
        at[block.first[t]] = 0
    opens = at >= 0
    if n >= piece:
        sentence = np.cumsum(at >= 0)
        least = (block.hash >> np.uint64(32) << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64))
        width = 1
        while 2 * width <= piece:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[: n - piece + 1], least[piece - width :])
        chosen = (np.uint64(0xFFFFFFFF) - (least & np.uint64(0xFFFFFFFF))).astype(np.int64)[sentence[: n - piece + 1] == sentence[piece - 1 :]]
        chosen = chosen[at[chosen] < 0]
        at[chosen] = block.start[chosen] - block.offset[np.searchsorted(block.first, chosen, side="right") - 1]
    cut = np.flatnonzero(at >= 0)
    return cut, at[cut], opens[cut]


def runs(first: np.ndarray, closes: np.ndarray, sentences: int, least_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) pieces of all runs, each once; ``first`` holds the first word of each piece and the number of words, ``closes`` whether a piece ends a sentence.

    Runs are those of whole sentences and those of pieces.
    """
    n = len(first) - 1
    at = np.arange(n)

    def shortest(edge: np.ndarray) -> np.ndarray:
        return np.maximum(np.searchsorted(edge, edge[:-1] + least_words), at + sentences)

    forward = shortest(first)
    whole = forward <= n
    back = n - shortest(first[-1] - first[::-1])[::-1]
    whole_back = (back >= 0) & closes
    edges = np.concatenate((np.zeros(1, np.int64), np.flatnonzero(closes) + 1))
    spoken = edges[:-sentences] * (n + 1) + edges[sentences:]
    pair = np.unique(np.concatenate((at[whole] * (n + 1) + forward[whole], back[whole_back] * (n + 1) + at[whole_back] + 1, spoken)))
    return pair // (n + 1), pair % (n + 1)


def span_hashes(texts: list[bytes], sentences: int, least_words: int, piece: int) -> tuple[np.ndarray, ...]:
    """(text, hash, start, end) of every run of every text; hashes are of the run's lower-cased words alone."""
    block = Words([t.lower() for t in texts])
    power = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(len(block.hash), _STEP))))
    down = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(len(block.hash), _BACK))))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(block.hash * power[:-1])))
    cut, _, opens = piece_cuts(block, texts, piece)
    edge = np.searchsorted(cut, block.first)
    out: list[tuple[np.ndarray, ...]] = []
    for t in range(len(texts)):
        if edge[t] == edge[t + 1]:
            continue
        first = np.append(cut[edge[t] : edge[t + 1]], block.first[t + 1])
        a, b = runs(first, np.append(opens[edge[t] + 1 : edge[t + 1]], True), sentences, least_words)
        wa, wb = first[a], first[b]
        out.append((np.full(len(a), t), mix((total[wb] - total[wa]) * down[wa] + (wb - wa).astype(np.uint64)), a, b))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def without(texts: list[bytes], spans: list[list[tuple[int, int]]], piece: int) -> Iterator[tuple[bytes, int, int]]:
    """Each text without the pieces of its spans, its pieces, and how many of them went."""
    block = Words([t.lower() for t in texts])
    cut, at, _ = piece_cuts(block, texts, piece)
    edge = np.searchsorted(cut, block.first)
    for t, text in enumerate(texts):
        starts = [*at[edge[t] : edge[t + 1]].tolist(), len(text)]
        gone = np.zeros(len(starts) - 1, bool)
        for a, b in spans[t]:
            gone[a:b] = True
        yield b"".join(text[a:b] for a, b, g in zip(starts[:-1], starts[1:], gone.tolist(), strict=True) if not g), len(gone), int(gone.sum())


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sentences: int = SENTENCES, least_words: int = LEAST_WORDS, piece: int = PIECE) -> DataFrame:
    """One row for every document that loses pieces of sentences: id, n_pieces, n_removed, removed_chars, text (what remains).

    Documents that lose nothing are not in the result, nor are those that hold only first places. The first place of a run is that of the least id (nulls last),
    then of the least text hash, then of the first sentence; runs repeated within a document count too.
    Words are runs of letters, digits and characters beyond ASCII, lower-cased in ASCII; white space and marks
    do not matter. Rows equal in id and text count as one document and give equal rows, but rows without an id are documents
    of their own. Null and empty texts lose nothing; extra columns are not read; an empty table gives an empty result. A run
    shared by a third of all documents is aggregated before the shuffle, and the join that finds its places is one Spark can split.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    plain, number = stable_numbers(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "rows")
    row = F.when(F.col("id").isNull(), F.col(number)).otherwise(0)
    rows = plain.where("text is not null").select("id", "text", F.xxhash64("text").alias("mark"), row.cast("long").alias("row"))
    owner = ("id", "mark", "row")

    def hash_runs(bits: Broadcast | None) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in arrow_rows(batches):
                texts = text_bytes(batch.column("text"))
                for a, b in blocks(texts):
                    t, h, start, end = span_hashes(texts[a:b], sentences, least_words, piece)
                    h = h.astype(np.uint64)
                    if bits is not None:
                        known = in_bitmap(bits.value, h)
                        t, h, start, end = t[known], h[known], start[known], end[known]
                    own = pa.array(t + a)
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), *(batch.column(c).take(own) for c in owner), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], ["h", *owner, "a", "b"])

        return run

    spans = lambda bits: rows.mapInArrow(hash_runs(bits), f"h long, id {kind}, mark long, row long, a int, b int")
    place = F.struct(F.col("id").isNull().alias("none"), *owner, "a")
    repeated = spans(None).groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("last")).where(~F.col("first").eqNullSafe(F.col("last")))
    repeated = materialise(repeated.select("h", "first"), "repeated")
    bits = docs.sparkSession.sparkContext.broadcast(bitmap_of(repeated, "h", BITMAP))
    again = materialise(spans(bits), "spans")  # both sides of the join are then scans, and Spark can split a hot key
    later = again.join(repeated, "h").where(~place.eqNullSafe(F.col("first")))
    cut = later.groupBy(*owner).agg(F.collect_set(F.struct("a", "b")).alias("spans"))

    def drop(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, 1024):
            texts, spans = text_bytes(batch.column("text")), [[(s["a"], s["b"]) for s in own] for own in batch.column("spans").to_pylist()]
            made = [row for a, b in blocks(texts) for row in without(texts[a:b], spans[a:b], piece)]
            old = batch.column("text").to_pylist()
            left = [x.decode() for x, _, _ in made]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([n for _, n, _ in made], pa.int64()), pa.array([n for *_, n in made], pa.int64()), pa.array([len(o) - len(x) for o, x in zip(old, left, strict=True)], pa.int64()), pa.array(left, pa.string())],
                ["id", "n_pieces", "n_removed", "removed_chars", "text"],
            )

    wanted = cut.select(*[F.col(c).alias(f"{c}_") for c in owner], "spans")
    same = [rows[c].eqNullSafe(wanted[f"{c}_"]) for c in owner]
    joined = rows.join(wanted, same).select("id", "text", "spans")
    out = joined.mapInArrow(drop, f"id {kind}, n_pieces long, n_removed long, removed_chars long, text string")
    return out.select(F.col("id").alias(id_col), "n_pieces", "n_removed", "removed_chars", "text")
