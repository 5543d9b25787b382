"""Lexical retrieval packing: BM25 neighbours of a seed document fill its window of tokens.

Documents are tokenised once. Their whole windows stand alone; what is left of each, shorter than a window, is
dealt to shards of a bounded number of documents, ranges of an order in which texts of similar words stand near each other: the
signs of weighted sums of random directions, one direction a token id, rare ids weighing more. Every shard has an inverted index over token ids; document
frequencies and the mean length cover the whole corpus. The longest unused piece seeds a window, BM25
ranks the unused pieces of the shard by the seed's terms, and the best that fit fill the window; where none
fits, the best one is cut. So every window of a shard but its last is full.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import arrow_rows, materialise

WINDOW, END_ID, VOCABULARY = 2048, 1, 1 << 16
#: Documents of a shard, about; an index of so many remainders takes a few MB.
SHARD_DOCS = 400
#: Signs of a text's place among all: 16 million places, so that shards of billions of documents still hold neighbours.
SIGNS = 24
K1, B = 1.2, 0.75


class Encoder:
    """Token ids as the tokenizer file gives them without special tokens; ``tokenizers`` itself is the fallback.

    The vocabulary and merges of a byte-level file are also what ``tiktoken`` runs, several times as fast; texts
    that hold an added token's string go to ``tokenizers``.
    """

    def __init__(self, path: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.added = [x["content"] for x in spec["added_tokens"]]
        self.fast = None
        if spec["model"]["type"] == "BPE" and (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and not spec.get("normalizer") and not spec["pre_tokenizer"]["add_prefix_space"]:
            printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
            rest = [b for b in range(256) if b not in printable]
            byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
            ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.added}
            pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            self.fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or any(x in text for x in self.added):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.frombuffer(array("I", self.fast.encode_ordinary(text)), np.uint32)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


_axes: dict[int, np.ndarray] = {}


def axes(seed: int = 29) -> np.ndarray:
    """A direction for every token id, longer for ids that merges made late, which are rarer."""
    if seed not in _axes:
        _axes[seed] = np.random.default_rng(seed).standard_normal((VOCABULARY, SIGNS), np.float32) * np.log1p(np.arange(VOCABULARY, dtype=np.float32))[:, None]
    return _axes[seed]


def place(ids: np.ndarray) -> int:
    """Where a text stands among all: signs of the sum of its ids' directions, read as a Gray code, so that neighbours differ in few signs."""
    bits = int.from_bytes(np.packbits(np.ones(len(ids), np.float32) @ axes().take(ids, axis=0) > 0).tobytes(), "big")
    for shift in (16, 8, 4, 2, 1):
        bits ^= bits >> shift
    return bits


def narrow(ids: np.ndarray) -> np.ndarray:
    """Token ids in 16 bits, which must hold them."""
    if len(ids) and int(ids.max()) >= VOCABULARY:
        raise ValueError(f"token id {int(ids.max())} does not fit 16 bits")
    return ids.astype("<u2")


def tokenise(docs: DataFrame, path: str, id_col: str, text_col: str, window: int) -> DataFrame:
    """(row, id, doc_tokens, crcs of whole windows, tail as little-endian 16-bit ids, place of the tail) per document."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in arrow_rows(batches, 1024):
            totals, crcs, tails, places = [], [], [], []
            for text in batch.column("text"):
                ids = np.append(enc.ids(text.as_py() or ""), np.uint32(END_ID)).astype("<u4")
                cut = len(ids) // window * window
                totals.append(len(ids))
                crcs.append([zlib.crc32(ids[a : a + window].tobytes()) for a in range(0, cut, window)])
                tails.append(narrow(ids)[cut:].tobytes())
                places.append(place(ids[cut:]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(totals, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(tails, pa.binary()), pa.array(places, pa.int32())], ["id", "doc_tokens", "crcs", "tail", "place"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, doc_tokens long, crcs array<long>, tail binary, place int")


def corpus_statistics(tokens: DataFrame) -> tuple[np.ndarray, float]:
    """Document frequency of every token id and mean length, over all remainders; the vocabulary bounds both the rows and the array."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, length, docs = np.zeros(VOCABULARY, np.int64), 0, 0
        for batch in batches:
            for tail in batch.column("tail").to_pylist():
                ids = np.frombuffer(tail, "<u2")
                seen[np.unique(ids)] += 1
                length += len(ids)
                docs += len(ids) > 0
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(([-2, -1], used))), pa.array(np.concatenate(([docs, length], seen[used])))], ["term", "n"])

    rows = tokens.select("tail").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    by = dict(zip(rows["term"].tolist(), rows["n"].tolist(), strict=True))
    docs, length = by.pop(-2, 0), by.pop(-1, 0)
    frequency = np.zeros(VOCABULARY, np.int64)
    frequency[list(by)] = list(by.values())
    idf = np.log1p((docs - frequency + 0.5) / (frequency + 0.5)).astype(np.float32)
    return idf, length / docs if docs else 1.0


class ShardIndex:
    """Inverted index of one shard: for each term the pieces that hold it, with BM25 weights."""

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray, mean: float):
        owner = np.repeat(np.arange(len(tails)), [len(t) for t in tails])
        ids = np.concatenate(tails).astype(np.int64) if tails else np.zeros(0, np.int64)
        pair, tf = np.unique(ids * len(tails) + owner, return_counts=True) if len(ids) else (ids, ids)
        self.n = len(tails)
        self.term, self.doc = pair // max(self.n, 1), pair % max(self.n, 1)
        length = np.array([len(t) for t in tails], np.float32)
        self.weight = (idf[self.term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[self.doc] / mean))).astype(np.float64)
        self.order = np.argsort(self.doc, kind="stable")
        self.of_doc = np.searchsorted(self.doc[self.order], np.arange(self.n + 1))
        self.terms, begin = np.unique(self.term, return_index=True)
        self.postings = list(zip(np.split(self.doc, begin[1:]), np.split(self.weight, begin[1:]), strict=True))

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every piece of the shard for the seed's terms."""
        terms = self.term[self.order[self.of_doc[seed] : self.of_doc[seed + 1]]]
        docs, weights = zip(*[self.postings[t] for t in np.searchsorted(self.terms, terms).tolist()], strict=True)
        return np.bincount(np.concatenate(docs), np.concatenate(weights), self.n)


def pack_shard(tails: list[np.ndarray], idf: np.ndarray, mean: float, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Windows of (piece, start in it, length). Each seed is the longest piece left; ties take the earlier one."""
    index = ShardIndex(tails, idf, mean)
    start = np.zeros(len(tails), np.int64)
    left = np.array([len(t) for t in tails], np.int64)
    while left.any():
        seed = int(np.argmax(left))
        content = [(seed, int(start[seed]), int(left[seed]))]
        room, start[seed], left[seed] = window - int(left[seed]), start[seed] + left[seed], 0
        if room and left.any():
            unused = np.flatnonzero(left)
            ranked = unused[np.argsort(-index.scores(seed)[unused], kind="stable")]
            size = left[ranked]
            at = 0
            while room and at < len(ranked):
                fits = np.flatnonzero(size[at:] <= room)
                if not len(fits):
                    break
                at += int(fits[0])
                piece = int(ranked[at])
                content.append((piece, int(start[piece]), int(left[piece])))
                room, start[piece], left[piece] = room - int(left[piece]), start[piece] + left[piece], 0
                at += 1
            if room and left.any():
                piece = int(next(p for p in ranked if left[p]))
                content.append((piece, int(start[piece]), room))
                start[piece] += room
                left[piece] -= room
        yield content


def retrieval_packs(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Pieces of packed sequences: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of the tokenizer file at ``tokenizer`` without special tokens, then id 1; null text
    counts as empty and is that one id. Each id lies in one piece. Pieces of a sequence stand gapless from
    offset 0, and its length is at most ``window``; only the last sequence of a shard may be shorter. sequence_id
    is unique over the result. ids_crc32 is taken over unsigned little-endian 32-bit ids. Repeated rows and
    ids and null ids are packed like any others; extra columns are not read; an empty table gives an empty result.
    Partitions, no more than the session's shuffle partitions, are cut into shards of at most ``shard_docs``, one held at a time.
    The tokenised table is written once to the shared folder, so that rows keep their shards on a retry. A tokenizer with
    ids of more than 16 bits raises an error.
    """
    tokens = materialise(tokenise(docs, tokenizer, id_col, text_col, window), "tokens")
    n = tokens.count()
    idf, mean = corpus_statistics(tokens)
    shards = max(1, -(-n // shard_docs))
    kind = docs.schema[id_col].dataType.simpleString()

    parts = min(shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def pack(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of a partition, in order of place, shard by shard; one shard is held at a time."""
        held, waiting = None, 0
        sequence = None
        for batch in batches:
            if not len(batch):
                continue
            sequence = int(batch["part"].iloc[0]) << 40 if sequence is None else sequence
            held, waiting = batch if held is None else pd.concat([held, batch]), waiting + len(batch)
            while waiting >= 2 * shard_docs:
                made, sequence = shard(held.iloc[:shard_docs], sequence)
                held, waiting = held.iloc[shard_docs:], waiting - shard_docs
                yield made
        if waiting:
            for rows in ([held] if waiting <= shard_docs else [held.iloc[: waiting // 2], held.iloc[waiting // 2 :]]):
                made, sequence = shard(rows, sequence)
                yield made

    def shard(held: pd.DataFrame, sequence: int) -> tuple[pd.DataFrame, int]:
        """The pieces of a shard, whose sequences are numbered from ``sequence`` on, and the next number."""
        rows = held.sort_values(["id", "doc_tokens", "tail"], kind="stable", na_position="last").reset_index(drop=True)
        out: list[tuple[int, int, int, int, int, int]] = []
        for r, crcs in enumerate(rows["crcs"]):
            for k, crc in enumerate(crcs):
                out.append((r, k * window, window, int(crc), sequence, 0))
                sequence += 1
        tails = [np.frombuffer(t, "<u2") for t in rows["tail"]]
        base = [len(crcs) * window for crcs in rows["crcs"]]
        for content in pack_shard(tails, idf, mean, window):
            offset = 0
            for r, start, length in content:
                out.append((r, base[r] + start, length, zlib.crc32(tails[r][start : start + length].astype("<u4").tobytes()), sequence, offset))
                offset += length
            sequence += 1
        cols = np.array(out, np.int64).reshape(-1, 6).T
        made = pd.DataFrame(dict(zip(("start", "length", "ids_crc32", "sequence_id", "offset"), cols[1:], strict=True)))
        made.insert(0, "id", rows["id"].iloc[cols[0]].array)
        made["doc_tokens"] = rows["doc_tokens"].to_numpy()[cols[0]]
        return made, sequence

    # Equal places are told apart by the row's place in the written table, so that repeated rows spread over shards too.
    spread = tokens.withColumn("mix", F.xxhash64(F.monotonically_increasing_id()))
    dealt = spread.repartitionByRange(parts, "place", "mix").sortWithinPartitions("place", "mix").select("id", "doc_tokens", "crcs", "tail", F.spark_partition_id().alias("part"))
    packed = dealt.mapInPandas(pack, f"id {kind}, start long, length long, ids_crc32 long, sequence_id long, offset long, doc_tokens long")
    return packed.select(F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
