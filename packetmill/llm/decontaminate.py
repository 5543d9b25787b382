"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Items are partitioned by their number of distinct shingles, and every partition has one sketch size:
the k least hashes of an item's shingles (bottom-k MinHash), with k one more than the most shingles that
a document may miss and still contain the item. A document that contains the item therefore holds at
least one shingle of the sketch, however long the document is, so that the search loses nothing.
Documents look all their shingles up in a bitmap of the sketch hashes, whose size is fixed; those that hit it meet the
sketches in a join on the hash, and the pairs found are verified on the shingles themselves.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Words, arrow_rows, blocks, materialise, mix, numbered, text_bytes

SHINGLE, CONTAINMENT = 5, 0.8
#: Bits of the bitmap that goes to the executors (8 MB), whatever the number of items.
BITMAP = 1 << 26
#: Candidate items of a document that are verified together: its text moves once for about so many.
TOGETHER = 256
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def lowered(column: pa.Array) -> list[bytes]:
    """Lower-cased UTF-8 of documents and items alike."""
    return text_bytes(pc.utf8_lower(column.cast(pa.large_string())))


def shingle_set(text: bytes, size: int) -> set[bytes]:
    """Distinct shingles of a lower-cased text; a text of fewer words has its whole sequence as one, an empty one has none."""
    words = _WORD.findall(text)
    if not words:
        return set()
    return {b" ".join(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))}


def hashes(block: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``size`` words from each word on, different for every size, and whether they all lie in one text."""
    h, whole = block.shingles(size)
    return mix(h ^ np.uint64(size)), whole


def sketches(texts: list[bytes], size: int, threshold: float) -> Iterator[tuple[int, int, np.ndarray]]:
    """(text, words of a shingle, sketch) of each item; an item of fewer than ``size`` words has its whole sequence as sketch."""
    block = Words(texts)
    for t in range(len(texts)):
        a, b = block.first[t], block.first[t + 1]
        words = min(size, b - a)
        if words:
            h = np.unique(hashes(Words([texts[t]]), words)[0])
            largest = (1 << len(h).bit_length()) - 1  # of the item's partition by size
            yield t, int(words), h[: math.floor(largest - threshold * largest + 1e-9) + 1]


def contained(text: bytes, items: list[bytes], size: int) -> list[tuple[int, int]]:
    """(an item's shingles, those in the text) of each item; a short one counts where its words stand consecutively."""
    shingles, spaced, found = shingle_set(text, size), b" " + b" ".join(_WORD.findall(text)) + b" ", []
    for item in items:
        own = shingle_set(item, size)
        one = next(iter(own))
        short = one.count(b" ") + 1 < size
        found.append((1, int(b" " + one + b" " in spaced)) if short else (len(own), len(own & shingles)))
    return found


def contained_items(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = SHINGLE, threshold: float = CONTAINMENT) -> DataFrame:
    """(doc id, item id, n_shingles, n_shared, containment) for every item that a whole document contains.

    Texts are lower-cased; words are runs of letters a to z, digits and characters beyond ASCII; shingles are ``size`` words,
    distinct. Containment is the share of the item's shingles that the document has; pairs reach ``threshold``. An item
    of fewer words is one shingle, found where its words stand consecutively. Null or wordless texts match nothing.
    Repeated documents and items each give their rows; null ids pass through; extra columns are not read; an empty table
    on either side gives an empty result. The driver holds a bitmap of fixed size, whatever the number of items; a
    document that hits the bitmap is written once to the shared folder with its hits.
    """
    spark = docs.sparkSession
    doc_kind, item_kind = docs.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    wanted, number = numbered(items.select(F.col(item_id).alias("item"), F.col(item_text).alias("words")).where("words is not null"), "items")

    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches):
            rows, lengths, found = [], [], []
            for t, n, h in sketches(lowered(batch.column("words")), size, threshold):
                rows += [t] * len(h)
                lengths += [n] * len(h)
                found.append(h)
            h = np.concatenate(found or [np.zeros(0, np.uint64)])
            yield pa.RecordBatch.from_arrays([batch.column(number).take(pa.array(rows, pa.int64())), pa.array(lengths, pa.int32()), pa.array(h.view(np.int64))], ["n", "length", "hash"])

    sketched = materialise(wanted.mapInArrow(sketch, "n long, length int, hash long"), "sketches")
    place = F.pmod(F.col("hash"), F.lit(BITMAP))
    parts = sketched.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()  # at most BITMAP / 32,768 rows of 4 KB
    lengths = sorted(r.length for r in sketched.select("length").distinct().collect())  # at most ``size`` rows
    bits = np.zeros(BITMAP, np.uint8)
    for part in parts:
        one = np.unpackbits(np.frombuffer(part.bits, np.uint8), bitorder="little")
        at = (part.bucket - 1) * len(one) + 1  # Spark's buckets begin at position 1
        bits[max(at, 0) : at + len(one)] |= one[max(-at, 0) : BITMAP - at]
    shared = spark.sparkContext.broadcast(np.packbits(bits))

    def look_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        for batch in arrow_rows(batches):
            hits: dict[int, list[int]] = {}
            texts = lowered(batch.column("text"))
            for a, b in blocks(texts):
                block = Words(texts[a:b])
                for n in lengths:
                    h, whole = hashes(block, n)
                    spot = (h % np.uint64(BITMAP)).astype(np.int64)
                    at = np.flatnonzero((bitmap[spot >> 3] >> (7 - (spot & 7)) & 1).astype(bool) & whole)
                    for t, x in zip((a + np.searchsorted(block.first, at, side="right") - 1).tolist(), h[at].view(np.int64).tolist(), strict=True):
                        hits.setdefault(t, []).append(x)
            own = sorted(hits)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(own, pa.int64())), pa.array([texts[t].decode() for t in own], pa.string()), pa.array([sorted(set(hits[t])) for t in own], pa.list_(pa.int64()))], ["id", "text", "hits"])

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    suspects, row = numbered(rows.mapInArrow(look_up, f"id {doc_kind}, text string, hits array<long>"), "suspects")
    pairs = suspects.select(F.col(row).alias("d"), F.explode("hits").alias("hash")).join(sketched.select("n", "hash"), "hash").select("d", "n").distinct()
    pairs = materialise(pairs, "pairs")  # two numbers a row
    parts = pairs.groupBy("d").agg(F.ceil(F.count("*") / TOGETHER).alias("parts"))
    dealt = pairs.join(parts, "d").withColumn("part", F.pmod(F.xxhash64("n"), F.col("parts"))).join(wanted.withColumnRenamed(number, "n"), "n")
    lists = dealt.groupBy("d", "part").agg(F.collect_list(F.struct("item", "words")).alias("items"))  # about TOGETHER each

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, 16):
            for t, document in enumerate(text_bytes(batch.column("text"))):
                items = batch.column("items")[t].values
                n, m = np.array(contained(document, lowered(items.field("words")), size), np.int64).T
                keep = np.flatnonzero(m >= threshold * n - 1e-9)
                n, m = n[keep], m[keep]
                if len(keep):
                    ids = batch.column("id").take(pa.array(np.full(len(keep), t)))
                    yield pa.RecordBatch.from_arrays([ids, items.field("item").take(pa.array(keep)), pa.array(n), pa.array(m), pa.array(m / n)], ["doc_id", "item_id", "n_shingles", "n_shared", "containment"])

    joined = lists.join(suspects.select(F.col(row).alias("d"), "id", "text"), "d").select("id", "text", "items")
    out = joined.mapInArrow(verify, f"doc_id {doc_kind}, item_id {item_kind}, n_shingles long, n_shared long, containment double")
    return out.withColumnsRenamed({"doc_id": doc_id, "item_id": item_id})


ORACLE = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents WHERE text IS NOT NULL
), item_words AS (
  SELECT item_id, regexp_extract_all(lower(text), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark WHERE text IS NOT NULL
), item_shingles AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i+4], ' ') AS s, least(len(w), 5) AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
), shingles AS (
  SELECT DISTINCT doc_id, k, array_to_string(w[i:i+k-1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, greatest(len(w) - k + 1, 0) + 1)) AS i FROM words, (SELECT DISTINCT k FROM item_shingles))
), sizes AS (SELECT item_id, count(*) AS n FROM item_shingles GROUP BY item_id)
SELECT doc_id, item_id, n AS n_shingles, count(*) AS n_shared, count(*)::DOUBLE / n AS containment
FROM item_shingles JOIN shingles USING (s, k) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n HAVING count(*) >= 0.8 * n - 1e-9
"""
