"""Sharding by best-fit-decreasing bin packing: rows of equal texts stay together, shards get nearly equal bytes.

Groups are sorted by size and each goes into the bin with the least remaining room that still holds it, found in a balanced
tree. That happens twice. Tasks first pack their own groups into bins of a small fixed capacity, a 512th of a shard; a larger
group has a bin alone. The bins, whose number depends on the number of shards and tasks and not on the rows, are then
packed into the shards, whose capacity is the least for which best fit needs no further shard.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .base import discard, materialise

#: Bytes that a row takes beside its text.
ROW_BYTES = 8
#: Bins of the first packing a shard.
BINS = 512
#: At most so many groups of copies are joined by broadcast; any other has fewer than this part of all rows.
HOT = 4096
KEYS = ["digest", "text_crc32", "size"]


class _Node:
    __slots__ = ("key", "left", "level", "right")

    def __init__(self, key: tuple[int, int]):
        self.key, self.level, self.left, self.right = key, 1, None, None


def _skew(t: _Node | None) -> _Node | None:
    if t and t.left and t.left.level == t.level:
        top = t.left
        t.left, top.right = top.right, t
        return top
    return t


def _split(t: _Node | None) -> _Node | None:
    if t and t.right and t.right.right and t.right.right.level == t.level:
        top = t.right
        t.right, top.left = top.left, t
        top.level += 1
        return top
    return t


def _insert(t: _Node | None, key: tuple[int, int]) -> _Node:
    if t is None:
        return _Node(key)
    if key < t.key:
        t.left = _insert(t.left, key)
    else:
        t.right = _insert(t.right, key)
    return _split(_skew(t))


def _remove(t: _Node | None, key: tuple[int, int]) -> _Node | None:
    if t is None:
        return None
    if key < t.key:
        t.left = _remove(t.left, key)
    elif key > t.key:
        t.right = _remove(t.right, key)
    elif t.left is None or t.right is None:
        return t.left or t.right
    else:
        least = t.right
        while least.left:
            least = least.left
        t.key = least.key
        t.right = _remove(t.right, least.key)
    low = min(t.left.level if t.left else 0, t.right.level if t.right else 0) + 1
    if low < t.level:
        t.level = low
        if t.right and t.right.level > low:
            t.right.level = low
    t = _skew(t)
    t.right = _skew(t.right)
    if t.right:
        t.right.right = _skew(t.right.right)
    t = _split(t)
    t.right = _split(t.right)
    return t


class Bins:
    """Open bins of one capacity in an AA tree by (remaining room, bin); sizes are to come in descending order."""

    def __init__(self, capacity: int):
        self.capacity, self.count, self.root = capacity, 0, None

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The open bin with the least room of at least ``size``, and of those the first."""
        t, best = self.root, None
        while t:
            if t.key[0] >= size:
                t, best = t.left, t.key
            else:
                t = t.right
        return best

    def place(self, size: int, count: int) -> list[tuple[int, int]]:
        """Put ``count`` groups of one size; (bin, groups) in turn.

        The bin that a group enters becomes the tightest, so that groups of its size follow until it holds no more.
        """
        out = []
        while count:
            found = self.tightest(size)
            if found:
                room, number = found
                self.root = _remove(self.root, found)
            else:
                room, number = max(self.capacity, size), self.count
                self.count += 1
            k = min(count, room // size)
            room -= k * size
            if room:
                self.root = _insert(self.root, (room, number))
            out.append((number, k))
            count -= k
        return out


def _runs(sizes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(size, start, count) of the runs of equal neighbours."""
    starts = np.flatnonzero(np.diff(sizes, prepend=sizes[:1] - 1)) if len(sizes) else np.zeros(0, np.int64)
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(sizes)], strict=True):
        yield int(sizes[a]), a, b - a


def pack(sizes: Sequence[int], capacity: int, most: int | None = None) -> np.ndarray | None:
    """Bin of every size (descending) by best fit; None if more than ``most`` bins are needed."""
    sizes, bins, out = np.asarray(sizes, np.int64), Bins(capacity), np.zeros(len(sizes), np.int64)
    for size, a, count in _runs(sizes):
        for number, k in bins.place(size, count):
            out[a : a + k] = number
            a += k
        if most is not None and bins.count > most:
            return None
    return out


def deal(sizes: Sequence[int], shards: int) -> np.ndarray:
    """Shard of every size (descending): best fit at the least capacity that needs no more than ``shards``.

    A size beyond the fair share of what is left has a shard alone, since no dealing of the others could equal it.
    """
    sizes = np.asarray(sizes, np.int64)
    out, alone, rest = np.zeros(len(sizes), np.int64), 0, int(sizes.sum())
    while alone < min(len(sizes), shards - 1) and int(sizes[alone]) * (shards - alone) >= rest:
        out[alone] = alone
        rest -= int(sizes[alone])
        alone += 1
    todo, free = sizes[alone:], shards - alone
    if not len(todo):
        return out
    low = max(-(-rest // free), int(todo[0]))
    high = -(-rest // free) + int(todo[0])  # then every shard that cannot take a size holds more than its fair share
    best = pack(todo, high, free)
    while low < high:
        middle = (low + high) // 2
        found = pack(todo, middle, free)
        if found is None:
            low = middle + 1
        else:
            high, best = middle, found
    out[alone:] = alone + best
    return out


def shard_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shards: int = 24) -> DataFrame:
    """One row per input row: id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null under this law).

    size is the text's UTF-8 bytes and 8. Rows of equal texts share a shard, whole; a null text counts as an empty one. Shards
    have nearly equal bytes, but that a group larger than a fair share has a shard alone. Slots number a shard's
    rows from 0 without gaps. Repeated rows, null and equal ids each have a slot of their own; extra columns are not read;
    an empty table gives no rows. With fewer groups than shards some shards stay empty.

    Texts are read once. The driver holds sizes of at most twice 512 bins a shard and one for every shuffle partition.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialise(docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("digest")), "sizes")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = rows.groupBy(*KEYS).agg(F.count("*").alias("n")).withColumn("weight", F.col("n") * F.col("size"))
    groups = materialise(groups.withColumn("part", F.pmod(F.hash(*KEYS), F.lit(parts))), "groups")
    total, number = groups.agg(F.coalesce(F.sum("weight"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    capacity = max(math.ceil(total / (shards * BINS)), 1)

    def first_packing(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, bins = None, None
        for batch in batches:
            parts, weights = batch.column("part").to_numpy(), batch.column("weight").to_numpy()
            unit = np.zeros(len(parts), np.int64)
            for p, start, length in _runs(parts):
                if p != part:
                    part, bins = p, Bins(capacity)
                for size, a, count in _runs(weights[start : start + length]):
                    a += start
                    for b, k in bins.place(size, count):
                        unit[a : a + k] = p << 32 | b
                        a += k
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in (*KEYS, "n", "weight")], pa.array(unit)], [*KEYS, "n", "weight", "unit"])

    ordered = groups.repartition(parts, "part").sortWithinPartitions("part", F.col("weight").desc(), *KEYS)
    packed = materialise(ordered.mapInArrow(first_packing, "digest long, text_crc32 long, size long, n long, weight long, unit long"), "bins")
    discard(groups)
    bins = packed.groupBy("unit").agg(F.sum("weight").alias("weight")).toPandas().sort_values(["weight", "unit"], ascending=[False, True])  # bounded: see above
    shard_of = pd.DataFrame({"unit": bins["unit"].to_numpy(np.int64), "shard": deal(bins["weight"].to_numpy(np.int64), shards).astype(np.int32)})
    placed = packed.join(F.broadcast(spark.createDataFrame(shard_of, "unit long, shard int")), "unit").select(*KEYS, "n", "shard")
    hot = F.col("n") > F.lit(number // HOT)
    few = F.broadcast(placed.where(hot).select(*KEYS, "shard"))  # at most HOT rows
    dealt = rows.join(few, KEYS).unionByName(rows.join(few, KEYS, "left_anti").join(placed.where(~hot).select(*KEYS, "shard"), KEYS))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(shards, np.int64)
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            order = np.argsort(shard, kind="stable")
            sizes = np.bincount(shard, minlength=shards)
            place = np.empty(len(shard), np.int64)
            place[order] = np.arange(len(shard)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(seen, sizes)
            seen += sizes
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("id", "size", "text_crc32", "shard")] + [pa.array(np.full(len(shard), task, np.int32)), pa.array(place)], ["id", "size", "text_crc32", "shard", "task", "place"])

    numbered = materialise(dealt.select("id", "size", "text_crc32", "shard").mapInArrow(count, f"id {kind}, size long, text_crc32 long, shard int, task int, place long"), "places")
    discard(rows, packed)
    sums = numbered.groupBy("shard", "task").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(W.partitionBy("shard").orderBy("task")) - F.col("rows")
    starts = materialise(sums.select("shard", "task", before.alias("before")), "starts")
    out = numbered.join(starts, ["shard", "task"])
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("place")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
