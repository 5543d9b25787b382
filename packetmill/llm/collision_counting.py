"""Embedding near-duplicates by collision-counting projections, verified with the cosine in double precision.

Unit vectors are projected on many random directions. Two vectors collide on a direction when one lies in the
window centred on the other along that direction's sorted values; the number of collisions over all directions is
binomial, with a probability that the cosine fixes. Pairs are verified when their count reaches the value that a
pair at the threshold reaches with the wanted recall. Windows over the sorted values produce the pairs, and their sum the candidates.

Windows of single directions thin out pairs by a constant factor only, whatever their width. So vectors
are first dealt to cells, the signs along a few further directions, once for each of several tables; the number of
tables keeps the recall, and the number of signs grows with the largest label, so that cells stay small. Cells that
stay large all the same are cut into tiles, and every pair of tiles is a group of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import acos, ceil, comb, erf, log, log2, pi, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import discard, materialise
from .components import components

COSINE, DIRECTIONS, WINDOW, RECALL = 0.93, 32, 0.5, 0.99
#: Vectors of a cell that the number of signs aims at, and of a tile.
CELL, TILE = 512, 1024
#: Collisions that are summed at once, at most but for a single row: left rows by right rows by directions.
EMITTED = 1 << 23
SEED = 11


def least_count(cosine: float, directions: int = DIRECTIONS, window: float = WINDOW, recall: float = RECALL) -> int:
    """The largest count that a pair at ``cosine`` reaches with probability ``recall``: projections of its difference are normal."""
    p = erf(window / sqrt(2 - 2 * cosine) / sqrt(2)) if cosine < 1 else 1.0
    below = 0.0
    for count in range(directions + 1):
        below += comb(directions, count) * p**count * (1 - p) ** (directions - count)
        if below > 1 - recall:
            return count
    return directions


def tables_for(cosine: float, signs: int, recall: float = RECALL) -> int:
    """Tables of ``signs`` signs each so that a pair at ``cosine`` shares a cell of one with probability ``recall``."""
    if not signs:
        return 1
    together = (1 - acos(min(cosine, 1.0)) / pi) ** signs
    return 1 if together >= recall else ceil(log(1 - recall) / log(1 - together))


def directions(dim: int, n: int, salt: int) -> np.ndarray:
    return np.random.default_rng([SEED, salt, dim]).standard_normal((dim, n))


def unit(rows: Iterable) -> np.ndarray:
    x = np.array([np.asarray(r, np.float64) for r in rows])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def collisions(left: np.ndarray, right: np.ndarray, window: float, least: int = 1, same: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(left row, right row, count) of pairs that collide on ``least`` columns or more; ``same``: only right rows behind the left one.

    Each column of the right side is sorted once, and the window of a left row is a range of that order. Every column gives
    (left row, window neighbour) pairs, which are sorted and summed, some left rows at a time: pairs that no window
    brings together are never looked at, and memory is bounded by the windows of those rows.
    """
    order = np.argsort(right, axis=0).T
    values = np.take_along_axis(right.T, order, axis=1)
    order = order.astype(np.int32)
    low = np.array([np.searchsorted(v, a - window) for v, a in zip(values, left.T, strict=True)])
    high = np.array([np.searchsorted(v, a + window, side="right") for v, a in zip(values, left.T, strict=True)])
    step = max(1, EMITTED // max(1, right.size))
    for at in range(0, len(left), step):
        emitted = []
        for own, a, b in zip(order, low[:, at : at + step], high[:, at : at + step], strict=True):
            size = b - a
            row = np.repeat(np.arange(len(size), dtype=np.int32), size)
            neighbour = own[np.arange(len(row)) + np.repeat(a - np.cumsum(size) + size, size)]
            if same:
                behind = neighbour > row + at
                row, neighbour = row[behind], neighbour[behind]
            emitted.append(row * np.int32(len(right)) + neighbour)
        pair, count = np.unique(np.concatenate(emitted), return_counts=True)
        pair, count = pair[count >= least], count[count >= least]
        yield at + pair // len(right), pair % len(right), count


def linked_pairs(left: np.ndarray, right: np.ndarray, same: bool, cosine: float, window: float, n: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of pairs whose collision count passes and whose cosine reaches the threshold."""
    lines = directions(left.shape[1], n, 1)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for i, j, _ in collisions(left @ lines, right @ lines, window, least, same):
        for at in range(0, len(i), 1 << 16):
            a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            keep = (left[a] * right[b]).sum(axis=1) >= cosine
            found.append((a[keep], b[keep]))
    i, j = zip(*found, strict=True)
    return np.concatenate(i), np.concatenate(j)


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least position of every position's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        after = label.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def collision_links(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, n_directions: int = DIRECTIONS, window: float = WINDOW, recall: float = RECALL, cell: int = CELL, tile: int = TILE) -> DataFrame:
    """One row per input row: id, n_links (other rows linked directly), component_id (least id reachable), kept (id = component_id).

    Rows with equal, non-null labels link when the cosine of their vectors, in double precision, reaches ``cosine``.
    Vectors that are null, empty, all zero or hold null or non-finite components link with nothing, nor do vectors of
    different lengths. Equal vectors of a label are one class: they count in each other's n_links but are compared as one,
    so that a vector in a third of all rows makes no pairs. A link between classes is found with probability
    about ``recall`` squared or more at the threshold, and higher above it; none below the threshold is reported.
    Repeated ids keep their rows, and null ids are passed over as component_id (kept is false for them). Extra
    columns are not read; an empty table gives an empty result.
    """
    given = vectors.schema[vector_col].dataType.simpleString()
    held = given if given == "array<float>" else "array<double>"  # singles stay as narrow as they are; all arithmetic is in doubles
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast(held).alias("v"))
    sound = F.coalesce(
        F.col("label").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0),
        F.lit(False),
    )
    digest = F.sha2(F.concat_ws(",", F.transform("v", lambda x: F.hex(F.xxhash64(x)))), 256)  # equal vectors meet by it, never by their components
    rows = rows.withColumn("sound", sound).withColumn("digest", F.when(F.col("sound"), digest))
    classes = materialise(
        rows.where("sound").groupBy("label", "digest").agg(F.count("*").alias("n"), F.min("id").alias("least"), F.first("v").alias("v")).withColumn("node", F.monotonically_increasing_id()), "vectors"
    )
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    signs = min(30, max(0, ceil(log2(max(largest, 1) / cell))))  # cells are integers; 30 signs are met by 5e11 vectors of a label
    tables = tables_for(cosine, signs, recall)
    least = least_count(cosine, n_directions, window, recall)
    kind = classes.schema["label"].dataType.simpleString()

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(signs, dtype=np.int64)
        for batch in batches:
            vectors = batch.column("v").to_pylist()
            cells: list[list[int]] = [[]] * len(vectors)
            for dim in {len(v) for v in vectors}:
                at = [k for k, v in enumerate(vectors) if len(v) == dim]
                bits = (unit(vectors[k] for k in at) @ directions(dim, tables * signs, 2)) > 0
                for k, own in zip(at, (bits.reshape(len(at), tables, signs) @ weights).tolist(), strict=True):
                    cells[k] = own
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int32()))], [*batch.schema.names, "cells"])

    dealt = classes.select("node", "label", "n", "v").mapInArrow(deal, f"node long, label {kind}, n long, v {held}, cells array<int>")
    dealt = materialise(dealt, "cells")
    placed = dealt.select("*", F.size("v").alias("dim"), F.posexplode("cells").alias("table", "cell")).withColumn("cells", F.slice("cells", F.lit(1), F.col("table")))
    where = ["label", "dim", "table", "cell"]
    large = placed.groupBy(*where).count().where(F.col("count") > tile).select(*where, F.ceil(F.col("count") / tile).cast("long").alias("tiles"))
    cut = placed.join(large, where, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("node"), F.col("tiles")))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    cut = cut.withColumn("ti", F.least("own", "other")).withColumn("tj", F.greatest("own", "other"))

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        table, ti, tj = int(key[2]), int(key[4]), int(key[5])
        group = group.sort_values("node", kind="stable")
        own = group["own"].to_numpy()
        a = np.flatnonzero(own == ti)
        b = a if ti == tj else np.flatnonzero(own == tj)
        none = pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64), "n": np.zeros(0, np.int64)})
        if len(a) == 0 or len(b) == 0 or len(group) < 2:
            return none
        x = unit(group["v"])
        i, j = linked_pairs(x[a], x[b], ti == tj, cosine, window, n_directions, least)
        i, j = a[i], b[j]
        if table and len(i):  # a pair belongs to the first table that brings it together
            cells = np.array([np.asarray(c) for c in group["cells"]])
            first = np.zeros(len(i), bool)
            for at in range(0, len(i), 1 << 16):
                part = slice(at, at + (1 << 16))
                first[part] = ~(cells[i[part]] == cells[j[part]]).any(axis=1)
            i, j = i[first], j[first]
        if not len(i):
            return none
        size = group["n"].to_numpy()
        degree = np.bincount(i, size[j], len(group)) + np.bincount(j, size[i], len(group))
        node, root = group["node"].to_numpy(), roots(len(group), i, j)
        at = np.flatnonzero(degree)
        return pd.DataFrame({"a": node[at], "b": node[root[at]], "n": degree[at].astype(np.int64)})

    found = materialise(cut.select("node", "n", "v", "cells", "own", *where, "ti", "tj").groupBy(*where, "ti", "tj").applyInPandas(compare, "a long, b long, n long"), "pairs")
    discard(dealt)
    degree = found.groupBy("a").agg(F.sum("n").alias("linked"))
    joined = components(found.select("a", "b"))
    rooted = classes.join(degree, F.col("node") == F.col("a"), "left").drop("a")
    rooted = rooted.join(joined.withColumnRenamed("node", "k"), F.col("node") == F.col("k"), "left").withColumn("root", F.coalesce("component", "node"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("label", "digest", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id")
    out = rows.where("sound").join(named, ["label", "digest"]).select("id", "n_links", "component_id")
    out = out.unionByName(rows.where("not sound").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
