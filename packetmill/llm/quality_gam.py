"""Quality classifier: a generalised additive model with pairwise interactions, boosted cyclically.

Every feature is cut into bins; boosting goes round the features, each time fitting a tree of at most three leaves
on the bins of one feature, so that a feature ends up with one lookup table. Then the pairs that promise most get
two-dimensional tables from trees with one cut on either axis. A score is the sum of lookups.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Words, arrow_rows, blocks, fold, text_bytes

THRESHOLD, FOLDS = 0.3, 5
#: Most labelled rows that a model is fitted on: those with the least hashes of their ids.
SAMPLE = 20_000
NAMES = ("bytes", "words", "word_length", "upper", "digit", "full_stop", "comma", "exclamation", "bar", "symbol", "other_mark", "line", "beyond_ascii", "distinct_words", "distinct_shingles")
_LOWER, _UPPER, _DIGIT, _SPACE, _LINE, _STOP, _COMMA, _EXCLAIM, _BAR, _SYMBOL, _OTHER, _BEYOND = range(12)


def _classes() -> np.ndarray:
    out = np.full(256, _OTHER)
    out[97:123], out[65:91], out[48:58], out[128:] = _LOWER, _UPPER, _DIGIT, _BEYOND
    out[[32, 9, 13, 0]] = _SPACE
    for code, chars in ((_LINE, "\n"), (_STOP, "."), (_COMMA, ","), (_EXCLAIM, "!"), (_BAR, "|"), (_SYMBOL, "#$%&*@~^<>{}[]\\/_=+`")):
        out[[ord(c) for c in chars]] = code
    return out


_CLASS = _classes()


def features(texts: list[bytes]) -> np.ndarray:
    """One row of ``NAMES`` per text; an empty text has zeros, but ones for distinct shares."""
    n = len(texts)
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    count = np.bincount(np.repeat(np.arange(n) * 12, sizes) + _CLASS[data], minlength=12 * n).reshape(n, 12).astype(float)
    block = Words([t.lower() for t in texts])
    words = np.diff(block.first)
    per = np.maximum(words, 1)
    lengths = np.concatenate(([0], np.cumsum(block.end - block.start)))
    shingles, whole = block.shingles(4)
    distinct, varied = np.ones(n), np.ones(n)
    for i, (a, b) in enumerate(zip(block.first[:-1].tolist(), block.first[1:].tolist(), strict=True)):
        if b - a > 1:
            distinct[i] = len(np.unique(block.hash[a:b])) / (b - a)
        if b - a > 4:
            varied[i] = len(np.unique(shingles[a : b - 3])) / (b - a - 3)
    letters = np.maximum(count[:, _LOWER] + count[:, _UPPER] + count[:, _BEYOND], 1)
    size = np.maximum(sizes, 1)
    columns = [np.log1p(sizes), np.log1p(words), (lengths[block.first[1:]] - lengths[block.first[:-1]]) / per, count[:, _UPPER] / letters, count[:, _DIGIT] / size]
    columns += [count[:, c] / per for c in (_STOP, _COMMA, _EXCLAIM, _BAR, _SYMBOL, _OTHER, _LINE)] + [count[:, _BEYOND] / size, distinct, varied]
    return np.stack(columns, axis=1)


@dataclass
class Gam:
    """Bin edges per feature, one table per feature, and (feature, feature, coarse edges, coarse edges, table) per pair."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]
    intercept: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, j], side="right")]
        for a, b, ea, eb, table in self.pairs:
            total += table[np.searchsorted(ea, x[:, a], side="right"), np.searchsorted(eb, x[:, b], side="right")]
        return 1 / (1 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts at quantiles of all values, and at quantiles of those other than the commonest one, which may be most of them.

    Cuts stand halfway between neighbouring values, so that unseen ones fall to the nearer side.
    """
    seen, count = np.unique(values, return_counts=True)
    rest = values[values != seen[count.argmax()]]
    at = np.linspace(0, 1, bins + 1)[1:-1]
    after = np.searchsorted(seen, np.concatenate([np.quantile(v, at) for v in (values, rest) if len(v)]), side="right")
    after = np.unique(np.concatenate((after, after - 1)).clip(1, len(seen) - 1)) if len(seen) > 1 else after[:0]
    return (seen[after - 1] + seen[after]) / 2


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Newton steps of a tree over ordered bins: the best cut, then the best cut of either side."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for k, (a, b) in enumerate(parts):
            if b - a > 1:
                left_g, left_h = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
                all_g, all_h = g[a:b].sum(), h[a:b].sum()
                gain = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h) - _gain(all_g, all_h)
                if gain.max() > best[0]:
                    best = (gain.max(), k, a + 1 + int(gain.argmax()))
        if best[1] is None:
            break
        a, b = parts[best[1]]
        parts[best[1] : best[1] + 1] = [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1.0)
    return out


def _crossed_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and Newton steps of the best cut on both axes of a grid."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    best = (0.0, np.zeros_like(g))
    whole = _gain(cg[-1, -1], ch[-1, -1])
    if min(g.shape) < 2:
        return best
    quadrants = [(c[:-1, :-1], c[:-1, -1:] - c[:-1, :-1], c[-1:, :-1] - c[:-1, :-1], c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + c[:-1, :-1]) for c in (cg, ch)]
    gain = sum(_gain(a, b) for a, b in zip(*quadrants, strict=True)) - whole
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    steps = np.empty_like(g)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for cols in (slice(0, j + 1), slice(j + 1, None)):
            steps[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + 1.0)
    return float(gain.max()), steps


def train(x: np.ndarray, y: np.ndarray, *, bins: int = 32, rounds: int = 60, rate: float = 0.25, n_pairs: int = 5, pair_bins: int = 8, pair_rounds: int = 20) -> Gam:
    """Cyclic boosting of main tables, then of the tables of the ``n_pairs`` most promising pairs; no rows give a constant one half."""
    n, width = x.shape
    if not n:
        return Gam([np.zeros(0)] * width, [np.zeros(1)] * width, [], 0.0)
    share = np.clip(y.mean(), 0.01, 0.99)
    edges = [_edges(x[:, j], bins) for j in range(width)]
    place = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    intercept = float(np.log(share / (1 - share)))
    total = np.full(n, intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j in range(width):
            g, h = slopes()
            step = rate * _shallow_tree(np.bincount(place[j], g, len(tables[j])), np.bincount(place[j], h, len(tables[j])))
            tables[j] += step
            total += step[place[j]]
    coarse = [_edges(x[:, j], pair_bins) for j in range(width)]
    spot = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(coarse)]

    def grid(a: int, b: int, values: np.ndarray) -> np.ndarray:
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        return np.bincount(spot[a] * shape[1] + spot[b], values, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    promise = sorted(((_crossed_tree(grid(a, b, g), grid(a, b, h))[0], a, b) for a in range(width) for b in range(a)), reverse=True)[:n_pairs]
    pairs = [(a, b, coarse[a], coarse[b], np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1))) for _, a, b in promise]
    for _ in range(pair_rounds):
        for a, b, _, _, table in pairs:
            g, h = slopes()
            step = rate * _crossed_tree(grid(a, b, g), grid(a, b, h))[1]
            table += step
            total += step[spot[a], spot[b]]
    return Gam(edges, tables, pairs, intercept)


def _featured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches):
            texts = text_bytes(batch.column("text"))
            x = np.concatenate([features(texts[a:b]) for a, b in blocks(texts)] or [np.zeros((0, len(NAMES)))])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(list(x), pa.list_(pa.float64()))], ["id", "x"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, x array<double>")


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Gam:
    """A model of ``label_col`` = 1 from labelled rows outside the held-out fold.

    Fitted on at most ``sample`` rows, those with the least hashes of their ids; rows without a label or text count out.
    Of an id with several labels the largest counts.
    """
    known = labels.where((fold(id_col, FOLDS) != 0) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("k")).agg(F.max(label_col).alias("y")).orderBy(F.xxhash64("k"), "k").limit(sample)
    wanted = F.broadcast(known)  # at most ``sample`` rows
    rows = _featured(docs.join(wanted, docs[id_col] == wanted.k, "left_semi"), id_col, text_col)
    found = rows.join(wanted, rows.id == wanted.k).select("id", "x", "y").orderBy("id", "x").limit(sample).toPandas()
    x = np.array(found["x"].tolist(), float).reshape(-1, len(NAMES))
    return train(x, (found["y"].to_numpy(float) == 1).astype(float))


def probabilities(texts: list[bytes], model: Gam) -> np.ndarray:
    return np.concatenate([model.score(features(texts[a:b])) for a, b in blocks(texts)] or [np.zeros(0)])


def score(docs: DataFrame, model: Gam, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, held_out (crc32 of the id as text is 0 modulo 5), score, predicted (1 from ``threshold`` on).

    Only whole texts enter a score; null counts as empty, and an empty text has a score too. Repeated rows, null
    ids and extra columns are harmless; no rows give no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(probabilities(text_bytes(batch.column("text")), model))], ["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, score double")
    return rows.select(F.col("id").alias(id_col), (fold("id", FOLDS) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep(docs: DataFrame, model: Gam, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose score reaches ``threshold``."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches):
            yield batch.filter(pa.array(probabilities(text_bytes(batch.column(at)), model) >= threshold))

    plain = docs.toDF(*names)
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
