"""Language identification: averaged hashed subword embeddings, a linear softmax, and calibrated rejection.

Subwords are the three- and four-byte pieces of lower-cased words, with a mark at either end of a word. A text's vector
is the mean of its pieces' embeddings; embeddings and softmax are trained together by stochastic gradient descent
in numpy. Since mean and softmax weights are linear, a text is scored by one table of piece scores.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .base import arrow_rows, blocks, fold, materialise, text_bytes

BUCKETS, WIDTH, FOLDS, HELD = 1 << 15, 16, 4, 2
#: Documents per language that a model is fitted on, and in all, at most: those with the least hashes of id and text.
SAMPLE, MOST = 600, 6000
UNKNOWN = "und"
_LETTER = np.array([b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)


def pieces(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every piece of lower-cased texts; pieces of three and of four bytes, none across a word's end."""
    data = _LETTER[np.frombuffer(b" " + b" ".join(texts) + b"  ", np.uint8)]
    inner = data != 32
    ends = np.cumsum([len(t) + 1 for t in texts])
    wide = data.astype(np.uint32)
    buckets, owners = [], []
    for n in (3, 4):
        m = len(data) - n + 1
        valid = inner[1 : m + 1].copy()
        value = wide[:m] | wide[1 : m + 1] << 8 | wide[2 : m + 2] << 16
        if n == 4:
            valid &= inner[2 : m + 2]
            value = value | wide[3 : m + 3] << 24
        at = np.flatnonzero(valid)
        h = (value[at] * np.uint32(2654435761)) ^ np.uint32(n * 0x9E37)
        buckets.append(((h ^ h >> np.uint32(15)) * np.uint32(2246822519) >> np.uint32(17)).astype(np.int64))
        owners.append(np.searchsorted(ends, at, side="right"))
    return np.concatenate(buckets), np.minimum(np.concatenate(owners), len(texts) - 1)


@dataclass
class Model:
    """Score of every piece for every language, the bias, the temperature, and the score below which a label is doubtful."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject: float

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Language number and calibrated probability of every lower-cased text."""
        wide = max(len(self.languages), 1)
        best, score = [np.zeros(0, np.int64)], [np.zeros(0)]
        for a, b in blocks(texts, max(1 << 14, (1 << 22) // wide)):
            bucket, owner = pieces(texts[a:b])
            count = np.maximum(np.bincount(owner, minlength=b - a), 1)
            logits = np.stack([np.bincount(owner, self.table[bucket, k], b - a) / count for k in range(wide)], axis=1) + self.bias
            p = softmax(logits / self.temperature)
            best.append(p.argmax(axis=1))
            score.append(p.max(axis=1))
        return np.concatenate(best), np.concatenate(score)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], languages: list[str], *, epochs: int = 6, rate: float = 2.0, seed: int = 5) -> Model:
    """Stochastic gradient descent over (buckets, counts, language); every fifth row calibrates temperature and rejection."""
    rng = np.random.default_rng(seed)
    n = len(languages)
    embed = rng.uniform(-1, 1, (BUCKETS, WIDTH)) / WIDTH
    weight, bias = np.zeros((WIDTH, n)), np.zeros(n)
    held = [r for i, r in enumerate(rows) if i % 5 == 4]
    used = [r for i, r in enumerate(rows) if i % 5 != 4]
    steps, done = max(epochs * len(used), 1), 0
    for _ in range(epochs):
        for k in rng.permutation(len(used)):
            bucket, count, label = used[k]
            share = count / count.sum()
            x = share @ embed[bucket]
            error = softmax(x @ weight + bias)
            error[label] -= 1
            pace = rate * (1 - done / steps)
            back = weight @ error
            weight -= pace * np.outer(x, error)
            bias -= 0.01 * pace * error
            embed[bucket] -= pace * WIDTH * share[:, None] * back
            done += 1
    table = embed @ weight
    logits = np.array([(c / c.sum()) @ table[b] + bias for b, c, _ in held]).reshape(len(held), n)
    truth = np.array([y for *_, y in held], np.int64)
    best = (np.inf, 1.0)
    for temperature in np.geomspace(0.25, 8, 41):
        if len(truth):
            p = softmax(logits / temperature)
            # one in a thousand labels is taken to be wrong, so that no temperature claims certainty
            best = min(best, (float(-np.log(0.999 * p[np.arange(len(truth)), truth] + 0.001 / n).mean() + 1e-3 / temperature), float(temperature)))
    reject = 0.0
    if len(truth):
        p = softmax(logits / best[1])
        order = np.argsort(-p.max(axis=1))
        right = np.cumsum((p.argmax(axis=1) == truth)[order]) / np.arange(1, len(truth) + 1)
        accepted = np.flatnonzero(right >= 0.99)
        reject = float(p.max(axis=1)[order][accepted[-1]]) if len(accepted) else 1.0
    return Model(languages, table, bias, best[1], reject)


def _lowered(column: pa.Array) -> list[bytes]:
    return text_bytes(pc.utf8_lower(column.cast(pa.large_string())))


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, most: int = MOST) -> Model:
    """A model from text and non-null language of documents outside the held-out fold: ``sample`` of each language and ``most`` in all, at most.

    The documents with the least hashes of id and text are taken, so that null and repeated ids neither exceed the sample nor leave a
    language out; beyond ``most`` languages those with the fewest documents are not learned.
    """
    known = docs.where((fold(id_col, FOLDS) != HELD) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    known = known.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("hash"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    languages = materialise(known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most), "languages")  # at most ``most`` rows
    sample = min(sample, max(1, most // max(languages.count(), 1)))
    place = F.row_number().over(W.partitionBy("lang").orderBy("hash"))  # every task hands on its least hashes only
    chosen = known.join(F.broadcast(languages.select("lang")), "lang").withColumn("place", place).where(F.col("place") <= sample)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches):
            keys, counts = [], []
            for text in _lowered(batch.column("text")):
                k, c = np.unique(pieces([text])[0], return_counts=True)
                keys.append(k)
                counts.append(c)
            yield pa.RecordBatch.from_arrays([batch.column("hash"), batch.column("lang"), pa.array(keys, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))], ["hash", "lang", "bucket", "count"])

    rows = chosen.select("hash", "text", "lang").mapInArrow(count, "hash long, lang string, bucket array<int>, count array<int>").where("size(bucket) > 0").toPandas()
    rows = rows.sort_values(["hash", "lang"]).sample(frac=1, random_state=3) if len(rows) else rows
    languages = sorted(set(rows["lang"]))
    number = {x: i for i, x in enumerate(languages)}
    return train([(np.asarray(b), np.asarray(c, float), number[y]) for b, c, y in zip(rows["bucket"], rows["count"], rows["lang"], strict=True)], languages)


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", rejecting: bool = False) -> DataFrame:
    """One row per input row: id, held_out (crc32 of the id as text is 2 modulo 4), lang_pred, score (calibrated probability), accepted.

    accepted says whether the score reaches the rejection level, above which 99 of 100 validation labels are right.

    Whole texts are read. lang_pred is ``und``, with score 0, for null texts and texts without a letter, and where no
    language was learned; with ``rejecting`` also where the score is below the calibrated one. Repeated rows, null
    ids and extra columns are harmless; no rows give no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    least = model.reject if rejecting else 0.0

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches):
            column = batch.column("text")
            best, score = model.predict(_lowered(column)) if model.languages else (np.zeros(len(column), np.int64), np.zeros(len(column)))
            letters = pc.fill_null(pc.match_substring_regex(column, r"\pL"), False).to_numpy(zero_copy_only=False)
            known = letters & (score >= least) & bool(model.languages)
            names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), known.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0)), pa.array(known & (score >= model.reject))], ["id", "lang_pred", "score", "accepted"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, lang_pred string, score double, accepted boolean")
    return rows.select(F.col("id").alias(id_col), (fold("id", FOLDS) == HELD).alias("held_out"), "lang_pred", "score", "accepted")
