"""Collocations from sorted count streams: phrases whose words stand together more often than their parts explain.

Phrases are counted by length, and only where their parts are frequent: a bitmap of fixed size, which may err on the safe side
only, tells tasks what the passes before found. The counts are then kept in two layouts. In prefix order a phrase
follows its beginnings and precedes its extensions to the right; in suffix order (words from last to first) the same holds
for its ends and extensions to the left. One pass over either stream, with a stack of at most three phrases, gives all left
counts, right counts and extension counts; the two streams then meet in a merge join.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .base import arrow_rows, blocks, discard, materialise, mix, text_bytes

LEAST_COUNT, LONGEST, TOP = 30, 4, 2000
UNKNOWN = "und"
#: Bits of the bitmap of frequent words and pairs that goes to the executors (8 MB), whatever their number.
BITMAP = 1 << 26
#: Text bytes that are counted at once.
BLOCK = 2 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_HARD = np.array([b in b".,;:!?\n\x0b\x0c\r" for b in range(256)])
_GAP = _HARD | np.array([b in b" \t" for b in range(256)])
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
GRAM = "lang string, phrase string, words int, f long"


def word_hashes(langs: list[str], words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words under their languages."""
    seeds = {x: xxhash.xxh64_intdigest(x.encode()) for x in set(langs)}
    return np.array([xxhash.xxh64_intdigest(w, seeds[x]) for x, w in zip(langs, words, strict=True)], np.uint64)


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of pairs from those of their words."""
    return mix(a * _STEP + b)


class Block:
    """Words of some texts in order: each one's number among the block's distinct words, its piece and its text."""

    def __init__(self, texts: list[bytes]):
        data = _LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
        gap = _GAP[data]
        step = np.diff(gap.view(np.int8), prepend=np.int8(1), append=np.int8(1))
        start, end = np.flatnonzero(step == -1), np.flatnonzero(step == 1)
        self.piece = np.cumsum(_HARD[data], dtype=np.int32)[start]
        offsets = np.cumsum([len(x) + 1 for x in texts], dtype=np.int64)
        self.text = np.searchsorted(offsets, start, side="right")
        places = np.zeros(len(start) + 1, np.int32)
        np.cumsum(end - start, out=places[1:])
        words = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(places), pa.py_buffer(data[~gap])]).dictionary_encode()
        self.word, self.dictionary = words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary


class Counts:
    """Phrases of one block, from words on by length: their numbers, first places and counts."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        self.block = Block(texts)
        codes, names = pd.factorize(np.array([*langs, ""], object))
        self.names = names
        self.code = codes[self.block.text]
        self._number(1, self.code * max(len(self.block.dictionary), 1) + self.block.word, np.arange(len(self.block.word)))
        self.single = self.number

    def _number(self, words: int, keys: np.ndarray, at: np.ndarray) -> None:
        number, distinct = pd.factorize(keys)
        self.words, self.at, self.number = words, at, number
        self.n = np.bincount(number, minlength=len(distinct))
        self.first = np.zeros(len(distinct), np.int64)
        self.first[number[::-1]] = at[::-1]

    def longer(self, keep: np.ndarray | None = None) -> None:
        """Go on to phrases one word longer; both parts of the present length must be in ``keep``, a mask by phrase (None: any)."""
        piece, size = self.block.piece, self.words
        place = np.full(len(piece) + 1, -1, np.int64)
        good = slice(None) if keep is None else keep[self.number]
        place[self.at[good]] = self.number[good]
        at = np.flatnonzero((place[:-1] >= 0) & (place[1:] >= 0))
        at = at[at + size < len(piece)]
        at = at[piece[at] == piece[at + size]]
        self._number(size + 1, place[at] * max(len(self.n), 1) + place[at + 1], at)

    def langs(self) -> list[str]:
        return self.names[self.code[self.first]].tolist()

    def table(self) -> pa.RecordBatch:
        """The phrases with their counts, as ``GRAM``."""
        parts = [self.block.dictionary.take(pa.array(self.block.word[self.first + k])) for k in range(self.words)]
        phrase = parts[0] if self.words == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()))
        return pa.RecordBatch.from_arrays([pa.array(self.langs(), pa.string()), phrase.cast(pa.string()), pa.array(np.full(len(self.n), self.words, np.int32)), pa.array(self.n.astype(np.int64))], ["lang", "phrase", "words", "f"])

    def word_hashes(self) -> np.ndarray:
        """Of the words, before ``longer``."""
        return word_hashes(self.langs(), self.block.dictionary.take(pa.array(self.block.word[self.first])).to_pylist())


def bitmap(grams: DataFrame) -> np.ndarray:
    """A bitmap of fixed size of the words or pairs of a ``GRAM`` table."""

    def places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, 65_536):
            langs, parts = batch.column("lang").to_pylist(), [x.split(b" ") for x in text_bytes(batch.column("phrase"))]
            h = word_hashes(langs, [x[0] for x in parts])
            two = np.array([len(x) == 2 for x in parts], bool)
            if two.any():
                h[two] = joined(h[two], word_hashes([x for x, t in zip(langs, two, strict=True) if t], [x[1] for x in parts if len(x) == 2]))
            yield pa.RecordBatch.from_arrays([pa.array((h % np.uint64(BITMAP)).astype(np.int64))], ["place"])

    placed = grams.select("lang", "phrase").mapInArrow(places, "place long")
    parts = placed.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).collect()  # at most BITMAP / 32,768 rows of 4 KB
    bits = np.zeros(BITMAP, np.uint8)
    for part in parts:
        one = np.unpackbits(np.frombuffer(part.bits, np.uint8), bitorder="little")
        at = (part.bucket - 1) * len(one) + 1  # Spark's buckets begin at position 1
        bits[max(at, 0) : at + len(one)] |= one[max(-at, 0) : BITMAP - at]
    return np.packbits(bits)


def found(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    spot = (h % np.uint64(BITMAP)).astype(np.int64)
    return (bits[spot >> 3] >> (7 - (spot & 7)) & 1).astype(bool)


def counted(rows: DataFrame, known: list) -> DataFrame:
    """Phrases of ``rows`` (lang, text) as ``GRAM``, summed: words if nothing is ``known``, pairs of the words in its first bitmap, and phrases of three and four words whose pairs are in its second."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_rows(batches, 1024):
            texts, langs = text_bytes(batch.column("text")), batch.column("lang").to_pylist()
            for a, b in blocks(texts, BLOCK):
                grams = Counts(texts[a:b], langs[a:b])
                if not known:
                    yield from arrow_rows([grams.table()], 32_768)
                    continue
                h, single = grams.word_hashes(), grams.single
                grams.longer(found(known[0].value, h))
                if len(known) == 1:
                    yield from arrow_rows([grams.table()], 32_768)
                    continue
                grams.longer(found(known[1].value, joined(h[single[grams.first]], h[single[grams.first + 1]])))
                while True:
                    yield from arrow_rows([grams.table()], 32_768)
                    if grams.words == LONGEST:
                        break
                    grams.longer()

    return rows.mapInArrow(count, GRAM).groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))


def stream(grams: DataFrame, singles: DataFrame, backward: bool) -> DataFrame:
    """(lang, phrase, words, f, parts, beyond) of phrases of two words and more, from one pass over their sorted stream.

    parts are the counts of the phrase's first one, two, ... words (its last ones, if ``backward``); beyond is the largest count of
    a phrase that has one word more at the other end. Phrases are dealt by their two outermost words and sorted by
    words; counts of single words come by a merge join, so that no frequent word gathers its phrases in one task.
    """
    words = F.split("phrase", " ")
    words = F.reverse(words) if backward else words
    keys = [f"g{k + 1}" for k in range(LONGEST)]
    laid = grams.select("lang", "phrase", "words", "f", *[F.get(words, F.lit(k)).alias(c) for k, c in enumerate(keys)])
    pairs = laid.where("words = 2").hint("merge").join(singles.select("lang", F.col("phrase").alias("g1"), F.col("f").alias("outer")), ["lang", "g1"])
    laid = pairs.unionByName(laid.where("words > 2").withColumn("outer", F.lit(None).cast("long")))
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("f", pa.int64()), ("parts", pa.list_(pa.int64())), ("beyond", pa.int64())])

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[list] = []  # each one begins with the one before: [lang, words, phrase, f, parts, beyond]
        out: list[tuple] = []

        def close(lang: str | None, own: list[str]) -> None:
            while open_ and (open_[-1][0] != lang or open_[-1][1] != own[: len(open_[-1][1])]):
                x = open_.pop()
                out.append((x[0], x[2], len(x[1]), x[3], x[4], x[5]))

        def flush() -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [()] * len(schema)
            made = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema)
            out.clear()
            return made

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("lang", "phrase", "words", "f", "outer", *keys)]
            for lang, phrase, n, f, outer, *own in zip(*columns, strict=True):
                close(lang, own[:n])
                parts = [*open_[-1][4], open_[-1][3]] if open_ else [outer]
                if open_:
                    open_[-1][5] = max(open_[-1][5], f)
                open_.append([lang, own[:n], phrase, f, parts, 0])
            yield flush()
        close(None, [])
        yield flush()

    dealt = laid.repartition("lang", "g1", "g2").sortWithinPartitions("lang", *keys)
    return dealt.select("lang", "phrase", "words", "f", "outer", *keys).mapInArrow(walk, "lang string, phrase string, words int, f long, parts array<long>, beyond long")


def exact(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def collocations(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = LEAST_COUNT, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of two to four words.

    Texts are lower-cased (A to Z), split into pieces at ``. , ; : ! ?`` and line ends, and pieces into words at spaces and tabs.
    a counts a phrase, l and r the two parts of the cut of least score floor(2000000 * a / (l + r)), ties to the first cut; n
    counts all words of the language. A phrase within a longer one of at least ``least`` occurrences that has 80 % of its count
    goes. Null texts are empty, a null language is ``und``; repeated rows count each; a language without words gives no
    rows; ids and extra columns are not read; an empty table gives no rows. Ties in rank are broken by score, a, phrase.

    Whole texts are read three times. A bitmap of frequent words and one of frequent pairs, 8 MB each, go to the executors.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).alias("text")).where("text is not null")
    words = materialise(counted(rows, []), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    singles = words.where(F.col("f") >= least)
    known = [spark.sparkContext.broadcast(bitmap(singles))]
    pairs = materialise(counted(rows, known).where(F.col("f") >= least), "pairs")
    known.append(spark.sparkContext.broadcast(bitmap(pairs)))
    grams = pairs.unionByName(materialise(counted(rows, known).where(F.col("f") >= least), "phrases"))
    forward = stream(grams, singles, False).withColumnsRenamed({"parts": "begins", "beyond": "right"})
    backward = stream(grams, singles, True).select("lang", "phrase", F.col("parts").alias("ends"), F.col("beyond").alias("left"))
    both = forward.hint("merge").join(backward, ["lang", "phrase"])
    a = exact(F.col("f"))
    cuts = []
    for k in range(1, LONGEST):
        both = both.withColumns({f"l{k}": F.get("begins", F.lit(k - 1)), f"r{k}": F.get("ends", F.col("words") - k - 1)}).withColumns({f"x{k}": a * 2_000_000, f"y{k}": exact(F.col(f"l{k}")) + exact(F.col(f"r{k}"))})
        cuts.append(F.when(F.col("words") > k, F.struct(F.expr(f"x{k} div y{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))))
    kept = both.where(exact(F.greatest("left", "right")) * 100 < a * 80).withColumn("cut", F.array_min(F.array_compact(F.array(*cuts))))
    best = kept.select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "cut.score")
    order = W.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
), places AS (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, 5) r(k) WHERE len(w) >= k
), grams AS (
  SELECT lang, k, array_to_string(w[i:i+k-1], ' ') AS phrase, count(*) AS f FROM places GROUP BY ALL HAVING count(*) >= 30
), candidates AS (
  SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM grams WHERE k > 1
), halves AS (
  SELECT lang, phrase, f, j, array_to_string(w[1:j], ' ') AS head, array_to_string(w[j+1:], ' ') AS tail FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates)
), cuts AS (
  SELECT h.lang, h.phrase, h.f AS a, x.f AS l, y.f AS r, j, ((2000000::HUGEINT * h.f) // (x.f + y.f))::BIGINT AS score
  FROM halves h JOIN grams x ON x.lang = h.lang AND x.phrase = h.head JOIN grams y ON y.lang = h.lang AND y.phrase = h.tail
), least AS (
  SELECT lang, phrase, min((score, j, l, r, a)) AS m FROM cuts GROUP BY lang, phrase
), inside AS (
  SELECT lang, array_to_string(w[i:i+m-1], ' ') AS phrase, f FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM candidates))
), covered AS (
  SELECT lang, phrase, max(f) AS f FROM inside GROUP BY lang, phrase
), ranked AS (
  SELECT lang, phrase, m[5] AS a, m[3] AS l, m[4] AS r, m[1] AS score, row_number() OVER (PARTITION BY lang ORDER BY m[1] DESC, m[5] DESC, encode(phrase)) AS rank
  FROM least LEFT JOIN covered USING (lang, phrase) WHERE f IS NULL OR 100::HUGEINT * f < 80::HUGEINT * m[5]
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
