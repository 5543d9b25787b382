"""Spelling variants: words one edit apart, found by dynamic programming over sorted lists.

The vocabulary is dealt to blocks of words that share what lies outside an interval: two words one edit apart differ in one half of
the shorter one only, so they meet in the block of that half. Inside a block the remaining letters are sorted, and each word
scans the list with the rows of a banded edit matrix: rows of the letters that neighbours share are kept, and where every
cell of a row exceeds one edit, all words with that prefix are passed over at once. Blocks that hold too many words
are dealt again with half the interval, down to one letter, so that no pair is lost and no block is large.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import arrow_rows, discard, materialise, text_bytes

LEAST_LENGTH, LEAST_COUNT, TIMES = 6, 5, 5
#: One in so many runs of a document loses a letter.
TYPO = 199
#: Words of a block, beyond which it is dealt again.
BLOCK = 4096
_RUN = re.compile("[a-zÀ-ÿ]+")
_OVER = 2
_LAST = "￿"


def run_counts(doc_id: str, text: bytes, least: int = LEAST_LENGTH) -> Iterator[tuple[str, int]]:
    """(word, count) of a text's runs of letters, with the planned deletions; shorter words are left out."""
    seed = zlib.crc32(doc_id.encode() + b":")
    for run, n in Counter(_RUN.findall(text.lower().decode())).items():  # bytes lower A to Z only
        if len(run) >= least:
            h = zlib.crc32(run.encode(), seed)
            if h % TYPO == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least:
                yield run, n


def shared(a: str, b: str) -> int:
    """Letters that two words begin with alike."""
    k, n = 0, min(len(a), len(b))
    while k < n and a[k] == b[k]:
        k += 1
    return k


def scan(words: list[str], prefix: list[int], query: str) -> Iterator[int]:
    """Places in a sorted list of distinct words, none shorter than the query, that are exactly one edit from it.

    prefix[i] is the number of letters that word i shares with the one before. Rows hold the cells next to the diagonal.
    """
    n, m = len(words), len(query)
    rows = [(_OVER, 0, 1)]
    i = depth = 0
    while i < n:
        word = words[i]
        del rows[depth + 1 :]
        x, y, z = rows[depth]
        size = len(word)
        while depth < size:
            c = word[depth]
            left = min(x + (c != query[depth - 1]) if 0 < depth <= m else _OVER, y + 1)
            same = min(y + (c != query[depth]), z + 1, left + 1) if depth < m else _OVER
            right = min(z + (c != query[depth + 1]), same + 1) if depth + 1 < m else _OVER
            x, y, z = left, same, right
            depth += 1
            rows.append((x, y, z))
            if x > 1 and y > 1 and z > 1:
                break
        else:
            if (y if size == m else x if size == m + 1 else _OVER) == 1:
                yield i
            i += 1
            depth = prefix[i] if i < n else 0
            continue
        i = bisect_left(words, word[:depth] + _LAST, i + 1)
        depth = prefix[i] if i < n else 0


def block_pairs(parts: list[str], length: int, last: bool) -> Iterator[tuple[int, int]]:
    """Pairs of places in a block: ``parts`` are the sorted letters inside the interval, of ``length`` or one more.

    A letter put in can stand at several places of a run of equal ones; it counts at the last of them, which
    belongs to this block unless all of the shorter part comes before it and intervals follow (``last`` is false).
    """
    prefix = [0] + [shared(a, b) for a, b in zip(parts, parts[1:], strict=False)]
    for i, query in enumerate(parts):
        if len(query) == length:
            for j in scan(parts, prefix, query):
                if len(parts[j]) == length:
                    if j > i:
                        yield i, j
                elif last or not parts[j].startswith(query):
                    yield i, j


def near_pairs(vocabulary: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """(word, n, other, other_n) of all words of ``vocabulary`` (distinct word, n) that are one edit apart, in both directions."""
    length = F.length("word")
    sizes = F.array(length, length - 1)
    cells = vocabulary.select("word", "n", F.explode(sizes).alias("m")).where(F.col("m") >= LEAST_LENGTH)
    half = F.floor(F.col("m") / 2).cast("int")
    interval = lambda a, b: F.struct(a.alias("lo"), b.alias("hi"))
    cells = cells.withColumn("i", F.explode(F.array(interval(F.lit(0), half), interval(half, F.col("m"))))).select("word", "n", "m", "i.lo", "i.hi")
    more = length - F.col("m")
    tail = F.expr("substring(word, hi + length(word) - m + 1)")
    key = F.concat_ws(":", "m", "lo", "hi", F.expr("substring(word, 1, lo)"), tail)
    keyed, settled, scratch = cells.withColumn("key", key), None, []
    while True:
        large = materialise(keyed.where("hi - lo > 1").groupBy("key").count().where(F.col("count") > block).select("key"), "large-blocks")
        scratch.append(large)
        if large.isEmpty():
            break
        small = keyed.join(large, "key", "left_anti")
        settled = small if settled is None else settled.unionByName(small)
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        again = keyed.join(large, "key", "left_semi").withColumn("i", F.explode(F.array(interval(F.col("lo"), middle), interval(middle, F.col("hi"))))).select("word", "n", "m", "i.lo", "i.hi")
        keyed = again.withColumn("key", key)
    keyed = keyed if settled is None else settled.unionByName(keyed)
    part = F.expr("substring(word, lo + 1, hi - lo + length(word) - m)")
    rows = keyed.select("key", part.alias("part"), (F.col("hi") - F.col("lo")).alias("length"), (F.col("hi") == F.col("m")).alias("last"), "word", "n")

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("other", pa.string()), ("other_n", pa.int64())])
        now, held = None, []
        out: list[tuple] = []

        def close() -> None:
            if len(held) > 1:
                for i, j in block_pairs([r[0] for r in held], held[0][1], held[0][2]):
                    a, b = held[i][3:], held[j][3:]
                    out.append((*a, *b))
                    out.append((*b, *a))

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True) if out else [()] * 4, schema, strict=True)], schema=schema)
            out.clear()
            return made

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "part", "length", "last", "word", "n")]
            for k, *row in zip(*columns, strict=True):
                if k != now:
                    close()
                    now, held = k, []
                held.append(row)
            if len(out) > 50_000:
                yield flush()
        close()
        yield flush()

    dealt = rows.repartition("key").sortWithinPartitions("key", "part")
    return dealt.mapInArrow(search, "word string, n long, other string, other_n long")


def spelling_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n): every word of at least 6 letters and 5 occurrences with its likelier spelling.

    Words are runs of letters of whole texts with A to Z lower-cased; one in 199 (document, run) pairs loses a letter
    first, by the crc32 of ``<id>:<run>``. Null texts have no words; a null id counts as the text 'null'; repeated rows count each;
    extra columns are not read; an empty table gives no rows. A word's form is the near word (one letter put in, deleted or
    replaced) of largest n, ties by the least in code points, if its n is at least five times the word's; root
    follows forms to the last one.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id"), F.col(text_col).alias("text")).where("text is not null")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.int64())], ["word", "n"])
            totals.clear()
            return made

        for batch in arrow_rows(batches, 512):
            for i, text in zip(batch.column("id").to_pylist(), text_bytes(batch.column("text")), strict=True):
                for word, n in run_counts(i, text):
                    totals[word] += n
            if len(totals) > 300_000:
                yield flush()
        yield flush()

    counted = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)
    vocabulary = materialise(counted, "vocabulary")
    near = near_pairs(vocabulary, block=block).groupBy("word").agg(F.first("n").alias("own"), F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))).alias("best"))
    better = -F.col("best.n") >= TIMES * F.col("own")
    near = materialise(near.select("word", "n_near", F.when(better, F.col("best.word")).alias("form"), F.when(better, -F.col("best.n")).alias("form_n")), "near-words")
    roots = materialise(near.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:  # every round follows twice as many forms; n grows fivefold with each, so rounds are few
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = materialise(roots.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        discard(roots)
        moved = not after.where("moved").isEmpty()
        roots = after.drop("moved")
        if not moved:
            break
    out = vocabulary.join(near, "word", "left").join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


#: Letters beyond ASCII as single bytes, so that a byte edit is a letter edit.
_LETTERS = "".join(chr(c) for c in range(0xC0, 0x100))
_BYTES = "".join(f"chr({c})||" for c in (*range(1, 32), *range(33, 65), 91)).removesuffix("||")
ORACLE = rf"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
), counts AS (
  SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL
), bytes AS (
  SELECT run, n, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, 'null') || ':' || run, ''), lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)] ELSE [195, unicode(ch) - 64] END)) AS b FROM counts
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda h, x: xor(h >> 8, t[(xor(h & 255, x) + 1)::INT])), 4294967295) AS h FROM bytes, crc_table
), words AS (
  SELECT CASE WHEN h % 199 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed
), vocabulary AS (
  SELECT word, sum(n)::BIGINT AS n, translate(word, '{_LETTERS}', {_BYTES}) AS flat FROM words WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM vocabulary a JOIN vocabulary b ON abs(length(a.word) - length(b.word)) <= 1 AND a.word <> b.word WHERE levenshtein(a.flat, b.flat) = 1
), near AS (
  SELECT word, count(*) AS n_near, min((-other_n, other)) AS best, any_value(n) AS n FROM pairs GROUP BY word
), forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= 5 * v.n THEN best[2] END AS form, CASE WHEN -best[1] >= 5 * v.n THEN -best[1] END AS form_n FROM vocabulary v LEFT JOIN near USING (word)
), chain AS (
  SELECT word, word AS root, form AS further FROM forms
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.further
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, root FROM chain WHERE further IS NULL) USING (word)
"""
