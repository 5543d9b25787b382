"""What the operators of this subpackage share: tables, scratch tables and text buffers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT = "spark.checkpoint.dir"
#: Spark removes the shuffle files of an execution when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITTEN: ContextVar[list[DataFrame] | None] = ContextVar("written", default=None)  # by the ``settled`` at work


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` of a folder of Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one where the session names none and runs in one process only."""
    found = spark.conf.get(CHECKPOINT, None) or spark.sparkContext.getConf().get(CHECKPOINT)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT} to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='packetmill-')}"
        spark.conf.set(CHECKPOINT, found)
    return found.rstrip("/")


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here and a lost executor costs no recomputation.

    Nothing reads the shuffle files of the write again, so they go when it ends and disk holds those of one write at a time.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    if (written := _WRITTEN.get()) is not None:
        written.append(out)
    return out


def settled(make: Callable[[], DataFrame], tag: str) -> DataFrame:
    """``make()`` written as by ``materialise``; the scratch tables that it wrote on the way, which nothing reads any more, go."""
    written: list[DataFrame] = []
    token = _WRITTEN.set(written)
    try:
        out = materialise(make(), tag)
    finally:
        _WRITTEN.reset(token)
    discard(*(table for table in written if table is not out))
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialise`` that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_scratch", None)
        if not path:
            continue
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def free_name(df: DataFrame) -> str:
    """A column name that ``df`` does not have."""
    name, taken = "row", {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def numbered(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """``df`` with a number for every row under a column name that it does not have, written once so that all readers see the same numbers."""
    name = free_name(df)
    return materialise(df.withColumn(name, F.monotonically_increasing_id()), tag), name


def stable_numbers(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """``df`` with a number for every row that all scans give alike, however they are planned, under a column name that it does not have.

    Of a plain scan of Parquet files the number is the place of the row's file among the sorted paths and the row's place in that
    file, so that nothing is copied; the driver holds one entry a file, as the scan itself does. Any other table is
    written once with ``numbered``.
    """
    try:
        files = sorted(r[0] for r in df.select("_metadata.file_path").distinct().collect())
        placed = df.select("*", F.struct("_metadata.file_path", "_metadata.row_index").alias(free_name(df)))
    except AnalysisException:
        return numbered(df, tag)
    name = free_name(df)
    order = F.broadcast(df.sparkSession.createDataFrame(list(zip(files, range(len(files)), strict=True)), "file_path string, file_number long").select(F.struct("file_path", "file_number").alias(f"{name}_file")))
    met = placed.join(order, F.col(f"{name}_file.file_path") == F.col(f"{name}.file_path"))
    return met.select(*[F.col(f"`{c}`") for c in df.columns], (F.shiftleft(F.col(f"{name}_file.file_number"), 36) + F.col(f"{name}.row_index")).alias(name)), name


def bitmap_of(hashes: DataFrame, column: str, size: int) -> np.ndarray:
    """A bitmap of ``size`` bits, a multiple of 2**15, of the 64-bit hashes of a column; the driver gets at most size / 32,768 rows of 4 KB."""
    place = F.pmod(F.col(column), F.lit(size))
    parts = hashes.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    bits = np.zeros(size, np.uint8)
    for part in parts:
        one = np.unpackbits(np.frombuffer(part.bits, np.uint8), bitorder="little")
        at = (part.bucket - 1) * len(one) + 1  # Spark's buckets begin at position 1
        bits[max(at, 0) : at + len(one)] |= one[max(-at, 0) : size - at]
    return np.packbits(bits)


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which unsigned hashes ``bitmap_of`` may hold; never false for one that it does, as the size divides 2**64."""
    spot = (hashes % np.uint64(8 * len(bits))).astype(np.int64)
    return (bits[spot >> 3] >> (7 - (spot & 7)) & 1).astype(bool)


def fold(column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids count as the text 'null'."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("null")).cast("binary")) % parts


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 of every text; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()]


def blocks(texts: list[bytes], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of about ``most`` bytes, so that arrays over bytes stay small; a longer text stands alone."""
    start = total = 0
    for i, text in enumerate(texts):
        if total and total + len(text) > most:
            yield start, i
            start, total = i, 0
        total += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


#: Letters and digits of ASCII and every byte of a character beyond it.
WORD_BYTE = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def _power(which: str, n: int) -> np.ndarray:
    """The first n powers of the base (or its inverse) modulo 2**64, kept between blocks of ordinary size."""
    have = _powers.get(which)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 20), _BASE if which == "up" else _INVERSE, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if n <= 1 << 21:
            _powers[which] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


class Words:
    """Words of a block of lower-cased texts as arrays: byte ranges, 64-bit hashes, and each text's first word.

    A word is a run of ASCII letters or digits and bytes beyond ASCII. Hashes come from one
    cumulative polynomial sum over the whole block, so no Python code runs per word.
    """

    def __init__(self, texts: list[bytes], word_byte: np.ndarray = WORD_BYTE):
        self.blob = b"\0".join(texts) + b"\0"
        data = np.frombuffer(self.blob, np.uint8)
        step = np.diff(word_byte[data].view(np.int8), prepend=np.int8(0))
        self.start, self.end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(x) + 1 for x in texts], out=offsets[1:])
        self.offset = offsets
        self.first = np.searchsorted(self.start, offsets)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _power("up", len(data)), out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * _power("down", len(data))[self.start] + (self.end - self.start).astype(np.uint64))

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``size`` words from each word on, and whether they all lie in one text."""
        n = max(len(self.hash) - size + 1, 0)
        h = np.zeros(n, np.uint64)
        for k in range(size):
            h = mix(h * _BASE + self.hash[k : k + n])
        whole = np.ones(n, bool)
        for at in self.first[1:-1]:
            whole[max(at - size + 1, 0) : at] = False
        return h, whole


def arrow_rows(batches: Iterable[pa.RecordBatch], most: int = 4096) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most``, which bounds what one batch makes."""
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            yield batch.slice(at, most)
