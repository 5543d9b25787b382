"""Packets in object storage: listings and JSON artifact files, read and written through Spark's file sources."""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import serialize_artifact
from ..functions.text import artifact_storage_path
from ..vocabulary import ARTIFACT_FILES
from .tables import shared_folder


#: Folders that a task lists before a level is dealt to more tasks; files and bytes of contents that it hands on at once.
FOLDERS_A_TASK, FILES_AT_ONCE, MOST_BYTES = 64, 64, 8 << 20
_ENTRIES = "name string, size long, millis long, folder boolean"


def read_storage_listing(spark: SparkSession, root: str, bucket: str) -> DataFrame:
    """(bucket_id, name, size, updated_at) of every file below a root; contents are not read."""
    found = _files(spark, root).select("name", "size", F.timestamp_millis("millis").alias("updated_at")) if _opens(root) else _scanned(spark, root).select("name", F.col("length").alias("size"), F.col("modificationTime").alias("updated_at"))
    return found.select(F.lit(bucket).alias("bucket_id"), "name", "size", "updated_at")


def _opens(root: str) -> bool:
    """Whether tasks can open a root themselves; others, of schemes that only Spark knows, are listed by its driver."""
    try:
        fs.FileSystem.from_uri(root)
    except (ValueError, OSError, NotImplementedError):
        return False
    return True


def _scanned(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.withColumn("name", relative(F.col("path"), root))


def _hidden(name: str) -> bool:
    """Names that Spark's file sources pass over."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _files(spark: SparkSession, root: str) -> DataFrame:
    """(name, size, millis) of every file below a root, but hidden ones.

    Tasks list the folders of a level, which goes to a table of its own, and those found there are dealt out for the next one: the driver gets
    the number of folders, not the files. A folder is listed by one task.
    """

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for folder in batch.column("name").to_pylist():
                found = [x for x in system.get_file_info(fs.FileSelector(f"{base.rstrip('/')}/{folder}")) if not _hidden(x.base_name)]
                names = [f"{folder}/{x.base_name}".lstrip("/") for x in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array([x.size for x in found], pa.int64()), pa.array([(x.mtime_ns or 0) // 1_000_000 for x in found], pa.int64()), pa.array([x.type == fs.FileType.Directory for x in found], pa.bool_())], ["name", "size", "millis", "folder"]
                )

    held, paths, level = shared_folder(spark, "listing"), [], spark.createDataFrame([("",)], "name string")
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while True:
        paths.append(f"{held}/{len(paths)}")
        level.mapInArrow(look, _ENTRIES).write.parquet(paths[-1])
        level = spark.read.schema(_ENTRIES).parquet(paths[-1]).where("folder").select("name")
        folders = level.count()
        if not folders:
            return spark.read.schema(_ENTRIES).parquet(*paths).where("not folder").drop("folder")
        level = level.repartition(min(most, 1 + folders // FOLDERS_A_TASK), "name")


def _contents(spark: SparkSession, root: str) -> DataFrame:
    """(name, content) of the JSON files below a root but empty ones, read by as many tasks as a shuffle has."""

    def load(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            names, contents = [], []
            for name in batch.column("name").to_pylist():
                with system.open_input_file(f"{base.rstrip('/')}/{name}") as file:
                    contents.append(file.read())
                names.append(name)
                if sum(map(len, contents)) > MOST_BYTES or len(names) == FILES_AT_ONCE:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(contents, pa.binary())], ["name", "content"])
                    names, contents = [], []
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(contents, pa.binary())], ["name", "content"])

    names = _files(spark, root).where(F.col("name").endswith(".json") & (F.col("size") > 0)).select("name")
    return names.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "name").mapInArrow(load, "name string, content binary")


def listing_from_table(objects: DataFrame) -> DataFrame:
    """A listing table with its size taken from the metadata; folders, which have none, are left out."""
    return objects.withColumn("size", F.get_json_object("metadata", "$.size").cast("long")).where("size is not null").drop("metadata")


def relative(path: Column, root: str) -> Column:
    """The part of a file's path below the root, whatever the scheme."""
    stem = root.split("://")[-1].rstrip("/")
    stem = stem[stem.index("/") :] if "/" in stem else "/" + stem
    return F.regexp_extract(path, "^(?:[a-z0-9]+:)?/*.*?" + _quoted(stem.strip("/")) + "/+(.*)$", 1)


def _quoted(text: str) -> str:
    return "".join("\\" + c if c in r"\.+*?()[]{}^$|" else c for c in text)


def kind_of(name: Column) -> Column:
    """Artifact kind of a file name below a run's prefix; null for other files."""
    kinds = F.create_map(*[F.lit(x) for kind, file in ARTIFACT_FILES.items() for x in (file, kind)])
    return kinds[name]


def read_packets(spark: SparkSession, root: str) -> DataFrame:
    """(version, video_id, run_id, artifact_kind, body, content_sha256, byte_count) of files at pre-research/<v>/<video>/<run>/<file> below a root."""
    files = _contents(spark, root) if _opens(root) else _scanned(spark, root, "*.json")
    part = lambda i: F.regexp_extract("name", "^pre-research/(v[12])/([^/]+)/([^/]+)/(.+)$", i)
    rows = files.select("name", "content").select(part(1).alias("version"), part(2).alias("video_id"), part(3).alias("run_id"), kind_of(part(4)).alias("artifact_kind"), F.decode("content", "UTF-8").alias("body"), F.sha2("content", 256).alias("content_sha256"), F.octet_length("content").cast("long").alias("byte_count"))
    return rows.where("version <> '' and artifact_kind is not null")


def write_packets(packets: DataFrame, root: str) -> DataFrame:
    """(storage_path, content_sha256, byte_count) of the artifacts written: (packet_storage_prefix, artifact_kind, body).

    Each artifact is one file at its fixed path, in canonical form with a line end. Tasks write through the Hadoop file
    system under a temporary name and then rename, so that a retried task leaves whole files only, and hand on what they
    wrote. That goes to a hidden table below the root, which is what comes back: the input is computed once.
    """
    path = artifact_storage_path(F.col("packet_storage_prefix"), F.col("artifact_kind"))
    made = packets.select(path.alias("storage_path"), serialize_artifact(F.col("body")).alias("a")).select("storage_path", F.col("a.content").alias("content"))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            places, hashes, sizes = batch.column("storage_path"), [], []
            for place, text in zip(places.to_pylist(), batch.column("content").to_pylist(), strict=True):
                target, content = f"{base.rstrip('/')}/{place}", text.encode()
                system.create_dir(os.path.dirname(target), recursive=True)
                temporary = f"{target}.{uuid.uuid4().hex}.tmp"
                with system.open_output_stream(temporary) as out:
                    out.write(content)
                system.move(temporary, target)
                hashes.append(hashlib.sha256(content).hexdigest())
                sizes.append(len(content))
            yield pa.RecordBatch.from_arrays([places, pa.array(hashes, pa.string()), pa.array(sizes, pa.int64())], ["storage_path", "content_sha256", "byte_count"])

    receipts, schema = f"{root.rstrip('/')}/_written/{uuid.uuid4().hex}", "storage_path string, content_sha256 string, byte_count long"
    made.mapInArrow(write, schema).write.parquet(receipts)
    return packets.sparkSession.read.schema(schema).parquet(receipts)
