"""Tables at rest: declared schemas, target tables in buckets, taxonomy and video context."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Declared columns of the tables that jobs read and write.
SCHEMAS = {
    "catalog": "video_id string, title string, description string, published_at timestamp, channel_id string, duration_seconds int, url string, transcript_status string, transcript_bucket string, transcript_path string, transcript_language string, transcript_char_count long, transcript_text string",
    "storage_objects": "bucket_id string, name string, created_at timestamp, updated_at timestamp, metadata string",
    "run": "run_id string, video_id string, status string, attempt int, transcript_sha256 string, prompt_bundle_version string, model_id string, taxonomy_version string, research_as_of date, packet_schema_version string, packet_storage_prefix string, packet_sha256 string, research_session_id string, synthesis_session_id string, lease_token string, lease_expires_at timestamp, created_at timestamp, completed_at timestamp, intent_path string, intent_sha256 string, error_code string",
    "session": "run_id string, phase string, attempt int, eve_session_id string, status string, started_at timestamp, completed_at timestamp, error_code string",
    "video_state": "video_id string, transcript_sha256 string, eligibility_status string, ineligibility_reasons array<string>, duration_seconds int, transcript_object_exists boolean, evaluated_at timestamp, latest_run_id string, pipeline_status string, pre_research_pipeline_finished boolean, finished_transcript_sha256 string, finished_intent_id string",
    "artifact": "run_id string, artifact_kind string, schema_version string, storage_bucket string, storage_path string, content_sha256 string, byte_count long, created_at timestamp",
    "ingestion_intent": "intent_id string, run_id string, video_id string, schema_version string, idempotency_key string, storage_bucket string, storage_path string, content_sha256 string, status string, applied_at timestamp",
    "intent_event": "intent_id string, operation_index int, operation_kind string, status string, affected_table string, affected_key string, error_detail string",
    "web_search_event": "run_id string, subagent string, query string, provider string, searched_at timestamp, result_urls array<string>, selected_urls array<string>, search_purpose string",
    "session_events": "session_id string, seq long, type string, message string",
}


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table of a known name with its declared schema; members that a file lacks are null."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{path}/{name}.parquet")


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The hash bucket of a row by its keys."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def write_table(df: DataFrame, path: str, keys: Sequence[str], buckets: int = 64) -> None:
    """Overwrite only the buckets that ``df`` has rows in; a bucket is the hash of the keys. ``df`` must not read ``path``.

    Rows of a bucket go to one task each, and only touched partitions are replaced, so a small change rewrites little.
    ``versions.Versions`` keeps several tables so, reads by bucket and publishes a batch at once.
    """
    spread = df.withColumn("bucket", bucket_of(keys, buckets))
    spread.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def touched_buckets(df: DataFrame, keys: Sequence[str], buckets: int = 64) -> DataFrame:
    """The distinct buckets that rows would fall into: what has to be read before a replace."""
    return df.select(bucket_of(keys, buckets).alias("bucket")).distinct()


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; a temporary one where that is unset and the session is one process."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='packetmill-')}"
    return f"{root.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def load_taxonomy(versions: DataFrame, categories: DataFrame, domains: DataFrame, version: str) -> DataFrame:
    """One row: a version's categories by (sort_order, code) and its active domains by (sort_order, code), as arrays of structs."""
    one = versions.where(F.col("version") == version).select("taxonomy_version_id")
    listed = lambda rows, code: rows.join(F.broadcast(one), "taxonomy_version_id", "left_semi").agg(F.sort_array(F.collect_list(F.struct("sort_order", code)))).toDF("x")  # noqa: E731  tens of codes
    return listed(categories, "category_code").withColumnRenamed("x", "categories").crossJoin(listed(domains.where("active"), "domain_code").withColumnRenamed("x", "domains"))


def load_video_context(catalog: DataFrame) -> DataFrame:
    """The catalog with its transcript (null: empty), its hash and its length in characters where none is recorded."""
    text = F.coalesce("transcript_text", F.lit(""))
    return catalog.withColumn("transcript_sha256", F.sha2(text, 256)).withColumn("char_count", F.coalesce("transcript_char_count", F.length(text).cast("long"))).withColumn("transcript_text", text)
