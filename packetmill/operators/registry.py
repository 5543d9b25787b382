"""Content-addressed artifacts: registration, uploads, completeness, verification, packets and the intent ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.json import serialize_struct
from ..functions.text import artifact_storage_path
from ..vocabulary import ARTIFACT_KINDS, RESEARCH_KINDS

VALID_HASH = "^[0-9a-f]{64}$"


def register_artifacts(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """(run_id, artifact_kind, storage_path, content_sha256, outcome) of every incoming artifact.

    registered, identical, ARTIFACT_CONTENT_COLLISION (another hash), ARTIFACT_PATH_COLLISION (another place), or
    UNKNOWN_ARTIFACT_KIND. Within a batch the least (path, hash) of a run and kind counts as the first.
    """
    first = W.partitionBy("run_id", "artifact_kind").orderBy("storage_path", "content_sha256")
    rows = incoming.select("run_id", "artifact_kind", "storage_path", "content_sha256").withColumn("_k", F.row_number().over(first))
    rows = rows.withColumns({"_p": F.first("storage_path").over(first), "_h": F.first("content_sha256").over(first)})
    held = existing.select("run_id", "artifact_kind", F.col("storage_path").alias("_ep"), F.col("content_sha256").alias("_eh"))
    rows = rows.join(held, ["run_id", "artifact_kind"], "left")
    path, sha = F.coalesce("_ep", F.when(F.col("_k") > 1, F.col("_p"))), F.coalesce("_eh", F.when(F.col("_k") > 1, F.col("_h")))
    outcome = (
        F.when(~F.col("artifact_kind").isin(*ARTIFACT_KINDS), "UNKNOWN_ARTIFACT_KIND").when(sha.isNull(), "registered")
        .when(sha != F.col("content_sha256"), "ARTIFACT_CONTENT_COLLISION").when(path != F.col("storage_path"), "ARTIFACT_PATH_COLLISION").otherwise("identical")
    )
    return rows.select("run_id", "artifact_kind", "storage_path", "content_sha256", outcome.alias("outcome"))


def registry_after(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """The registry with what ``register_artifacts`` registers."""
    new = register_artifacts(existing, incoming).where("outcome = 'registered'").drop("outcome")
    return existing.unionByName(new, allowMissingColumns=True)


def classify_uploads(objects: DataFrame, incoming: DataFrame) -> DataFrame:
    """(bucket_id, name, content_sha256, outcome): uploaded, identical or STORAGE_CONTENT_COLLISION."""
    held = objects.groupBy("bucket_id", "name").agg(F.min("content_sha256").alias("_h"))
    joined = incoming.join(held, ["bucket_id", "name"], "left")
    outcome = F.when(F.col("_h").isNull(), "uploaded").when(F.col("_h") == F.col("content_sha256"), "identical").otherwise("STORAGE_CONTENT_COLLISION")
    return joined.select("bucket_id", "name", "content_sha256", outcome.alias("outcome"))


def packet_completeness(runs: DataFrame, artifacts: DataFrame, required: Sequence[str], valid_hash: bool = True) -> DataFrame:
    """(run_id, missing, complete): required kinds without an artifact (of valid hash), in their order."""
    good = artifacts.where(F.col("artifact_kind").isin(*required))
    good = good.where(F.col("content_sha256").rlike(VALID_HASH)) if valid_hash else good
    have = good.groupBy("run_id").agg(F.collect_set("artifact_kind").alias("_have"))
    joined = runs.select("run_id").distinct().join(have, "run_id", "left")
    missing = F.array_except(F.array(*map(F.lit, required)), F.coalesce("_have", F.array().cast("array<string>")))
    return joined.select("run_id", missing.alias("missing")).withColumn("complete", F.size("missing") == 0)


def verify_artifacts(artifacts: DataFrame, stored: DataFrame, runs: DataFrame) -> DataFrame:
    """(run_id, artifact_kind, code): ARTIFACT_PATH_MISMATCH, ARTIFACT_MISSING, ARTIFACT_HASH_MISMATCH or null.

    runs brings each run's packet_storage_prefix; one slash at the end of a path does not matter.
    """
    held = stored.select(F.col("bucket_id").alias("storage_bucket"), F.col("name").alias("storage_path"), F.col("content_sha256").alias("_actual"))
    joined = artifacts.join(runs.select("run_id", "packet_storage_prefix"), "run_id").join(held, ["storage_bucket", "storage_path"], "left")
    expected = artifact_storage_path(F.col("packet_storage_prefix"), F.col("artifact_kind"))
    code = (
        F.when(~F.regexp_replace("storage_path", r"/\z", "").eqNullSafe(expected), "ARTIFACT_PATH_MISMATCH").when(F.col("_actual").isNull(), "ARTIFACT_MISSING").when(F.col("_actual") != F.col("content_sha256"), "ARTIFACT_HASH_MISMATCH")
    )
    return joined.select("run_id", "artifact_kind", code.alias("code"))


def artifact_marks(artifacts: DataFrame, stored: DataFrame) -> DataFrame:
    """(run_id, artifact_kind, mark, byte_count, actual_bytes): ok, HASH_MISMATCH or MISSING against what is stored."""
    held = stored.select(F.col("bucket_id").alias("storage_bucket"), F.col("name").alias("storage_path"), F.col("content_sha256").alias("_actual"), F.col("size").alias("actual_bytes"))
    joined = artifacts.join(held, ["storage_bucket", "storage_path"], "left")
    mark = F.when(F.col("_actual").isNull(), "MISSING").when(F.col("_actual") == F.col("content_sha256"), "ok").otherwise("HASH_MISMATCH")
    return joined.select("run_id", "artifact_kind", mark.alias("mark"), "byte_count", "actual_bytes")


def packet_manifest_hash(artifacts: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(run_id, packet_sha256): canonical hash of the prefix and the artifacts by kind."""
    entry = F.struct("artifact_kind", "content_sha256", "storage_path")
    listed = artifacts.groupBy("run_id").agg(F.sort_array(F.collect_list(entry)).alias("artifacts"))
    manifest = serialize_struct(F.struct(F.col("artifacts"), F.col("packet_storage_prefix")))
    return listed.join(prefixes.select("run_id", "packet_storage_prefix"), "run_id").select("run_id", manifest["sha256"].alias("packet_sha256"))


def load_research_packets(artifacts: DataFrame, bodies: DataFrame) -> DataFrame:
    """One row per run: its seven research bodies by kind, and code.

    code is RESEARCH_CHECKPOINT_INCOMPLETE when a kind is not registered or has no body, ARTIFACT_HASH_MISMATCH when a
    body does not hash to what is registered, else null; with a code the bodies are null.
    """
    wanted = artifacts.where(F.col("artifact_kind").isin(*RESEARCH_KINDS)).select("run_id", "artifact_kind", "content_sha256")
    rows = wanted.join(bodies.select("run_id", "artifact_kind", "body"), ["run_id", "artifact_kind"], "left").withColumn("same", F.sha2("body", 256) == F.col("content_sha256"))
    wide = rows.groupBy("run_id").agg(
        F.count_distinct(F.when(F.col("body").isNotNull(), F.col("artifact_kind"))).alias("_n"), F.bool_and(F.coalesce("same", F.lit(True))).alias("_same"),
        *[F.max(F.when(F.col("artifact_kind") == k, F.col("body"))).alias(k) for k in RESEARCH_KINDS],
    )
    code = F.when(F.col("_n") < len(RESEARCH_KINDS), "RESEARCH_CHECKPOINT_INCOMPLETE").when(~F.col("_same"), "ARTIFACT_HASH_MISMATCH")
    return wide.withColumn("code", code).select("run_id", "code", *[F.when(F.col("code").isNull(), F.col(k)).alias(k) for k in RESEARCH_KINDS])


def upsert_intent_ledger(ledger: DataFrame, incoming: DataFrame) -> DataFrame:
    """(run_id, intent_id, content_sha256, status, outcome) of the ledger after the incoming intents, one per run.

    inserted; updated where the hash is the same and the status draft or validated; INTENT_CONTENT_COLLISION
    otherwise; kept for runs with nothing incoming. Of several incoming intents of a run the least id counts.
    """
    one = incoming.groupBy("run_id").agg(F.min(F.struct("intent_id", "content_sha256")).alias("n"))
    both = ledger.select("run_id", F.struct("intent_id", "content_sha256", "status").alias("o")).join(one, "run_id", "full_outer")
    outcome = (
        F.when(F.col("n").isNull(), "kept").when(F.col("o").isNull(), "inserted")
        .when((F.col("o.content_sha256") == F.col("n.content_sha256")) & F.col("o.status").isin("draft", "validated"), "updated").otherwise("INTENT_CONTENT_COLLISION")
    )
    new = outcome.isin("inserted", "updated")
    return both.select(
        "run_id", F.when(new, F.col("n.intent_id")).otherwise(F.col("o.intent_id")).alias("intent_id"), F.when(new, F.col("n.content_sha256")).otherwise(F.col("o.content_sha256")).alias("content_sha256"),
        F.when(new, "validated").otherwise(F.col("o.status")).alias("status"), outcome.alias("outcome"),
    )


def packet_objects(objects: DataFrame, catalog: DataFrame) -> DataFrame:
    """(video_id, bucket_id, name, size, kind): each video's transcript and packet objects. Ids are read from paths and joined literally."""
    stem = F.regexp_extract("name", r"/([^/]+)\.[^/.]*$", 1)
    packet = F.regexp_extract("name", r"^pre-research/[^/]+/([^/]+)/", 1)
    known = objects.withColumn("kind", F.when(packet != "", "packet").otherwise("transcript")).withColumn("video_id", F.when(packet != "", packet).otherwise(stem))
    return known.join(catalog.select("video_id").distinct(), "video_id", "left_semi").select("video_id", "bucket_id", "name", "size", "kind")
