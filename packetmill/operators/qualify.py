"""Which catalog items qualify, why others do not, and who claims them.

A catalog row's text is hashed and tested where it is read and then dropped, so that no exchange carries it.
Occupancy is per item and transcript hash: a changed transcript opens an item again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..vocabulary import MAX_DURATION_SECONDS, MODEL_ID, OCCUPYING, OTHER_REASON, PACKET_VERSION, PRIMARY_REASONS, PROMPT_VERSION, REASONS, TAXONOMY_VERSION, TRANSCRIPT_BUCKET
from ..functions.text import packet_storage_prefix


def _queue_order() -> list[Column]:
    return [F.col("published_at").asc_nulls_last(), F.col("video_id").asc()]


def is_blank(text: Column, blank: str = "sql") -> Column:
    """Null or nothing but spaces (``sql``) or any white space (``unicode``)."""
    left = F.trim(text) if blank == "sql" else F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    return F.coalesce(F.length(left) == 0, F.lit(True))


def with_transcript_sha256(catalog: DataFrame, blank: str = "sql") -> DataFrame:
    """The catalog with transcript_sha256 and has_text in place of transcript_text; a null text has no hash."""
    return catalog.withColumn("transcript_sha256", F.sha2("transcript_text", 256)).withColumn("has_text", ~is_blank(F.col("transcript_text"), blank)).drop("transcript_text")


def _hashed(catalog: DataFrame, blank: str = "sql") -> DataFrame:
    return catalog if "has_text" in catalog.columns else with_transcript_sha256(catalog, blank)


def with_storage_object_exists(catalog: DataFrame, objects: DataFrame) -> DataFrame:
    """The catalog with transcript_object_exists: an object of its bucket and path. The join is on the path; buckets are few."""
    there = objects.where("name is not null").select(F.col("bucket_id").alias("_bucket"), F.col("name").alias("_name")).distinct().withColumn("_there", F.lit(True))
    joined = catalog.join(there, (catalog.transcript_path == there._name) & (catalog.transcript_bucket == there._bucket), "left")
    return joined.withColumn("transcript_object_exists", F.coalesce("_there", F.lit(False))).drop("_bucket", "_name", "_there")


def duration_status(seconds: Column) -> Column:
    """DURATION_MISSING, DURATION_INVALID, VIDEO_TOO_LONG, or null for a fit duration."""
    value = seconds.cast("double")
    return (
        F.when(seconds.isNull(), "DURATION_MISSING")
        .when(F.isnan(value) | (F.abs(value) == float("inf")) | (value <= 0), "DURATION_INVALID")
        .when(value >= MAX_DURATION_SECONDS, "VIDEO_TOO_LONG")
    )


def _stored() -> Column:
    return (F.col("transcript_status") == "stored") & (F.col("transcript_bucket") == TRANSCRIPT_BUCKET) & F.col("transcript_path").isNotNull() & (F.col("duration_seconds") > 0) & (F.col("duration_seconds") < MAX_DURATION_SECONDS)


def canonical_eligible(catalog: DataFrame, objects: DataFrame) -> DataFrame:
    """Rows that meet the eight static conditions, without their text."""
    fit = _hashed(catalog.where(_stored())).where("has_text").drop("has_text")
    there = objects.where(F.col("bucket_id") == TRANSCRIPT_BUCKET).select(F.col("name").alias("transcript_path"))
    return fit.join(there, "transcript_path", "left_semi").select(*[c for c in catalog.columns if c != "transcript_text"], "transcript_sha256")


def occupied(runs: DataFrame) -> DataFrame:
    """Distinct (video_id, transcript_sha256) that a live or applied run holds."""
    return runs.where(F.col("status").isin(*OCCUPYING)).select("video_id", "transcript_sha256").distinct()


def _hashes_of(rows: DataFrame, sha: str, name: str) -> DataFrame:
    """(video_id, name): each video's distinct hashes, so that a flag needs one join on the video alone."""
    return rows.groupBy("video_id").agg(F.collect_set(sha).alias(name))


def has_live_or_applied_run(catalog: DataFrame, runs: DataFrame) -> DataFrame:
    """The catalog with has_live_or_applied_run for its current hash."""
    held = _hashes_of(runs.where(F.col("status").isin(*OCCUPYING)), "transcript_sha256", "_live")
    flag = F.coalesce(F.array_contains("_live", F.col("transcript_sha256")), F.lit(False))
    return _hashed(catalog).join(held, "video_id", "left").withColumn("has_live_or_applied_run", flag).drop("_live")


def finished_for_current_transcript(catalog: DataFrame, state: DataFrame) -> DataFrame:
    """The catalog with finished_for_current: finished, and for the hash that it has now."""
    held = _hashes_of(state.where("pre_research_pipeline_finished"), "finished_transcript_sha256", "_done")
    flag = F.coalesce(F.array_contains("_done", F.col("transcript_sha256")), F.lit(False))
    return _hashed(catalog).join(held, "video_id", "left").withColumn("finished_for_current", flag).drop("_done")


def ineligibility_reasons(catalog: DataFrame, objects: DataFrame, runs: DataFrame | None = None, state: DataFrame | None = None, blank: str = "sql") -> DataFrame:
    """The catalog with reasons: every reason that holds, in reporting order."""
    out = with_storage_object_exists(_hashed(catalog, blank), objects)
    out = has_live_or_applied_run(out, runs) if runs is not None else out.withColumn("has_live_or_applied_run", F.lit(False))
    out = finished_for_current_transcript(out, state) if state is not None else out.withColumn("finished_for_current", F.lit(False))
    seconds = F.col("duration_seconds")
    holds = (
        ~F.coalesce(F.col("transcript_status") == "stored", F.lit(False)), ~F.col("has_text"), ~F.coalesce(F.col("transcript_bucket") == TRANSCRIPT_BUCKET, F.lit(False)), F.col("transcript_path").isNull(),
        ~F.col("transcript_object_exists"), seconds.isNull(), seconds <= 0, seconds >= MAX_DURATION_SECONDS, F.col("has_live_or_applied_run"), F.col("finished_for_current"),
    )
    return out.withColumn("reasons", F.array_compact(F.array(*[F.when(h, r) for h, r in zip(holds, REASONS, strict=True)])))


def primary_reason(reasons: Column) -> Column:
    """The most urgent group of an array of reasons: '' for none, a general code for unknown ones only."""
    out = F.when(F.size(reasons) == 0, "")
    for code, members in PRIMARY_REASONS:
        out = out.when(F.arrays_overlap(reasons, F.array(*map(F.lit, members))), code)
    return out.otherwise(OTHER_REASON)


def list_eligible_videos(catalog: DataFrame, objects: DataFrame, runs: DataFrame, state: DataFrame | None = None, limit: int | None = 50, include_applied: bool = False, video_id: str | None = None) -> DataFrame:
    """The queue, oldest first: eligible, unoccupied unless ``include_applied``, with state columns or their defaults."""
    fit = canonical_eligible(catalog if video_id is None else catalog.where(F.col("video_id") == video_id), objects)
    fit = has_live_or_applied_run(fit.withColumn("has_text", F.lit(True)), runs).drop("has_text")
    if state is not None:
        held = state.select("video_id", "pipeline_status", "pre_research_pipeline_finished", "finished_transcript_sha256")
        fit = fit.join(held, "video_id", "left")
        finished = F.coalesce(F.col("pre_research_pipeline_finished") & (F.col("finished_transcript_sha256") == F.col("transcript_sha256")), F.lit(False))
        fit = fit.withColumn("pipeline_status", F.coalesce("pipeline_status", F.lit("not_started"))).withColumn("finished_for_current", finished).drop("pre_research_pipeline_finished", "finished_transcript_sha256")
    else:
        fit = fit.withColumn("pipeline_status", F.lit("not_started")).withColumn("finished_for_current", F.lit(False))
    if not include_applied:
        fit = fit.where("not has_live_or_applied_run and not finished_for_current")
    fit = fit.orderBy(*_queue_order())
    return fit if limit is None else fit.limit(limit)


def first_unprocessed(eligible: DataFrame) -> DataFrame:
    """The first queued row without a live run, or else the first row."""
    return eligible.orderBy(F.col("has_live_or_applied_run").asc(), *_queue_order()).limit(1)


def refresh_qualification(catalog: DataFrame, objects: DataFrame, runs: DataFrame, state: DataFrame, now: Column) -> DataFrame:
    """The next state table: eligibility and reasons of every catalog item; a changed hash clears what it had finished.

    Items that left the catalog keep their rows. ``now`` is when the items were looked at.
    """
    seen = ineligibility_reasons(catalog, objects, runs, state)
    fresh = seen.select(
        "video_id", F.col("transcript_sha256").alias("n_sha"), "reasons", F.col("duration_seconds").alias("n_seconds"), F.col("transcript_object_exists").alias("n_object"),
        F.when(F.size("reasons") == 0, "eligible").otherwise("ineligible").alias("n_status"), F.lit(True).alias("_seen"),
    )
    both = fresh.join(state, "video_id", "full_outer")
    known = F.col("_seen").isNotNull()
    stale = known & F.col("finished_transcript_sha256").isNotNull() & ~F.col("finished_transcript_sha256").eqNullSafe(F.col("n_sha"))
    return both.select(
        "video_id",
        F.when(known, F.col("n_sha")).otherwise(F.col("transcript_sha256")).alias("transcript_sha256"),
        F.when(known, F.col("n_status")).otherwise(F.col("eligibility_status")).alias("eligibility_status"),
        F.when(known, F.col("reasons")).otherwise(F.col("ineligibility_reasons")).alias("ineligibility_reasons"),
        F.when(known, F.col("n_seconds")).otherwise(F.col("duration_seconds")).alias("duration_seconds"),
        F.coalesce(F.when(known, F.col("n_object")).otherwise(F.col("transcript_object_exists")), F.lit(False)).alias("transcript_object_exists"),
        F.when(known, now).otherwise(F.col("evaluated_at")).alias("evaluated_at"),
        F.when(stale, F.when(F.col("n_status") == "eligible", "eligible").otherwise("not_started")).otherwise(F.coalesce("pipeline_status", F.lit("not_started"))).alias("pipeline_status"),
        F.when(stale, False).otherwise(F.coalesce("pre_research_pipeline_finished", F.lit(False))).alias("pre_research_pipeline_finished"),
        F.when(~stale, F.col("finished_transcript_sha256")).alias("finished_transcript_sha256"),
        F.when(~stale, F.col("finished_intent_id")).alias("finished_intent_id"),
    )


def qualification_counts(state: DataFrame) -> DataFrame:
    """(eligibility_status, reason, n_videos) with subtotals per status and in all; totals count a video once."""
    rows = state.select("video_id", "eligibility_status", F.explode_outer("ineligibility_reasons").alias("reason"))
    by_reason = rows.where("reason is not null").groupBy("eligibility_status", "reason").agg(F.count("*").alias("n_videos"))
    totals = state.rollup("eligibility_status").agg(F.count("*").alias("n_videos")).select("eligibility_status", F.lit(None).cast("string").alias("reason"), "n_videos")
    return by_reason.unionByName(totals)


def claim_batch(eligible: DataFrame, runs: DataFrame, n: int, now: str, lease_seconds: int = 10800) -> DataFrame:
    """New run rows for the n oldest eligible items, one per item and hash, with a lease; none that a run already holds.

    Run ids and lease tokens are hashes of what is claimed and when, so that a repeated claim is the same claim.
    """
    free = eligible.dropDuplicates(["video_id", "transcript_sha256"]).join(occupied(runs), ["video_id", "transcript_sha256"], "left_anti").orderBy(*_queue_order()).limit(n)
    at = F.lit(now).cast("timestamp")
    out = free.select("video_id", "transcript_sha256", F.sha2(F.concat_ws("|", "video_id", "transcript_sha256", F.lit(now)), 256).alias("run_id"))
    return out.select(
        "run_id", "video_id", "transcript_sha256", F.lit("claimed").alias("status"), F.sha2(F.concat_ws("|", F.lit("lease"), "run_id"), 256).alias("lease_token"), (at + F.make_interval(secs=F.lit(lease_seconds))).alias("lease_expires_at"),
        F.to_date(at).alias("research_as_of"), F.lit(PACKET_VERSION).alias("packet_schema_version"), packet_storage_prefix(F.col("video_id"), F.col("run_id")).alias("packet_storage_prefix"),
        F.lit(PROMPT_VERSION).alias("prompt_bundle_version"), F.lit(TAXONOMY_VERSION).alias("taxonomy_version"), F.lit(MODEL_ID).alias("model_id"), at.alias("created_at"),
    )


def claim_named(requests: DataFrame, catalog: DataFrame, objects: DataFrame, runs: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """(video_id, claimed, reason) for every requested id: its primary reason, or VIDEO_NOT_FOUND, where it cannot be claimed."""
    seen = ineligibility_reasons(catalog, objects, runs, state).select("video_id", primary_reason(F.col("reasons")).alias("reason"))
    joined = requests.select("video_id").distinct().join(seen, "video_id", "left").withColumn("reason", F.coalesce("reason", F.lit("VIDEO_NOT_FOUND")))
    return joined.select("video_id", (F.col("reason") == "").alias("claimed"), "reason")


def expire_leases(runs: DataFrame, now: Column) -> DataFrame:
    """Runs with claimed or analyzing ones past their lease failed, LEASE_EXPIRED."""
    over = F.coalesce(F.col("status").isin("claimed", "analyzing") & (F.col("lease_expires_at") < now), F.lit(False))
    return runs.withColumns({"error_code": F.when(over, "LEASE_EXPIRED").otherwise(F.col("error_code")), "status": F.when(over, "failed").otherwise(F.col("status"))})


def touch_runs(runs: DataFrame, touches: DataFrame, now: Column) -> DataFrame:
    """Runs with leases extended and status and intent pointers set where the token matches.

    touches: (run_id, lease_token, lease_seconds, status, intent_path, intent_sha256); nulls leave a value as it is, and
    a lease is 60 to 21,600 seconds. Of several touches of a run the one with the longest lease counts.
    """
    fit = touches.where(F.col("lease_seconds").isNull() | F.col("lease_seconds").between(60, 21600))
    rank = W.partitionBy("run_id", "lease_token").orderBy(F.col("lease_seconds").desc_nulls_last(), F.col("status").asc_nulls_last(), F.col("intent_path").asc_nulls_last())
    one = fit.withColumn("_k", F.row_number().over(rank)).where("_k = 1").select("run_id", "lease_token", F.col("lease_seconds").alias("_s"), F.col("status").alias("_status"), F.col("intent_path").alias("_path"), F.col("intent_sha256").alias("_sha"))
    joined = runs.join(one, ["run_id", "lease_token"], "left")
    return joined.select(*[
        {
            "lease_expires_at": F.when(F.col("_s").isNotNull(), now + F.make_interval(secs=F.col("_s"))).otherwise(F.col("lease_expires_at")),
            "status": F.coalesce("_status", "status"), "intent_path": F.coalesce("_path", "intent_path"), "intent_sha256": F.coalesce("_sha", "intent_sha256"),
        }.get(c, F.col(c)).alias(c)
        for c in runs.columns
    ])
