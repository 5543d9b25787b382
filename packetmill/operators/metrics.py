"""Operational metrics: partial aggregates over few groups, rollups, percentiles and deterministic samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import vocabulary as v
from .validate import source_minimum


def _rate(condition: Column) -> Column:
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double"))


def queue_age(eligible: DataFrame, today: Column) -> DataFrame:
    """(oldest, age_days, queue_length) of the queue."""
    return eligible.agg(F.min("published_at").alias("oldest"), F.datediff(today, F.min("published_at")).alias("age_days"), F.count("*").alias("queue_length"))


def status_counts(rows: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """(value, n) of every declared value, zero where there is none."""
    n = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    known = rows.sparkSession.createDataFrame([(x,) for x in values], "value string")
    return known.join(n, "value", "left").select("value", F.coalesce("n", F.lit(0)).alias("n"))


def session_stats(sessions: DataFrame, pointers: DataFrame) -> DataFrame:
    """(phase, starts, completions, failures, retries, orphans): an orphan is started and not where its run points.

    pointers: (run_id, phase, eve_session_id).
    """
    held = pointers.select("run_id", "phase", "eve_session_id").distinct().withColumn("_held", F.lit(True))
    rows = sessions.join(held, ["run_id", "phase", "eve_session_id"], "left")
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return rows.groupBy("phase").agg(
        F.count("*").alias("starts"), n(F.col("status") == "completed").alias("completions"), n(F.col("status") == "failed").alias("failures"), n(F.col("attempt") > 1).alias("retries"), n((F.col("status") == "started") & F.col("_held").isNull()).alias("orphans")
    )


def stage_durations(sessions: DataFrame) -> DataFrame:
    """(phase, n, avg_seconds, p50_seconds, p95_seconds, max_seconds) of completed sessions, and 'end_to_end' per run."""
    return _durations(sessions).groupBy("phase").agg(F.count("*").alias("n"), F.avg("s").alias("avg_seconds"), F.percentile("s", 0.5).alias("p50_seconds"), F.percentile("s", 0.95).alias("p95_seconds"), F.max("s").alias("max_seconds"))


def _durations(sessions: DataFrame) -> DataFrame:
    """(phase, s): seconds of every completed session, and of every run from its first start to its last end."""
    took = lambda a, b: F.unix_timestamp(b) - F.unix_timestamp(a)
    ended = sessions.where("completed_at is not null")
    whole = ended.groupBy("run_id").agg(F.min("started_at").alias("a"), F.max("completed_at").alias("b")).select(F.lit("end_to_end").alias("phase"), took("a", "b").alias("s"))
    return ended.select("phase", took("started_at", "completed_at").alias("s")).unionByName(whole)


def stage_quantiles(sessions: DataFrame, probabilities: Sequence[float] = (0.5, 0.95), accuracy: int = 10_000) -> DataFrame:
    """(phase, n, avg_seconds, max_seconds, quantiles) like ``stage_durations``, from mergeable sketches of fixed size.

    Each quantile is the duration of some session whose rank is within n / accuracy of the one asked for.
    """
    return _durations(sessions).groupBy("phase").agg(F.count("*").alias("n"), F.avg("s").alias("avg_seconds"), F.max("s").alias("max_seconds"), F.percentile_approx("s", list(probabilities), accuracy).alias("quantiles"))


def stage_gaps(sessions: DataFrame) -> DataFrame:
    """(run_id, research_end, synthesis_start, gap_seconds): each synthesis start whose event before it, in its run, is the end of research.

    Ends of research are those of completed sessions; an end and a start at one time count as end first.
    """
    ends = sessions.where("phase = 'research' and status = 'completed' and completed_at is not null").select("run_id", F.col("completed_at").alias("at"), F.lit(0).alias("starts"))
    starts = sessions.where("phase = 'synthesis' and started_at is not null").select("run_id", F.col("started_at").alias("at"), F.lit(1).alias("starts"))
    order = W.partitionBy("run_id").orderBy("at", "starts")
    rows = ends.unionByName(starts).withColumns({"before": F.lag("at").over(order), "was": F.lag("starts").over(order)}).where("starts = 1 and was = 0")
    return rows.select("run_id", F.col("before").alias("research_end"), F.col("at").alias("synthesis_start"), (F.unix_timestamp("at") - F.unix_timestamp("before")).alias("gap_seconds"))


def search_stats(events: DataFrame) -> DataFrame:
    """(run_id, subagent, searches, results, selected)."""
    return events.groupBy("run_id", "subagent").agg(F.count("*").alias("searches"), F.sum("n_results").alias("results"), F.sum("n_selected").alias("selected"))


def first_party_share(analyses: DataFrame, resources: DataFrame) -> DataFrame:
    """(n_analyses, first_party_share): analyses with a verified first-party resource."""
    good = resources.where(F.col("is_first_party") & (F.col("verification_status") == "verified")).select("analysis_id").distinct().withColumn("_good", F.lit(True))
    return analyses.select("analysis_id").distinct().join(good, "analysis_id", "left").agg(F.count("*").alias("n_analyses"), _rate(F.col("_good")).alias("first_party_share"))


def organization_domain_distribution(candidates: DataFrame) -> DataFrame:
    """(primary_domain_code, n, share) of primary organizations; other_unknown is one of the codes."""
    n = candidates.where("is_primary_featured").groupBy("primary_domain_code").agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("_total"))  # one row
    return n.crossJoin(F.broadcast(total)).select("primary_domain_code", "n", (F.col("n") / F.col("_total")).alias("share"))


def source_quality(sources: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row: n_sources and shares verified, official and public; n_primaries and how many meet the source minimum."""
    a = sources.agg(F.count("*").alias("n_sources"), _rate(F.col("verification_status") == "verified").alias("verified"), _rate(F.col("authority_tier").isin(*v.AUTHORITATIVE_TIERS)).alias("official"), _rate(F.col("publicly_retrievable")).alias("public"))
    met = source_minimum(sources).withColumn("_met", F.col("has_identity") & F.col("has_technical"))
    b = candidates.where("is_primary_featured").select("organization_candidate_id").join(met, "organization_candidate_id", "left").agg(F.count("*").alias("n_primaries"), _rate(F.col("_met")).alias("minimum_met"))
    return a.crossJoin(b)  # one row by one row


def technology_family_shape(families: DataFrame, analyses: DataFrame) -> DataFrame:
    """(shape, n, share) of analyses with zero, one or several families."""
    n = families.groupBy("analysis_id").agg(F.count("*").alias("k"))
    shape = F.when(F.coalesce("k", F.lit(0)) == 0, "zero").when(F.col("k") == 1, "one").otherwise("several")
    rows = analyses.select("analysis_id").join(n, "analysis_id", "left").groupBy(shape.alias("shape")).agg(F.count("*").alias("n"))
    return rows.crossJoin(F.broadcast(rows.agg(F.sum("n").alias("_t")))).select("shape", "n", (F.col("n") / F.col("_t")).alias("share"))


def review_and_failure_rates(runs: DataFrame) -> DataFrame:
    """(code, n, share): review_required, and every error code of failed runs, out of all runs."""
    code = F.when(F.col("status") == "review_required", "review_required").when(F.col("status") == "failed", F.coalesce("error_code", F.lit("UNKNOWN")))
    total = runs.agg(F.count("*").alias("_t"))
    return runs.groupBy(code.alias("code")).agg(F.count("*").alias("n")).where("code is not null").crossJoin(F.broadcast(total)).select("code", "n", (F.col("n") / F.col("_t")).alias("share"))


def category_stability(categories: DataFrame, key: str = "video_id") -> DataFrame:
    """(video, runs, primaries, modal_code, modal_share) over repeated analyses; the least code wins a tie."""
    n = categories.where(F.col("assignment_role") == "primary").groupBy(key, "category_code").agg(F.count("*").alias("n"))
    return n.groupBy(key).agg(
        F.sum("n").alias("runs"), F.count("*").alias("primaries"), F.min_by("category_code", F.struct(-F.col("n"), F.col("category_code"))).alias("modal_code"), (F.max("n") / F.sum("n")).alias("modal_share")
    )


def category_audit(categories: DataFrame, analyses: DataFrame) -> DataFrame:
    """(category_code, difficulty, content_form, level, n) of primaries, cubed; level is the grouping id."""
    rows = categories.where(F.col("assignment_role") == "primary").join(analyses.select("analysis_id", "difficulty", "content_form"), "analysis_id")
    return rows.cube("category_code", "difficulty", "content_form").agg(F.grouping_id().alias("level"), F.count("*").alias("n"))


def stratified_golden_set(categories: DataFrame, n: int = 45, seed: str = "golden") -> DataFrame:
    """(analysis_id, category_code, place): about n analyses, the same number of each primary category, by hash order.

    Each stratum keeps its quota of least hashes; the window runs on what a bounded aggregation leaves.
    """
    primary = categories.where(F.col("assignment_role") == "primary").select("analysis_id", "category_code").withColumn("h", F.sha2(F.concat(F.lit(seed + "|"), "analysis_id"), 256))
    quota = primary.select("category_code").distinct().agg(F.ceil(F.lit(n) / F.count("*")).alias("quota"))
    place = F.row_number().over(W.partitionBy("category_code").orderBy("h", "analysis_id"))
    ranked = primary.withColumn("place", place).where(F.col("place") <= n)
    return ranked.crossJoin(F.broadcast(quota)).where("place <= quota").select("analysis_id", "category_code", "place")


def review_queue(analyses: DataFrame, threshold: float = 0.70) -> DataFrame:
    """Analyses below the confidence threshold, worst first."""
    return analyses.where(F.col("overall_confidence") < threshold).orderBy("overall_confidence", "analysis_id")


def verified_claim_conflicts(resources: DataFrame, verification: DataFrame, key: str = "analysis_id") -> DataFrame:
    """(key, url) of resources marked verified and first-party that no verifier row of the same normalised URL confirms.

    Both sides have (key, url, verification_status, is_first_party) with url normalised.
    """
    sure = F.col("is_first_party") & (F.col("verification_status") == "verified")
    return resources.where(sure).select(key, "url").distinct().join(verification.where(sure).select(key, "url"), [key, "url"], "left_anti")


def required_search_gaps(runs: DataFrame, events: DataFrame) -> DataFrame:
    """(run_id, subagent) of runs in which a subagent recorded no search."""
    wanted = runs.select("run_id").distinct().select("run_id", F.explode(F.array(*map(F.lit, v.SUBAGENTS))).alias("subagent"))
    return wanted.join(events.select("run_id", "subagent"), ["run_id", "subagent"], "left_anti")
