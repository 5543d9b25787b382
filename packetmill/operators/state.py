"""Run and session state: latest rows, legal moves, work lists, projections, the finished feed and its invariants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import vocabulary as v
from .registry import packet_completeness
from .report import Child, gather, stored, within


def latest_live_run(runs: DataFrame) -> DataFrame:
    """The newest resumable run of every video; ties by run id."""
    order = W.partitionBy("video_id").orderBy(F.col("created_at").desc_nulls_last(), "run_id")
    return runs.where(F.col("status").isin(*v.RESUMABLE)).withColumn("_k", F.row_number().over(order)).where("_k = 1").drop("_k")


def latest_session(sessions: DataFrame) -> DataFrame:
    """The session of the highest attempt of every run and phase; ties by session id."""
    rest = [c for c in sessions.columns if c not in ("run_id", "phase")]
    one = sessions.groupBy("run_id", "phase").agg(F.max_by(F.struct(*rest), F.struct("attempt", "eve_session_id")).alias("s"))
    return one.select("run_id", "phase", *[F.col(f"s.{c}").alias(c) for c in rest])


def illegal_transitions(history: DataFrame, key: str = "run_id", order: Sequence[str] = ("created_at",)) -> DataFrame:
    """(key, previous, status) of consecutive statuses that the lifecycle does not allow; any run not yet at an end may fail or be superseded."""
    before = F.lag("status").over(W.partitionBy(key).orderBy(*order))
    rows = history.withColumn("previous", before).where("previous is not null and previous <> status")
    ended = F.col("status").isin("failed", "superseded") & ~F.col("previous").isin(*v.TERMINAL)
    legal = F.concat_ws(">", "previous", "status").isin(*[f"{a}>{b}" for a, b in v.TRANSITIONS])
    return rows.where(~(ended | legal)).select(key, "previous", "status")


def phase_access(runs: DataFrame, requests: DataFrame) -> DataFrame:
    """(request_id, code) of every request; null means it may go on.

    requests: (request_id, run_id, action, session_id, packet_video_id, packet_sha256), action one of save_research,
    save_synthesis, load_research; packet columns are null when nothing is saved.
    """
    r = runs.select("run_id", F.col("status").alias("_st"), F.col("video_id").alias("_v"), F.col("transcript_sha256").alias("_sha"), F.col("research_session_id").alias("_rs"), F.col("synthesis_session_id").alias("_ss"))
    rows = requests.join(r, "run_id", "left")
    action, status = F.col("action"), F.col("_st")
    other = lambda bound: bound.isNotNull() & ~bound.eqNullSafe(F.col("session_id"))
    code = (
        F.when(status.isNull(), "RUN_NOT_FOUND")
        .when(F.col("packet_video_id").isNotNull() & (F.col("packet_video_id") != F.col("_v")), "VIDEO_MISMATCH")
        .when(F.col("packet_sha256").isNotNull() & ~F.col("packet_sha256").eqNullSafe(F.col("_sha")), "TRANSCRIPT_HASH_MISMATCH")
        .when((action == "save_research") & ~status.isin("claimed", "analyzing") | (action == "save_synthesis") & (status != "synthesizing") | (action == "load_research") & ~status.isin("research_complete", "synthesizing"), "ILLEGAL_PHASE")
        .when((action == "save_synthesis") & F.col("_ss").isNull(), "SESSION_BINDING_PENDING")
        .when((action == "save_research") & other(F.col("_rs")) | (action == "save_synthesis") & other(F.col("_ss")) | (action == "load_research") & (status == "synthesizing") & other(F.col("_ss")), "SESSION_MISMATCH")
    )
    return rows.select("request_id", code.alias("code"))


def pipeline_label(status: Column) -> Column:
    """The label of a run status for readers; analyzing reads researching, and queued is not yet claimed."""
    return F.when(status == "analyzing", "researching").when(status == "queued", "eligible").otherwise(status)


def project_video_state(runs: DataFrame, state: DataFrame) -> DataFrame:
    """The state table with latest_run_id and pipeline_status from each video's newest run; a finished video stays finished."""
    order = F.struct("created_at", "run_id")
    last = runs.groupBy("video_id").agg(F.max_by("run_id", order).alias("_run"), F.max_by("status", order).alias("_st"))
    rows = state.join(last, "video_id", "left")
    label = F.when(F.col("pre_research_pipeline_finished"), "finished").otherwise(F.coalesce(pipeline_label(F.col("_st")), F.col("pipeline_status")))
    return rows.withColumn("pipeline_status", label).withColumn("latest_run_id", F.col("_run")).drop("_run", "_st")


def fail_sessions(sessions: DataFrame, failures: DataFrame, now: Column) -> DataFrame:
    """Sessions with the started ones named by failures (run_id, eve_session_id, error_code) failed."""
    f = failures.select("run_id", "eve_session_id", F.col("error_code").alias("_code")).dropDuplicates(["run_id", "eve_session_id"])
    rows = sessions.join(f, ["run_id", "eve_session_id"], "left")
    hit = F.coalesce((F.col("status") == "started") & F.col("_code").isNotNull(), F.lit(False))
    new = {"error_code": F.when(hit, F.col("_code")).otherwise(F.col("error_code")), "completed_at": F.when(hit, now).otherwise(F.col("completed_at")), "status": F.when(hit, "failed").otherwise(F.col("status"))}
    return rows.select(*[new.get(c, F.col(c)).alias(c) for c in sessions.columns])


def revert_failed_synthesis(runs: DataFrame, run_ids: DataFrame) -> DataFrame:
    """Runs with the named synthesizing ones back at research_complete and unbound."""
    rows = runs.join(run_ids.select("run_id").distinct().withColumn("_hit", F.lit(True)), "run_id", "left")
    hit = F.coalesce(F.col("_hit") & (F.col("status") == "synthesizing"), F.lit(False))
    new = {"synthesis_session_id": F.when(~hit, F.col("synthesis_session_id")) if "synthesis_session_id" in runs.columns else None, "status": F.when(hit, "research_complete").otherwise(F.col("status"))}
    return rows.select(*[(new.get(c) if new.get(c) is not None else F.col(c)).alias(c) for c in runs.columns])


def phase_from_status(status: Column) -> Column:
    return F.when(status.isin("claimed", "analyzing"), "research").when(status.isin("research_complete", "synthesizing"), "synthesis")


def next_actions(runs: DataFrame, sessions: DataFrame, artifacts: DataFrame) -> DataFrame:
    """(run_id, action, error) of every run: what the dispatcher does next, or what holds it up.

    A failed session of the phase ends it: research fails the run, synthesis goes back to research_complete. A live
    one is waited for; without one the phase is started, or completed where its artifacts are all registered.
    """
    last = latest_session(sessions).select("run_id", F.col("phase").alias("_phase"), F.col("status").alias("_session"))
    done = lambda kinds, name: packet_completeness(runs, artifacts, kinds).select("run_id", F.col("complete").alias(name), F.array_join("missing", ",").alias(name + "_missing"))
    rows = runs.select("run_id", "status", phase_from_status(F.col("status")).alias("phase")).join(last, (F.col("phase") == F.col("_phase")) & (runs.run_id == last.run_id), "left").drop(last.run_id)
    rows = rows.join(done(v.RESEARCH_KINDS, "research"), "run_id").join(done(v.SYNTHESIS_KINDS, "synthesis"), "run_id")
    research, synthesis = F.col("phase") == "research", F.col("phase") == "synthesis"
    session, status = F.col("_session"), F.col("status")
    over = session.isin("completed")
    action = (
        F.when(research & F.col("research"), "mark_research_complete").when(research & (session == "failed"), "fail_research").when(research & (session == "started"), "wait_research").when(research & session.isNull(), "start_research").when(research, "resume_research")
        .when((status == "synthesizing") & F.col("synthesis"), "complete_synthesis").when((status == "synthesizing") & (session == "failed"), "revert_synthesis").when((status == "synthesizing") & (session == "started"), "wait_synthesis").when(synthesis, "start_synthesis")
        .when(status.isin("intent_ready", "applying"), "apply").when(status == "applied", "finalize").otherwise("none")
    )
    error = (
        F.when(research & over & ~F.col("research"), F.concat(F.lit("RESEARCH_CHECKPOINT_INCOMPLETE: "), F.col("research_missing")))
        .when((status == "synthesizing") & over & ~F.col("synthesis"), F.concat(F.lit("SYNTHESIS_PACKET_INCOMPLETE: "), F.col("synthesis_missing"))).when(status == "review_required", "Automatic apply refused: run is review_required")
    )
    return rows.select("run_id", action.alias("action"), error.alias("error"))


def run_summary(runs: DataFrame, state: DataFrame) -> DataFrame:
    """(run_id, video_id, phase, packet_storage_prefix, finished): phase is the video's label, or else the run's status."""
    s = state.select("video_id", F.col("pipeline_status").alias("_label"), F.col("pre_research_pipeline_finished").alias("_done"))
    prefix = F.coalesce("packet_storage_prefix", F.concat_ws("/", F.lit("pre-research/v2"), "video_id", "run_id"))
    return runs.join(s, "video_id", "left").select("run_id", "video_id", F.coalesce("_label", "status").alias("phase"), prefix.alias("packet_storage_prefix"), F.coalesce("_done", F.lit(False)).alias("finished"))


def finished_feed(catalog: DataFrame, state: DataFrame, runs: DataFrame, analyses: DataFrame, children: dict[str, tuple]) -> DataFrame:
    """Videos finished for the hash they have now, oldest first, with their applied run, analysis and nested child lists.

    children: name to (rows with analysis_id, columns in sort order), and sources to nest in the rows as the column ``sources``, if any. The
    feed is stored first and other rows go where they are read; all are aggregated in one exchange before the join, so that no join multiplies rows.
    """
    done = state.where(F.col("pre_research_pipeline_finished") & (F.col("finished_transcript_sha256") == F.col("transcript_sha256"))).select("video_id", "finished_transcript_sha256", "finished_intent_id")
    applied = runs.where(F.col("status") == "applied").select("video_id", F.col("transcript_sha256").alias("finished_transcript_sha256"), "run_id")
    out = catalog.select("video_id", "title", "published_at").join(done, "video_id").join(applied, ["video_id", "finished_transcript_sha256"]).join(analyses.drop("video_id"), "run_id")
    if children:
        out = stored(out)
        keys = out.select("analysis_id")
        lists = gather({name: within(Child(rows, "analysis", (), columns, *sources), keys) for name, (rows, columns, *sources) in children.items()})
        out = out.join(lists, F.concat(F.lit("analysis:"), "analysis_id") == F.col("owner"), "left").drop("owner")
    return out.orderBy(F.col("published_at").asc_nulls_last(), "video_id")


def finished_invariant_violations(state: DataFrame, runs: DataFrame, analyses: DataFrame, complete: DataFrame) -> DataFrame:
    """(video_id, code): the finish flag against what it stands for, in both directions, and against its own columns.

    A video is really finished if an applied run of its current hash has an analysis and all its artifacts; complete:
    (run_id, complete).
    """
    real = runs.where(F.col("status") == "applied").join(analyses.select("run_id").distinct(), "run_id", "left_semi").join(complete.where("complete").select("run_id"), "run_id", "left_semi")
    real = real.select("video_id", "transcript_sha256").distinct().withColumn("_real", F.lit(True))
    rows = state.join(real, ["video_id", "transcript_sha256"], "left").withColumn("_real", F.coalesce("_real", F.lit(False)))
    flag = F.coalesce("pre_research_pipeline_finished", F.lit(False))
    found = F.array_compact(F.array(
        F.when(flag & ~F.col("_real"), "FINISHED_WITHOUT_PROOF"), F.when(~flag & F.col("_real"), "PROOF_WITHOUT_FINISHED"), F.when(flag & ~F.col("finished_transcript_sha256").eqNullSafe(F.col("transcript_sha256")), "FINISHED_HASH_STALE"),
        F.when(flag & F.col("finished_intent_id").isNull(), "FINISHED_INTENT_MISSING"), F.when(flag & (F.col("pipeline_status") != "finished"), "FINISHED_LABEL_MISMATCH"),
    ))
    return rows.select("video_id", F.explode(found).alias("code"))


def uniqueness_violations(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(rule, key, n) for every key that more than one row of its rule's table has; keys are joined by a bar."""
    out = None
    for rule, (rows, keys) in tables.items():
        part = rows.groupBy(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key")).agg(F.count("*").alias("n")).where("n > 1").select(F.lit(rule).alias("rule"), "key", "n")
        out = part if out is None else out.unionByName(part)
    return out
