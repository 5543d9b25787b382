"""Queries over catalog, objects, runs and state: qualification, queue and claims."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import qualify as q
from .derived import Tables
from .registered import query

NOW = "2024-01-05 00:00:00"
_LIVE = "('queued','claimed','analyzing','research_complete','synthesizing','intent_ready','applying','applied')"
_STATIC = "c.transcript_status = 'stored' and c.transcript_bucket = 'ai-engineer-transcripts' and c.transcript_path is not null and length(trim(c.transcript_text, ' ')) > 0 and c.duration_seconds > 0 and c.duration_seconds < 5400 and exists (select 1 from {storage_objects} o where o.bucket_id = c.transcript_bucket and o.name = c.transcript_path)"
_RUN = f"exists (select 1 from {{runs}} r where r.video_id = c.video_id and r.transcript_sha256 = sha256(c.transcript_text) and r.status in {_LIVE})"
_DONE = "exists (select 1 from {video_state} s where s.video_id = c.video_id and s.pre_research_pipeline_finished and s.finished_transcript_sha256 = sha256(c.transcript_text))"
_REASONS = f"""concat_ws(',', case when c.transcript_status = 'stored' then null else 'transcript_status_not_stored' end, case when coalesce(length(trim(c.transcript_text, ' ')), 0) = 0 then 'transcript_text_empty' end,
  case when c.transcript_bucket = 'ai-engineer-transcripts' then null else 'transcript_bucket_invalid' end, case when c.transcript_path is null then 'transcript_path_missing' end,
  case when not exists (select 1 from {{storage_objects}} o where o.bucket_id = c.transcript_bucket and o.name = c.transcript_path) then 'transcript_object_missing' end,
  case when c.duration_seconds is null then 'duration_missing' when c.duration_seconds <= 0 then 'duration_non_positive' when c.duration_seconds >= 5400 then 'duration_at_or_over_5400_seconds' end,
  case when {_RUN} then 'already_live_for_current_transcript' end, case when {_DONE} then 'already_finished_for_current_transcript' end)"""
_PRIMARY = """case when reasons = '' then '' when reasons like '%not_stored%' or reasons like '%text_empty%' then 'TRANSCRIPT_NOT_STORED' when reasons like '%object_missing%' or reasons like '%path_missing%' or reasons like '%bucket_invalid%' then 'TRANSCRIPT_OBJECT_MISSING'
  when reasons like '%duration_missing%' then 'DURATION_MISSING' when reasons like '%non_positive%' then 'DURATION_INVALID' when reasons like '%at_or_over%' then 'VIDEO_TOO_LONG' else 'VIDEO_ALREADY_CLAIMED_OR_FINISHED' end"""
_QUEUE = f"select c.*, sha256(c.transcript_text) as sha, {_RUN} as live from {{catalog}} c where {_STATIC}"


def _state(t: Tables) -> DataFrame:
    return t.video_state.withColumn("ineligibility_reasons", F.array_compact("raw_reasons")).drop("raw_reasons")


@query("transcript_sha256", "select video_id, sha256(transcript_text) as transcript_sha256, coalesce(length(trim(transcript_text, ' ')), 0) > 0 as has_text from {catalog}")
def transcript_sha256(t: Tables) -> DataFrame:
    return q.with_transcript_sha256(t.catalog).select("video_id", "transcript_sha256", "has_text")


@query("storage_object_exists", "select video_id, exists (select 1 from {storage_objects} o where o.bucket_id = c.transcript_bucket and o.name = c.transcript_path) as transcript_object_exists from {catalog} c")
def storage_object_exists(t: Tables) -> DataFrame:
    return q.with_storage_object_exists(t.catalog.select("video_id", "transcript_bucket", "transcript_path"), t.storage_objects).select("video_id", "transcript_object_exists")


@query("canonical_eligible", f"select c.video_id, sha256(c.transcript_text) as transcript_sha256 from {{catalog}} c where {_STATIC}")
def canonical_eligible(t: Tables) -> DataFrame:
    return q.canonical_eligible(t.catalog, t.storage_objects).select("video_id", "transcript_sha256")


@query("duration_status", "select video_id, case when duration_seconds is null then 'DURATION_MISSING' when duration_seconds <= 0 then 'DURATION_INVALID' when duration_seconds >= 5400 then 'VIDEO_TOO_LONG' end as status from {catalog}")
def duration_status(t: Tables) -> DataFrame:
    return t.catalog.select("video_id", q.duration_status(F.col("duration_seconds")).alias("status"))


@query("ineligibility_reasons", f"select video_id, {_REASONS} as reasons from {{catalog}} c")
def ineligibility_reasons(t: Tables) -> DataFrame:
    return q.ineligibility_reasons(t.catalog, t.storage_objects, t.runs, _state(t)).select("video_id", F.array_join("reasons", ",").alias("reasons"))


@query("primary_reason", f"select video_id, {_PRIMARY} as reason from (select video_id, {_REASONS} as reasons from {{catalog}} c)")
def primary_reason(t: Tables) -> DataFrame:
    return q.ineligibility_reasons(t.catalog, t.storage_objects, t.runs, _state(t)).select("video_id", q.primary_reason(F.col("reasons")).alias("reason"))


@query("live_or_applied_run", f"select c.video_id, {_RUN} as has_live_or_applied_run from {{catalog}} c")
def live_or_applied_run(t: Tables) -> DataFrame:
    return q.has_live_or_applied_run(t.catalog, t.runs).select("video_id", "has_live_or_applied_run")


@query("finished_for_current", f"select c.video_id, {_DONE} as finished_for_current from {{catalog}} c")
def finished_for_current(t: Tables) -> DataFrame:
    return q.finished_for_current_transcript(t.catalog, _state(t)).select("video_id", "finished_for_current")


@query("list_eligible_videos", f"select video_id, sha as transcript_sha256, published_at, duration_seconds from ({_QUEUE}) c where not live and not {_DONE} order by published_at asc nulls last, video_id limit 50")
def list_eligible_videos(t: Tables) -> DataFrame:
    return q.list_eligible_videos(t.catalog, t.storage_objects, t.runs, _state(t)).select("video_id", "transcript_sha256", "published_at", "duration_seconds")


@query("list_eligible_all", f"select c.video_id, sha as transcript_sha256, live as has_live_or_applied_run, coalesce(s.pipeline_status, 'not_started') as pipeline_status, coalesce(s.pre_research_pipeline_finished and s.finished_transcript_sha256 = sha, false) as finished_for_current from ({_QUEUE}) c left join {{video_state}} s on s.video_id = c.video_id")
def list_eligible_all(t: Tables) -> DataFrame:
    return q.list_eligible_videos(t.catalog, t.storage_objects, t.runs, _state(t), limit=None, include_applied=True).select("video_id", "transcript_sha256", "has_live_or_applied_run", "pipeline_status", "finished_for_current")


@query("first_unprocessed", f"select video_id from ({_QUEUE}) c order by live, published_at asc nulls last, video_id limit 1")
def first_unprocessed(t: Tables) -> DataFrame:
    return q.first_unprocessed(q.list_eligible_videos(t.catalog, t.storage_objects, t.runs, limit=None, include_applied=True)).select("video_id")


@query("refresh_qualification", f"""
select c.video_id, sha256(c.transcript_text) as transcript_sha256, case when c.reasons = '' then 'eligible' else 'ineligible' end as eligibility_status, c.reasons,
  case when stale then false else coalesce(s.pre_research_pipeline_finished, false) end as pre_research_pipeline_finished, case when not stale then s.finished_intent_id end as finished_intent_id,
  case when stale then case when c.reasons = '' then 'eligible' else 'not_started' end else coalesce(s.pipeline_status, 'not_started') end as pipeline_status
from (select c.*, {_REASONS} as reasons from {{catalog}} c) c left join {{video_state}} s on s.video_id = c.video_id,
  lateral (select s.finished_transcript_sha256 is not null and s.finished_transcript_sha256 is distinct from sha256(c.transcript_text) as stale) x""")
def refresh_qualification(t: Tables) -> DataFrame:
    out = q.refresh_qualification(t.catalog, t.storage_objects, t.runs, _state(t), F.lit("2024-01-05").cast("date"))
    return out.select("video_id", "transcript_sha256", "eligibility_status", F.array_join("ineligibility_reasons", ",").alias("reasons"), "pre_research_pipeline_finished", "finished_intent_id", "pipeline_status")


@query("qualification_counts", """
select eligibility_status, reason, count(*) as n_videos from (select eligibility_status, unnest(raw_reasons) as reason from {video_state}) where reason is not null group by all
union all select eligibility_status, null, count(*) from {video_state} group by rollup (eligibility_status)""")
def qualification_counts(t: Tables) -> DataFrame:
    return q.qualification_counts(_state(t))


@query("claim_batch", f"""
select sha256(video_id || '|' || sha || '|{NOW}') as run_id, video_id, sha as transcript_sha256, 'claimed' as status, 'pre-research/v2/' || video_id || '/' || sha256(video_id || '|' || sha || '|{NOW}') as packet_storage_prefix, '2024-01-05' as research_as_of
from ({_QUEUE}) c where not live order by published_at asc nulls last, video_id limit 20""")
def claim_batch(t: Tables) -> DataFrame:
    queue = q.list_eligible_videos(t.catalog, t.storage_objects, t.runs, limit=None, include_applied=True)
    return q.claim_batch(queue, t.runs, 20, NOW).select("run_id", "video_id", "transcript_sha256", "status", "packet_storage_prefix", F.col("research_as_of").cast("string").alias("research_as_of"))


@query("claim_named", f"""
select r.video_id, reason = '' as claimed, reason from (select distinct 'v' || lpad(cast(doc_id * 3 as varchar), 10, '0') as video_id from {{documents}}) r
left join lateral (select 1) one on true left join (select video_id as v, {_PRIMARY} as reason0 from (select video_id, {_REASONS} as reasons from {{catalog}} c)) x on x.v = r.video_id, lateral (select coalesce(reason0, 'VIDEO_NOT_FOUND') as reason) y""")
def claim_named(t: Tables) -> DataFrame:
    wanted = t.sql("select 'v' || lpad(cast(doc_id * 3 as string), 10, '0') as video_id from {documents}")
    return q.claim_named(wanted, t.catalog, t.storage_objects, t.runs, _state(t))


@query("expire_leases", f"""
select run_id, case when over then 'failed' else status end as status, case when over then 'LEASE_EXPIRED' else error_code end as error_code
from (select *, status in ('claimed', 'analyzing') and coalesce(lease_expires_at < timestamp '{NOW}', false) as over from {{runs}})""")
def expire_leases(t: Tables) -> DataFrame:
    return q.expire_leases(t.runs, F.lit(NOW).cast("timestamp_ntz")).select("run_id", "status", "error_code")


_TOUCHES = """select 'r' || lpad(cast(event_id as string), 10, '0') as run_id, 'l' || cast(event_id % 3 as string) as lease_token, cast(event_id % 30000 as int) as lease_seconds,
  case when event_id % 2 = 0 then 'applying' end as status, case when event_id % 3 = 0 then 'p' || cast(event_id as string) end as intent_path, cast(null as string) as intent_sha256 from {events}"""


@query("touch_runs", f"""
select r.run_id, coalesce(x.status, r.status) as status, coalesce(x.intent_path, r.intent_path) as intent_path, x.lease_seconds is not null as touched
from {{runs}} r left join (select * from ({_TOUCHES}) where lease_seconds between 60 and 21600) x on x.run_id = r.run_id and x.lease_token = r.lease_token""")
def touch_runs(t: Tables) -> DataFrame:
    after = q.touch_runs(t.runs, t.sql(_TOUCHES), F.lit("2031-01-01").cast("timestamp_ntz"))
    return after.select("run_id", "status", "intent_path", F.coalesce(F.col("lease_expires_at") >= F.lit("2031-01-01").cast("timestamp_ntz"), F.lit(False)).alias("touched"))
