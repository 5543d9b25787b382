"""Queries of run and session state, the finished feed and the metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocabulary as v
from ..functions.urls import normalize_official_url
from ..operators import metrics as m
from ..operators import qualify as q
from ..operators import registry as r
from ..operators import state as s
from .derived import Tables
from .function_queries import _DROP, _TIDY
from .qualify_queries import _QUEUE, _state
from .registered import query
from .validate_queries import _FIT, _IDENTITY, _TECHNICAL, _in, _lines

_values = lambda values: "(values " + ", ".join(f"('{x}')" for x in values) + ") as k(value)"


@query("latest_live_run", f"select video_id, run_id, status from (select *, row_number() over (partition by video_id order by created_at desc nulls last, run_id) as k from {{runs}} where status in {_in(v.RESUMABLE)}) where k = 1")
def latest_live_run(t: Tables) -> DataFrame:
    return s.latest_live_run(t.runs).select("video_id", "run_id", "status")


@query("latest_session", "select run_id, phase, attempt, eve_session_id, status from (select *, row_number() over (partition by run_id, phase order by attempt desc, eve_session_id desc) as k from {sessions}) where k = 1")
def latest_session(t: Tables) -> DataFrame:
    return s.latest_session(t.sessions).select("run_id", "phase", "attempt", "eve_session_id", "status")


_LEGAL = ",".join(f"'{a}>{b}'" for a, b in v.TRANSITIONS)


@query("illegal_transitions", f"""
select video_id, previous, status from (select video_id, status, lag(status) over (partition by video_id order by created_at, run_id) as previous from {{runs}})
where previous is not null and previous <> status and not (status in ('failed', 'superseded') and previous not in ('applied', 'failed', 'superseded')) and previous || '>' || status not in ({_LEGAL})""")
def illegal_transitions(t: Tables) -> DataFrame:
    return s.illegal_transitions(t.runs, "video_id", ("created_at", "run_id"))


_BOUND = "select run_id, video_id, transcript_sha256, status, case when lease_token = 'l1' then null else 'a' || lease_token end as research_session_id, case when lease_token = 'l2' then null else 'b' || lease_token end as synthesis_session_id from {runs}"
_ASKS = "select event_id as request_id, 'r' || lpad(cast(event_id - event_id % 40 + event_id % 3 as string), 10, '0') as run_id, case event_id % 3 when 0 then 'save_research' when 1 then 'save_synthesis' else 'load_research' end as action, case when event_id % 2 = 0 then 'a' else 'b' end || 'l' || cast(event_id % 4 as string) as session_id, case when event_id % 10 = 3 then 'other' end as packet_video_id, case when event_id % 14 = 5 then SHA[['q']] end as packet_sha256 from {events}"


@query("phase_access", f"""
select a.request_id, case when r.run_id is null then 'RUN_NOT_FOUND' when a.packet_video_id <> r.video_id then 'VIDEO_MISMATCH' when a.packet_sha256 <> r.transcript_sha256 then 'TRANSCRIPT_HASH_MISMATCH'
  when action = 'save_research' and status not in ('claimed', 'analyzing') or action = 'save_synthesis' and status <> 'synthesizing' or action = 'load_research' and status not in ('research_complete', 'synthesizing') then 'ILLEGAL_PHASE'
  when action = 'save_synthesis' and synthesis_session_id is null then 'SESSION_BINDING_PENDING'
  when action = 'save_research' and research_session_id <> session_id or action = 'save_synthesis' and synthesis_session_id <> session_id or action = 'load_research' and status = 'synthesizing' and synthesis_session_id <> session_id then 'SESSION_MISMATCH' end as code
from ({_ASKS}) a left join ({_BOUND}) r on r.run_id = a.run_id""")
def phase_access(t: Tables) -> DataFrame:
    return s.phase_access(t.sql(_BOUND), t.sql(_ASKS))


_LAST = "select video_id, run_id, status from (select *, row_number() over (partition by video_id order by created_at desc, run_id desc) as k from {runs}) where k = 1"


@query("project_video_state", f"select s.video_id, l.run_id as latest_run_id, case when s.pre_research_pipeline_finished then 'finished' else coalesce(case l.status when 'analyzing' then 'researching' when 'queued' then 'eligible' else l.status end, s.pipeline_status) end as pipeline_status from {{video_state}} s left join ({_LAST}) l on l.video_id = s.video_id")
def project_video_state(t: Tables) -> DataFrame:
    return s.project_video_state(t.runs, _state(t)).select("video_id", "latest_run_id", "pipeline_status")


@query("fail_sessions", "select run_id, eve_session_id, case when status = 'started' and eve_session_id like '%1' then 'failed' else status end as status, case when status = 'started' and eve_session_id like '%1' then 'SYNTHESIS_FAILED' else error_code end as error_code from {sessions}")
def fail_sessions(t: Tables) -> DataFrame:
    failures = t.sessions.where("eve_session_id like '%1'").select("run_id", "eve_session_id", F.lit("SYNTHESIS_FAILED").alias("error_code"))
    return s.fail_sessions(t.sessions, failures, F.lit("2024-02-01").cast("timestamp_ntz")).select("run_id", "eve_session_id", "status", "error_code")


@query("revert_failed_synthesis", f"select run_id, case when status = 'synthesizing' and run_id like '%2' then 'research_complete' else status end as status, case when not (status = 'synthesizing' and run_id like '%2') then synthesis_session_id end as synthesis_session_id from ({_BOUND})")
def revert_failed_synthesis(t: Tables) -> DataFrame:
    return s.revert_failed_synthesis(t.sql(_BOUND), t.runs.where("run_id like '%2'")).select("run_id", "status", "synthesis_session_id")


@query("phase_from_status", "select run_id, case when status in ('claimed', 'analyzing') then 'research' when status in ('research_complete', 'synthesizing') then 'synthesis' end as phase from {runs}")
def phase_from_status(t: Tables) -> DataFrame:
    return t.runs.select("run_id", s.phase_from_status(F.col("status")).alias("phase"))


def _gone(kinds: str) -> str:
    return f"select p.run_id, coalesce(string_agg(k.artifact_kind, ',' order by k.kind_no) filter (a.run_id is null), '') as missing from {{runs}} p cross join (select * from {{kinds}} where {kinds}) k left join {{artifacts}} a on a.run_id = p.run_id and a.artifact_kind = k.artifact_kind and length(a.content_sha256) = 64 group by p.run_id"


@query("next_actions", f"""
select run_id, case when phase = 'research' then case when rm = '' then 'mark_research_complete' when ses = 'failed' then 'fail_research' when ses = 'started' then 'wait_research' when ses is null then 'start_research' else 'resume_research' end
    when status = 'synthesizing' and sm = '' then 'complete_synthesis' when status = 'synthesizing' and ses = 'failed' then 'revert_synthesis' when status = 'synthesizing' and ses = 'started' then 'wait_synthesis' when phase = 'synthesis' then 'start_synthesis'
    when status in ('intent_ready', 'applying') then 'apply' when status = 'applied' then 'finalize' else 'none' end as action,
  case when phase = 'research' and ses = 'completed' and rm <> '' then 'RESEARCH_CHECKPOINT_INCOMPLETE: ' || rm when status = 'synthesizing' and ses = 'completed' and sm <> '' then 'SYNTHESIS_PACKET_INCOMPLETE: ' || sm when status = 'review_required' then 'Automatic apply refused: run is review_required' end as error
from (select p.run_id, p.status, p.phase, l.status as ses, a.missing as rm, b.missing as sm from (select run_id, status, case when status in ('claimed', 'analyzing') then 'research' when status in ('research_complete', 'synthesizing') then 'synthesis' end as phase from {{runs}}) p
  left join (select * from (select *, row_number() over (partition by run_id, phase order by attempt desc, eve_session_id desc) as k from {{sessions}}) where k = 1) l on l.run_id = p.run_id and l.phase = p.phase join ({_gone("kind_no < 7")}) a on a.run_id = p.run_id join ({_gone("kind_no between 7 and 10")}) b on b.run_id = p.run_id)""")
def next_actions(t: Tables) -> DataFrame:
    return s.next_actions(t.runs, t.sessions, t.artifacts)


@query("run_summary", "select r.run_id, r.video_id, coalesce(s.pipeline_status, r.status) as phase, r.packet_storage_prefix, coalesce(s.pre_research_pipeline_finished, false) as finished from {runs} r left join {video_state} s on s.video_id = r.video_id")
def run_summary(t: Tables) -> DataFrame:
    return s.run_summary(t.runs, _state(t))


_ANALYSES = "select 'a' || run_id as analysis_id, run_id from {runs}"
_KIDS = "select 'ar' || lpad(cast(l_orderkey as string), 10, '0') as analysis_id, l_linenumber, l_suppkey from {lines}"


@query("finished_feed", f"""
select c.video_id, c.title, r.run_id, s.finished_intent_id, coalesce(k.lines, '') as lines from {{catalog}} c join {{video_state}} s on s.video_id = c.video_id and s.pre_research_pipeline_finished and s.finished_transcript_sha256 = s.transcript_sha256
join {{runs}} r on r.video_id = c.video_id and r.status = 'applied' and r.transcript_sha256 = s.finished_transcript_sha256 left join (select analysis_id, string_agg(l_linenumber || ':' || l_suppkey, ',' order by l_linenumber, l_suppkey) as lines from ({_KIDS}) group by 1) k on k.analysis_id = 'a' || r.run_id""")
def finished_feed(t: Tables) -> DataFrame:
    feed = s.finished_feed(t.catalog, _state(t), t.runs, t.sql(_ANALYSES), {"lines": (t.sql(_KIDS), ("l_linenumber", "l_suppkey"))})
    lines = F.array_join(F.transform(F.coalesce("lines", F.array().cast("array<struct<l_linenumber:bigint,l_suppkey:bigint>>")), lambda x: F.concat_ws(":", x["l_linenumber"], x["l_suppkey"])), ",")
    return feed.select("video_id", "title", "run_id", "finished_intent_id", lines.alias("lines"))


_REAL = "exists (select 1 from {runs} r where r.video_id = s.video_id and r.transcript_sha256 = s.transcript_sha256 and r.status = 'applied' and r.run_id not like '%5')"


@query("finished_invariant_violations", _lines(*[f"select video_id, '{c}' as code from {{video_state}} s where {w}" for c, w in (
    ("FINISHED_WITHOUT_PROOF", f"pre_research_pipeline_finished and not {_REAL}"), ("PROOF_WITHOUT_FINISHED", f"not pre_research_pipeline_finished and {_REAL}"), ("FINISHED_HASH_STALE", "pre_research_pipeline_finished and finished_transcript_sha256 is distinct from transcript_sha256"),
    ("FINISHED_INTENT_MISSING", "pre_research_pipeline_finished and finished_intent_id is null"), ("FINISHED_LABEL_MISMATCH", "pre_research_pipeline_finished and pipeline_status <> 'finished'"),
)]))
def finished_invariant_violations(t: Tables) -> DataFrame:
    return s.finished_invariant_violations(_state(t), t.runs, t.sql(_ANALYSES), t.runs.select("run_id", (~F.col("run_id").endswith("5")).alias("complete")))


@query("uniqueness_violations", f"select 'live run' as rule, video_id || '|' || transcript_sha256 as key, count(*) as n from {{runs}} where status in {_in(v.OCCUPYING)} group by all having count(*) > 1 union all select 'session', run_id || '|' || phase || '|' || attempt, count(*) from {{sessions}} group by all having count(*) > 1 union all select 'primary category', analysis_id, count(*) from {{categories}} where assignment_role = 'primary' group by all having count(*) > 1")
def uniqueness_violations(t: Tables) -> DataFrame:
    return s.uniqueness_violations({
        "live run": (t.runs.where(F.col("status").isin(*v.OCCUPYING)), ("video_id", "transcript_sha256")), "session": (t.sessions, ("run_id", "phase", "attempt")),
        "primary category": (t.categories.where("assignment_role = 'primary'"), ("analysis_id",)),
    })


# --- metrics


@query("queue_age", f"select min(published_at) as oldest, (date '2026-08-16' - min(published_at))::int as age_days, count(*) as queue_length from ({_QUEUE}) where not live")
def queue_age(t: Tables) -> DataFrame:
    return m.queue_age(q.list_eligible_videos(t.catalog, t.storage_objects, t.runs, limit=None), F.lit("2026-08-16").cast("date"))


@query("run_status_counts", f"select value, count(r.run_id) as n from {_values(v.RUN_STATUSES)} left join {{runs}} r on r.status = value group by 1")
def run_status_counts(t: Tables) -> DataFrame:
    return m.status_counts(t.runs, "status", v.RUN_STATUSES)


@query("pipeline_label_counts", f"select value, count(s.video_id) as n from {_values(v.PIPELINE_LABELS)} left join {{video_state}} s on s.pipeline_status = value group by 1")
def pipeline_label_counts(t: Tables) -> DataFrame:
    return m.status_counts(t.video_state, "pipeline_status", v.PIPELINE_LABELS)


@query("session_stats", "select phase, count(*) as starts, count_if(status = 'completed') as completions, count_if(status = 'failed') as failures, count_if(attempt > 1) as retries, count_if(status = 'started' and not eve_session_id like '%6') as orphans from {sessions} group by 1")
def session_stats(t: Tables) -> DataFrame:
    return m.session_stats(t.sessions, t.sessions.where("eve_session_id like '%6'").select("run_id", "phase", "eve_session_id"))


@query("stage_durations", """
select phase, count(*) as n, avg(s) as avg_seconds, quantile_cont(s, 0.5) as p50_seconds, quantile_cont(s, 0.95) as p95_seconds, max(s) as max_seconds from (
  select phase, cast(floor(epoch(completed_at)) - floor(epoch(started_at)) as bigint) as s from {sessions} where completed_at is not null
  union all select 'end_to_end', cast(floor(epoch(max(completed_at))) - floor(epoch(min(started_at))) as bigint) from {sessions} where completed_at is not null group by run_id) group by 1""")
def stage_durations(t: Tables) -> DataFrame:
    return m.stage_durations(t.sessions)


_ACCURACY = 100
_TOOK = "select phase, cast(floor(epoch(completed_at)) - floor(epoch(started_at)) as bigint) as s from {sessions} where completed_at is not null union all select 'end_to_end', cast(floor(epoch(max(completed_at))) - floor(epoch(min(started_at))) as bigint) from {sessions} where completed_at is not null group by run_id"


@query("stage_quantiles", f"select phase, count(*) as n, avg(s) as avg_seconds, max(s) as max_seconds, true as p50_within, true as p95_within from ({_TOOK}) group by 1")
def stage_quantiles(t: Tables) -> DataFrame:
    """Sketched quantiles, and whether the exact rank of each lies within the stated error of the one asked for."""
    found = m.stage_quantiles(t.sessions, (0.5, 0.95), _ACCURACY)
    each = m._durations(t.sessions).join(found.select("phase", "quantiles"), "phase")
    below, upto = ([F.sum((F.col("s") < F.col("quantiles")[k]).cast("long")) for k in (0, 1)], [F.sum((F.col("s") <= F.col("quantiles")[k]).cast("long")) for k in (0, 1)])
    n = F.count("*")
    within = [(below[k] <= n * p + n / _ACCURACY + 1) & (upto[k] >= n * p - n / _ACCURACY - 1) for k, p in enumerate((0.5, 0.95))]
    ranks = each.groupBy("phase").agg(within[0].alias("p50_within"), within[1].alias("p95_within"))
    return found.join(ranks, "phase").select("phase", "n", "avg_seconds", "max_seconds", "p50_within", "p95_within")


@query("stage_gaps", """
select run_id, ended as research_end, moment as synthesis_start, cast(floor(epoch(moment)) - floor(epoch(ended)) as bigint) as gap_seconds from (
  select *, lag(moment) over w as ended, lag(starts) over w as was from (
    select run_id, completed_at as moment, 0 as starts from {sessions} where phase = 'research' and status = 'completed' and completed_at is not null
    union all select run_id, started_at, 1 from {sessions} where phase = 'synthesis') window w as (partition by run_id order by moment, starts))
where starts = 1 and was = 0""")
def stage_gaps(t: Tables) -> DataFrame:
    return m.stage_gaps(t.sessions)


@query("search_stats", "select run_id, subagent, count(*) as searches, sum(n_results)::bigint as results, sum(n_selected)::bigint as selected from {searches} group by 1, 2")
def search_stats(t: Tables) -> DataFrame:
    return m.search_stats(t.searches)


@query("first_party_share", "select count(*) as n_analyses, avg(case when exists (select 1 from {resources} r where r.analysis_id = a.analysis_id and r.is_first_party and r.verification_status = 'verified') then 1.0::double else 0 end) as first_party_share from (select distinct analysis_id from {resources}) a")
def first_party_share(t: Tables) -> DataFrame:
    return m.first_party_share(t.resources, t.resources)


@query("organization_domain_distribution", "select primary_domain_code, count(*) as n, count(*)::double / sum(count(*)) over () as share from {candidates} where is_primary_featured group by 1")
def organization_domain_distribution(t: Tables) -> DataFrame:
    return m.organization_domain_distribution(t.candidates)


@query("source_quality", f"""
select * from (select count(*) as n_sources, avg((verification_status = 'verified')::int) as verified, avg((authority_tier <> 'reputable_secondary')::int) as official, avg(publicly_retrievable::int) as public from {{sources}}),
 (select count(*) as n_primaries, avg(coalesce(m, false)::int) as minimum_met from {{candidates}} c left join (select organization_candidate_id, bool_or({_FIT} and source_role in {_IDENTITY}) and bool_or({_FIT} and source_role in {_TECHNICAL}) as m from {{sources}} group by 1) s on s.organization_candidate_id = c.organization_candidate_id where is_primary_featured)""")
def source_quality(t: Tables) -> DataFrame:
    return m.source_quality(t.sources, t.candidates)


@query("technology_family_shape", "select case when k is null then 'zero' when k = 1 then 'one' else 'several' end as shape, count(*) as n, count(*)::double / sum(count(*)) over () as share from {analyses} a left join (select analysis_id, count(*) as k from {families} group by 1) f on f.analysis_id = a.analysis_id group by 1")
def technology_family_shape(t: Tables) -> DataFrame:
    return m.technology_family_shape(t.families, t.analyses)


@query("review_and_failure_rates", "select code, count(*) as n, count(*)::double / (select count(*) from {runs}) as share from (select case status when 'review_required' then 'review_required' when 'failed' then coalesce(error_code, 'UNKNOWN') end as code from {runs}) where code is not null group by 1")
def review_and_failure_rates(t: Tables) -> DataFrame:
    return m.review_and_failure_rates(t.runs)


@query("category_stability", """
select video_id, sum(n)::bigint as runs, count(*) as primaries, arg_min(category_code, struct_pack(a := -n, b := category_code)) as modal_code, max(n)::double / sum(n) as modal_share from (select video_id, category_code, count(*) as n from {categories} where assignment_role = 'primary' group by 1, 2) group by 1""")
def category_stability(t: Tables) -> DataFrame:
    return m.category_stability(t.categories)


@query("category_audit", "select category_code, difficulty, content_form, grouping_id(category_code, difficulty, content_form)::bigint as level, count(*) as n from {categories} c join {analyses} a using (analysis_id) where assignment_role = 'primary' group by cube (category_code, difficulty, content_form)")
def category_audit(t: Tables) -> DataFrame:
    return m.category_audit(t.categories, t.analyses)


@query("stratified_golden_set", """
select analysis_id, category_code, place::int as place from (select analysis_id, category_code, row_number() over (partition by category_code order by sha256('golden|' || analysis_id), analysis_id) as place, ceil(45.0 / (select count(distinct category_code) from {categories} where assignment_role = 'primary')) as quota from {categories} where assignment_role = 'primary') where place <= quota""")
def stratified_golden_set(t: Tables) -> DataFrame:
    return m.stratified_golden_set(t.categories)


@query("review_queue", "select analysis_id, overall_confidence from {analyses} where overall_confidence < 0.7")
def review_queue(t: Tables) -> DataFrame:
    return m.review_queue(t.analyses).select("analysis_id", "overall_confidence")


_CLAIMS = f"select cast(page_id % 50 as string) as analysis_id, {_TIDY.format(_DROP)} as url, page_id from {{pages}} where page_id % 3 = 0 and page_id % 4 = 0"


@query("verified_claim_conflicts", f"select distinct analysis_id, url from ({_CLAIMS}) where (analysis_id, url) not in (select analysis_id, url from ({_CLAIMS}) where page_id % 8 = 0)")
def verified_claim_conflicts(t: Tables) -> DataFrame:
    claims = t.resources.withColumn("url", normalize_official_url(F.col("url")))
    checked = claims.where("position % 8 = 0")
    return m.verified_claim_conflicts(claims, checked)


@query("required_search_gaps", f"select run_id, value as subagent from (select distinct run_id from {{searches}}), {_values(v.SUBAGENTS)} where (run_id, value) not in (select run_id, subagent from {{searches}} where n_results = 1 and n_selected < 2)")
def required_search_gaps(t: Tables) -> DataFrame:
    return m.required_search_gaps(t.searches, t.searches.where("n_results = 1 and n_selected < 2"))


@query("packet_inventory", "select artifact_kind, count(*) as n, sum(byte_count)::bigint as bytes from {artifacts} group by 1")
def packet_inventory(t: Tables) -> DataFrame:
    return r.artifact_marks(t.artifacts, t.stored).groupBy("artifact_kind").agg(F.count("*").alias("n"), F.sum("byte_count").alias("bytes"))
