"""Operator-shaped tables as SQL over the given tables, in a form that Spark and DuckDB both read.

A view's text names other tables as {name}. ``SHA[[x]]`` is the SHA-256 hex digest of x and ``ARR[[a, b]]`` an array, each
written as either engine wants it. Everything is an expression of row ids, so both engines see the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..vocabulary import ARTIFACT_FILES, CATEGORIES, DOMAINS, ENTITY_KINDS, RESOURCE_TYPES, RUN_STATUSES, SOURCE_ROLES

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _pick(values: tuple[str, ...], index: str) -> str:
    """The value at a place, from 0, by a list in text that both engines split alike."""
    return f"split_part('{','.join(values)}', ',', cast({index} as int) + 1)"


_V = "'v' || lpad(cast(doc_id as string), 10, '0')"
_R = "'r' || lpad(cast({} as string), 10, '0')"
_CAND = "cast(l_orderkey as string) || '-' || cast(l_linenumber as string)"

VIEWS = {
    "lines": """
select l_orderkey, l_linenumber, min(l_partkey) as l_partkey, min(l_suppkey) as l_suppkey, min(l_discount) as l_discount from {lineitem} group by l_orderkey, l_linenumber""",
    "catalog": f"""
select {_V} as video_id, substr(text, 1, 40) as title,
  case when doc_id % 17 = 3 then null else make_date(cast(2020 + doc_id % 5 as int), cast(1 + doc_id % 12 as int), cast(1 + doc_id % 28 as int)) end as published_at,
  case when doc_id % 13 = 5 then null when doc_id % 19 = 7 then 0 else cast((n_chars * 7) % 7200 as int) end as duration_seconds,
  case when doc_id % 5 = 4 then 'none' else 'stored' end as transcript_status,
  case when doc_id % 23 = 9 then 'other-bucket' else 'ai-engineer-transcripts' end as transcript_bucket,
  case when doc_id % 29 = 11 then null else 'talks/' || {_V} || '.txt' end as transcript_path,
  case when doc_id % 31 = 13 then '   ' when doc_id % 37 = 1 then null else text end as transcript_text,
  cast(n_chars as bigint) as transcript_char_count, lang as transcript_language, source as channel_id
from {{documents}}""",
    "storage_objects": f"""
select case when doc_id % 23 = 9 then 'other-bucket' else 'ai-engineer-transcripts' end as bucket_id, 'talks/' || {_V} || '.txt' as name, cast(n_chars as bigint) as size, SHA[[coalesce(text, '')]] as content_sha256
from {{documents}} where doc_id % 9 <> 2""",
    "runs": f"""
select {_R.format("e.event_id")} as run_id, {_V.replace("doc_id", "d.doc_id")} as video_id,
  case when e.event_id % 7 = 0 then SHA[['stale']] else SHA[[coalesce(d.text, '')]] end as transcript_sha256,
  {_pick(RUN_STATUSES, "e.event_id % 11")} as status, e.ts as created_at, 'l' || cast(e.event_id % 4 as string) as lease_token,
  case when e.event_id % 5 = 4 then null when e.event_id % 5 < 2 then e.ts + interval '3' hour else e.ts + interval '9' day end as lease_expires_at,
  'pre-research/v2/' || {_V.replace("doc_id", "d.doc_id")} || '/' || {_R.format("e.event_id")} as packet_storage_prefix,
  cast(null as string) as intent_path, cast(null as string) as intent_sha256, case when e.event_id % 11 = 9 then 'E' || cast(e.event_id % 3 as string) end as error_code
from {{events}} e join {{documents}} d on d.doc_id = cast(floor(e.event_id / 40) as bigint)""",
    "video_state": f"""
select {_V} as video_id, case when doc_id % 6 = 0 then SHA[['stale']] else SHA[[coalesce(text, '')]] end as transcript_sha256,
  case when doc_id % 4 = 0 then 'eligible' when doc_id % 4 = 1 then 'pending' else 'ineligible' end as eligibility_status,
  case when doc_id % 4 < 2 then ARR[[cast(null as string)]] when doc_id % 8 < 6 then ARR[['duration_missing']] else ARR[['transcript_text_empty', 'duration_missing']] end as raw_reasons,
  case when doc_id % 7 = 0 then 'finished' when doc_id % 10 = 3 then 'claimed' else 'eligible' end as pipeline_status, cast(n_chars % 9000 as int) as duration_seconds, doc_id % 9 <> 2 as transcript_object_exists,
  doc_id % 7 = 0 as pre_research_pipeline_finished, case when doc_id % 14 = 0 then SHA[[coalesce(text, '')]] when doc_id % 7 = 0 then SHA[['stale']] end as finished_transcript_sha256,
  case when doc_id % 7 = 0 then 'i' || cast(doc_id as string) end as finished_intent_id, cast('2024-01-01' as date) as evaluated_at
from {{documents}} where doc_id % 3 <> 1""",
    "sessions": f"""
select {_R.format("event_id - event_id % 40 + event_id % 3")} as run_id, case when event_id % 2 = 0 then 'research' else 'synthesis' end as phase, cast(floor((event_id % 40) / 6) + 1 as int) as attempt,
  's' || cast(event_id as string) as eve_session_id, case event_id % 5 when 0 then 'failed' when 1 then 'started' else 'completed' end as status, ts as started_at,
  case when event_id % 5 > 1 then case when event_id % 3 = 0 then ts + interval '10' minute when event_id % 3 = 1 then ts + interval '45' minute else ts + interval '2' hour end end as completed_at,
  case when event_id % 5 = 0 then 'SESSION_FAILED' end as error_code
from {{events}}""",
    "session_events": """
select cast(conv_id as string) as session_id, cast(turn as bigint) as seq,
  case when turn % 7 = 6 then 'session.waiting' when turn % 7 = 5 and conv_id % 3 = 0 then 'turn.failed' when turn % 7 = 4 then 'turn.completed' when role = 'assistant' then 'message.completed' else 'message.started' end as type, text as message
from {conversations}""",
    "candidates": f"""
select cast(l_orderkey as string) as analysis_id, {_CAND} as organization_candidate_id, 'org' || cast(l_suppkey % 40 as string) as normalized_name,
  l_linenumber = 1 and l_orderkey % 17 <> 3 or l_linenumber = 2 and l_orderkey % 19 = 5 as is_primary_featured, cast(case when l_orderkey % 23 = 4 then 1 else l_linenumber end as int) as featured_rank,
  {_pick((*DOMAINS, "unlisted_domain"), "l_partkey % 28")} as primary_domain_code,
  case l_partkey % 4 when 0 then '' when 1 then {_pick(DOMAINS, "l_suppkey % 27")} when 2 then {_pick(DOMAINS, "l_suppkey % 27")} || ',' || {_pick(DOMAINS, "l_partkey % 27")} else 'frontier_model_lab,cloud_ai_platform,frontier_model_lab' end as secondary_csv,
  case when l_orderkey % 3 = 0 then 'parent' end as parent_name, case when l_orderkey % 6 = 0 then 'https://parent.example' end as parent_canonical_url,
  case when l_linenumber = 1 and l_orderkey % 5 <> 0 then 'primary_featured_organization,partner' else 'mentioned_only' end as roles_csv, cast(l_discount * 10 as double) as confidence
from {{lines}}""",
    "sources": f"""
select {_CAND} as organization_candidate_id, cast(l_orderkey as string) as analysis_id, cast(1 + l_partkey % 3 as int) as source_rank, {_pick(SOURCE_ROLES, "l_suppkey % 14")} as source_role,
  {_pick(("first_party", "official_registry", "standards_body", "reputable_secondary"), "l_partkey % 4")} as authority_tier, l_returnflag <> 'R' as publicly_retrievable,
  {_pick(("verified", "likely", "uncertain", "verified"), "cast(l_quantity as bigint) % 4")} as verification_status, 'https://s.example/' || cast(l_partkey % 9 as string) as normalized_url
from {{lineitem}}
union all
select cast(l_orderkey as string) || '-1', cast(l_orderkey as string), cast(4 + l_linenumber as int), {_pick(SOURCE_ROLES, "l_partkey % 14")}, 'first_party', true, 'verified', 'https://t.example/' || cast(l_linenumber as string) from {{lineitem}}""",
    "analyses": f"""
select cast(o_orderkey as string) as analysis_id, {_R.format("o_orderkey")} as run_id, 'c' || cast(o_custkey as string) as video_id, {_pick(("introductory", "intermediate", "advanced", "expert"), "o_orderkey % 4")} as difficulty,
  {_pick(("talk", "tutorial", "demo", "panel", "interview", "workshop", "keynote"), "o_custkey % 7")} as content_form, cast((o_orderkey * 37) % 1001 as double) / 1000 as overall_confidence,
  repeat('word ', cast(60 + o_orderkey % 90 as int)) as initial_summary, repeat(' part', cast(150 + o_custkey % 300 as int)) as structured_summary
from {{orders}}""",
    "categories": f"""
select cast(o_orderkey as string) as analysis_id, 'c' || cast(o_custkey as string) as video_id, {_pick((*CATEGORIES, "unlisted_category"), "o_orderkey % 18")} as category_code, 'primary' as assignment_role, cast(null as int) as alternative_rank from {{orders}}
union all
select cast(l_orderkey as string), 'x', {_pick(CATEGORIES, "l_partkey % 17")}, case when l_suppkey % 31 = 0 then 'primary' else 'secondary' end, cast(l_linenumber as int) from {{lines}}""",
    "families": f"""
select cast(l_orderkey as string) as analysis_id, cast(case when l_suppkey % 29 = 0 then 1 else l_linenumber end as int) as family_rank, 'f' || cast(l_partkey % 50 as string) as family_label,
  {_pick(("current", "changed_since_publication", "historical", "uncertain"), "l_partkey % 4")} as temporal_status, cast(l_suppkey % 3 as int) as n_evidence, cast(l_partkey % 2 as int) as n_urls
from {{lines}} where l_orderkey % 5 <> 0""",
    "resources": f"""
select cast(page_id % 50 as string) as analysis_id, {_pick(RESOURCE_TYPES, "page_id % 12")} as resource_type, 'page ' || cast(page_id as string) as title, url, {_pick(("verified", "likely", "uncertain", "rejected"), "page_id % 4")} as verification_status,
  page_id % 3 = 0 as is_first_party, cast(page_id % 3 as int) as n_evidence, cast(page_id as bigint) as position from {{pages}}""",
    "entities": f"""
select cast(page_id % 50 as string) as analysis_id, {_pick(ENTITY_KINDS, "page_id % 10")} as entity_kind, 'n' || cast(page_id % 7 as string) as normalized_name, cast(page_id % 2 as int) as n_evidence from {{pages}}""",
    "searches": f"""
select 'u' || cast(user_id as string) as run_id, {_pick(("organization_researcher", "web_context_scout", "source_verifier"), "event_id % 7 % 3")} as subagent, ts as searched_at, cast(event_id % 11 as int) as n_results, cast(event_id % 4 as int) as n_selected
from {{events}}""",
    "kinds": "select * from (values " + ", ".join(f"({i}, '{k}', '{f}')" for i, (k, f) in enumerate(ARTIFACT_FILES.items())) + ") as k(kind_no, artifact_kind, file_name)",
    "bodies": f"""
select {_R.format("d.doc_id")} as run_id, {_V.replace("doc_id", "d.doc_id")} as video_id, k.artifact_kind as artifact_kind, 'pre-research/v2/' || {_V.replace("doc_id", "d.doc_id")} || '/' || {_R.format("d.doc_id")} as packet_storage_prefix, k.kind_no, d.doc_id as doc_id,
  '{{"run_id":"' || {_R.format("d.doc_id")} || '","kind":"' || k.artifact_kind || '","video_id":"' || case when (d.doc_id + k.kind_no) % 19 = 0 then 'other' else {_V.replace("doc_id", "d.doc_id")} end || '","evidence_ids":["e' || cast((d.doc_id + k.kind_no) % 5 as string) || '","e' || cast(d.doc_id % 3 as string) || '"]}}' as body, k.file_name as file_name
from {{documents}} d cross join {{kinds}} k where (d.doc_id + k.kind_no) % 13 <> 0""",
    "artifacts": """
select run_id, video_id, artifact_kind, 'research-ingestion-intents' as storage_bucket, packet_storage_prefix || '/' || case when (doc_id + kind_no) % 21 = 0 then 'elsewhere.json' else file_name end as storage_path,
  case when (doc_id + kind_no) % 17 = 0 then SHA[['x']] when (doc_id + kind_no) % 29 = 0 then 'not a hash' else SHA[[body]] end as content_sha256, cast(length(body) as bigint) as byte_count
from {bodies}""",
    "stored": """
select 'research-ingestion-intents' as bucket_id, packet_storage_prefix || '/' || file_name as name, SHA[[body]] as content_sha256, cast(length(body) as bigint) as size from {bodies} where (doc_id + kind_no) % 11 <> 0""",
    "packet_runs": "select distinct run_id, video_id, packet_storage_prefix from {bodies}",
}


def text_of(name_or_sql: str, spark: bool) -> str:
    """SQL of a view (or of any text) for Spark or for DuckDB."""
    sql = VIEWS.get(name_or_sql, name_or_sql)
    sha, arr = ("sha2(\\1, 256)", "array(\\1)") if spark else ("sha256(\\1)", "[\\1]")
    return re.sub(r"ARR\[\[(.*?)\]\]", arr, re.sub(r"SHA\[\[(.*?)\]\]", sha, sql))


def needs(sql: str) -> list[str]:
    return [n for n in dict.fromkeys(re.findall(r"\{(\w+)\}", sql)) if n in VIEWS or n in BASE]


def oracle(sql: str) -> str:
    """DuckDB SQL with every view that it names, directly or through others, as a common table expression."""
    order: list[str] = []

    def visit(text: str) -> None:
        for n in needs(text):
            if n in VIEWS and n not in order:
                visit(VIEWS[n])
                order.append(n)

    visit(sql)
    fill = lambda text: re.sub(r"\{(\w+)\}", lambda m: m[1] if m[1] in VIEWS or m[1] in BASE else m[0], text_of(text, False))
    return ("WITH " + ",\n".join(f"{n} AS ({fill(VIEWS[n])})" for n in order) + "\n" if order else "") + fill(sql)


class Tables:
    """The tables of a folder and the derived ones, by attribute; a table is read or defined when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def sql(self, text: str) -> DataFrame:
        """Spark SQL over {name} tables."""
        names = {n: f"packetmill_{n}_{id(self)}" for n in needs(text)}
        for n, view in names.items():
            getattr(self, n).createOrReplaceTempView(view)
        out = self.spark.sql(re.sub(r"\{(\w+)\}", lambda m: names.get(m[1], m[0]), text_of(text, True)))
        for view in names.values():
            self.spark.catalog.dropTempView(view)
        return out

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in VIEWS and name not in BASE:
            raise AttributeError(name)
        if name not in self._made:
            self._made[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet") if name in BASE else self.sql(VIEWS[name])
        return self._made[name]
