"""Queries of the contract checks over JSON bodies derived from documents, and of listings and windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import apply as a
from ..operators import registry as r
from ..operators import validate as x
from ..sources.packets import listing_from_table
from ..streaming import search_counts_stream
from .derived import Tables
from .registered import query
from .validate_queries import _lines

_UUID = "'0b8f9d0e-7f0a-4c1e-9b1a-' || lpad(cast(doc_id as string), 12, '0')"
_S = "cast(doc_id as string)"

_ENVELOPES = f"""select doc_id as intent_id, '{{"schema_version":"2.0.0","intent_id":"' || case when doc_id % 7 = 1 then 'x' else {_UUID} end || '","source":{{"run_id":"' || {_UUID} || '","video_id":"' || case when doc_id % 11 = 2 then '' else 'v' end || '","transcript_sha256":"' || SHA[[{_S}]]
  || '","model_id":"' || case when doc_id % 13 = 3 then 'other' else 'zai/glm-5.2' end || '","research_as_of":"2026-0' || cast(doc_id % 10 as string) || '-11"}},"idempotency_key":"' || case when doc_id % 17 = 4 then 'K' else '' end || SHA[[{_S}]] || '","evidence_grades_used":[' || case when doc_id % 5 = 0 then '' when doc_id % 5 = 1 then '"guess"' else '"verified_external"' end
  || '],"operations":[' || case when doc_id % 19 = 5 then '' else '{{"kind":"k"}}' end || ']}}' as body from {{documents}}"""


@query("validate_envelope", _lines(*[f"select doc_id as intent_id, '{m}' as message from {{documents}} where {c}" for c, m in (
    ("doc_id % 7 = 1", "intent_id is not a uuid"), ("doc_id % 17 = 4", "idempotency_key is not a hash"), ("doc_id % 13 = 3", "source.model_id is not the fixed model"), ("doc_id % 11 = 2", "source.video_id is empty"), ("doc_id % 5 = 0", "evidence_grades_used is empty"),
    ("doc_id % 5 = 1", "evidence_grades_used has an unknown grade"), ("doc_id % 19 = 5", "operations is empty"), ("doc_id % 10 = 0", "source.research_as_of is not a date"),
)]))
def validate_envelope(t: Tables) -> DataFrame:
    return x.validate_envelope(t.sql(_ENVELOPES))


_PAYLOADS = f"""select doc_id as intent_id, cast(0 as int) as operation_index, 'replace_domain_assignments' as kind, '[' || case when doc_id % 7 = 0 then '' else '{{"domain_code":"' || case when doc_id % 5 = 0 then '' else 'd' end || '","confidence":' || case when doc_id % 3 = 0 then '1.5' else '0.25' end || ',"rationale":"r"}}' end || ']' as payload from {{documents}}
union all select doc_id, 1, 'upsert_resource_candidates', '[{{"resource_type":"' || case when doc_id % 4 = 0 then 'poem' else 'paper' end || '","title":"t","url":"' || case when doc_id % 6 = 1 then 'no url' else 'https://a.example/' end || '","normalized_url":"n","relationship_to_video":"r","why_valuable":"w","verification_status":"likely","is_first_party":' || case when doc_id % 9 = 2 then '1' else 'true' end || ',"confidence":1,"evidence_ids":["' || {_UUID} || '"]}}]' from {{documents}}
union all select doc_id, 2, 'create_video_analysis', '{{"initial_summary":"' || repeat('a', cast(150 + doc_id % 100 as int)) || '","structured_summary":"' || repeat('b', 400) || '","contextualized_abstract":"' || repeat('c', 200) || '","why_it_matters":"' || repeat('d', 40) || '","key_takeaways":[' || case when doc_id % 8 = 0 then '"1"' else '"1","2","3","4","5"' end
  || '],"concepts":[],"prerequisites":[],"learning_outcomes":[],"limitations":[],"quantitative_claims":[],"demonstrations":[],"curriculum_roles":[],"challenge_seeds":[],"difficulty":"' || case when doc_id % 10 = 3 then 'hard' else 'expert' end || '","content_form":"talk","evidence_level":"anecdotal","overall_confidence":0.5}}' from {{documents}}
union all select doc_id, 3, 'replace_lifecycle_assignments', '["design"' || case when doc_id % 12 = 4 then ',"later"' else '' end || ']' from {{documents}}"""


@query("validate_payload", _lines(*[f"select doc_id as intent_id, {i}::int as operation_index, '{m}' as message from {{documents}} where {c}" for i, c, m in (
    (0, "doc_id % 7 = 0", "replace_domain_assignments must have 1 to 6 items"), (0, "doc_id % 7 <> 0 and doc_id % 5 = 0", "domain_code breaks text"), (0, "doc_id % 7 <> 0 and doc_id % 3 = 0", "confidence breaks unit"), (1, "doc_id % 4 = 0", "resource_type breaks enum"),
    (1, "doc_id % 6 = 1", "url breaks url"), (1, "doc_id % 9 = 2", "is_first_party breaks bool"), (2, "doc_id % 100 < 50", "initial_summary breaks text"), (2, "doc_id % 8 = 0", "key_takeaways breaks list"), (2, "doc_id % 10 = 3", "difficulty breaks enum"), (3, "doc_id % 12 = 4", "x breaks enum"),
)]))
def validate_payload(t: Tables) -> DataFrame:
    return x.validate_payload(t.sql(_PAYLOADS))


_RECEIPTS = f"""select doc_id as intent_id, case when doc_id % 9 = 0 then '{{' else '{{"schema_version":"' || case doc_id % 3 when 0 then '1.0.0' when 1 then '2.0.0' else '3' end || '","intent_id":"' || {_UUID} || '","run_id":"' || {_UUID} || '","video_id":"v","intent_sha256":"' || case when doc_id % 5 = 0 then 'h' else SHA[[{_S}]] end || '","status":"' || case when doc_id % 7 = 0 then 'lost' else 'applied' end
  || '","applied_at":' || case when doc_id % 4 = 0 then 'null' when doc_id % 4 = 1 then '"2026-08-16T12:34:56.000Z"' else '"soon"' end || ',"analysis_id":null,"operations":[]' || case when doc_id % 2 = 0 then ',"packet_schema_version":"2.0.0","packet_storage_prefix":"p","finished_marker_written":false,"artifact_count":11' else '' end || '}}' end as body from {{documents}}"""


@query("validate_receipts", _lines(*[f"select doc_id as intent_id, '{m}' as message from {{documents}} where {c}" for c, m in (
    ("doc_id % 9 = 0", "invalid_json"), ("doc_id % 9 <> 0 and doc_id % 3 = 2", "unsupported"), ("doc_id % 9 <> 0 and doc_id % 3 < 2 and doc_id % 5 = 0", "intent_sha256 breaks sha"), ("doc_id % 9 <> 0 and doc_id % 3 < 2 and doc_id % 7 = 0", "status breaks enum"), ("doc_id % 9 <> 0 and doc_id % 3 < 2 and doc_id % 4 > 1", "applied_at breaks time"),
    *[("doc_id % 3 = 1 and doc_id % 2 = 1", m) for m in ("packet_schema_version breaks text", "packet_storage_prefix breaks text", "finished_marker_written breaks bool", "artifact_count breaks int")],
)]))
def validate_receipts(t: Tables) -> DataFrame:
    return x.validate_receipts(t.sql(_RECEIPTS))


_FILES = f"""select doc_id as run_id, 'web_context' as artifact_kind, '{{"schema_version":"' || case when doc_id % 5 = 0 then '1.0.0' else '2.0.0' end || '","run_id":"' || {_UUID} || '","video_id":"v","transcript_sha256":"' || SHA[[{_S}]] || '","research_as_of":"2026-08-' || cast(doc_id % 50 + 10 as string) || '","searches":' || case when doc_id % 3 = 0 then '{{}}' else '[]' end || ',"resources":[],"entities":[],"verified_results":[]}}' as body from {{documents}}
union all select doc_id, 'taxonomy_classification', '{{"schema_version":"2.0.0","run_id":"' || {_UUID} || '","video_id":"v","transcript_sha256":"' || SHA[[{_S}]] || '","research_as_of":"2026-08-16","taxonomy_version":"1","secondary":[1' || case when doc_id % 4 = 0 then ',2,3,4' else '' end || '],"domains":[' || case when doc_id % 6 = 0 then '' else '1' end || '],"lifecycle_stages":["design"],"difficulty":"expert","content_form":"talk","evidence_level":"anecdotal"}}' from {{documents}}"""


@query("validate_research_artifacts", _lines(*[f"select doc_id as run_id, '{k}' as artifact_kind, '{m}' as message from {{documents}} where {c}" for k, c, m in (
    ("web_context", "doc_id % 5 = 0", "schema_version breaks enum"), ("web_context", "doc_id % 50 + 10 > 31", "research_as_of breaks date"), ("web_context", "doc_id % 3 = 0", "searches breaks list"), ("taxonomy_classification", "doc_id % 4 = 0", "secondary breaks list"), ("taxonomy_classification", "doc_id % 6 = 0", "domains breaks list"),
)]))
def validate_research_artifacts(t: Tables) -> DataFrame:
    return x.validate_research_artifacts(t.sql(_FILES))


_MATCH = "select doc_id as run_id, source as summary, case when doc_id % 5 = 0 then null when doc_id % 5 = 1 then 'other' else source end as intent_summary, cast(doc_id % 4 as int) as n_families, case when doc_id % 6 = 0 then null else cast(doc_id % 3 as int) end as intent_families, ARR[['a', lang]] as candidate_ids, case when doc_id % 7 = 0 then ARR[['a']] else ARR[['a', 'en', 'fr', 'de', 'es']] end as intent_candidate_ids, ARR[['s']] as source_ids, case when doc_id % 8 = 0 then ARR[['t']] else ARR[['s']] end as intent_source_ids from {documents}"


@query("validate_intent_matches_files", _lines(
    "select doc_id as run_id, 'create_contextualized_initial_summary must match 60-initial-summary.json' as message from {documents} where doc_id % 5 = 1", "select doc_id, 'replace_technology_library_summaries must match 70-technology-library-summary.json' from {documents} where doc_id % 6 <> 0 and doc_id % 4 <> doc_id % 3",
    "select doc_id, 'organization_profile candidate is missing from replace_organization_candidates' from {documents} where doc_id % 7 = 0 and lang <> 'a'", "select doc_id, 'organization_profile source is missing from replace_organization_sources' from {documents} where doc_id % 8 = 0",
))
def validate_intent_matches_files(t: Tables) -> DataFrame:
    return x.validate_intent_matches_files(t.sql(_MATCH))


_USED = "select doc_id as intent_id, case when doc_id % 4 = 0 then 'replace_evidence_anchors' else 'upsert_resource_candidates' end as kind, '[{\"evidence_ids\":[\"e' || cast(doc_id % 3 as string) || '\",\"e9\"]},{\"evidence_id\":\"e' || cast(doc_id % 7 as string) || '\"}]' as payload from {documents}"


@query("missing_evidence_applied", "select distinct 'a' || doc_id as analysis_id, e as evidence_id from (select doc_id, unnest(['e' || (doc_id % 3), 'e9', 'e' || (doc_id % 7)]) as e from {documents} where doc_id % 4 <> 0) where not (e = 'e9' and doc_id % 2 = 0) and e <> 'e1'")
def missing_evidence_applied(t: Tables) -> DataFrame:
    anchors = t.sql("select 'a' || cast(doc_id as string) as analysis_id, 'e1' as evidence_id from {documents} union all select 'a' || cast(doc_id as string), 'e9' from {documents} where doc_id % 2 = 0")
    return x.missing_evidence_applied(t.sql(_USED), anchors, t.sql("select doc_id as intent_id, 'a' || cast(doc_id as string) as analysis_id from {documents}"))


@query("registry_after", """
select run_id, artifact_kind, content_sha256 from (select run_id, artifact_kind, 'old' as content_sha256 from {bodies} where doc_id % 3 = 0
  union all select run_id, artifact_kind, sha256(body) from {bodies} where doc_id % 2 = 0 and doc_id % 3 <> 0)""")
def registry_after(t: Tables) -> DataFrame:
    held = t.sql("select run_id, artifact_kind, 'p' as storage_path, 'old' as content_sha256 from {bodies} where doc_id % 3 = 0")
    new = t.sql("select run_id, artifact_kind, 'p' as storage_path, SHA[[body]] as content_sha256 from {bodies} where doc_id % 2 = 0")
    return r.registry_after(held, new).select("run_id", "artifact_kind", "content_sha256")


@query("apply_rows", "select 'a' || (doc_id % 40) as analysis_id, n_chars::bigint as n from {documents} where (doc_id % 40) % 3 <> 0 union all select 'a' || (doc_id % 40), -n_chars::bigint from {documents} where (doc_id % 40) % 3 = 0")
def apply_rows(t: Tables) -> DataFrame:
    target = t.sql("select 'a' || cast(doc_id % 40 as string) as analysis_id, cast(n_chars as bigint) as n from {documents}")
    incoming = t.sql("select 'i' || cast(doc_id % 40 as string) as intent_id, 'a' || cast(doc_id % 40 as string) as analysis_id, -cast(n_chars as bigint) as n from {documents}")
    results = t.sql("select distinct 'i' || cast(doc_id % 40 as string) as intent_id, case when (doc_id % 40) % 3 = 0 then 'applied' when (doc_id % 40) % 3 = 1 then 'refused' else 'already_applied' end as result from {documents}")
    return a.apply_rows(results, incoming, target, ["analysis_id"]).select("analysis_id", "n")


@query("storage_listing", "select name, size from {stored} where size % 5 <> 0")
def storage_listing(t: Tables) -> DataFrame:
    objects = t.sql("select bucket_id, name, case when size % 5 = 0 then null else '{\"size\":' || cast(size as string) || '}' end as metadata from {stored}")
    return listing_from_table(objects).select("name", "size")


@query("search_counts", "select date_trunc('hour', searched_at)::timestamp as window_start, subagent, count(*) as searches from {searches} group by all")
def search_counts(t: Tables) -> DataFrame:
    timed = t.searches.withColumn("searched_at", F.col("searched_at").cast("timestamp"))
    return search_counts_stream(timed).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
