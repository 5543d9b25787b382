"""Queries of the validators over candidates, sources, categories, families, packets and intents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocabulary as v
from ..operators import validate as x
from .derived import Tables
from .registered import query

_in = lambda values: "(" + ",".join(f"'{c}'" for c in values) + ")"
_IDENTITY, _TECHNICAL, _TIERS, _DOMAINS = map(_in, (v.IDENTITY_ROLES, v.TECHNICAL_ROLES, v.AUTHORITATIVE_TIERS, v.DOMAINS))
_FIT = f"publicly_retrievable and verification_status = 'verified' and authority_tier in {_TIERS}"
_MINIMUM = f"select organization_candidate_id, bool_or({_FIT} and source_role in {_IDENTITY}) as i, bool_or({_FIT} and source_role in {_TECHNICAL}) as t from {{sources}} group by 1"


def _candidates(t: Tables) -> DataFrame:
    split = lambda c: F.when(F.col(c) == "", F.array().cast("array<string>")).otherwise(F.split(c, ","))
    return t.candidates.withColumns({"secondary_domain_codes": split("secondary_csv"), "relationship_roles": split("roles_csv"), "position": F.col("organization_candidate_id")})


def _lines(*parts: str) -> str:
    return " union all ".join(parts)


_SETS = f"select analysis_id, count_if(is_primary_featured) as p, count_if(featured_rank = 1) as r, count_if(is_primary_featured and featured_rank = 1) as b from {{candidates}} group by 1"
_ROWS = """select *, row_number() over (partition by analysis_id, featured_rank order by organization_candidate_id) as kr, row_number() over (partition by analysis_id, normalized_name order by organization_candidate_id) as kn,
  case when secondary_csv = '' then [] else string_split(secondary_csv, ',') end as sec from {candidates}"""
_CANDIDATES = _lines(
    f"select analysis_id, '{x.ONE_PRIMARY}' as message from ({_SETS}) where p <> 1", f"select analysis_id, '{x.ONE_RANK}' from ({_SETS}) where r <> 1", f"select analysis_id, '{x.SAME_ROW}' from ({_SETS}) where p = 1 and r = 1 and b = 0",
    f"select analysis_id, normalized_name || ': featured_rank ' || featured_rank || ' is duplicated' from ({_ROWS}) where kr > 1", f"select analysis_id, normalized_name || ': normalized_name is duplicated' from ({_ROWS}) where kn > 1",
    f"select analysis_id, normalized_name || ': unknown primary_domain_code ' || primary_domain_code from ({_ROWS}) where primary_domain_code not in {_DOMAINS}", f"select analysis_id, normalized_name || ': at most two secondary organization domains are allowed' from ({_ROWS}) where len(sec) > 2",
    f"select analysis_id, normalized_name || ': secondary domains must not repeat the primary domain' from ({_ROWS}) where list_contains(sec, primary_domain_code)", f"select analysis_id, normalized_name || ': duplicate secondary_domain_code' from ({_ROWS}) where len(list_distinct(sec)) < len(sec)",
    f"select analysis_id, normalized_name || ': parent_name requires parent_canonical_url' from ({_ROWS}) where parent_name is not null and parent_canonical_url is null",
    f"select analysis_id, normalized_name || ': primary featured organization must include relationship role primary_featured_organization' from ({_ROWS}) where is_primary_featured and roles_csv not like '%primary_featured_organization%'",
)


@query("validate_organization_candidates", _CANDIDATES)
def validate_organization_candidates(t: Tables) -> DataFrame:
    return x.validate_organization_candidates(_candidates(t))


@query("qualifying_sources", f"select organization_candidate_id, source_rank, {_FIT} as qualifying from {{sources}}")
def qualifying_sources(t: Tables) -> DataFrame:
    return t.sources.select("organization_candidate_id", "source_rank", x.qualifying_source().alias("qualifying"))


@query("validate_source_minimum", _lines(*[f"select c.organization_candidate_id, '{m}' as message from {{candidates}} c left join ({_MINIMUM}) s using (organization_candidate_id) where not coalesce(s.{k}, false)" for k, m in (("i", x.NO_IDENTITY), ("t", x.NO_TECHNICAL))]))
def validate_source_minimum(t: Tables) -> DataFrame:
    return x.validate_source_minimum(t.candidates, t.sources)


@query("validate_intent_source_minimum", _lines(*[f"select c.analysis_id, '{m}' as message from {{candidates}} c left join ({_MINIMUM}) s using (organization_candidate_id) where c.is_primary_featured and c.primary_domain_code <> 'other_unknown' and c.analysis_id in (select analysis_id from {{sources}}) and not coalesce(s.{k}, false)" for k, m in (("i", x.NO_IDENTITY), ("t", x.NO_TECHNICAL))]))
def validate_intent_source_minimum(t: Tables) -> DataFrame:
    return x.validate_intent_source_minimum(t.candidates, t.sources)


@query("validate_organization_sources", _lines(
    "select analysis_id, null::varchar as organization_candidate_id, 'At most forty organization sources are allowed' as message from {sources} group by 1 having count(*) > 40",
    "select analysis_id, organization_candidate_id, 'Duplicate source_rank ' || source_rank || ' for organization ' || organization_candidate_id from {sources} group by 1, 2, source_rank having count(*) > 1",
    "select distinct analysis_id, organization_candidate_id, 'Duplicate normalized_url for organization ' || organization_candidate_id from {sources} group by 1, 2, normalized_url having count(*) > 1",
))
def validate_organization_sources(t: Tables) -> DataFrame:
    return x.validate_organization_sources(t.sources)


_CAT = "select analysis_id, count(*) as n, count_if(assignment_role = 'primary') as p, count_if(assignment_role = 'secondary') as s from {categories} group by 1"


@query("validate_category_assignments", _lines(f"select analysis_id, 'At most four category assignments are allowed' as message from ({_CAT}) where n > 4", f"select analysis_id, 'Exactly one primary category is required' from ({_CAT}) where p <> 1", f"select analysis_id, 'At most three secondary categories are allowed' from ({_CAT}) where s > 3"))
def validate_category_assignments(t: Tables) -> DataFrame:
    return x.validate_category_assignments(t.categories)


_REASON = "case when cast(analysis_id as bigint) % 2 = 0 then 'none shown' end as no_main_technology_reason"


@query("validate_technology_families", _lines(
    "select analysis_id, 'At most eight technology families are allowed' as message from {families} group by 1 having count(*) > 8", f"select analysis_id, 'no_main_technology_reason is required when families is empty' from (select analysis_id, {_REASON} from {{analyses}}) a where no_main_technology_reason is null and analysis_id not in (select analysis_id from {{families}})",
    "select analysis_id, 'technology family_rank values must be unique' from {families} group by 1 having count(*) > count(distinct family_rank)",
))
def validate_technology_families(t: Tables) -> DataFrame:
    return x.validate_technology_families(t.families, t.analyses.selectExpr("analysis_id", _REASON))


_PROFILES = """select a.run_id, a.analysis_id, c.organization_candidate_id as primary_id, c.primary_domain_code as primary_org_domain, case when cast(a.analysis_id as bigint) % 9 = 2 then 'cloud_ai_platform' else coalesce(c.primary_domain_code, 'other_unknown') end as primary_domain_code,
  case when cast(a.analysis_id as bigint) % 4 = 1 then 'no company' end as no_organization_reason, cast(a.analysis_id as bigint) % 3 = 0 as review_required, cast(cast(a.analysis_id as bigint) % 5 as int) as n_conflicts, a.overall_confidence
from {analyses} a left join {candidates} c on c.analysis_id = a.analysis_id and c.is_primary_featured and c.organization_candidate_id = c.analysis_id || '-1'"""
_P = f"select p.*, coalesce(n, 0) as n, coalesce(i, false) as i, coalesce(t, false) as t from ({_PROFILES}) p left join (select organization_candidate_id, count(*) as n, bool_or({_FIT} and source_role in {_IDENTITY}) as i, bool_or({_FIT} and source_role in {_TECHNICAL}) as t from {{sources}} group by 1) s on s.organization_candidate_id = p.primary_id"


def _with_run(t: Tables, rows: DataFrame) -> DataFrame:
    return rows.join(t.analyses.select("analysis_id", "run_id"), "analysis_id")


@query("validate_organization_profile", _lines(*[f"select run_id, '{m}' as message from ({_P}) where {c}" for c, m in (
    ("primary_id is null and primary_domain_code <> 'other_unknown'", "Missing primary organization must use primary_domain_code other_unknown"), ("primary_id is null and no_organization_reason is null", "no_organization_reason is required when no organization is identified"),
    ("primary_id is null and not review_required", "review_required must be true when no organization is identified"), ("primary_id is not null and primary_domain_code <> primary_org_domain", "Profile primary_domain_code must match the primary featured organization"),
    ("primary_org_domain = 'other_unknown' and not review_required", "other_unknown primary organization domain requires review_required"), ("primary_org_domain <> 'other_unknown' and n not between 2 and 6", "Primary organization must have two to six ranked sources"),
    ("primary_org_domain <> 'other_unknown' and not i", x.NO_IDENTITY), ("primary_org_domain <> 'other_unknown' and not t", x.NO_TECHNICAL),
)]))
def validate_organization_profile(t: Tables) -> DataFrame:
    return x.validate_organization_profile(t.sql(_PROFILES), _with_run(t, t.sources))


@query("synthesis_review_reasons", f"""
select run_id, r as reasons, case when r = '' then 'intent_ready' else 'review_required' end as next_status from (select run_id, concat_ws(',', case when overall_confidence < 0.7 then 'overall_confidence_below_0.70' end,
  case when primary_id is null or primary_domain_code = 'other_unknown' then 'primary_organization_domain_other_unknown' when not (i and t) then 'authoritative_source_minimum_failed' end) as r from ({_P}))""")
def synthesis_review_reasons(t: Tables) -> DataFrame:
    return x.synthesis_review_reasons(t.sql(_PROFILES), t.sources).withColumn("reasons", F.array_join("reasons", ","))


_BODY = "'{\"review_required\":' || cast(review_required as string) || ',\"primary_domain_code\":\"' || primary_domain_code || '\"}'"


@query("infer_next_status", f"select a.run_id, case when p.run_id is not null and (review_required or primary_domain_code = 'other_unknown') then 'review_required' else 'intent_ready' end as next_status from {{analyses}} a left join (select * from ({_PROFILES}) where cast(analysis_id as bigint) % 7 <> 0) p on p.run_id = a.run_id")
def infer_next_status(t: Tables) -> DataFrame:
    stored = t.sql(f"select run_id, {_BODY} as body from ({_PROFILES}) where cast(analysis_id as bigint) % 7 <> 0")
    return x.infer_next_status(t.analyses, stored)


_RUN_STATUS = "case when cast(analysis_id as bigint) % 6 = 0 then 'review_required' else 'intent_ready' end"


@query("review_refusal_reasons", "select distinct run_id, reason from (" + _lines(
    f"select run_id, 'run status is review_required' as reason from {{analyses}} where {_RUN_STATUS} = 'review_required'", f"select run_id, 'organization profile review_required' from ({_PROFILES}) where review_required", f"select run_id, 'unresolved organization hierarchy conflicts' from ({_PROFILES}) where n_conflicts > 0",
    f"select run_id, 'organization profile primary_domain_code is other_unknown' from ({_PROFILES}) where primary_domain_code = 'other_unknown'", "select run_id, 'primary organization domain is other_unknown' from {candidates} join {analyses} using (analysis_id) where is_primary_featured and primary_domain_code = 'other_unknown'",
    *[f"select run_id, '{m}' from {{candidates}} c join {{analyses}} using (analysis_id) left join ({_MINIMUM}) s using (organization_candidate_id) where c.is_primary_featured and c.primary_domain_code <> 'other_unknown' and not coalesce(s.{k}, false)" for k, m in (("i", x.NO_IDENTITY), ("t", x.NO_TECHNICAL))],
    f"select run_id, message from ({_CANDIDATES}) join {{analyses}} using (analysis_id)",
) + ")")
def review_refusal_reasons(t: Tables) -> DataFrame:
    """By analysis, which candidates and sources carry; only the reasons get their run, of which an analysis has one."""
    runs = t.analyses.selectExpr("analysis_id", f"{_RUN_STATUS} as status")
    profiles = t.sql(_PROFILES).select("analysis_id", "review_required", "n_conflicts", F.col("primary_domain_code").alias("profile_domain"))
    reasons = x.review_refusal_reasons(runs, profiles, _candidates(t), t.sources, "analysis_id").select("analysis_id", "reason")
    return _with_run(t, reasons).select("run_id", "reason").distinct()


@query("missing_evidence_research", """select distinct run_id, e as evidence_id from (select run_id, unnest(['e' || ((doc_id + kind_no) % 5), 'e' || (doc_id % 3)]) as e from {bodies} where artifact_kind = 'organization_research')
where (run_id, e) not in (select run_id, 'e' || (doc_id % 4) from {bodies})""")
def missing_evidence_research(t: Tables) -> DataFrame:
    return x.missing_evidence_research(t.bodies, t.sql("select distinct run_id, 'e' || cast(doc_id % 4 as string) as evidence_id from {bodies}"))


@query("missing_evidence_packet", """select distinct run_id, e as evidence_id from (select run_id, unnest(['e' || ((doc_id + kind_no) % 5), 'e' || (doc_id % 3)]) as e from {bodies} where artifact_kind in ('initial_summary', 'technology_library_summary', 'organization_profile', 'organization_research', 'ingestion_intent'))
where (run_id, e) not in (select run_id, 'e' || (doc_id % 4) from {bodies})""")
def missing_evidence_packet(t: Tables) -> DataFrame:
    return x.missing_evidence_packet(t.bodies, t.sql("select distinct run_id, 'e' || cast(doc_id % 4 as string) as evidence_id from {bodies}"))


_IDENT = "select run_id as packet_key, artifact_kind, run_id, case when (doc_id + kind_no) % 19 = 0 then 'other' when kind_no % 4 = 3 then null else video_id end as video_id, case when doc_id % 15 = 3 and kind_no = 2 then SHA[['z']] else SHA[[video_id]] end as transcript_sha256, '2024-01-0' || cast(1 + doc_id % 2 + case when (doc_id + kind_no) % 23 = 0 then 5 else 0 end as string) as research_as_of, case when doc_id % 8 = 0 and kind_no > 6 then 'later' when doc_id % 3 = 0 then null else 'then' end as video_published_at, kind_no % 2 = 0 as has_published from {bodies}"


@query("validate_packet_identity", _lines(*[f"select a.packet_key, a.artifact_kind || '.{f} does not match run_manifest' as message from ({_IDENT}) a join ({_IDENT}) m on m.packet_key = a.packet_key and m.artifact_kind = 'run_manifest' where a.artifact_kind <> 'run_manifest' and {'a.has_published and' if f == 'video_published_at' else f'a.{f} is not null and'} a.{f} is distinct from m.{f}" for f in ("run_id", "video_id", "transcript_sha256", "research_as_of", "video_published_at")]))
def validate_packet_identity(t: Tables) -> DataFrame:
    return x.validate_packet_identity(t.sql(_IDENT))


_DOCS = """select doc_id as intent_id, case when doc_id % 11 = 0 then '{oops' else '{"schema_version":"' || case doc_id % 3 when 0 then '1.0.0' when 1 then '2.0.0' else '3.1' end || '","operations":[{"kind":"create_video_analysis","payload":{"n":' || cast(doc_id as string) || '}},{"kind":"'
  || case doc_id % 5 when 0 then 'execute_sql' when 1 then 'create_video_analysis' else 'replace_evidence_anchors' end || '","payload":[' || cast(n_chars as string) || ']},{"kind":"replace_domain_assignments","payload":[]}]}' end as body from {documents}"""


@query("dispatch_schema_version", f"select intent_id, case when not json_valid(body) then 'invalid_json' when body ->> '$.schema_version' = '2.0.0' then 'v2' when body ->> '$.schema_version' = '1.0.0' then 'v1' else 'unsupported' end as contract from ({_DOCS})")
def dispatch_schema_version(t: Tables) -> DataFrame:
    return x.dispatch_schema_version(t.sql(_DOCS)).select("intent_id", "contract")


_OPS = f"select intent_id, (i - 1)::int as operation_index, o ->> '$.kind' as kind, (o -> '$.payload')::varchar as payload from (select intent_id, unnest(from_json(body -> '$.operations', '[\"JSON\"]')) as o, generate_subscripts(from_json(body -> '$.operations', '[\"JSON\"]'), 1) as i from ({_DOCS}) where json_valid(body))"


@query("explode_operations", f"select intent_id, operation_index, kind, payload, case kind when 'create_video_analysis' then 'research_video_analysis' when 'replace_evidence_anchors' then 'research_evidence_anchor' when 'replace_domain_assignments' then 'research_video_domain' end as target_table from ({_OPS})")
def explode_operations(t: Tables) -> DataFrame:
    return x.explode_operations(t.sql(_DOCS))


@query("validate_operation_order", _lines(
    f"select intent_id, operation_index, 'unknown or forbidden operation kind' as message from ({_OPS}) where kind = 'execute_sql'", f"select intent_id, operation_index, 'operation kind is repeated' from ({_OPS}) where operation_index = 1 and kind = 'create_video_analysis'",
    f"select a.intent_id, a.operation_index, 'operation is out of order' from ({_OPS}) a join ({_OPS}) b on b.intent_id = a.intent_id and b.operation_index = 1 and b.kind = 'replace_evidence_anchors' where a.operation_index = 2",
))
def validate_operation_order(t: Tables) -> DataFrame:
    return x.validate_operation_order(x.explode_operations(t.sql(_DOCS)))


@query("validate_taxonomy_classification", "select run_id, message from (" + _lines(
    f"select analysis_id as run_id, 'exactly one primary category is required' as message from ({_CAT}) where p <> 1", f"select analysis_id, 'at most three secondary categories' from ({_CAT}) where s > 3",
    f"select distinct analysis_id, 'unknown category code' from {{categories}} where category_code not in {_in(v.CATEGORIES)}", "select distinct analysis_id, 'one to six domains are required' from {categories} where analysis_id not in (select analysis_id from {families} group by 1 having count(*) <= 6)",
    "select distinct analysis_id, 'unknown or inactive domain code' from {families} where cast(substr(family_label, 2) as int) % 8 = 0", "select distinct analysis_id, 'one to seven lifecycle stages are required' from {categories} where analysis_id not in (select analysis_id from {families})",
    "select distinct analysis_id, 'unknown lifecycle stage' from {families} where temporal_status = 'uncertain'",
) + ")")
def validate_taxonomy_classification(t: Tables) -> DataFrame:
    domains = t.sql("select analysis_id as run_id, family_label as domain_code from {families}")
    stages = t.sql("select analysis_id as run_id, case when temporal_status = 'uncertain' then 'later' else 'design' end as lifecycle_stage from {families}")
    active = t.sql("select distinct family_label as domain_code, cast(substr(family_label, 2) as int) % 8 <> 0 as active from {families}")
    return x.validate_taxonomy_classification(t.categories.withColumnRenamed("analysis_id", "run_id"), domains, stages, active)


@query("missing_required_evidence", "select analysis_id, 'resource' as \"table\", title as name, count(*) as n from {resources} where n_evidence = 0 group by all union all select analysis_id, 'entity', normalized_name, count(*) from {entities} where n_evidence = 0 group by all")
def missing_required_evidence(t: Tables) -> DataFrame:
    return x.missing_required_evidence({"resource": t.resources.withColumn("name", F.col("title")), "entity": t.entities.withColumn("name", F.col("normalized_name"))})


@query("summary_word_counts", "select * from (select analysis_id, len(string_split(trim(initial_summary), ' '))::int as initial_words, len(string_split(trim(structured_summary), ' '))::int as structured_words from {analyses}) where initial_words not between 75 and 125 or structured_words not between 200 and 400")
def summary_word_counts(t: Tables) -> DataFrame:
    return x.summary_word_counts(t.analyses)


@query("unsupported_current_status", "select analysis_id, family_rank, family_label from {families} where temporal_status <> 'uncertain' and n_evidence = 0 and n_urls = 0")
def unsupported_current_status(t: Tables) -> DataFrame:
    return x.unsupported_current_status(t.families).select("analysis_id", "family_rank", "family_label")
