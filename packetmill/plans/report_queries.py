"""Whole reports and the nested feed: every child list against SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import report as p
from ..operators import state as s
from .apply_queries import _CODES, _with_latest
from .derived import Tables
from .qualify_queries import _state
from .registered import query

_RUN = "'r' || lpad(cast(event_id - event_id % 40 + event_id % 3 as string), 10, '0')"
#: Rows of each child list: kind, SQL, sort keys and columns as SQL, and sort keys for Spark (None: as ``child_order`` has them).
_LISTS: dict[str, tuple[str, str, str, tuple[str, ...]]] = {
    "sessions": ("run", "select run_id, phase, attempt, status, eve_session_id from {sessions}", "phase, attempt", ("phase", "attempt", "status", "eve_session_id")),
    "artifacts": ("run", "select run_id, artifact_kind, byte_count from {artifacts}", "artifact_kind", ("artifact_kind", "byte_count")),
    "searches": ("run", f"select {_RUN} as run_id, ts as searched_at, 'q' || cast(event_id % 9 as string) as query from {{events}}", "searched_at", ("query",)),
    "analysis": ("run", "select run_id, analysis_id, difficulty, content_form, initial_summary, structured_summary from {analyses}", "analysis_id", ("analysis_id", "difficulty", "content_form", "initial_summary", "structured_summary")),
    "intent": ("run", "select run_id, 'i' || analysis_id as intent_id, case when cast(analysis_id as bigint) % 3 = 0 then 'applied' else 'validated' end as status from {analyses}", "intent_id", ("intent_id", "status")),
    "events": ("intent", "select 'i' || cast(l_orderkey as string) as intent_id, cast(l_linenumber as int) as operation_index, 'applied' as status from {lines}", "operation_index", ("operation_index", "status")),
    "summary": ("analysis", "select analysis_id, 'said of ' || content_form as transcript_summary, 'in ' || difficulty || ' times' as temporal_context from {analyses} where cast(analysis_id as bigint) % 2 = 0", "transcript_summary", ("transcript_summary", "temporal_context")),
    "categories": ("analysis", "select analysis_id, assignment_role, alternative_rank, category_code from {categories}", "", ("assignment_role", "category_code")),
    "domains": ("analysis", "select cast(l_orderkey as string) as analysis_id, 'd' || cast(l_partkey % 9 as string) as domain_code, cast(l_discount as double) as confidence from {lines}", "-confidence, domain_code", ("domain_code", "confidence")),
    "lifecycle": ("analysis", "select cast(l_orderkey as string) as analysis_id, 's' || cast(l_suppkey % 5 as string) as lifecycle_stage from {lines} where l_linenumber < 3", "lifecycle_stage", ("lifecycle_stage",)),
    "families": ("analysis", "select analysis_id, family_rank, family_label, temporal_status from {families}", "family_rank, family_label", ("family_rank", "family_label", "temporal_status")),
    "entities": ("analysis", "select cast(page_id as string) as analysis_id, 'library' as entity_kind, 'n' || cast(page_id % 7 as string) as normalized_name from {pages}", "entity_kind, normalized_name", ("entity_kind", "normalized_name")),
    "resources": ("analysis", "select cast(page_id as string) as analysis_id, 'paper' as resource_type, 'page ' || cast(page_id as string) as title, page_id % 3 = 0 as is_first_party from {pages}", "resource_type, title", ("resource_type", "title", "is_first_party")),
}
_SHOWN = {"analysis": ("analysis_id", "difficulty"), "domains": ("domain_code",), "searches": ("query",)}
_ORGANIZATIONS = ("normalized_name", "is_primary_featured", "featured_rank", "organization_candidate_id", "primary_domain_code", "parent_name", "sources")


def children(t: Tables) -> dict[str, p.Child]:
    out = {}
    for name, (kind, sql, order, columns) in _LISTS.items():
        keys = p.child_order(name) if name == "categories" else [F.expr(x) for x in order.split(", ")]
        out[name] = p.Child(t.sql(sql), kind, keys, columns)
    out["organizations"] = p.Child(t.candidates, "analysis", p.child_order("organizations"), _ORGANIZATIONS, t.sources)
    return out


def told(items: Column, columns: tuple[str, ...]) -> Column:
    return F.array_join(F.transform(items, lambda x: F.concat_ws(":", *[x[c].cast("string") for c in columns])), ",")


def told_organizations(items: Column) -> Column:
    inner = lambda x: F.array_join(F.transform(x["sources"], lambda y: F.concat_ws(":", y["source_rank"].cast("string"), y["source_role"], y["normalized_url"])), ";")
    return F.array_join(F.transform(items, lambda x: F.concat(x["normalized_name"], F.lit("["), inner(x), F.lit("]"))), ",")


def _list_sql(name: str) -> str:
    kind, sql, order, columns = _LISTS[name]
    shown = _SHOWN.get(name, columns)
    order = "(assignment_role <> 'primary'), alternative_rank is null, alternative_rank, " + f"coalesce(list_position([{_CODES}], category_code), 0)" if name == "categories" else order
    return f"select {kind}_id, string_agg(concat_ws(':', {', '.join(f'cast({c} as varchar)' for c in shown)}), ',' order by {order}, {', '.join(columns)}) as {name} from ({sql}) group by 1"


_NESTED = """select c.analysis_id, string_agg(c.normalized_name || '[' || coalesce(s.told, '') || ']', ',' order by not c.is_primary_featured, c.featured_rank, c.normalized_name, c.organization_candidate_id) as organizations
from {candidates} c left join (select organization_candidate_id, string_agg(source_rank || ':' || source_role || ':' || normalized_url, ';' order by source_rank, source_role, normalized_url) as told from {sources} group by 1) s on s.organization_candidate_id = c.organization_candidate_id group by 1"""
_CHOSEN = "select video_id, run_id from (select *, row_number() over (partition by video_id order by created_at desc nulls last, run_id) as k from {runs}) where k = 1"
_JOINED = {"run": "x.run_id", "analysis": "a.analysis_id", "intent": "a.intent_id"}
_REPORT = f"""
select c.video_id, s.pipeline_status, coalesce(n.n, 0) as n_runs, x.run_id, {', '.join(f"coalesce({name}.{name}, '') as {name}" for name in (*_LISTS, 'organizations'))}
from {{catalog}} c left join {{video_state}} s on s.video_id = c.video_id left join (select video_id, count(*) as n from {{runs}} group by 1) n on n.video_id = c.video_id left join ({_CHOSEN}) x on x.video_id = c.video_id
left join (select run_id, analysis_id, 'i' || analysis_id as intent_id from {{analyses}}) a on a.run_id = x.run_id
""" + "\n".join(f"left join ({_list_sql(name)}) {name} on {name}.{kind}_id = {_JOINED[kind]}" for name, (kind, *_) in _LISTS.items()) + f"\nleft join ({_NESTED}) organizations on organizations.analysis_id = a.analysis_id"


@query("full_reports", _REPORT)
def full_reports(t: Tables) -> DataFrame:
    out = p.full_reports(t.catalog, _with_latest(t), t.runs, children(t))
    lists = [told(F.col(name), _SHOWN.get(name, columns)).alias(name) for name, (_, _, _, columns) in _LISTS.items()]
    return out.select("video_id", "pipeline_status", "n_runs", "run_id", *lists, told_organizations(F.col("organizations")).alias("organizations"))


_PREVIEW = "case when length(trim({0})) > 320 then substr(trim({0}), 1, 319) || '…' else nullif(trim({0}), '') end"
_PRODUCED = f"""
select c.video_id, x.run_id, coalesce(o.companies, '') as companies, coalesce(f.technologies, '') as technologies, {_PREVIEW.format('a.initial_summary')} as transcript_only, {_PREVIEW.format('a.structured_summary')} as structured,
  case when cast(a.analysis_id as bigint) % 2 = 0 then 'said of ' || a.content_form end as contextualized, cast(null as varchar) as why_it_matters, case when cast(a.analysis_id as bigint) % 2 = 0 then 'in ' || a.difficulty || ' times' end as temporal_context,
  a.difficulty, a.content_form, coalesce(categories.categories, '') as categories, coalesce(lifecycle.lifecycle, '') as lifecycle, coalesce(domains.domains, '') as domains, coalesce(entities.entities, '') as entities, coalesce(resources.resources, '') as resources
from {{catalog}} c left join ({_CHOSEN}) x on x.video_id = c.video_id left join {{analyses}} a on a.run_id = x.run_id
left join (select analysis_id, string_agg(concat_ws(':', normalized_name, cast(is_primary_featured as varchar), cast(featured_rank as varchar), primary_domain_code, parent_name), ',' order by not is_primary_featured, featured_rank, normalized_name, organization_candidate_id) as companies from {{candidates}} group by 1) o on o.analysis_id = a.analysis_id
left join (select analysis_id, string_agg(family_rank || ':' || family_label || ':' || temporal_status, ',' order by family_rank, family_label, temporal_status) as technologies from {{families}} group by 1) f on f.analysis_id = a.analysis_id
""" + "\n".join(f"left join ({_list_sql(name)}) {name} on {name}.analysis_id = a.analysis_id" for name in ("categories", "lifecycle", "domains", "entities", "resources"))


@query("produced_lists", _PRODUCED)
def produced_lists(t: Tables) -> DataFrame:
    out = p.produced_lists(p.full_reports(t.catalog, _with_latest(t), t.runs, children(t)))
    taxonomy = F.col("taxonomy")
    return out.select(
        "video_id", "run_id", told(F.col("companies"), ("name", "primary", "rank", "domain", "parent")).alias("companies"), told(F.col("technologies"), ("rank", "family", "temporal_status")).alias("technologies"), "summaries.*",
        "taxonomy.difficulty", "taxonomy.content_form", told(taxonomy["categories"], ("role", "code")).alias("categories"), F.array_join(taxonomy["lifecycle"], ",").alias("lifecycle"), told(taxonomy["domains"], ("code",)).alias("domains"),
        told(F.col("entities"), ("kind", "name")).alias("entities"), told(F.col("resources"), ("type", "title", "first_party")).alias("resources"),
    )


@query("finished_feed_nested", f"""
select c.video_id, r.run_id, s.finished_intent_id, coalesce(o.organizations, '') as organizations, coalesce(f.families, '') as families
from {{catalog}} c join {{video_state}} s on s.video_id = c.video_id and s.pre_research_pipeline_finished and s.finished_transcript_sha256 = s.transcript_sha256
join {{runs}} r on r.video_id = c.video_id and r.status = 'applied' and r.transcript_sha256 = s.finished_transcript_sha256
left join ({_NESTED}) o on o.analysis_id = cast(cast(substr(r.run_id, 2) as bigint) as string) left join ({_list_sql('families')}) f on f.analysis_id = cast(cast(substr(r.run_id, 2) as bigint) as string)""")
def finished_feed_nested(t: Tables) -> DataFrame:
    """The feed with organizations and, inside them, their ranked sources."""
    analyses = t.sql("select run_id, cast(cast(substr(run_id, 2) as bigint) as string) as analysis_id from {runs}")
    ordered = t.candidates.withColumn("later", ~F.col("is_primary_featured"))
    lists = {"organizations": (ordered, ("later", "featured_rank", "normalized_name", "organization_candidate_id", "sources"), t.sources), "families": (t.families, ("family_rank", "family_label", "temporal_status"))}
    feed = s.finished_feed(t.catalog, _state(t), t.runs, analyses, lists)
    some = lambda c: F.coalesce(c, F.lit(""))
    return feed.select("video_id", "run_id", "finished_intent_id", some(told_organizations(F.col("organizations"))).alias("organizations"), some(told(F.col("families"), ("family_rank", "family_label", "temporal_status"))).alias("families"))
