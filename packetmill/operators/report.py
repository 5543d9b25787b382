"""Verification reports: the run that is shown, ordered child lists, samples, previews and stored-object checks.

Every child table is aggregated by its key before it is joined, and long texts are cut before they are collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import vocabulary as v
from ..functions.text import ordinal, preview_text
from ..sources.tables import shared_folder


def select_run(runs: DataFrame, state: DataFrame, run_id: str | None = None) -> DataFrame:
    """(video_id, run_id) of the run to show: the requested one, else the state's latest, else the newest."""
    s = state.select("video_id", F.col("latest_run_id").alias("_latest"))
    wanted = F.coalesce(F.col("run_id") == F.lit(run_id), F.lit(False))
    order = W.partitionBy("video_id").orderBy(wanted.desc(), F.coalesce(F.col("run_id") == F.col("_latest"), F.lit(False)).desc(), F.col("created_at").desc_nulls_last(), "run_id")
    return runs.join(s, "video_id", "left").withColumn("_k", F.row_number().over(order)).where("_k = 1").select("video_id", "run_id")


#: Sort keys of each child list, codes by their declared order; nulls last is written as a leading flag.
def child_order(table: str) -> list[Column]:
    last = lambda c: [F.col(c).isNull(), F.col(c)]
    return {
        "categories": [F.when(F.col("assignment_role") == "primary", 0).otherwise(1), *last("alternative_rank"), ordinal(F.col("category_code"), v.CATEGORIES)],
        "lifecycle": [ordinal(F.col("lifecycle_stage"), v.LIFECYCLE_STAGES)],
        "families": [F.col("family_rank"), F.col("family_label")],
        "resources": [ordinal(F.col("resource_type"), v.RESOURCE_TYPES), F.col("title")],
        "entities": [ordinal(F.col("entity_kind"), v.ENTITY_KINDS), F.col("normalized_name")],
        "organizations": [~F.col("is_primary_featured"), F.col("featured_rank"), F.col("normalized_name")],
    }[table]


def ordered_children(rows: DataFrame, table: str, columns: Sequence[str], key: str = "analysis_id") -> DataFrame:
    """(key, items): each key's rows as an array of the columns, in the table's own order."""
    order = [c.alias(f"_{i}") for i, c in enumerate(child_order(table))]
    item = F.struct(*order, *[F.col(c) for c in columns])
    listed = F.sort_array(F.collect_list(item))
    return rows.groupBy(key).agg(F.transform(listed, lambda x: F.struct(*[x[c].alias(c) for c in columns])).alias("items"))


def organization_sources_ranked(sources: DataFrame, candidates: DataFrame) -> DataFrame:
    """Sources with their candidate's name and rank, by featured rank, then source rank."""
    c = candidates.select("organization_candidate_id", "normalized_name", "featured_rank")
    return sources.join(c, "organization_candidate_id").orderBy("featured_rank", "source_rank")


def evidence_sample(anchors: DataFrame, n: int = 5, key: str = "analysis_id") -> DataFrame:
    """(key, total, evidence_id, preview) of the first n anchors by place in the text, nulls last, then id."""
    order = W.partitionBy(key).orderBy(F.col("start_character").asc_nulls_last(), "evidence_id")
    # Excerpts are cut before they move, and a row number that is only filtered lets Spark keep n rows a key before the shuffle.
    rows = anchors.select(key, "evidence_id", "start_character", preview_text(F.col("short_excerpt"), 180).alias("preview")).withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= n)
    total = anchors.groupBy(key).agg(F.count("*").alias("total"))
    return rows.join(total, key).select(key, "total", "evidence_id", "preview")


def organizations_with_sources(candidates: DataFrame, sources: DataFrame, columns: Sequence[str] = ("source_rank", "source_role", "normalized_url")) -> DataFrame:
    """Candidates with their sources, ranked, as an array of the columns: the inner level of reports and feeds; none is an empty array."""
    item = F.struct(*columns)
    listed = sources.groupBy("organization_candidate_id").agg(F.sort_array(F.collect_list(item)).alias("sources"))
    kinds = listed.schema["sources"].dataType
    return candidates.join(listed, "organization_candidate_id", "left").withColumn("sources", F.coalesce("sources", F.array().cast(kinds)))


@dataclass
class Child:
    """A list of a report: rows, the kind of their key (run, analysis or intent) and its column, sort keys, and the columns shown.

    sources, if given, are nested in the rows as ``organizations_with_sources`` has them, once it is known which rows are wanted.
    """

    rows: DataFrame
    kind: str
    order: Sequence[Column]
    columns: Sequence[str]
    sources: DataFrame | None = None

    @property
    def key(self) -> str:
        return f"{self.kind}_id"


def stored(df: DataFrame) -> DataFrame:
    """Rows written to the shared folder and read again: their size is known there, and what hangs on them is planned by it."""
    path = shared_folder(df.sparkSession, "report")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def within(child: Child, keys: DataFrame) -> Child:
    """The child with only the rows of the given keys, one column of its kind; sources are nested after that, only those of its rows."""
    rows = child.rows.join(keys, child.key, "left_semi")
    if child.sources is not None:
        own = stored(rows)
        rows = organizations_with_sources(own, child.sources.join(own.select("organization_candidate_id"), "organization_candidate_id", "left_semi"))
    return Child(rows, child.kind, child.order, child.columns)


def gather(children: Mapping[str, Child]) -> DataFrame:
    """(owner, one array a child): the rows of all children in one union and one aggregation by owner, which is kind and key.

    A row fills its own child's column only, so that each list keeps its types; lists are sorted by their keys, then by the
    columns shown. Keys that are null own nothing.
    """
    union = None
    for name, child in children.items():
        item = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(child.order)], *[F.col(c) for c in child.columns])
        part = child.rows.where(F.col(child.key).isNotNull()).select(_owner(child.kind, F.col(child.key)).alias("owner"), item.alias(name))
        union = part if union is None else union.unionByName(part, allowMissingColumns=True)

    def listed(name: str, columns: Sequence[str]) -> Column:
        return F.transform(F.sort_array(F.collect_list(name)), lambda x: F.struct(*[x[c].alias(c) for c in columns])).alias(name)

    return union.groupBy("owner").agg(*[listed(name, child.columns) for name, child in children.items()])


def _owner(kind: str, key: Column) -> Column:
    return F.concat(F.lit(kind + ":"), key.cast("string"))


def full_reports(catalog: DataFrame, state: DataFrame, runs: DataFrame, children: Mapping[str, Child], run_id: str | None = None) -> DataFrame:
    """One row per video: title, pipeline_status, n_runs, the selected run_id, and every child list of that run; none is an empty array.

    ``analysis`` among the children gives the run's analysis_id and ``intent`` its intent_id, by which the lists of
    these kinds are found; a run has one of either. The chosen runs, their analyses and intents are stored first, so that
    children lose all other rows where they are read (or, where these are many, in one join) before they share one exchange.
    """
    chosen = stored(select_run(runs, state, run_id))
    n = runs.groupBy("video_id").agg(F.count("*").alias("n_runs"))
    out = catalog.select("video_id", "title").join(state.select("video_id", "pipeline_status"), "video_id", "left").join(n, "video_id", "left").join(chosen, "video_id", "left").na.fill(0, ["n_runs"])
    keys = {"run": chosen.select("run_id")}
    for kind in ("analysis", "intent"):
        if kind in children:
            keys[kind] = stored(children[kind].rows.join(keys["run"], "run_id", "left_semi").select(f"{kind}_id"))
    lists = gather({name: within(child, keys[child.kind]) if child.kind in keys else child for name, child in children.items()})
    for kind, of in (("run", None), ("analysis", "analysis"), ("intent", "intent")):
        names = [name for name, child in children.items() if child.kind == kind]
        if of in children:
            out = out.withColumn(f"{kind}_id", F.get(of, F.lit(0))[f"{kind}_id"])
        if names:
            own = lists.where(F.col("owner").startswith(kind + ":")).select("owner", *names)
            out = out.join(own, _owner(kind, F.col(f"{kind}_id")) == own["owner"], "left").drop("owner")
    return out.select(*[c for c in out.columns if c not in children], *[F.coalesce(c, F.array().cast(out.schema[c].dataType)).alias(c) for c in children])


def produced_lists(reports: DataFrame) -> DataFrame:
    """(video_id, run_id, companies, technologies, summaries, taxonomy, entities, resources) of ``full_reports``: what a run produced, with long texts as previews.

    Taken from the lists organizations, families, summary, analysis, categories, domains, lifecycle, entities and resources, as far as they are there.
    """
    has = set(reports.columns)

    def listed(name: str, columns: Mapping[str, str], cut: str | None = None) -> Column:
        known = {f.name for f in reports.schema[name].dataType.elementType.fields} if name in has else set()
        one = lambda x: F.struct(*[(preview_text(F.coalesce(x[c], F.lit("")), 240) if c == cut else x[c]).alias(k) for k, c in columns.items() if c in known])
        return F.transform(name, one) if known else F.array()

    def first(name: str, column: str, length: int | None = None) -> Column:
        held = name in has and column in {f.name for f in reports.schema[name].dataType.elementType.fields}
        value = F.get(name, F.lit(0))[column] if held else F.lit(None).cast("string")
        return preview_text(F.coalesce(value, F.lit("")), length) if length else value

    companies = {"name": "normalized_name", "primary": "is_primary_featured", "rank": "featured_rank", "scope": "organization_scope", "roles": "relationship_roles", "domain": "primary_domain_code", "official_url": "official_url", "parent": "parent_name", "status": "current_status", "summary": "authoritative_summary"}
    technologies = {"rank": "family_rank", "family": "family_label", "technology": "primary_technology", "kind": "primary_technology_kind", "temporal_status": "temporal_status", "current_status": "current_status", "official_urls": "official_urls", "implementations": "implementations", "summary": "summary"}
    told = F.coalesce(first("summary", "transcript_summary"), first("analysis", "contextualized_abstract"), F.lit(""))
    summaries = F.struct(
        first("analysis", "initial_summary", 320).alias("transcript_only"), first("analysis", "structured_summary", 320).alias("structured"), preview_text(told, 320).alias("contextualized"),
        first("analysis", "why_it_matters", 240).alias("why_it_matters"), first("summary", "temporal_context", 240).alias("temporal_context"),
    )
    taxonomy = F.struct(
        *[first("analysis", c).alias(c) for c in ("difficulty", "content_form", "evidence_level")], listed("categories", {"role": "assignment_role", "code": "category_code", "confidence": "confidence"}).alias("categories"),
        listed("domains", {"code": "domain_code", "confidence": "confidence"}).alias("domains"), (F.transform("lifecycle", lambda x: x["lifecycle_stage"]) if "lifecycle" in has else F.array()).alias("lifecycle"),
    )
    entities = listed("entities", {"kind": "entity_kind", "name": "normalized_name", "url": "canonical_url", "status": "verification_status"})
    resources = listed("resources", {"type": "resource_type", "title": "title", "url": "url", "first_party": "is_first_party", "status": "verification_status"})
    return reports.select("video_id", "run_id", listed("organizations", companies, "authoritative_summary").alias("companies"), listed("families", technologies, "summary").alias("technologies"), summaries.alias("summaries"), taxonomy.alias("taxonomy"), entities.alias("entities"), resources.alias("resources"))


def produced(analyses: DataFrame, summaries: DataFrame) -> DataFrame:
    """(analysis_id, transcript_only, structured, contextualized): previews; the contextualized one falls back on the abstract."""
    cut = lambda c, name: preview_text(F.col(c), 320).alias(name)
    s = summaries.select("analysis_id", F.col("transcript_summary").isNotNull().alias("_has"), cut("transcript_summary", "_said"))
    rows = analyses.select("analysis_id", cut("initial_summary", "transcript_only"), cut("structured_summary", "structured"), cut("contextualized_abstract", "_abstract")).join(s, "analysis_id", "left")
    return rows.select("analysis_id", "transcript_only", "structured", F.when(F.col("_has"), F.col("_said")).otherwise(F.col("_abstract")).alias("contextualized"))


def summarize_artifact(bodies: DataFrame, body: str = "body") -> DataFrame:
    """bodies with known scalar members, lengths of known arrays, the primary organization's name and previews; absent ones are null."""
    out = bodies
    for name in ("schema_version", "run_id", "video_id", "research_as_of", "status", "analysis_id", "intent_id", "artifact_count", "packet_storage_prefix"):
        out = out.withColumn("s_" + name, F.get_json_object(body, "$." + name))
    for member, name in (("families", "family_count"), ("candidates", "candidate_count"), ("sources", "source_count"), ("operations", "operation_count"), ("resources", "resource_count"), ("entities", "entity_count")):
        value = F.get_json_object(body, "$." + member)
        out = out.withColumn("s_" + name, F.when(value.startswith("["), F.json_array_length(value)))
    out = out.withColumn("s_primary_featured_organization", F.get_json_object(body, "$.primary_featured_organization.canonical_name"))
    for name in ("transcript_summary", "initial_summary"):
        out = out.withColumn("s_" + name, preview_text(F.get_json_object(body, "$." + name), 280))
    return out


def transcript_check(catalog: DataFrame, stored: DataFrame, runs: DataFrame) -> DataFrame:
    """(video_id, run_id, stored, bytes, hash_matches) of each video's transcript object against the run's hash."""
    held = stored.select(F.col("bucket_id").alias("transcript_bucket"), F.col("name").alias("transcript_path"), F.col("content_sha256").alias("_h"), F.col("size").alias("bytes"))
    rows = catalog.select("video_id", "transcript_bucket", "transcript_path").join(held, ["transcript_bucket", "transcript_path"], "left").join(runs.select("video_id", "run_id", "transcript_sha256"), "video_id")
    return rows.select("video_id", "run_id", F.col("_h").isNotNull().alias("stored"), "bytes", F.coalesce(F.col("_h") == F.col("transcript_sha256"), F.lit(False)).alias("hash_matches"))


def video_reports(catalog: DataFrame, state: DataFrame, runs: DataFrame, sessions: DataFrame, children: dict[str, tuple[DataFrame, str, Sequence[str]]], analyses: DataFrame) -> DataFrame:
    """One row per video: state, run count, selected run, its sessions, and its analysis' child lists by name.

    children: name to (rows, table of ``child_order``, columns); analyses: (run_id, analysis_id).
    """
    chosen = select_run(runs, state)
    n = runs.groupBy("video_id").agg(F.count("*").alias("n_runs"))
    ses = sessions.groupBy("run_id").agg(F.sort_array(F.collect_list(F.struct("phase", "attempt", "status"))).alias("sessions"))
    out = catalog.select("video_id", "title").join(state.select("video_id", "pipeline_status"), "video_id", "left").join(n, "video_id", "left").join(chosen, "video_id", "left")
    out = out.join(ses, "run_id", "left").join(analyses.select("run_id", "analysis_id"), "run_id", "left").na.fill(0, ["n_runs"])
    for name, (rows, table, columns) in children.items():
        out = out.join(ordered_children(rows, table, columns).withColumnRenamed("items", name), "analysis_id", "left")
    return out
