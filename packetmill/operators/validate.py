"""Validators: each returns violation rows (key, code or message); what has no row is valid.

Set rules come in row form, as grouped aggregates, so that they hold for a whole table of intents at once. Contract
checks of payloads are rule tables (``PAYLOAD_RULES``) that one engine turns into expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import vocabulary as v
from ..functions.json import collect_evidence_ids
from ..functions.text import ordinal

# What the contract says when a rule is broken.
ONE_PRIMARY = "Exactly one is_primary_featured organization is required"
ONE_RANK = "Exactly one featured_rank = 1 organization is required"
SAME_ROW = "The primary featured organization must have featured_rank 1"
NO_IDENTITY = "Primary organization requires at least one verified, publicly retrievable identity/ownership source (official homepage/about, registry/filing, or official acquisition/organization announcement)"
NO_TECHNICAL = "Primary organization requires at least one verified, publicly retrievable implementation-specific technical source (official product, documentation, repository, research/model/system card, engineering blog, changelog, or standards specification)"


def _has(values: Sequence[str], column: Column | str) -> Column:
    return F.coalesce((F.col(column) if isinstance(column, str) else column).isin(*values), F.lit(False))


def violations(df: DataFrame, keys: Sequence[str], checks: Sequence[tuple[Column, Column | str]]) -> DataFrame:
    """(keys, message) for every check that holds; a message may be a column."""
    found = F.array_compact(F.array(*[F.when(c, m if isinstance(m, Column) else F.lit(m)) for c, m in checks]))
    return df.select(*keys, F.explode(found).alias("message"))


# --- documents, envelopes, operations


def dispatch_schema_version(docs: DataFrame, body: str = "body") -> DataFrame:
    """docs with contract: v1, v2, unsupported, or invalid_json."""
    version = F.try_variant_get(F.try_parse_json(body), "$.schema_version", "string")
    return docs.withColumn(
        "contract", F.when(F.try_parse_json(body).isNull(), "invalid_json").when(version == v.PACKET_VERSION, "v2").when(version == v.V1_VERSION, "v1").otherwise("unsupported")
    )


def explode_operations(intents: DataFrame, key: str = "intent_id", body: str = "body") -> DataFrame:
    """(key, operation_index, kind, payload, target_table) per operation; kinds that are not allowed have no table."""
    ops = F.try_variant_get(F.try_parse_json(body), "$.operations", "array<variant>")
    rows = intents.select(key, F.posexplode(ops).alias("operation_index", "op"))
    tables = F.create_map(*[F.lit(x) for pair in v.OPERATION_TABLES.items() for x in pair])
    kind = F.try_variant_get("op", "$.kind", "string")
    return rows.select(key, "operation_index", kind.alias("kind"), F.to_json(F.variant_get("op", "$.payload", "variant")).alias("payload"), tables[kind].alias("target_table"))


def operations_of(intents: DataFrame, body: str = "body") -> DataFrame:
    """The intents with ``ops``, the list of (kind, payload) that ``explode_operations`` gives one a row; null where a body has no list."""
    ops = F.try_variant_get(F.try_parse_json(body), "$.operations", "array<variant>")
    return intents.withColumn("ops", F.transform(ops, lambda op: F.struct(F.try_variant_get(op, F.lit("$.kind"), "string").alias("kind"), F.to_json(F.variant_get(op, F.lit("$.payload"), "variant")).alias("payload"))))


def _with_v1(ops: DataFrame, versions: DataFrame | None, key: str) -> DataFrame:
    """ops with ``v1``: whether versions (key, schema_version) has the first version for their intent."""
    if versions is None:
        return ops.withColumn("v1", F.lit(False))
    first = versions.where(F.col("schema_version") == v.V1_VERSION).select(key).distinct().withColumn("v1", F.lit(True))
    return ops.join(first, key, "left").withColumn("v1", F.coalesce("v1", F.lit(False)))


def validate_operation_order(ops: DataFrame, key: str = "intent_id", versions: DataFrame | None = None) -> DataFrame:
    """(key, operation_index, message): unknown kinds, repeats, and kinds after a later one of the fixed order.

    versions (key, schema_version) says which intents are of version 1, which has kinds and an order of its own.
    """
    ops = _with_v1(ops, versions, key)
    place = F.when(F.col("v1"), ordinal(F.col("kind"), v.V1_OPERATIONS)).otherwise(ordinal(F.col("kind"), v.OPERATIONS))
    before = F.max("place").over(W.partitionBy(key).orderBy("operation_index").rowsBetween(W.unboundedPreceding, -1))
    nth = F.row_number().over(W.partitionBy(key, "kind").orderBy("operation_index"))
    rows = ops.withColumn("place", F.coalesce(place, F.lit(0))).withColumn("before", before).withColumn("nth", nth)
    checks = ((F.col("place") == 0, "unknown or forbidden operation kind"), ((F.col("place") > 0) & (F.col("nth") > 1), "operation kind is repeated"), ((F.col("place") > 0) & (F.col("nth") == 1) & (F.col("before") > F.col("place")), "operation is out of order"))
    return violations(rows, [key, "operation_index"], checks)


UUID = "^([0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[1-8][0-9a-fA-F]{3}-[89abAB][0-9a-fA-F]{3}-[0-9a-fA-F]{12}|0{8}-0{4}-0{4}-0{4}-0{12}|[fF]{8}-[fF]{4}-[fF]{4}-[fF]{4}-[fF]{12})$"
SHA, DATE, DATETIME, URL = "^[0-9a-f]{64}$", r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])$", r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])T([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d+)?)?Z$", r"^[A-Za-z][A-Za-z0-9+.-]*:\S+$"


def validate_envelope(intents: DataFrame, key: str = "intent_id", body: str = "body") -> DataFrame:
    """(key, message): formats of ids, hashes and dates, the model literal, known grades, at least one operation."""
    at = lambda path: F.get_json_object(body, path)
    bad = lambda path, pattern: ~F.coalesce(at(path).rlike(pattern), F.lit(False))
    grades = F.from_json(at("$.evidence_grades_used"), "array<string>")
    ops = F.from_json(at("$.operations"), "array<string>")
    checks = [
        (bad("$.intent_id", UUID), "intent_id is not a uuid"), (bad("$.source.run_id", UUID), "source.run_id is not a uuid"), (bad("$.source.transcript_sha256", SHA), "source.transcript_sha256 is not a hash"),
        (bad("$.idempotency_key", SHA), "idempotency_key is not a hash"), (~F.coalesce(at("$.source.model_id") == v.MODEL_ID, F.lit(False)), "source.model_id is not the fixed model"), (~F.coalesce(F.length(at("$.source.video_id")) > 0, F.lit(False)), "source.video_id is empty"),
        (~F.coalesce(F.size(grades) > 0, F.lit(False)), "evidence_grades_used is empty"), (F.coalesce(F.size(F.array_except(grades, F.array(*map(F.lit, v.EVIDENCE_GRADES)))) > 0, F.lit(False)), "evidence_grades_used has an unknown grade"),
        (~F.coalesce(F.size(ops) > 0, F.lit(False)), "operations is empty"), ((at("$.schema_version") == v.PACKET_VERSION) & (bad("$.source.research_as_of", DATE) | at("$.source.research_as_of").try_cast("date").isNull()), "source.research_as_of is not a date"),
    ]
    return violations(intents, [key], checks)


#: Rules by operation kind: (rule, member, ...). A kind whose payload is a list also has its bounds.
_TEXT, _LIST, _ENUM, _UNIT, _INT, _UUID, _URL, _BOOL, _TIME, _DATE, _IDS = "text", "list", "enum", "unit", "int", "uuid", "url", "bool", "time", "date", "ids"
PAYLOAD_LISTS = {
    "replace_category_assignments": (1, 4), "replace_domain_assignments": (1, 6), "replace_lifecycle_assignments": (1, 7), "replace_evidence_anchors": (1, 80), "replace_organization_candidates": (1, 20),
    "replace_organization_sources": (0, 40), "upsert_resource_candidates": (0, 25), "upsert_entity_candidates": (0, 25), "record_web_search_events": (0, 40),
}
PAYLOAD_RULES: dict[str, tuple[tuple, ...]] = {
    "create_video_analysis": (
        (_TEXT, "initial_summary", 200, 1200), (_TEXT, "structured_summary", 400, 4000), (_TEXT, "contextualized_abstract", 200, 2000), (_TEXT, "why_it_matters", 40, 1200), (_LIST, "key_takeaways", 5, 10), (_LIST, "concepts", 0, 30),
        *[(_LIST, m, 0, 20) for m in ("prerequisites", "learning_outcomes", "limitations", "quantitative_claims", "demonstrations")], (_LIST, "curriculum_roles", 0, 10), (_LIST, "challenge_seeds", 0, 10),
        (_ENUM, "difficulty", v.DIFFICULTIES), (_ENUM, "content_form", v.CONTENT_FORMS), (_ENUM, "evidence_level", v.EVIDENCE_LEVELS), (_UNIT, "overall_confidence"),
    ),
    "create_contextualized_initial_summary": ((_TEXT, "transcript_summary", 200, 4000), (_LIST, "software_engineering_concepts", 0, 30), (_LIST, "ai_concepts", 0, 30), (_TEXT, "why_concepts_matter_together", 1), (_LIST, "external_context_notes", 0, 30), (_TEXT, "temporal_context", 1), (_IDS, "evidence_ids")),
    "replace_technology_library_summaries": ((_LIST, "families", 0, 8),),
    "replace_category_assignments": ((_ENUM, "category_code", v.CATEGORIES), (_ENUM, "assignment_role", ("primary", "secondary")), (_UNIT, "confidence"), (_TEXT, "rationale", 1), (_INT, "alternative_rank", 1, True)),
    "replace_domain_assignments": ((_TEXT, "domain_code", 1), (_UNIT, "confidence"), (_TEXT, "rationale", 1)),
    "replace_lifecycle_assignments": ((_ENUM, "", v.LIFECYCLE_STAGES),),
    "replace_evidence_anchors": ((_UUID, "evidence_id"), (_ENUM, "source_kind", v.EVIDENCE_SOURCES), (_URL, "source_url", True), (_TEXT, "short_excerpt", 1, 400), (_TEXT, "supports", 1)),
    "replace_organization_candidates": (
        (_UUID, "organization_candidate_id"), (_TEXT, "canonical_name", 1), (_TEXT, "normalized_name", 1), (_ENUM, "organization_scope", v.ORGANIZATION_SCOPES), (_LIST, "relationship_roles", 1, None), (_BOOL, "is_primary_featured"), (_INT, "featured_rank", 1),
        (_ENUM, "primary_domain_code", v.DOMAINS), (_LIST, "secondary_domain_codes", 0, 2), (_URL, "parent_canonical_url", True), (_URL, "official_url"), (_TEXT, "authoritative_summary", 1), (_DATE, "status_as_of"), (_BOOL, "ownership_changed_since_video"), (_UNIT, "confidence"), (_IDS, "evidence_ids"),
    ),
    "replace_organization_sources": (
        (_UUID, "organization_source_id"), (_UUID, "organization_candidate_id"), (_INT, "source_rank", 1), (_ENUM, "source_role", v.SOURCE_ROLES), (_ENUM, "authority_tier", v.AUTHORITY_TIERS), (_TEXT, "title", 1), (_TEXT, "publisher", 1), (_URL, "url"), (_TEXT, "normalized_url", 1),
        (_BOOL, "publicly_retrievable"), (_TIME, "retrieved_at"), (_TIME, "source_published_at", True), (_ENUM, "verification_status", v.VERIFICATION), (_BOOL, "is_required_core_source"), (_UUID, "evidence_id", True),
    ),
    "upsert_resource_candidates": ((_ENUM, "resource_type", v.RESOURCE_TYPES), (_TEXT, "title", 1), (_URL, "url"), (_TEXT, "normalized_url", 1), (_TEXT, "relationship_to_video", 1), (_TEXT, "why_valuable", 1), (_ENUM, "verification_status", v.VERIFICATION), (_BOOL, "is_first_party"), (_UNIT, "confidence"), (_IDS, "evidence_ids")),
    "upsert_entity_candidates": ((_ENUM, "entity_kind", v.ENTITY_KINDS), (_TEXT, "name", 1), (_TEXT, "normalized_name", 1), (_URL, "canonical_url", True), (_TEXT, "relationship_to_video", 1), (_UNIT, "confidence"), (_ENUM, "verification_status", v.VERIFICATION), (_IDS, "evidence_ids")),
    "record_web_search_events": ((_ENUM, "subagent", v.SUBAGENTS), (_TEXT, "query", 1), (_ENUM, "provider", ("exa",)), (_TIME, "searched_at"), (_LIST, "result_urls", 0, None), (_LIST, "selected_urls", 0, None), (_TEXT, "search_purpose", 1)),
}
_IDENTITY = ((_ENUM, "schema_version", (v.PACKET_VERSION,)), (_UUID, "run_id"), (_TEXT, "video_id", 1), ("sha", "transcript_sha256"), (_DATE, "research_as_of"))
ARTIFACT_RULES: dict[str, tuple[tuple, ...]] = {
    "run_manifest": (*_IDENTITY, (_TEXT, "taxonomy_version", 1), (_TEXT, "prompt_bundle_version", 1), (_ENUM, "model_id", (v.MODEL_ID,)), (_TIME, "claimed_at"), (_TIME, "video_published_at", True)),
    "transcript_analysis": (*_IDENTITY, *[r for r in PAYLOAD_RULES["create_video_analysis"] if r[1] in ("initial_summary", "structured_summary", "key_takeaways", "concepts", "demonstrations", "quantitative_claims", "limitations", "prerequisites", "learning_outcomes")], (_LIST, "sections", 0, None), (_LIST, "evidence_anchors", 0, None)),
    "taxonomy_classification": (*_IDENTITY, (_TEXT, "taxonomy_version", 1), (_LIST, "secondary", 0, 3), (_LIST, "domains", 1, 6), (_LIST, "lifecycle_stages", 1, 7), (_ENUM, "difficulty", v.DIFFICULTIES), (_ENUM, "content_form", v.CONTENT_FORMS), (_ENUM, "evidence_level", v.EVIDENCE_LEVELS)),
    "web_context": (*_IDENTITY, (_LIST, "searches", 0, None), (_LIST, "resources", 0, None), (_LIST, "entities", 0, None), (_LIST, "verified_results", 0, None)),
    "organization_research": (*_IDENTITY, (_LIST, "candidates", 0, 20), (_LIST, "proposed_sources", 0, 12), (_BOOL, "review_required"), (_LIST, "unresolved_conflicts", 0, None), (_LIST, "review_reasons", 0, None)),
    "source_verification": (*_IDENTITY, (_LIST, "resources", 0, None), (_LIST, "entities", 0, None), (_LIST, "verified_results", 0, None)),
    "curriculum_signals": (*_IDENTITY, (_LIST, "curriculum_roles", 0, 10), (_TEXT, "suggested_lesson_placement", 1), (_LIST, "challenge_seeds", 0, 10), (_LIST, "assessment_methods", 0, 10), (_LIST, "related_categories", 0, 5), (_ENUM, "recommended_learner_level", v.DIFFICULTIES)),
    "initial_summary": (*_IDENTITY, (_TIME, "generated_at"), *PAYLOAD_RULES["create_contextualized_initial_summary"]),
    "technology_library_summary": (*_IDENTITY, (_TIME, "generated_at"), (_LIST, "families", 0, 8)),
    "organization_profile": (*_IDENTITY, (_TIME, "generated_at"), (_LIST, "other_organizations", 0, 19), (_LIST, "sources", 0, 40), (_ENUM, "primary_domain_code", v.DOMAINS), (_LIST, "secondary_domain_codes", 0, 2), (_BOOL, "review_required")),
}


def _broken(members: Column, rule: tuple) -> Column:
    """Whether the members of a JSON object, as a map of texts, break a rule."""
    what, member, *rest = rule
    value = members[member]
    ok = F.lit(False)
    if what == _TEXT:
        low, high = (*rest, None)[:2]
        ok = (F.length(value) >= low) & (F.lit(True) if high is None else F.length(value) <= high)
    elif what in (_LIST, _IDS):
        items = F.from_json(value, "array<string>")
        low, high = (*rest, None)[:2] if what == _LIST else (0, None)
        ok = value.startswith("[") & (F.size(items) >= low) & (F.lit(True) if high is None else F.size(items) <= high) & ~F.exists(items, lambda x: F.coalesce(F.length(x) == 0, F.lit(True)))
        if what == _IDS:
            ok = ok & F.forall(items, lambda x: x.rlike(UUID))
    elif what == _ENUM:
        ok = value.isin(*rest[0])
    elif what == _UNIT:
        number = value.try_cast("double")
        ok = number.between(0, 1) & ~F.isnan(number)
    elif what == _INT:
        ok = (value.try_cast("double") >= rest[0]) & (value.try_cast("double") == F.floor(value.try_cast("double")))
    elif what == _BOOL:
        ok = value.isin("true", "false")
    else:
        ok = value.rlike({_UUID: UUID, _URL: URL, _TIME: DATETIME, _DATE: DATE, "sha": SHA}[what])
        if what in (_TIME, _DATE):  # a day that the calendar has
            ok = F.when(ok, F.substring(value, 1, 10).try_cast("date").isNotNull()).otherwise(ok)
    nullable = what in (_URL, _TIME, _UUID) and rest[:1] == [True] or what == _INT and rest[1:2] == [True]
    return ~F.coalesce(ok, F.lit(nullable) & value.isNull())


def check_rules(df: DataFrame, keys: Sequence[str], kind: str, body: str, rules: dict[str, tuple[tuple, ...]]) -> DataFrame:
    """(keys, message) of every rule of its kind that a JSON object breaks; an object is parsed once, whatever the number of rules."""
    rows = df.select(*keys, F.col(kind).alias("_kind"), F.from_json(body, "map<string,string>").alias("_members"))
    checks = [((F.col("_kind") == k) & _broken(F.col("_members"), r), f"{r[1]} breaks {r[0]}") for k, rs in rules.items() for r in rs]
    return violations(rows, keys, checks)


#: What version 1 bounds and allows otherwise.
V1_LISTS = {"record_web_search_events": (0, 20)}
V1_RULES: dict[str, tuple[tuple, ...]] = {"record_web_search_events": ((_ENUM, "subagent", v.SUBAGENTS[1:]),)}


def validate_payload(ops: DataFrame, key: str = "intent_id", versions: DataFrame | None = None) -> DataFrame:
    """(key, operation_index, message) over the payloads of ``explode_operations``; list payloads are checked item by item.

    versions (key, schema_version) says which intents are of version 1, which allows fewer search events and subagents.
    """
    ops = _with_v1(ops, versions, key)
    single = ops.where(~F.col("kind").isin(*PAYLOAD_LISTS))
    objects = check_rules(single, [key, "operation_index"], "kind", "payload", {k: r for k, r in PAYLOAD_RULES.items() if k not in PAYLOAD_LISTS})
    lists = ops.where(F.col("kind").isin(*PAYLOAD_LISTS)).withColumn("items", F.from_json("payload", "array<string>"))
    size = F.size("items")
    bounds = violations(lists, [key, "operation_index"], [((F.col("kind") == k) & ~F.coalesce(size.between(a, b), F.lit(False)), f"{k} must have {a} to {b} items") for k, (a, b) in PAYLOAD_LISTS.items()])
    bounds = bounds.unionByName(violations(lists.where("v1"), [key, "operation_index"], [((F.col("kind") == k) & (size > b), f"{k} must have {a} to {b} items in version 1") for k, (a, b) in V1_LISTS.items()]))
    items = lists.select(key, "operation_index", "kind", "v1", F.explode("items").alias("item"))
    items = items.withColumn("item", F.when(F.col("kind") == "replace_lifecycle_assignments", F.to_json(F.struct(F.col("item").alias("x")))).otherwise(F.col("item")))
    rules = {k: tuple((r[0], r[1] or "x", *r[2:]) for r in rs) for k, rs in PAYLOAD_RULES.items() if k in PAYLOAD_LISTS}
    old = check_rules(items.where("v1"), [key, "operation_index"], "kind", "item", V1_RULES)
    return objects.unionByName(bounds).unionByName(check_rules(items, [key, "operation_index"], "kind", "item", rules)).unionByName(old).distinct()


def validate_research_artifacts(artifacts: DataFrame, key: str = "run_id") -> DataFrame:
    """(key, artifact_kind, message) of contract breaks in artifact bodies."""
    return check_rules(artifacts, [key, "artifact_kind"], "artifact_kind", "body", ARTIFACT_RULES)


def validate_receipts(receipts: DataFrame, key: str = "intent_id", body: str = "body") -> DataFrame:
    """(key, message): statuses, hashes and counts of receipts, and the members that version 2 adds."""
    common = ((_UUID, "intent_id"), (_UUID, "run_id"), (_TEXT, "video_id", 1), ("sha", "intent_sha256"), (_ENUM, "status", ("applied", "rejected", "already_applied")), (_TIME, "applied_at", True), (_UUID, "analysis_id", True))
    added = ((_TEXT, "packet_schema_version", 1), (_TEXT, "packet_storage_prefix", 1), (_BOOL, "finished_marker_written"), (_INT, "artifact_count", 0))
    rows = dispatch_schema_version(receipts, body)
    out = check_rules(rows, [key], "contract", body, {"v1": common, "v2": (*common, *added)})
    return out.unionByName(rows.where("contract in ('unsupported', 'invalid_json')").select(key, F.col("contract").alias("message")))


# --- sets


def validate_category_assignments(rows: DataFrame, key: str = "analysis_id") -> DataFrame:
    """(key, message): one to four rows, exactly one primary, at most three secondary."""
    n = rows.groupBy(key).agg(F.count("*").alias("n"), F.count_if(F.col("assignment_role") == "primary").alias("p"), F.count_if(F.col("assignment_role") == "secondary").alias("s"))
    return violations(n, [key], [(F.col("n") > 4, "At most four category assignments are allowed"), (F.col("p") != 1, "Exactly one primary category is required"), (F.col("s") > 3, "At most three secondary categories are allowed")])


def validate_technology_families(rows: DataFrame, analyses: DataFrame, key: str = "analysis_id") -> DataFrame:
    """(key, message): at most eight families, unique ranks, a reason where there are none. analyses: (key, no_main_technology_reason)."""
    n = rows.groupBy(key).agg(F.count("*").alias("n"), F.count_distinct("family_rank").alias("d"))
    joined = analyses.select(key, "no_main_technology_reason").join(n, key, "left").na.fill(0, ["n", "d"])
    return violations(joined, [key], [(F.col("n") > 8, "At most eight technology families are allowed"), ((F.col("n") == 0) & F.col("no_main_technology_reason").isNull(), "no_main_technology_reason is required when families is empty"), (F.col("n") > F.col("d"), "technology family_rank values must be unique")])


def validate_organization_sources(rows: DataFrame, key: str = "organization_candidate_id", intent: str = "analysis_id") -> DataFrame:
    """(intent, key, message): at most forty sources per intent; unique rank and unique URL per candidate."""
    many = rows.groupBy(intent).count().where("count > 40").select(intent, F.lit(None).cast("string").alias(key), F.lit("At most forty organization sources are allowed").alias("message"))
    ranks = rows.groupBy(intent, key, "source_rank").count().where("count > 1").select(intent, key, F.concat(F.lit("Duplicate source_rank "), F.col("source_rank").cast("string"), F.lit(" for organization "), F.col(key)).alias("message"))
    urls = rows.groupBy(intent, key, "normalized_url").count().where("count > 1").select(intent, key, F.concat(F.lit("Duplicate normalized_url for organization "), F.col(key)).alias("message"))
    return many.unionByName(ranks).unionByName(urls.distinct())


def validate_organization_candidates(rows: DataFrame, key: str = "analysis_id", position: str = "position") -> DataFrame:
    """(key, message) of the organization set rules, over (key, position, candidate columns); messages name the candidate.

    Second and later uses of a rank, name or id count as the duplicates.
    """
    return _candidate_messages(_candidate_items(rows, key, position), key)


def _candidate_items(rows: DataFrame, key: str, position: str) -> DataFrame:
    """(key, is_primary_featured, primary_domain_code, item): what the set rules need of a candidate, its own messages among it; the domain of primary ones only."""
    label = F.coalesce("normalized_name", "organization_candidate_id")
    say = lambda text, *more: F.concat(label, F.lit(": " + text), *more)
    second, known = F.col("secondary_domain_codes"), F.array(*map(F.lit, v.DOMAINS))
    own = [
        (F.col("featured_rank") < 1, say("featured_rank must be an integer >= 1")), (~_has(v.DOMAINS, "primary_domain_code"), say("unknown primary_domain_code ", F.col("primary_domain_code"))),
        (F.size(second) > 2, say("at most two secondary organization domains are allowed")), (F.size(F.array_except(second, known)) > 0, say("unknown secondary_domain_code")),
        (F.array_contains(second, F.col("primary_domain_code")), say("secondary domains must not repeat the primary domain")), (F.size(F.array_distinct(second)) < F.size(second), say("duplicate secondary_domain_code")),
        (F.col("parent_name").isNotNull() & F.col("parent_canonical_url").isNull(), say("parent_name requires parent_canonical_url")),
        (F.col("is_primary_featured") & ~F.array_contains("relationship_roles", v.PRIMARY_ROLE), say("primary featured organization must include relationship role primary_featured_organization")),
    ]
    item = F.struct(F.col(position).alias("position"), F.col("featured_rank").alias("rank"), F.col("normalized_name").alias("name"), F.col("organization_candidate_id").alias("id"), _messages(own).alias("own"))
    return rows.select(key, "is_primary_featured", F.when(F.col("is_primary_featured"), F.col("primary_domain_code")).alias("primary_domain_code"), item.alias("item"))


def _candidate_messages(items: DataFrame, key: str) -> DataFrame:
    """(key, message) of the set rules over ``_candidate_items``."""
    rank = F.col("item")["rank"]
    sets = items.groupBy(key).agg(
        F.count_if("is_primary_featured").alias("p"), F.count_if(rank == 1).alias("r"), F.count_if(F.col("is_primary_featured") & (rank == 1)).alias("b"), F.count("*").alias("n"),
        F.sort_array(F.collect_list("item")).alias("items"),
    )

    def of_item(x: Column, i: Column) -> Column:
        """A candidate's own messages and those of values that one before it has."""
        before = F.slice("items", 1, i)
        again = lambda c: F.coalesce(F.exists(before, lambda y: y[c] == x[c]), F.lit(False))
        name = F.concat(F.coalesce(x["name"], x["id"]), F.lit(": "))
        return F.concat(x["own"], _messages([
            ((x["rank"] >= 1) & again("rank"), F.concat(name, F.lit("featured_rank "), x["rank"].cast("string"), F.lit(" is duplicated"))), (again("name"), F.concat(name, F.lit("normalized_name is duplicated"))),
            (again("id"), F.concat(name, F.lit("organization_candidate_id is duplicated"))),
        ]))

    whole = _messages([(F.col("p") != 1, F.lit(ONE_PRIMARY)), (F.col("r") != 1, F.lit(ONE_RANK)), ((F.col("p") == 1) & (F.col("r") == 1) & (F.col("b") == 0), F.lit(SAME_ROW)), (F.col("n") > 20, F.lit("At most twenty organization candidates are allowed"))])
    return sets.select(key, F.explode(F.concat(whole, F.flatten(F.transform("items", of_item)))).alias("message"))


def _messages(checks: Sequence[tuple[Column, Column]]) -> Column:
    """The messages whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(condition, message) for condition, message in checks]))


def qualifying_source() -> Column:
    """Public, verified and of an authoritative tier."""
    return F.coalesce(F.col("publicly_retrievable") & (F.col("verification_status") == "verified") & F.col("authority_tier").isin(*v.AUTHORITATIVE_TIERS), F.lit(False))


def source_minimum(sources: DataFrame, key: str = "organization_candidate_id") -> DataFrame:
    """(key, has_identity, has_technical) over qualifying sources."""
    fit = qualifying_source()
    return sources.groupBy(key).agg(F.bool_or(fit & _has(v.IDENTITY_ROLES, "source_role")).alias("has_identity"), F.bool_or(fit & _has(v.TECHNICAL_ROLES, "source_role")).alias("has_technical"))


def validate_source_minimum(candidates: DataFrame, sources: DataFrame, key: str = "organization_candidate_id") -> DataFrame:
    """(key, message) for candidates without a qualifying identity or technical source."""
    joined = candidates.select(key).distinct().join(source_minimum(sources, key), key, "left").na.fill(False)
    return violations(joined, [key], [(~F.col("has_identity"), NO_IDENTITY), (~F.col("has_technical"), NO_TECHNICAL)])


def validate_intent_source_minimum(candidates: DataFrame, sources: DataFrame, key: str = "analysis_id") -> DataFrame:
    """(key, message) for the primary candidate of each intent, passed over for other_unknown and where an intent has no sources."""
    primary = candidates.where(F.col("is_primary_featured") & (F.col("primary_domain_code") != v.UNKNOWN_DOMAIN)).join(sources.select(key).distinct(), key, "left_semi")
    return primary.select(key, "organization_candidate_id").join(validate_source_minimum(primary, sources), "organization_candidate_id").select(key, "message")


def validate_organization_profile(profiles: DataFrame, sources: DataFrame, key: str = "run_id") -> DataFrame:
    """(key, message) over profiles (key, primary_id, primary_org_domain, primary_domain_code, no_organization_reason, review_required) and their sources (key, ...)."""
    fit = qualifying_source()
    told = sources.select(key, "organization_candidate_id", (fit & _has(v.IDENTITY_ROLES, "source_role")).alias("i"), (fit & _has(v.TECHNICAL_ROLES, "source_role")).alias("t"))  # two flags move in place of what they are read from
    own = told.join(profiles.select(key, "primary_id"), key).where(F.col("organization_candidate_id") == F.col("primary_id"))
    n = own.groupBy(key).agg(F.count("*").alias("n"), F.bool_or("i").alias("i"), F.bool_or("t").alias("t"))
    rows = profiles.join(n, key, "left").na.fill(0, ["n"]).na.fill(False, ["i", "t"])
    none, unknown = F.col("primary_id").isNull(), F.col("primary_org_domain") == v.UNKNOWN_DOMAIN
    known = ~none & ~unknown
    checks = [
        (none & (F.col("primary_domain_code") != v.UNKNOWN_DOMAIN), "Missing primary organization must use primary_domain_code other_unknown"), (none & (F.coalesce(F.length("no_organization_reason"), F.lit(0)) == 0), "no_organization_reason is required when no organization is identified"),
        (none & ~F.col("review_required"), "review_required must be true when no organization is identified"), (~none & (F.col("primary_domain_code") != F.col("primary_org_domain")), "Profile primary_domain_code must match the primary featured organization"),
        (~none & unknown & ~F.col("review_required"), "other_unknown primary organization domain requires review_required"), (known & ~F.col("n").between(2, 6), "Primary organization must have two to six ranked sources"), (known & ~F.col("i"), NO_IDENTITY), (known & ~F.col("t"), NO_TECHNICAL),
    ]
    return violations(rows, [key], checks)


# --- across files


def validate_packet_identity(identities: DataFrame, key: str = "packet_key") -> DataFrame:
    """(key, message) where an artifact's identity differs from its packet's run_manifest.

    identities: (key, artifact_kind, run_id, video_id, transcript_sha256, research_as_of, video_published_at, has_published);
    absent fields are passed over, and the published date is compared null-aware where it is present.
    """
    fields = ("run_id", "video_id", "transcript_sha256", "research_as_of")
    manifest = identities.where("artifact_kind = 'run_manifest'").select(key, *[F.col(f).alias("m_" + f) for f in (*fields, "video_published_at")])
    rows = identities.where("artifact_kind <> 'run_manifest'").join(manifest, key)
    say = lambda f: F.concat(F.col("artifact_kind"), F.lit(f".{f} does not match run_manifest"))
    checks = [(F.coalesce(F.length(f) > 0, F.lit(False)) & ~F.col(f).eqNullSafe(F.col("m_" + f)), say(f)) for f in fields]
    checks.append((F.col("has_published") & ~F.col("video_published_at").eqNullSafe(F.col("m_video_published_at")), say("video_published_at")))
    return violations(rows, [key], checks)


def missing_evidence(references: DataFrame, anchors: DataFrame, key: str = "run_id") -> DataFrame:
    """Distinct (key, evidence_id) that are referred to and not anchored."""
    return references.select(key, "evidence_id").distinct().join(anchors.select(key, "evidence_id"), [key, "evidence_id"], "left_anti")


def references_in(bodies: DataFrame, kinds: Sequence[str], key: str = "run_id") -> DataFrame:
    """(key, evidence_id) of every reference in bodies of these kinds."""
    return bodies.where(F.col("artifact_kind").isin(*kinds)).select(key, F.explode(collect_evidence_ids(F.col("body"))).alias("evidence_id"))


def missing_evidence_research(bodies: DataFrame, anchors: DataFrame, key: str = "run_id") -> DataFrame:
    """References of organization research that no transcript anchor has."""
    return missing_evidence(references_in(bodies, ["organization_research"], key), anchors, key)


def missing_evidence_packet(bodies: DataFrame, anchors: DataFrame, key: str = "run_id") -> DataFrame:
    """References of summaries, profile, research and operations that neither transcript nor intent anchors have."""
    return missing_evidence(references_in(bodies, ["initial_summary", "technology_library_summary", "organization_profile", "organization_research", "ingestion_intent"], key), anchors, key)


def missing_evidence_applied(ops: DataFrame, anchors: DataFrame, analyses: DataFrame) -> DataFrame:
    """(analysis_id, evidence_id) that an intent's payloads refer to and its analysis has no anchor for; analyses: (intent_id, analysis_id)."""
    refs = ops.where("kind <> 'replace_evidence_anchors'").select("intent_id", F.explode(collect_evidence_ids(F.col("payload"))).alias("evidence_id")).join(analyses, "intent_id")
    return missing_evidence(refs, anchors, "analysis_id")


def validate_intent_matches_files(packets: DataFrame, key: str = "run_id") -> DataFrame:
    """(key, message) over packets (key, summary, intent_summary, n_families, intent_families, candidate_ids, intent_candidate_ids, source_ids, intent_source_ids); null intent members: no such operation."""
    lost = lambda a, b: F.size(F.array_except(a, b)) > 0
    checks = [
        (F.col("intent_summary").isNotNull() & ~F.col("intent_summary").eqNullSafe(F.col("summary")), "create_contextualized_initial_summary must match 60-initial-summary.json"),
        (F.col("intent_families").isNotNull() & ~F.col("intent_families").eqNullSafe(F.col("n_families")), "replace_technology_library_summaries must match 70-technology-library-summary.json"),
        (F.coalesce(lost("candidate_ids", "intent_candidate_ids"), F.lit(False)), "organization_profile candidate is missing from replace_organization_candidates"),
        (F.coalesce(lost("source_ids", "intent_source_ids"), F.lit(False)), "organization_profile source is missing from replace_organization_sources"),
    ]
    return violations(packets, [key], checks)


def synthesis_review_reasons(packets: DataFrame, sources: DataFrame, key: str = "run_id") -> DataFrame:
    """(key, reasons, next_status) over packets (key, overall_confidence, primary_id, primary_domain_code)."""
    met = source_minimum(sources).select(F.col("organization_candidate_id").alias("primary_id"), (F.col("has_identity") & F.col("has_technical")).alias("_met"))
    rows = packets.join(met, "primary_id", "left")
    unknown = F.col("primary_id").isNull() | (F.col("primary_domain_code") == v.UNKNOWN_DOMAIN)
    reasons = F.array_compact(F.array(F.when(F.col("overall_confidence") < 0.7, "overall_confidence_below_0.70"), F.when(unknown, "primary_organization_domain_other_unknown").when(~F.coalesce("_met", F.lit(False)), "authoritative_source_minimum_failed")))
    return rows.select(key, reasons.alias("reasons"), F.when(F.size(reasons) > 0, "review_required").otherwise("intent_ready").alias("next_status"))


def infer_next_status(runs: DataFrame, profiles: DataFrame, key: str = "run_id", body: str = "body") -> DataFrame:
    """(key, next_status) from each run's stored profile; a missing or unreadable one is intent_ready."""
    rows = runs.select(key).join(profiles.select(key, body), key, "left")
    review = (F.get_json_object(body, "$.review_required") == "true") | (F.get_json_object(body, "$.primary_domain_code") == v.UNKNOWN_DOMAIN)
    return rows.select(key, F.when(F.coalesce(review, F.lit(False)), "review_required").otherwise("intent_ready").alias("next_status"))


def review_refusal_reasons(runs: DataFrame, profiles: DataFrame, candidates: DataFrame, sources: DataFrame, key: str = "run_id") -> DataFrame:
    """(key, place, reason): what stands against applying a run without review; reasons are told in the order of place.

    runs: (key, status) and, where intents of version 1 are among them, schema_version: those have the first three reasons
    only. profiles: (key, review_required, n_conflicts, profile_domain); candidates and sources carry the key, and sources
    count for candidates of their own key.
    """
    v2 = runs.where(~F.col("schema_version").eqNullSafe(F.lit(v.V1_VERSION))) if "schema_version" in runs.columns else runs
    wanted = v2.select(key).distinct()
    rows = runs.select(key, "status").join(profiles, key, "left")
    own = violations(rows, [key], [
        (F.col("status") == "review_required", "run status is review_required"), (F.coalesce("review_required", F.lit(False)), "organization profile review_required"),
        (F.coalesce(F.col("n_conflicts") > 0, F.lit(False)), "unresolved organization hierarchy conflicts"),
    ])
    of = _candidate_items(candidates, key, "position").join(wanted, key, "left_semi")  # only what belongs to the runs is looked at, by the rows that the rules need
    sets = _candidate_messages(of, key)
    primary = of.where("is_primary_featured")
    unknown = primary.where(F.col("primary_domain_code") == v.UNKNOWN_DOMAIN).select(key, F.lit("primary organization domain is other_unknown").alias("message"))
    known = primary.where(F.col("primary_domain_code") != v.UNKNOWN_DOMAIN).select(key, F.col("item")["id"].alias("organization_candidate_id"))
    minimum = _minimum_of(known, sources, key)
    last = profiles.join(wanted, key, "left_semi").where(F.col("profile_domain") == v.UNKNOWN_DOMAIN).select(key, F.lit("organization profile primary_domain_code is other_unknown").alias("message"))
    place = F.when(F.col("message") == "run status is review_required", 1).when(F.col("message") == "organization profile review_required", 2).otherwise(3)
    out = own.withColumn("place", place)
    for k, part in enumerate((sets, unknown, minimum, last), 4):
        out = out.unionByName(part.withColumn("place", F.lit(k)))
    return out.repartition(key).distinct().select(key, "place", F.col("message").alias("reason"))  # by the key, so that what joins reasons with it finds them dealt


def _minimum_of(known: DataFrame, sources: DataFrame, key: str) -> DataFrame:
    """(key, message) for candidates (key, organization_candidate_id) without a qualifying identity or technical source under their key.

    Only qualifying sources move, one row for each candidate of a task: those that do not qualify say as much as absent ones.
    """
    at = [key, "organization_candidate_id"]
    of_role = lambda roles: _has(roles, "source_role")
    fit = sources.where(qualifying_source() & (of_role(v.IDENTITY_ROLES) | of_role(v.TECHNICAL_ROLES)))
    met = fit.groupBy(*at).agg(F.bool_or(of_role(v.IDENTITY_ROLES)).alias("has_identity"), F.bool_or(of_role(v.TECHNICAL_ROLES)).alias("has_technical"))
    return violations(known.join(met, at, "left").na.fill(False, ["has_identity", "has_technical"]), [key], [(~F.col("has_identity"), NO_IDENTITY), (~F.col("has_technical"), NO_TECHNICAL)])


# --- quality gates


def validate_taxonomy_classification(categories: DataFrame, domains: DataFrame, stages: DataFrame, active_domains: DataFrame, key: str = "run_id") -> DataFrame:
    """(key, message): one primary, at most three secondary, known codes, one to six active domains, one to seven stages."""
    n = categories.groupBy(key).agg(F.count_if(F.col("assignment_role") == "primary").alias("p"), F.count_if(F.col("assignment_role") == "secondary").alias("s"), F.count_if(~_has(v.CATEGORIES, "category_code")).alias("u"))
    d = domains.join(active_domains.where("active").select("domain_code", F.lit(True).alias("_a")), "domain_code", "left").groupBy(key).agg(F.count("*").alias("d"), F.count_if(F.col("_a").isNull()).alias("du"))
    g = stages.groupBy(key).agg(F.count("*").alias("g"), F.count_if(~_has(v.LIFECYCLE_STAGES, "lifecycle_stage")).alias("gu"))
    rows = n.join(d, key, "left").join(g, key, "left").na.fill(0)
    return violations(rows, [key], [
        (F.col("p") != 1, "exactly one primary category is required"), (F.col("s") > 3, "at most three secondary categories"), (F.col("u") > 0, "unknown category code"), (~F.col("d").between(1, 6), "one to six domains are required"),
        (F.col("du") > 0, "unknown or inactive domain code"), (~F.col("g").between(1, 7), "one to seven lifecycle stages are required"), (F.col("gu") > 0, "unknown lifecycle stage"),
    ])


def missing_required_evidence(tables: dict[str, DataFrame], key: str = "analysis_id", count: Column | None = None) -> DataFrame:
    """(key, table, name, n) of rows without evidence, by table; every table needs (key, name, n_evidence)."""
    out = None
    for name, rows in tables.items():
        part = rows.where(F.coalesce("n_evidence", F.lit(0)) == 0).groupBy(key, F.col("name")).agg(F.count("*").alias("n")).select(key, F.lit(name).alias("table"), "name", "n")
        out = part if out is None else out.unionByName(part)
    return out


def summary_word_counts(analyses: DataFrame, key: str = "analysis_id") -> DataFrame:
    """(key, initial_words, structured_words) of analyses whose summaries are not 75 to 125 and 200 to 400 words."""
    words = lambda c: F.when(F.coalesce(F.length(F.trim(c)), F.lit(0)) == 0, 0).otherwise(F.size(F.split(F.trim(c), r"\s+")))
    rows = analyses.select(key, words("initial_summary").alias("initial_words"), words("structured_summary").alias("structured_words"))
    return rows.where("initial_words not between 75 and 125 or structured_words not between 200 and 400")


def unsupported_current_status(families: DataFrame) -> DataFrame:
    """Families that claim a status other than uncertain with neither evidence nor official URLs."""
    return families.where((F.col("temporal_status") != "uncertain") & (F.col("n_evidence") == 0) & (F.col("n_urls") == 0))
