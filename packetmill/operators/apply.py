"""Deterministic application of validated intents to target tables: preflight, writes, events, receipts, completion.

Plain tables have no MERGE: a write returns the next table, the rows it leaves alone and the new ones, so that a batch is
computed whole before anything is published. An intent applies entirely or not at all: those with any violation are
left out before the first write. Applying the same intents again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json import serialize_struct
from ..functions.text import artifact_storage_path, iso_date, iso_datetime, packet_storage_prefix
from ..functions.urls import normalize_official_url, normalize_url
from ..sources.versions import Versions
from ..vocabulary import MODEL_ID, OPERATION_TABLES, PACKET_VERSION, V1_VERSION
from .validate import operations_of

# --- preflight


def apply_preflight(intents: DataFrame, runs: DataFrame, catalog: DataFrame, registry: DataFrame, missing: DataFrame, verified: DataFrame, refusals: DataFrame, approved: bool = False, finalize_only: bool = False) -> DataFrame:
    """(intent_id, code): the first condition that an intent fails, in fixed order; null if it may be applied.

    intents: ledger and file of each intent (intent_id, run_id, ledger_status, ledger_sha256, ledger_key, file_sha256,
    file_intent_id, file_run_id, file_video_id, file_transcript_sha256, file_taxonomy, file_model, file_prompt, file_key,
    computed_key, file_research_as_of, file_packet_version, schema_version). catalog: (video_id, reasons, transcript_sha256);
    registry: (run_id, content_sha256) of registered intent files; missing: (run_id, n_missing); verified:
    (run_id, code) of the first artifact that does not match; refusals: (run_id) that need a review.
    """
    r = runs.select("run_id", F.lit(True).alias("_run"), F.col("video_id").alias("_v"), F.col("status").alias("_st"), F.col("transcript_sha256").alias("_sha"), F.col("taxonomy_version").alias("_tax"), F.col("taxonomy_status").alias("_taxs"), F.col("model_id").alias("_model"), F.col("prompt_bundle_version").alias("_prompt"), F.col("research_as_of").alias("_asof"), F.col("packet_storage_prefix").alias("_prefix"))
    c = catalog.select(F.col("video_id").alias("_v"), F.lit(True).alias("_video"), F.col("reasons").alias("_reasons"), F.col("transcript_sha256").alias("_now"))
    g = registry.groupBy("run_id").agg(F.min("content_sha256").alias("_reg"))
    # Videos are looked up for runs, so that intents, which are wide, move once: all their joins are by run.
    rows = intents.join(r.join(c, "_v", "left"), "run_id", "left").join(g, "run_id", "left").join(missing.select("run_id", "n_missing"), "run_id", "left")
    rows = rows.join(verified.groupBy("run_id").agg(F.max("code").alias("_artifact")), "run_id", "left").join(refusals.select("run_id").distinct().withColumn("_refused", F.lit(True)), "run_id", "left")
    v2 = F.col("schema_version") == PACKET_VERSION
    differs = lambda a, b: ~F.col(a).eqNullSafe(F.col(b))
    done = (F.col("ledger_status") == "applied") | (F.col("_st") == "applied")
    prefix = F.coalesce(F.regexp_replace("_prefix", "/$", ""), packet_storage_prefix(F.col("_v"), F.col("run_id"), F.col("schema_version")))
    ordered = [
        (F.col("ledger_status").isNull(), "INTENT_NOT_FOUND"), (F.col("_run").isNull(), "RUN_NOT_FOUND"), (F.col("_video").isNull(), "VIDEO_NOT_FOUND"), (F.size("_reasons") > 0, "VIDEO_INELIGIBLE"), (differs("_now", "_sha"), "TRANSCRIPT_HASH_MISMATCH"),
        (differs("file_sha256", "ledger_sha256"), "INTENT_HASH_MISMATCH"), (F.col("_reg").isNotNull() & differs("_reg", "file_sha256"), "INTENT_HASH_MISMATCH"), (differs("file_intent_id", "intent_id"), "INTENT_ID_MISMATCH"),
        (differs("file_video_id", "_v") | differs("file_run_id", "run_id"), "SOURCE_MISMATCH"), (differs("file_transcript_sha256", "_sha"), "TRANSCRIPT_HASH_MISMATCH"), (differs("file_taxonomy", "_tax") | ~F.col("_taxs").eqNullSafe(F.lit("active")), "TAXONOMY_MISMATCH"),
        (~F.col("file_model").eqNullSafe(F.lit(MODEL_ID)) | differs("file_model", "_model"), "MODEL_MISMATCH"), (differs("file_prompt", "_prompt"), "PROMPT_MISMATCH"), (differs("computed_key", "file_key") | differs("computed_key", "ledger_key"), "IDEMPOTENCY_MISMATCH"),
        (v2 & ~F.col("file_research_as_of").eqNullSafe(iso_date(F.col("_asof"))), "RESEARCH_AS_OF_MISMATCH"), (v2 & ~F.col("file_packet_version").eqNullSafe(F.lit(PACKET_VERSION)), "PACKET_VERSION_MISMATCH"),
        (v2 & (prefix != packet_storage_prefix(F.col("_v"), F.col("run_id"))), "PACKET_PREFIX_MISMATCH"), (v2 & (F.coalesce("n_missing", F.lit(1)) > 0), "PACKET_INCOMPLETE"), (v2 & F.col("_artifact").isNotNull(), F.col("_artifact")),
        (F.lit(finalize_only) & ~done, "NOT_APPLIED"), (~done & F.lit(not approved) & F.coalesce("_refused", F.lit(False)), "REVIEW_REQUIRED"),
    ]
    code = F.coalesce(*[F.when(F.coalesce(when, F.lit(False)), c if isinstance(c, Column) else F.lit(c)) for when, c in ordered])
    return rows.select("intent_id", code.alias("code"))


# --- writes: each returns the next table


def replace_rows(target: DataFrame, incoming: DataFrame, keys: Sequence[str], touched: DataFrame | None = None) -> DataFrame:
    """The target without the rows of touched (or incoming) keys, and the incoming rows; a touched key without rows is emptied."""
    gone = (incoming if touched is None else touched).select(*keys).distinct().hint("shuffle_hash")  # keys alone are held, so that no target is sorted
    return target.join(gone, list(keys), "left_anti").unionByName(incoming, allowMissingColumns=True)


def upsert_rows(target: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The target with incoming rows in place of those of equal keys; of equal incoming keys the last by ``order`` wins."""
    last = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    one = incoming.withColumn("_k", F.row_number().over(last)).where("_k = 1").drop("_k", *[c for c in order if c not in target.columns])
    return target.join(one.select(*keys), list(keys), "left_anti").unionByName(one, allowMissingColumns=True)


def create_video_analysis(ops: DataFrame, existing: DataFrame) -> DataFrame:
    """Analyses with one for every run that has none; ids are hashes of run ids. Of several for a run the least intent counts."""
    first = ops.withColumn("_k", F.row_number().over(W.partitionBy("run_id").orderBy("intent_id"))).where("_k = 1").drop("_k")
    new = first.join(existing.select("run_id"), "run_id", "left_anti").withColumn("analysis_id", analysis_id_of("run_id"))
    return existing.unionByName(new.select(*[c for c in existing.columns if c in new.columns]), allowMissingColumns=True)


def create_initial_summary(ops: DataFrame, analyses: DataFrame, existing: DataFrame) -> DataFrame:
    """Summary rows with the run's analysis and research date; one per analysis, the first stays."""
    new = ops.join(analyses.select("run_id", "analysis_id"), "run_id").join(existing.select("analysis_id"), "analysis_id", "left_anti").dropDuplicates(["analysis_id"])
    return existing.unionByName(new.select(*[c for c in existing.columns if c in new.columns]), allowMissingColumns=True)


def replace_technology_summaries(rows: DataFrame, target: DataFrame, touched: DataFrame | None = None) -> DataFrame:
    """Families of touched analyses replaced; official URLs are normalised in place, in their order, and bad ones go."""
    flat = rows.select("analysis_id", "family_rank", F.posexplode("official_urls").alias("_p", "_u")).withColumn("_u", normalize_official_url(F.col("_u"))).where("_u is not null")
    urls = flat.groupBy("analysis_id", "family_rank").agg(F.transform(F.sort_array(F.collect_list(F.struct("_p", "_u"))), lambda x: x["_u"]).alias("_urls"))
    fixed = rows.join(urls, ["analysis_id", "family_rank"], "left").withColumn("official_urls", F.coalesce("_urls", F.array().cast("array<string>"))).drop("_urls")
    return replace_rows(target, fixed, ["analysis_id"], touched)


def replace_category_assignments(rows: DataFrame, target: DataFrame, touched: DataFrame | None = None) -> DataFrame:
    return replace_rows(target, rows, ["analysis_id"], touched)


replace_domain_assignments = replace_evidence_anchors = replace_category_assignments


def replace_lifecycle_assignments(ops: DataFrame, target: DataFrame) -> DataFrame:
    """The payload is an array of stages, one row each."""
    return replace_rows(target, ops.select("analysis_id", F.explode("stages").alias("lifecycle_stage")), ["analysis_id"], ops)


def replace_organization_candidates(rows: DataFrame, target: DataFrame, touched: DataFrame | None = None) -> DataFrame:
    """Candidates of touched analyses replaced, with URLs normalised; a null parent URL stays null."""
    fixed = rows.withColumns({"official_url": normalize_official_url(F.col("official_url")), "parent_canonical_url": normalize_official_url(F.col("parent_canonical_url"))})
    return replace_rows(target, fixed, ["analysis_id"], touched)


def replace_organization_sources(rows: DataFrame, target: DataFrame, candidates: DataFrame) -> DataFrame:
    """Sources of the candidates that the payload names replaced, with normalised URLs; sources of candidates that are gone go too."""
    fixed = rows.withColumn("normalized_url", normalize_official_url(F.col("url")))
    return replace_rows(target, fixed, ["organization_candidate_id"]).join(candidates.select("organization_candidate_id").distinct(), "organization_candidate_id", "left_semi")


def replace_sources_of(rows: DataFrame, target: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """As ``replace_organization_sources``, where only candidates of some analyses are at hand, before and after they were replaced.

    Sources of candidates that are gone go; incoming ones need a candidate; all others stay.
    """
    key = "organization_candidate_id"
    gone = before.select(key).join(after.select(key), key, "left_anti").distinct()
    fixed = rows.withColumn("normalized_url", normalize_official_url(F.col("url"))).join(after.select(key).distinct(), key, "left_semi")
    return replace_rows(target, fixed, [key], rows.select(key).unionByName(gone))


def upsert_resource_candidates(rows: DataFrame, target: DataFrame) -> DataFrame:
    """Resources by analysis and normalised URL, which is computed and not taken from the payload; the last in payload order wins.

    rows carry (applied_at, operation_index, position) besides the target's columns.
    """
    return upsert_rows(target, rows.withColumn("normalized_url", normalize_official_url(F.col("url"))), ["analysis_id", "normalized_url"], ["applied_at", "operation_index", "position"])


def append_entity_candidates(rows: DataFrame, target: DataFrame) -> DataFrame:
    """Entities are appended, never merged; their URLs keep utm_ parameters."""
    return target.unionByName(rows.withColumn("canonical_url", normalize_url(F.col("canonical_url"))), allowMissingColumns=True)


def append_web_search_events(rows: DataFrame, target: DataFrame) -> DataFrame:
    return target.unionByName(rows, allowMissingColumns=True)


# --- batches


def good_intents(intents: DataFrame, ops: DataFrame, preflight: DataFrame, violations: DataFrame, missing_evidence: DataFrame, analyses: DataFrame) -> DataFrame:
    """(intent_id, run_id, result, code): applied, already_applied, or refused with the first reason.

    An intent is refused for its preflight code, for any violation, for lacking an analysis (ANALYSIS_MISSING) or for
    evidence that is nowhere (EVIDENCE_MISSING). intents: (intent_id, run_id, ledger_status).
    """
    creates = ops.where("kind = 'create_video_analysis'").select("intent_id").distinct().withColumn("_creates", F.lit(True))
    has = analyses.select("run_id").distinct().withColumn("_has", F.lit(True))
    bad = violations.groupBy("intent_id").agg(F.min("message").alias("_bad"))
    lost = missing_evidence.select("intent_id").distinct().withColumn("_lost", F.lit(True))
    rows = intents.join(preflight.select("intent_id", F.col("code").alias("_code")), "intent_id", "left").join(creates, "intent_id", "left").join(has, "run_id", "left").join(bad, "intent_id", "left").join(lost, "intent_id", "left")
    code = F.coalesce("_code", F.when(F.col("_bad").isNotNull(), F.concat(F.lit("INVALID: "), "_bad")), F.when(F.col("_creates").isNull() & F.col("_has").isNull(), F.lit("ANALYSIS_MISSING")), F.when(F.col("_lost"), F.lit("EVIDENCE_MISSING")))
    result = F.when(F.col("ledger_status") == "applied", "already_applied").when(code.isNull(), "applied").otherwise("refused")
    return rows.select("intent_id", "run_id", result.alias("result"), F.when(result == "refused", code).alias("code"))


def apply_rows(results: DataFrame, incoming: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after replacing the keys of intents that apply now; rows of refused or earlier intents are not looked at."""
    now = incoming.join(results.where("result = 'applied'").select("intent_id"), "intent_id", "left_semi")
    return replace_rows(target, now, keys)


def runs_after(runs: DataFrame, results: DataFrame, now: Column, ledger: DataFrame | None = None) -> DataFrame:
    """Runs with those of applied intents applied and completed; completed_at and pointers that are there stay.

    ledger (intent_id, storage_path, content_sha256) fills intent_path and intent_sha256 where runs have these columns.
    """
    done = results.where("result = 'applied'").groupBy("run_id").agg(F.min("intent_id").alias("_i"))
    if ledger is not None:
        done = done.join(ledger.select(F.col("intent_id").alias("_i"), F.col("storage_path").alias("_path"), F.col("content_sha256").alias("_sha")), "_i", "left")
    rows = runs.join(done, "run_id", "left")
    hit = F.col("_i").isNotNull()
    new = {"status": F.when(hit, "applied").otherwise(F.col("status"))}
    if "completed_at" in runs.columns:
        new["completed_at"] = F.coalesce("completed_at", F.when(hit, now))
    for column, pointer in (("intent_path", "_path"), ("intent_sha256", "_sha")):
        if ledger is not None and column in runs.columns:
            new[column] = F.coalesce(column, pointer)
    return rows.select(*[new.get(c, F.col(c)).alias(c) for c in runs.columns])


def ledger_after(ledger: DataFrame, results: DataFrame, now: Column) -> DataFrame:
    """The ledger with intents that apply now applied at ``now``; other columns and rows stay."""
    done = results.where("result = 'applied'").select("intent_id", F.lit(True).alias("_now"))
    new = {"status": F.when(F.col("_now"), "applied").otherwise(F.col("status")), "applied_at": F.when(F.col("_now"), now).otherwise(F.col("applied_at"))}
    if "error_detail" in ledger.columns:
        new["error_detail"] = F.when(F.col("_now"), F.lit(None).cast("string")).otherwise(F.col("error_detail"))
    return ledger.join(done, "intent_id", "left").select(*[new.get(c, F.col(c)).alias(c) for c in ledger.columns])


def payload_items(ops: DataFrame, kind: str, target: DataFrame, member: str | None = None) -> DataFrame:
    """One row per item of the payloads of a kind: intent_id, run_id, analysis_id, operation_index, position, and the target's columns as the payload has them.

    member names the list where the payload is an object; a payload that is an object without a list is one item.
    """
    own = ("analysis_id", "run_id")
    item = T.StructType([f for f in target.schema if f.name not in own])
    text = F.get_json_object("payload", "$." + member) if member else F.when(F.col("payload").startswith("["), F.col("payload")).otherwise(F.concat(F.lit("["), "payload", F.lit("]")))
    rows = ops.where(F.col("kind") == kind).select("intent_id", "run_id", "analysis_id", "operation_index", F.posexplode(F.from_json(text, T.ArrayType(item))).alias("position", "_item"))
    return rows.select("intent_id", "run_id", "analysis_id", "operation_index", "position", "_item.*")


def by_kind(intents: DataFrame) -> DataFrame:
    """Intents with ``ops``, as ``operations_of`` gives them, dealt to a column a known kind: a list of (operation_index, payload); ``kinds`` lists the kinds of all."""
    kinds = F.col("ops")["kind"]
    once = F.size(F.array_distinct(kinds)) == F.size(kinds)  # as it should be: then a place says all, and no list is walked

    def listed(kind: str) -> Column:
        at = F.array_position(kinds, kind)
        one = F.array(F.struct((at - 1).cast("int").alias("operation_index"), F.get(F.col("ops")["payload"], (at - 1).cast("int")).alias("payload")))
        numbered = F.transform("ops", lambda op, i: F.struct(i.alias("operation_index"), op["kind"].alias("kind"), op["payload"].alias("payload")))
        many = F.transform(F.filter(numbered, lambda op: op["kind"] == kind), lambda op: F.struct(op["operation_index"].alias("operation_index"), op["payload"].alias("payload")))
        return F.when(~F.coalesce(once, F.lit(False)), many).when(at > 0, one).alias(kind)

    return intents.select(*[c for c in intents.columns if c != "ops"], kinds.alias("kinds"), *map(listed, OPERATION_TABLES))


def _operations_told(mine: DataFrame) -> DataFrame:
    """All operations, one a row, with ``n``: the number of rows that its event tells, null for kinds whose events tell none."""
    families, *others = (*_COUNTED, "replace_organization_sources")
    payload = lambda kind: F.col("payload")
    if "kinds" in mine.columns:
        mine = mine.select("intent_id", "run_id", "analysis_id", families, *others, F.posexplode("kinds").alias("operation_index", "kind"))
        payload = lambda kind: F.get(F.col(kind)["payload"], F.array_position(F.col(kind)["operation_index"], F.col("operation_index")).cast("int") - 1)
    n = F.when(F.col("kind") == families, F.json_array_length(F.get_json_object(payload(families), "$.families")))
    for kind in others:
        n = n.when(F.col("kind") == kind, F.json_array_length(payload(kind)))
    return mine.withColumn("n", n.cast("long"))


def _of_kind(ops: DataFrame, kind: str) -> DataFrame:
    """Operations of a kind, one a row, from rows or from what ``by_kind`` gives."""
    if "kinds" not in ops.columns:
        return ops.where(F.col("kind") == kind)
    own = [c for c in ("intent_id", "run_id", "analysis_id") if c in ops.columns]
    return ops.select(*own, F.explode(F.col(kind)).alias("_op")).select(*own, "_op.operation_index", F.lit(kind).alias("kind"), "_op.payload")


def apply_intents(tables: dict[str, DataFrame], ops: DataFrame, results: DataFrame, now: Column, settle: Callable[..., DataFrame] = lambda df, *parted: df) -> dict[str, DataFrame]:
    """The next state of every table after the intents whose result is ``applied``; nothing is written here.

    tables: the targets by name (those of ``OPERATION_TABLES``), and ``ledger`` (intent_id, run_id, status, applied_at,
    storage_path, content_sha256), ``runs`` (run_id, status, completed_at, intent_path, intent_sha256) and ``events``
    (as ``intent_events`` gives them). ops: (intent_id, operation_index, kind, payload) as ``explode_operations`` gives
    them, or one row an intent as ``by_kind`` deals them. results: (intent_id, run_id, result). An intent is applied whole or not at all, since refused ones are left
    out before any table is computed; the same intents again, found applied in the ledger, change nothing. ``settle`` may
    store the few steps that several tables share, parted by the given columns, for a caller that writes them all.
    """
    done = results.where("result = 'applied'").select("intent_id", "run_id").distinct()
    out = dict(tables)
    name = OPERATION_TABLES["create_video_analysis"]
    target = tables[name]
    creating = _of_kind(ops, "create_video_analysis").join(done, "intent_id").withColumn("analysis_id", F.lit(None).cast("string"))
    made = payload_items(creating, "create_video_analysis", target)
    out[name] = settle(create_video_analysis(made.drop("analysis_id", "position", "operation_index"), target))
    ids = done.join(out[name].select("run_id", "analysis_id"), "run_id").hint("shuffle_hash")  # so that no payloads are sorted
    mine = settle(ops.join(ids, "intent_id"))  # payloads meet their analyses once, and each table reads its own kind
    touched = lambda kind: _of_kind(mine, kind)

    def write(kind: str, next_table: Callable[[DataFrame, DataFrame], DataFrame], member: str | None = None, keep: tuple[str, ...] = ()) -> None:
        table = OPERATION_TABLES[kind]
        if table in tables:
            target = tables[table]
            rows = payload_items(touched(kind), kind, target, member)
            out[table] = next_table(rows.select(*target.columns, *keep), target).select(*target.columns)

    table = OPERATION_TABLES["create_contextualized_initial_summary"]
    if table in tables:
        rows = payload_items(touched("create_contextualized_initial_summary"), "create_contextualized_initial_summary", tables[table]).drop("analysis_id")
        out[table] = create_initial_summary(rows, out[name], tables[table]).select(*tables[table].columns)
    write("replace_technology_library_summaries", lambda rows, target: replace_technology_summaries(rows, target, touched("replace_technology_library_summaries")), "families")
    for kind in ("replace_category_assignments", "replace_domain_assignments", "replace_evidence_anchors"):
        write(kind, lambda rows, target, kind=kind: replace_category_assignments(rows, target, touched(kind)))
    table = OPERATION_TABLES["replace_lifecycle_assignments"]
    if table in tables:
        stages = touched("replace_lifecycle_assignments").select("analysis_id", F.from_json("payload", "array<string>").alias("stages"))
        out[table] = replace_lifecycle_assignments(stages, tables[table]).select(*tables[table].columns)
    write("replace_organization_candidates", lambda rows, target: replace_organization_candidates(rows, target, touched("replace_organization_candidates")))
    candidates = OPERATION_TABLES["replace_organization_candidates"]
    if candidates in out and OPERATION_TABLES["replace_organization_sources"] in tables:
        out[candidates] = settle(out[candidates])  # sources ask twice what is there now
    write("replace_organization_sources", lambda rows, target: replace_sources_of(rows, target, tables[candidates], out[candidates]) if candidates in out else replace_rows(target, rows, ["organization_candidate_id"]))
    write("upsert_resource_candidates", lambda rows, target: upsert_resource_candidates(rows.withColumn("applied_at", now), target), keep=("operation_index", "position"))
    write("upsert_entity_candidates", lambda rows, target: append_entity_candidates(rows, target))
    write("record_web_search_events", lambda rows, target: append_web_search_events(rows, target))
    if "events" in tables:
        out["events"] = tables["events"].unionByName(_events_of(_operations_told(mine)), allowMissingColumns=True)
    if "ledger" in tables:
        out["ledger"] = ledger_after(tables["ledger"], results, now)
    if "runs" in tables:
        out["runs"] = runs_after(tables["runs"], results, now, tables.get("ledger"))
    return out


#: The column by whose hash each table is kept in buckets; all others by analysis.
TABLE_KEYS = {name: "analysis_id" for name in OPERATION_TABLES.values()} | {
    OPERATION_TABLES["create_video_analysis"]: "run_id", OPERATION_TABLES["record_web_search_events"]: "run_id", OPERATION_TABLES["replace_organization_sources"]: "organization_candidate_id",
    "runs": "run_id", "ledger": "intent_id", "events": "intent_id",
}
#: Tables that intents only add to.
APPENDED = (OPERATION_TABLES["upsert_entity_candidates"], OPERATION_TABLES["record_web_search_events"], "events")


def analysis_id_of(run_id: str) -> Column:
    return F.sha2(F.concat(F.lit("analysis|"), run_id), 256)


def apply_batch(store: Versions, intents: DataFrame, number: int, decide: Callable[[dict[str, DataFrame], DataFrame], DataFrame]) -> None:
    """Apply intents (intent_id, run_id, body, applied_at) to the tables of ``store`` as its version ``number``.

    Only buckets with a key of the batch are read and written: of its intents, runs and analyses, and for sources of the
    candidates that its analyses had and get. Tables that are only added to are not read. ``decide`` takes the tables, so pruned,
    and the intents that the ledger does not have as applied, and returns (intent_id, run_id, result). A number that is
    published already is passed over.
    """
    if number in store.numbers():
        return
    known = store.manifest()["tables"]
    at: dict[str, list[int]] = {"ledger": store.touched("ledger", intents.select("intent_id"))}
    ledger = store.read("ledger", at["ledger"])
    fresh = intents.dropDuplicates(["intent_id"]).join(ledger.where("status = 'applied'").select("intent_id"), "intent_id", "left_anti")
    scratch = store.scratch()
    whole = scratch(by_kind(operations_of(fresh)))  # bodies are parsed once, and each table reads its own kind
    fresh = whole.select(*intents.columns)
    own = fresh.select("run_id").distinct()
    made, candidates, sources = (OPERATION_TABLES[k] for k in ("create_video_analysis", "replace_organization_candidates", "replace_organization_sources"))
    at[made] = at["runs"] = store.touched(made, own)
    analyses = store.read(made, at[made])
    ids = own.join(analyses.select("run_id", "analysis_id"), "run_id", "left").select(F.coalesce("analysis_id", analysis_id_of("run_id")).alias("analysis_id"))
    ids = scratch(ids)
    by_analysis = None
    for name in known:
        if TABLE_KEYS[name] == "analysis_id" and name not in APPENDED:
            by_analysis = store.touched(name, ids) if by_analysis is None else by_analysis
            at[name] = by_analysis
    ops = whole.drop(*[c for c in intents.columns if c != "intent_id"])
    if sources in known:
        none = F.lit(None).cast("string")
        named = payload_items(_of_kind(ops, "replace_organization_sources").withColumns({"analysis_id": none, "run_id": none}), "replace_organization_sources", store.read(sources, ())).select("organization_candidate_id")
        at[sources] = store.touched(sources, named)
        if candidates in known and len(at[sources]) < known[sources]["buckets"]:  # else all are touched already
            held = store.read(candidates, at[candidates]).join(ids, "analysis_id", "left_semi").select("organization_candidate_id")
            at[sources] = sorted({*at[sources], *store.touched(sources, held)})
    tables = {name: store.read(name, () if name in APPENDED else at[name]) for name in known}
    results = scratch(decide(tables, fresh).join(fresh.select("intent_id"), "intent_id", "left_semi"))
    if results.where("result = 'applied'").isEmpty():
        store.commit(number)
    else:
        adapts = store.spark.conf.get("spark.sql.adaptive.enabled") == "true"
        now = fresh.agg(F.max("applied_at")).first()[0]  # of the rows, not of the clock, so that a replay is the same
        after = apply_intents(tables, ops, results, F.lit(now).cast("timestamp"), scratch)
        store.commit(number, {n: (after[n], at[n]) for n in known if n not in APPENDED}, {n: after[n] for n in known if n in APPENDED}, gather=not adapts)  # steps that are read, and joins where plans adapt, have few tasks for their size
    store.drop_scratch()


#: Kinds whose event names the analysis and the number of rows.
_COUNTED = ("replace_technology_library_summaries", "replace_organization_candidates")


def intent_events(ops: DataFrame, results: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """(intent_id, operation_index, operation_kind, status, affected_table, affected_key) of every operation that applied.

    The key is the number of rows for organization sources, the run for search events, the analysis and the number of rows for
    families and organization candidates, and the analysis for all others. ops: (intent_id, run_id, operation_index, kind,
    analysis_id); counts: (intent_id, operation_index, n), where an absent one is 0.
    """
    rows = ops.join(results.where("result = 'applied'").select("intent_id"), "intent_id", "left_semi")
    rows = rows.join(counts.select("intent_id", "operation_index", "n"), ["intent_id", "operation_index"], "left") if counts is not None else rows.withColumn("n", F.lit(None).cast("long"))
    return _events_of(rows)


def _events_of(rows: DataFrame) -> DataFrame:
    """Events of applied operations with the number ``n`` of their rows."""
    tables = F.create_map(*[F.lit(x) for pair in OPERATION_TABLES.items() for x in pair])
    n = F.coalesce(F.col("n").cast("string"), F.lit("0"))
    key = (
        F.when(F.col("kind") == "replace_organization_sources", n).when(F.col("kind") == "record_web_search_events", F.col("run_id"))
        .when(F.col("kind").isin(*_COUNTED), F.concat("analysis_id", F.lit(":"), n)).otherwise(F.col("analysis_id"))
    )
    return rows.select("intent_id", "operation_index", F.col("kind").alias("operation_kind"), F.lit("applied").alias("status"), tables[F.col("kind")].alias("affected_table"), key.alias("affected_key"))


def build_receipts(intents: DataFrame, events: DataFrame, artifacts: DataFrame, ops: DataFrame | None = None) -> DataFrame:
    """(intent_id, body, content_sha256, byte_count): canonical receipts, operations in order.

    intents: (intent_id, run_id, video_id, intent_sha256, schema_version, packet_storage_prefix, status, applied_at,
    analysis_id); artifacts: (run_id) rows that count. An already applied intent without events takes its operations
    from ops (intent_id, operation_index, kind), each with the analysis as its key; another without events has none.
    """
    entry = ("affected_key", "affected_table", F.lit(None).cast("string").alias("error_detail"), F.col("operation_kind").alias("kind"), "operation_index", "status")
    listed = events.groupBy("intent_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("operation_index", F.struct(*entry).alias("entry")))), lambda x: x["entry"]).alias("operations"))
    n = artifacts.groupBy("run_id").agg(F.count("*").cast("int").alias("artifact_count"))
    rows = intents.join(n, "run_id", "left").join(listed, "intent_id", "left").na.fill(0, ["artifact_count"])
    if ops is not None:
        # Operations move as an index and a kind, those of intents that may take them only, and are told in full where they are listed.
        again = ops.select("intent_id", "operation_index", "kind").join(intents.where("status = 'already_applied'").select("intent_id"), "intent_id", "left_semi")
        again = again.groupBy("intent_id").agg(F.collect_list(F.struct("operation_index", "kind")).alias("_again"))
        tables = F.create_map(*[F.lit(x) for pair in OPERATION_TABLES.items() for x in pair])
        told = F.transform("_again", lambda x: F.struct(x["operation_index"].alias("operation_index"), F.struct(F.col("analysis_id").alias("affected_key"), tables[x["kind"]].alias("affected_table"), F.lit(None).cast("string").alias("error_detail"), x["kind"].alias("kind"), x["operation_index"].alias("operation_index"), F.lit("applied").alias("status")).alias("entry")))
        told = F.transform(F.sort_array(told), lambda x: x["entry"])
        rows = rows.join(again, "intent_id", "left").withColumn("operations", F.coalesce("operations", F.when(F.col("status") == "already_applied", told)))
    rows = rows.withColumn("operations", F.coalesce("operations", F.array().cast("array<struct<affected_key:string,affected_table:string,error_detail:string,kind:string,operation_index:int,status:string>>")))
    none = F.lit(None).cast("string")
    members = {
        "schema_version": F.lit(PACKET_VERSION), "packet_schema_version": F.when(F.col("schema_version") == V1_VERSION, V1_VERSION).otherwise(PACKET_VERSION), "packet_storage_prefix": F.col("packet_storage_prefix"),
        "finished_marker_written": F.lit(False), "artifact_count": F.col("artifact_count"), "intent_id": F.col("intent_id"), "run_id": F.col("run_id"), "video_id": F.col("video_id"), "intent_sha256": F.col("intent_sha256"),
        "status": F.col("status"), "applied_at": iso_datetime(F.col("applied_at")), "analysis_id": F.col("analysis_id"), "operations": F.col("operations"), "error_code": none, "error_detail": none,
    }
    receipt = F.struct(*[members[k].alias(k) for k in sorted(members)])  # members in key order are canonical as Spark writes them
    made = rows.select("intent_id", serialize_struct(receipt).alias("a"))
    return made.select("intent_id", F.col("a.content").alias("body"), F.col("a.sha256").alias("content_sha256"), F.col("a.byte_count").alias("byte_count"))


def finalize(receipts: DataFrame, registry: DataFrame, state: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(registry, state) after completion: a receipt is registered unless its run has one, and its video is finished.

    receipts: (intent_id, run_id, video_id, transcript_sha256, packet_storage_prefix, content_sha256). A run's registered
    receipt is kept, so that a second completion changes nothing.
    """
    path = artifact_storage_path(F.col("packet_storage_prefix"), F.lit("execution_receipt"))
    new = receipts.select("run_id", F.lit("execution_receipt").alias("artifact_kind"), path.alias("storage_path"), "content_sha256").dropDuplicates(["run_id"])
    held = registry.where("artifact_kind = 'execution_receipt'").select("run_id")
    after = registry.unionByName(new.join(held, "run_id", "left_anti"), allowMissingColumns=True)
    done = receipts.groupBy("video_id").agg(F.max_by(F.struct("transcript_sha256", "intent_id", "run_id"), "intent_id").alias("_d"))
    rows = state.join(done, "video_id", "full_outer")
    hit = F.col("_d").isNotNull()
    values = {
        "transcript_sha256": F.col("_d.transcript_sha256"), "finished_transcript_sha256": F.col("_d.transcript_sha256"), "finished_intent_id": F.col("_d.intent_id"), "latest_run_id": F.col("_d.run_id"),
        "pipeline_status": F.lit("finished"), "pre_research_pipeline_finished": F.lit(True),
    }
    if "pre_research_pipeline_finished_at" in state.columns:
        values["pre_research_pipeline_finished_at"] = F.coalesce("pre_research_pipeline_finished_at", now)
    return after, rows.select(*[F.when(hit, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in state.columns])
