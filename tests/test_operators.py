"""Operators on literal cases: boundaries, set rules, contracts, and applying twice."""

import json

import pytest
from pyspark.sql import functions as F

from packetmill import vocabulary as v
from packetmill.operators import apply as a
from packetmill.operators import qualify as q
from packetmill.operators import registry as r
from packetmill.operators import report as p
from packetmill.operators import state as s
from packetmill.operators import validate as x


@pytest.mark.parametrize(("reasons", "primary"), [
    (["transcript_status_not_stored", "transcript_text_empty"], "TRANSCRIPT_NOT_STORED"), (["transcript_object_missing"], "TRANSCRIPT_OBJECT_MISSING"), (["path_missing"], "TRANSCRIPT_OBJECT_MISSING"), (["bucket_invalid"], "TRANSCRIPT_OBJECT_MISSING"), (["duration_missing"], "DURATION_MISSING"),
    (["duration_non_positive"], "DURATION_INVALID"), (["duration_at_or_over_5400_seconds"], "VIDEO_TOO_LONG"), (["already_live"], "VIDEO_ALREADY_CLAIMED_OR_FINISHED"), (["already_finished_for_current_transcript"], "VIDEO_ALREADY_CLAIMED_OR_FINISHED"), ([], ""), (["something"], "VIDEO_INELIGIBLE"),
])
def test_primary_reason(spark, reasons, primary):
    rows = spark.createDataFrame([(reasons,)], "reasons array<string>")
    assert rows.select(q.primary_reason(F.col("reasons"))).first()[0] == primary


def test_durations(spark):
    rows = spark.createDataFrame([(5399.0,), (5400.0,), (5401.0,), (0.0,), (float("nan"),), (float("inf"),), (None,)], "s double")
    assert [y[0] for y in rows.select(q.duration_status(F.col("s"))).collect()] == [None, "VIDEO_TOO_LONG", "VIDEO_TOO_LONG", "DURATION_INVALID", "DURATION_INVALID", "DURATION_INVALID", "DURATION_MISSING"]


def test_blank(spark):
    rows = spark.createDataFrame([("  ",), (" \n ",), (None,), (" x ",)], "t string")
    assert [tuple(y) for y in rows.select(q.is_blank(F.col("t")), q.is_blank(F.col("t"), "unicode")).collect()] == [(True, True), (False, True), (True, True), (False, False)]


CATALOG = "video_id string, title string, published_at date, duration_seconds int, transcript_status string, transcript_bucket string, transcript_path string, transcript_text string"


def _catalog(spark, text="hello"):
    return spark.createDataFrame([("v", "t", None, 100, "stored", v.TRANSCRIPT_BUCKET, "p", text)], CATALOG)


def test_changed_transcript_opens_a_video_again(spark):
    objects = spark.createDataFrame([(v.TRANSCRIPT_BUCKET, "p")], "bucket_id string, name string")
    old = q.with_transcript_sha256(_catalog(spark)).first().transcript_sha256
    runs = spark.createDataFrame([("r", "v", old, "applied")], "run_id string, video_id string, transcript_sha256 string, status string")
    assert q.list_eligible_videos(_catalog(spark), objects, runs).count() == 0
    assert q.list_eligible_videos(_catalog(spark, "changed"), objects, runs).count() == 1
    assert q.list_eligible_videos(_catalog(spark), objects, runs, include_applied=True).count() == 1
    assert q.list_eligible_videos(_catalog(spark), objects, runs, include_applied=True, video_id="w").count() == 0


def test_claims_repeat_themselves(spark):
    objects = spark.createDataFrame([(v.TRANSCRIPT_BUCKET, "p")], "bucket_id string, name string")
    runs = spark.createDataFrame([], "run_id string, video_id string, transcript_sha256 string, status string")
    queue = q.list_eligible_videos(_catalog(spark), objects, runs)
    one, two = (q.claim_batch(queue, runs, 5, "2026-01-02 03:04:05") for _ in range(2))
    assert one.collect() == two.collect() and str(one.first().research_as_of) == "2026-01-02"
    assert q.claim_batch(queue, one, 5, "2026-01-02 03:04:06").count() == 0


CANDIDATE = "analysis_id string, position int, organization_candidate_id string, normalized_name string, is_primary_featured boolean, featured_rank int, primary_domain_code string, secondary_domain_codes array<string>, parent_name string, parent_canonical_url string, relationship_roles array<string>"


def _candidate(position=0, name="github", primary=True, rank=1, domain="coding_agents_developer_tools", secondary=("ai_developer_platform_sdk",)):
    return ("a", position, f"id-{name}", name, primary, rank, domain, list(secondary), None, None, [v.PRIMARY_ROLE])


@pytest.mark.parametrize(("rows", "messages"), [
    ([_candidate(primary=False, rank=2)], {x.ONE_PRIMARY, x.ONE_RANK}), ([_candidate(), _candidate(1, "microsoft", True, 2)], {x.ONE_PRIMARY}), ([_candidate(), _candidate(1, "microsoft", False, 2)], set()),
    ([_candidate(secondary=("cloud_ai_platform", "frontier_model_lab", "ai_developer_platform_sdk"))], {"github: at most two secondary organization domains are allowed"}), ([_candidate(secondary=("coding_agents_developer_tools",))], {"github: secondary domains must not repeat the primary domain"}),
    ([_candidate(), _candidate(1, "github", False, 2)], {"github: normalized_name is duplicated", "github: organization_candidate_id is duplicated"}), ([_candidate(rank=2), _candidate(1, "microsoft", False, 1)], {x.SAME_ROW}),
])
def test_organization_candidates(spark, rows, messages):
    assert {y.message for y in x.validate_organization_candidates(spark.createDataFrame(rows, CANDIDATE)).collect()} == messages


@pytest.mark.parametrize(("sources", "messages"), [
    ([("official_homepage", "first_party", True, "verified"), ("official_documentation", "first_party", True, "verified")], set()), ([("official_about", "first_party", True, "verified")], {x.NO_TECHNICAL}),
    ([("official_homepage", "first_party", True, "likely"), ("official_documentation", "first_party", False, "verified")], {x.NO_IDENTITY, x.NO_TECHNICAL}), ([("conference_primary_material", "reputable_secondary", True, "verified"), ("official_homepage", "reputable_secondary", True, "verified")], {x.NO_IDENTITY, x.NO_TECHNICAL}), ([], {x.NO_IDENTITY, x.NO_TECHNICAL}),
])
def test_source_minimum(spark, sources, messages):
    rows = spark.createDataFrame([("c", *y) for y in sources], "organization_candidate_id string, source_role string, authority_tier string, publicly_retrievable boolean, verification_status string")
    one = spark.createDataFrame([("c",)], "organization_candidate_id string")
    assert {y.message for y in x.validate_source_minimum(one, rows).collect()} == messages


UUID = "0b8f9d0e-7f0a-4c1e-9b1a-2f4d5c6e7a8b"


def _intent(operations, **changes):
    source = {"run_id": UUID, "video_id": "v", "transcript_sha256": "a" * 64, "model_id": v.MODEL_ID, "research_as_of": "2026-08-16"}
    return json.dumps({"schema_version": "2.0.0", "intent_id": UUID, "source": source, "idempotency_key": "b" * 64, "evidence_grades_used": ["said_in_transcript"], "operations": operations} | changes)


DOMAIN = {"kind": "replace_domain_assignments", "payload": [{"domain_code": "d", "confidence": 0.5, "rationale": "r"}]}
STAGES = {"kind": "replace_lifecycle_assignments", "payload": ["design"]}


@pytest.mark.parametrize(("operations", "order", "payload"), [
    ([DOMAIN, STAGES], [], []), ([STAGES, DOMAIN], [(1, "operation is out of order")], []), ([{"kind": "execute_sql", "payload": {}}], [(0, "unknown or forbidden operation kind")], []), ([DOMAIN, DOMAIN], [(1, "operation kind is repeated")], []),
    ([{"kind": "replace_lifecycle_assignments", "payload": ["later"]}], [], ["x breaks enum"]), ([{"kind": "replace_domain_assignments", "payload": [{"domain_code": "", "confidence": 1.5, "rationale": "r"}]}], [], ["confidence breaks unit", "domain_code breaks text"]),
    ([{"kind": "replace_domain_assignments", "payload": []}], [], ["replace_domain_assignments must have 1 to 6 items"]), ([{"kind": "replace_technology_library_summaries", "payload": {"families": []}}], [], []),
])
def test_operations(spark, operations, order, payload):
    intents = spark.createDataFrame([("i", _intent(operations))], "intent_id string, body string")
    ops = x.explode_operations(intents)
    assert [(y.operation_index, y.message) for y in x.validate_operation_order(ops).collect()] == order
    assert sorted(y.message for y in x.validate_payload(ops).collect()) == payload
    assert x.validate_envelope(intents).count() == 0


def test_envelope(spark):
    bad = _intent([], intent_id="x", evidence_grades_used=["guess"], idempotency_key="k")
    got = {y.message for y in x.validate_envelope(spark.createDataFrame([("i", bad)], "intent_id string, body string")).collect()}
    assert got == {"intent_id is not a uuid", "evidence_grades_used has an unknown grade", "idempotency_key is not a hash", "operations is empty"}


def test_receipts(spark):
    one = {"schema_version": "1.0.0", "intent_id": UUID, "run_id": UUID, "video_id": "v", "intent_sha256": "a" * 64, "status": "applied", "applied_at": None, "analysis_id": None, "operations": []}
    two = one | {"schema_version": "2.0.0", "packet_schema_version": "2.0.0", "packet_storage_prefix": "p", "finished_marker_written": True, "artifact_count": 11}
    rows = [("1", json.dumps(one)), ("2", json.dumps(two)), ("3", json.dumps(one | {"schema_version": "2.0.0"})), ("4", json.dumps(one | {"schema_version": "9"})), ("5", "{")]
    got = {}
    for y in x.validate_receipts(spark.createDataFrame(rows, "intent_id string, body string")).collect():
        got.setdefault(y.intent_id, set()).add(y.message)
    assert got == {"3": {"packet_schema_version breaks text", "packet_storage_prefix breaks text", "finished_marker_written breaks bool", "artifact_count breaks int"}, "4": {"unsupported"}, "5": {"invalid_json"}}


def test_research_artifacts(spark):
    good = {"schema_version": "2.0.0", "run_id": UUID, "video_id": "v", "transcript_sha256": "a" * 64, "research_as_of": "2026-08-16", "searches": [], "resources": [], "entities": [], "verified_results": []}
    rows = spark.createDataFrame([("r", "web_context", json.dumps(good)), ("s", "web_context", json.dumps(good | {"research_as_of": "x", "entities": None}))], "run_id string, artifact_kind string, body string")
    assert {(y.run_id, y.message) for y in x.validate_research_artifacts(rows).collect()} == {("s", "research_as_of breaks date"), ("s", "entities breaks list")}


def test_intent_matches_files(spark):
    rows = [("a", "s", "s", 1, 1, ["c"], ["c"], ["x"], ["x"]), ("b", "s", "t", 1, 2, ["c"], [], ["x"], None), ("c", "s", None, 1, None, ["c"], None, ["x"], ["y"])]
    frame = spark.createDataFrame(rows, "run_id string, summary string, intent_summary string, n_families int, intent_families int, candidate_ids array<string>, intent_candidate_ids array<string>, source_ids array<string>, intent_source_ids array<string>")
    got = sorted((y.run_id, y.message.split(" must ")[0].split(" is ")[0]) for y in x.validate_intent_matches_files(frame).collect())
    assert got == [("b", "create_contextualized_initial_summary"), ("b", "organization_profile candidate"), ("b", "replace_technology_library_summaries"), ("c", "organization_profile source")]


def test_missing_evidence_applied(spark):
    ops = spark.createDataFrame([("i", "upsert_resource_candidates", '[{"evidence_ids":["e1","e2"]}]'), ("i", "replace_evidence_anchors", '[{"evidence_id":"e9"}]')], "intent_id string, kind string, payload string")
    anchors = spark.createDataFrame([("a", "e1")], "analysis_id string, evidence_id string")
    assert [tuple(y) for y in x.missing_evidence_applied(ops, anchors, spark.createDataFrame([("i", "a")], "intent_id string, analysis_id string")).collect()] == [("a", "e2")]


def test_registration_within_a_batch(spark):
    cols = "run_id string, artifact_kind string, storage_path string, content_sha256 string"
    incoming = spark.createDataFrame([("r", "web_context", "p", "h"), ("r", "web_context", "p", "h"), ("r", "web_context", "p", "i"), ("r", "nothing", "p", "h")], cols)
    got = sorted((y.artifact_kind, y.content_sha256, y.outcome) for y in r.register_artifacts(spark.createDataFrame([], cols), incoming).collect())
    assert got == [("nothing", "h", "UNKNOWN_ARTIFACT_KIND"), ("web_context", "h", "identical"), ("web_context", "h", "registered"), ("web_context", "i", "ARTIFACT_CONTENT_COLLISION")]
    after = r.registry_after(spark.createDataFrame([], cols), incoming)
    assert r.registry_after(after, incoming).count() == after.count() == 1


def test_applying_twice_changes_nothing(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "analysis_id string, n int")
    rows = spark.createDataFrame([("a", 7), ("a", 8)], "analysis_id string, n int")
    once = a.replace_rows(target, rows, ["analysis_id"])
    assert sorted(once.collect()) == sorted(a.replace_rows(once, rows, ["analysis_id"]).collect()) == [("a", 7), ("a", 8), ("b", 2)]
    emptied = a.replace_rows(target, rows.limit(0), ["analysis_id"], touched=rows)
    assert emptied.collect() == [("b", 2)]
    ups = spark.createDataFrame([("a", 5, 1), ("a", 6, 2), ("c", 9, 1)], "analysis_id string, n int, position int")
    twice = a.upsert_rows(a.upsert_rows(target, ups, ["analysis_id"], ["position"]), ups, ["analysis_id"], ["position"])
    assert sorted(twice.collect()) == [("a", 6), ("b", 2), ("c", 9)]


def test_finalizing_twice_keeps_the_receipt(spark):
    receipts = spark.createDataFrame([("i", "r", "v", "s", "p", "c1")], "intent_id string, run_id string, video_id string, transcript_sha256 string, packet_storage_prefix string, content_sha256 string")
    registry = spark.createDataFrame([], "run_id string, artifact_kind string, storage_path string, content_sha256 string")
    state = spark.createDataFrame([], "video_id string, transcript_sha256 string, pipeline_status string, pre_research_pipeline_finished boolean, finished_transcript_sha256 string, finished_intent_id string, latest_run_id string")
    now = F.lit("2026-01-01").cast("timestamp")
    reg, sta = a.finalize(receipts, registry, state, now)
    reg2, sta2 = a.finalize(receipts.withColumn("content_sha256", F.lit("c2")), reg, sta, now)
    assert reg.collect() == reg2.collect() and sta.collect() == sta2.collect() and sta.first().pipeline_status == "finished"


def test_empty_inputs(spark):
    none = spark.createDataFrame([], CATALOG)
    objects = spark.createDataFrame([], "bucket_id string, name string")
    runs = spark.createDataFrame([], "run_id string, video_id string, transcript_sha256 string, status string, created_at timestamp")
    assert q.list_eligible_videos(none, objects, runs).count() == q.ineligibility_reasons(none, objects, runs).count() == s.latest_live_run(runs).count() == 0


# --- whole intents


def intent_tables(spark):
    from packetmill import vocabulary as v

    names = v.OPERATION_TABLES
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    return {
        names["create_video_analysis"]: make([("r2", "a2", "old")], "run_id string, analysis_id string, difficulty string"),
        names["replace_category_assignments"]: make([("a2", "old"), ("a9", "other")], "analysis_id string, category_code string"),
        names["record_web_search_events"]: make([], "run_id string, subagent string, query string"),
        "ledger": make([("i1", "r1", "validated", None, "p1", "h1"), ("i2", "r2", "validated", None, "p2", "h2"), ("i3", "r3", "validated", None, "p3", "h3")], "intent_id string, run_id string, status string, applied_at timestamp, storage_path string, content_sha256 string"),
        "runs": make([(r, "intent_ready", None, None, None) for r in ("r1", "r2", "r3")], "run_id string, status string, completed_at timestamp, intent_path string, intent_sha256 string"),
        "events": make([], "intent_id string, operation_index int, operation_kind string, status string, affected_table string, affected_key string"),
    }


INTENT = '{"operations":[{"kind":"create_video_analysis","payload":{"difficulty":"expert"}},{"kind":"replace_category_assignments","payload":[{"category_code":"%s"}]},{"kind":"record_web_search_events","payload":[{"subagent":"source_verifier","query":"q"}]}]}'


def rows_of(tables):
    return {name: sorted(map(str, t.collect())) for name, t in tables.items()}


def test_apply_intents_whole_or_not_at_all_and_once(spark):
    from packetmill.operators import apply as a
    from packetmill.operators.validate import explode_operations

    tables = intent_tables(spark)
    intents = spark.createDataFrame([("i1", INTENT % "x"), ("i2", INTENT % "y"), ("i3", INTENT % "z")], "intent_id string, body string")
    ops = explode_operations(intents)
    results = spark.createDataFrame([("i1", "r1", "applied"), ("i2", "r2", "applied"), ("i3", "r3", "refused")], "intent_id string, run_id string, result string")
    now = F.lit("2024-05-01").cast("timestamp")
    after = a.apply_intents(tables, ops, results, now)
    ids = {r.run_id: r.analysis_id for r in after["research_video_analysis"].collect()}
    assert set(ids) == {"r1", "r2"} and ids["r2"] == "a2"
    assert {(r.analysis_id, r.category_code) for r in after["research_video_category"].collect()} == {(ids["r1"], "x"), ("a2", "y"), ("a9", "other")}
    assert {(r.intent_id, r.status, r.applied_at is None) for r in after["ledger"].collect()} == {("i1", "applied", False), ("i2", "applied", False), ("i3", "validated", True)}
    assert {(r.run_id, r.status, r.intent_path, r.intent_sha256) for r in after["runs"].collect()} == {("r1", "applied", "p1", "h1"), ("r2", "applied", "p2", "h2"), ("r3", "intent_ready", None, None)}
    assert {(r.intent_id, r.operation_index, r.affected_key) for r in after["events"].collect()} == {("i1", 0, ids["r1"]), ("i1", 1, ids["r1"]), ("i1", 2, "r1"), ("i2", 0, "a2"), ("i2", 1, "a2"), ("i2", 2, "r2")}
    again = a.apply_intents(after, ops, results.withColumn("result", F.when(F.col("result") == "applied", "already_applied").otherwise(F.col("result"))), now)
    assert rows_of(again) == rows_of(after)


def test_replaced_targets_are_not_sorted(spark):
    make = spark.createDataFrame
    target = make([("a", "old"), ("b", "old"), (None, "old"), ("a", "older")], "analysis_id string, category_code string")
    rows = make([("a", "new"), ("a", "newer"), ("c", "new")], "analysis_id string, category_code string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = a.replace_category_assignments(rows, target)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert {tuple(r) for r in out.collect()} == {("b", "old"), (None, "old"), ("a", "new"), ("a", "newer"), ("c", "new")}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" in plan and "Sort " not in plan


def test_receipts_list_operations_where_there_are_no_events(spark):
    make = spark.createDataFrame
    ids = [("i1", "applied"), ("i2", "already_applied"), ("i3", "already_applied"), ("i4", "applied")]
    intents = make([(i, "r" + i, "v", "h", "2.0.0", "p", s, None, "a" + i) for i, s in ids], "intent_id string, run_id string, video_id string, intent_sha256 string, schema_version string, packet_storage_prefix string, status string, applied_at timestamp, analysis_id string")
    events = make([(i, 0, "create_video_analysis", "applied", "t", "key") for i in ("i1", "i3")], "intent_id string, operation_index int, operation_kind string, status string, affected_table string, affected_key string")
    ops = make([(i, n, k) for i, _ in ids for n, k in ((1, "record_web_search_events"), (0, "create_video_analysis"), (1, "other"))], "intent_id string, operation_index int, kind string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = a.build_receipts(intents, events, make([("ri1",)], "run_id string"), ops)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {r.intent_id: [(o["operation_index"], o["kind"], o["affected_key"], o["affected_table"]) for o in json.loads(r.body)["operations"]] for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    known = [(0, "create_video_analysis", "key", "t")]
    assert got == {"i1": known, "i3": known, "i4": [], "i2": [(0, "create_video_analysis", "ai2", "research_video_analysis"), (1, "other", "ai2", None), (1, "record_web_search_events", "ai2", "research_web_search_event")]}
    assert plan.count("Exchange") == 6 and "Union" not in plan  # listed operations stay where the join left them


def test_refusal_reasons_of_versions_and_their_order(spark):
    from packetmill.operators import validate as x

    runs = spark.createDataFrame([("r1", "review_required", "1.0.0"), ("r2", "review_required", "2.0.0")], "run_id string, status string, schema_version string")
    profiles = spark.createDataFrame([(r, True, 1, "other_unknown") for r in ("r1", "r2")], "run_id string, review_required boolean, n_conflicts int, profile_domain string")
    none = lambda schema: spark.createDataFrame([], schema)
    candidates = none("run_id string, organization_candidate_id string, normalized_name string, is_primary_featured boolean, featured_rank int, primary_domain_code string, secondary_domain_codes array<string>, parent_name string, parent_canonical_url string, relationship_roles array<string>, position int")
    sources = none("run_id string, organization_candidate_id string, source_role string, publicly_retrievable boolean, verification_status string, authority_tier string")
    got = [(r.run_id, r.reason) for r in x.review_refusal_reasons(runs, profiles, candidates, sources).orderBy("run_id", "place", "reason").collect()]
    first = ["run status is review_required", "organization profile review_required", "unresolved organization hierarchy conflicts"]
    assert got == [("r1", m) for m in first] + [("r2", m) for m in [*first, "organization profile primary_domain_code is other_unknown"]]


def test_refusal_reasons_move_qualifying_sources_only(spark):
    from packetmill.operators import validate as x

    make = spark.createDataFrame
    runs = make([("a", "ready"), ("b", "ready"), ("c", "ready")], "analysis_id string, status string")
    profiles = make([], "analysis_id string, review_required boolean, n_conflicts int, profile_domain string")
    candidates = make([("a", *_candidate()[1:]), ("b", *_candidate()[1:]), ("c", *_candidate(domain="other_unknown")[1:]), ("gone", *_candidate()[1:])], CANDIDATE)
    sources = make(
        [("a", "id-github", r, "first_party", True, s) for r in ("official_homepage", "official_documentation") for s in ("verified", "likely")] + [("b", "id-github", "official_homepage", "first_party", True, "verified"), ("b", "id-github", "official_documentation", "first_party", False, "verified")],
        "analysis_id string, organization_candidate_id string, source_role string, authority_tier string, publicly_retrievable boolean, verification_status string",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = x.review_refusal_reasons(runs, profiles, candidates, sources, "analysis_id")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert {(r.analysis_id, r.reason) for r in out.collect()} == {("b", x.NO_TECHNICAL), ("c", "primary organization domain is other_unknown")}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") <= 13 and plan.count("LeftSemi") == 4  # sources are not joined with the runs


def test_version_one_has_an_order_and_bounds_of_its_own(spark):
    from packetmill.operators import validate as x

    search = '{"subagent":"%s","query":"q","provider":"exa","searched_at":"2024-01-01T00:00:00Z","result_urls":[],"selected_urls":[],"search_purpose":"p"}'
    ops = spark.createDataFrame(
        [(i, 0, "upsert_entity_candidates", "[]") for i in ("v1", "v2")] + [(i, 1, "replace_evidence_anchors", "[]") for i in ("v1", "v2")] + [(i, 2, "record_web_search_events", "[" + ",".join([search % "organization_researcher"] * 21) + "]") for i in ("v1", "v2")] + [("v1", 3, "replace_organization_sources", "[]")],
        "intent_id string, operation_index int, kind string, payload string",
    )
    versions = spark.createDataFrame([("v1", "1.0.0"), ("v2", "2.0.0")], "intent_id string, schema_version string")
    order = {(r.intent_id, r.operation_index, r.message) for r in x.validate_operation_order(ops, versions=versions).collect()}
    assert order == {("v2", 1, "operation is out of order"), ("v1", 3, "unknown or forbidden operation kind")}
    found = {(r.intent_id, r.message) for r in x.validate_payload(ops.where("operation_index = 2"), versions=versions).collect()}
    assert found == {("v1", "record_web_search_events must have 0 to 20 items in version 1"), ("v1", "subagent breaks enum")}


def test_dates_are_days_of_the_calendar(spark):
    from packetmill.operators import validate as x

    days = ["2024-02-29", "2023-02-29", "2024-02-31", "2024-04-31", "2024-12-31"]
    ops = spark.createDataFrame([(d, 0, "record_web_search_events", '[{"subagent":"source_verifier","query":"q","provider":"exa","searched_at":"%sT10:00:00Z","result_urls":[],"selected_urls":[],"search_purpose":"p"}]' % d) for d in days], "intent_id string, operation_index int, kind string, payload string")
    assert {r.intent_id for r in x.validate_payload(ops).collect()} == {"2023-02-29", "2024-02-31", "2024-04-31"}


def test_one_slash_at_the_end_of_a_path(spark):
    from packetmill.operators import registry as r

    artifacts = spark.createDataFrame([("r", "web_context", "b", p, "h") for p in ("p/30-web-context.json", "p/30-web-context.json/", "p/30-web-context.json//", " p/30-web-context.json")], "run_id string, artifact_kind string, storage_bucket string, storage_path string, content_sha256 string")
    stored = spark.createDataFrame([("b", "p/30-web-context.json", "h")], "bucket_id string, name string, content_sha256 string")
    runs = spark.createDataFrame([("r", "p/")], "run_id string, packet_storage_prefix string")
    assert sorted(str(x.code) for x in r.verify_artifacts(artifacts, stored, runs).collect()) == ["ARTIFACT_MISSING", "ARTIFACT_PATH_MISMATCH", "ARTIFACT_PATH_MISMATCH", "None"]


def test_report_children_share_one_exchange(spark):
    """However many lists a report has, their rows move once; an owner without rows has empty lists."""
    import re

    from packetmill.operators import report as p

    runs = spark.createDataFrame([("r1", "v1", 1), ("r2", "v1", 2), ("r3", "v2", 1)], "run_id string, video_id string, created_at long")
    state = spark.createDataFrame([("v1", "finished", None)], "video_id string, pipeline_status string, latest_run_id string")
    catalog = spark.createDataFrame([("v1", "t"), ("v2", "u"), ("v3", "w")], "video_id string, title string")
    make = spark.createDataFrame
    children = {
        "analysis": p.Child(make([("r2", "a2", "long  text", None)], "run_id string, analysis_id string, initial_summary string, why_it_matters string"), "run", (), ("analysis_id", "initial_summary", "why_it_matters")),
        "intent": p.Child(make([("r2", "i2", "applied")], "run_id string, intent_id string, status string"), "run", (), ("intent_id", "status")),
        "events": p.Child(make([("i2", 1, "b"), ("i2", 0, "a"), ("i9", 0, "x"), (None, 0, "y")], "intent_id string, operation_index int, status string"), "intent", (F.col("operation_index"),), ("status",)),
        "organizations": p.Child(p.organizations_with_sources(make([("a2", "c1", "n1", 2, ["x"]), ("a2", "c2", "n2", 1, None)], "analysis_id string, organization_candidate_id string, normalized_name string, featured_rank int, relationship_roles array<string>"), make([("c1", 2, "r", "u2"), ("c1", 1, "r", "u1")], "organization_candidate_id string, source_rank int, source_role string, normalized_url string")), "analysis", (F.col("featured_rank"),), ("normalized_name", "relationship_roles", "sources")),
        "summary": p.Child(make([], "analysis_id string, transcript_summary string"), "analysis", (), ("transcript_summary",)),
    }
    out = p.full_reports(catalog, state, runs, children)
    got = {y.video_id: y for y in out.collect()}
    assert got["v1"].run_id == "r2" and got["v1"].n_runs == 2 and [y.status for y in got["v1"].events] == ["a", "b"] and got["v3"].n_runs == 0 and got["v3"].events == [] and got["v2"].run_id == "r3" and got["v2"].organizations == []
    assert [(y.normalized_name, [z.normalized_url for z in y.sources]) for y in got["v1"].organizations] == [("n2", []), ("n1", ["u1", "u2"])]
    plan = p.gather(children)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(owner", plan)) == 1
    made = {y.video_id: y for y in p.produced_lists(out).collect()}
    assert made["v1"].summaries.transcript_only == "long text" and [y.name for y in made["v1"].companies] == ["n2", "n1"] and made["v1"].entities == []
    assert p.full_reports(catalog, state, runs, children, run_id="r1").where("video_id = 'v1'").first().events == []


def test_candidate_rules_take_one_exchange_and_no_window(spark):
    rows = spark.createDataFrame([_candidate(), _candidate(2, "github", False, 1), _candidate(1, "github", False, 3)], CANDIDATE)
    out = x.validate_organization_candidates(rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan
    got = sorted(y.message for y in out.collect())
    assert got.count("github: normalized_name is duplicated") == 2 and got.count("github: featured_rank 1 is duplicated") == 1 and x.ONE_RANK in got


def test_reports_gather_only_rows_of_chosen_runs(spark, monkeypatch):
    make = spark.createDataFrame
    seen, gathered = {}, p.gather
    monkeypatch.setattr(p, "gather", lambda children: (seen.update({n: c.rows.collect() for n, c in children.items()}), gathered(children))[1])
    runs = make([("v1", "r1", 1), ("v1", "r2", 2)], "video_id string, run_id string, created_at int")
    children = {
        "analysis": p.Child(make([("r1", "a1"), ("r2", "a2")], "run_id string, analysis_id string"), "run", (), ("analysis_id",)),
        "organizations": p.Child(make([("a1", "c1"), ("a2", "c2"), ("a2", "c3"), (None, "c4")], "analysis_id string, organization_candidate_id string"), "analysis", (), ("organization_candidate_id", "sources"), make([("c1", 1, "r", "u"), ("c2", 2, "r", "u"), ("c2", 1, "r", "w")], "organization_candidate_id string, source_rank int, source_role string, normalized_url string")),
    }
    out = p.full_reports(make([("v1", "t"), ("v2", "u")], "video_id string, title string"), make([("v1", None, "x")], "video_id string, latest_run_id string, pipeline_status string"), runs, children)
    rows = {r.video_id: r for r in out.collect()}
    assert [(o.organization_candidate_id, [s.source_rank for s in o.sources]) for o in rows["v1"].organizations] == [("c2", [1, 2]), ("c3", [])] and rows["v2"].organizations == []
    assert len(seen["analysis"]) == 1 and {r.organization_candidate_id for r in seen["organizations"]} == {"c2", "c3"}


def test_produced_cuts_texts_before_the_join(spark):
    analyses = spark.createDataFrame([("a", "x " * 400, "s", "  "), ("b", None, "", "abstract"), ("c", "i", "j", "k")], "analysis_id string, initial_summary string, structured_summary string, contextualized_abstract string")
    summaries = spark.createDataFrame([("a", ""), ("b", None), ("c", "said  so")], "analysis_id string, transcript_summary string")
    out = p.produced(analyses, summaries)
    assert [(len(r.transcript_only or ""), r.structured, r.contextualized) for r in out.orderBy("analysis_id").collect()] == [(320, "s", None), (0, None, "abstract"), (1, "j", "said so")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan[: plan.index("Join")]
