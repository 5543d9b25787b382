"""File sources and sinks, and streams against their batch forms."""

import datetime
import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from packetmill.operators.apply import TABLE_KEYS
from packetmill.plans.derived import Tables
from packetmill.sources import packets, tables
from packetmill.sources.versions import Versions
from packetmill.streaming import apply_intents_stream, apply_stream, controller_outcomes_stream, ingest_packets_stream, outcomes_stream, search_counts_stream, search_ledger_stream, session_outcomes
from packetmill.streaming.jobs import SEARCH_SCHEMA

FOLDER = "/root/testdata/sf0.001"


def test_packets_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("pre-research/v2/v/r", "web_context", '{"b":1.0,"a":"é"}'), ("pre-research/v2/v/r", "initial_summary", "{}")], "packet_storage_prefix string, artifact_kind string, body string")
    written = packets.write_packets(rows, f"file://{tmp_path}/out")
    packets.write_packets(rows, f"file://{tmp_path}/out")
    back = packets.read_packets(spark, f"file://{tmp_path}/out")
    body = '{"a":"é","b":1}\n'
    assert {(r.video_id, r.run_id, r.artifact_kind, r.body) for r in back.collect()} == {("v", "r", "web_context", body), ("v", "r", "initial_summary", "{}\n")}
    one = back.where("artifact_kind = 'web_context'").first()
    assert one.content_sha256 == hashlib.sha256(body.encode()).hexdigest() and one.byte_count == len(body.encode()) and written.count() == 2
    listing = packets.read_storage_listing(spark, f"file://{tmp_path}/out", "b")
    assert {r.name for r in listing.collect()} == {"pre-research/v2/v/r/30-web-context.json", "pre-research/v2/v/r/initial-summary/60-initial-summary.json"}


def test_listing_from_table(spark):
    rows = spark.createDataFrame([("b", "x", '{"size":5}'), ("b", "folder", None)], "bucket_id string, name string, metadata string")
    assert [tuple(r) for r in packets.listing_from_table(rows).collect()] == [("b", "x", 5)]


def test_write_table_replaces_touched_buckets_only(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = spark.range(100).select("id", F.lit("old").alias("v"))
    tables.write_table(rows, path, ["id"], buckets=8)
    one = rows.where("id = 5").withColumn("v", F.lit("new"))
    bucket = tables.touched_buckets(one, ["id"], 8).first().bucket
    kept = spark.read.parquet(path).where(F.col("bucket") == bucket).where("id <> 5").drop("bucket")
    fresh = spark.createDataFrame(kept.unionByName(one).collect())
    tables.write_table(fresh, path, ["id"], buckets=8)
    after = spark.read.parquet(path)
    assert after.count() == 100 and after.where("v = 'new'").count() == 1


def test_read_table_has_the_declared_columns(spark, tmp_path):
    spark.range(1).select(F.lit("r").alias("run_id")).write.parquet(f"{tmp_path}/run.parquet")
    assert tables.read_table(spark, f"file://{tmp_path}", "run").first().status is None


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def shuffled_events(spark, path):
    """Session events in three files of rows in no order, and one far ahead that lets the watermark pass all of them."""
    failed = (F.col("seq") == 2) & (F.col("session_id").cast("long") % 3 == 0)
    events = Tables(spark, FOLDER).session_events.withColumn("at", F.timestamp_seconds(F.col("seq") * 60)).withColumn("type", F.when(failed, "session.failed").otherwise(F.col("type")))
    for k in range(3):
        events.where(F.pmod(F.xxhash64("session_id", "seq", F.lit(7)), F.lit(3)) == k).orderBy(F.rand(k)).coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame([("flush", 1, "message.started", None, datetime.datetime(2100, 1, 1))], events.schema).coalesce(1).write.mode("append").parquet(path)
    return spark.read.parquet(path).where("session_id <> 'flush'").drop("at"), spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_outcomes_stream_equals_batch_in_any_order(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    events, stream = shuffled_events(spark, f"{tmp_path}/events")
    query = outcomes_stream(stream, late="2 hours").writeStream.format("memory").queryName("outcomes").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination(300)
    expected = session_outcomes(events)
    assert expected.where("outcome = 'unknown'").count() and expected.where("outcome = 'failed'").count()
    assert sorted(map(str, spark.table("outcomes").collect())) == sorted(map(str, expected.collect()))


def test_controller_stream_equals_batch_in_any_order(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    events, stream = shuffled_events(spark, f"{tmp_path}/events")
    complete = events.select("session_id").distinct().withColumn("complete", F.col("session_id").cast("long") % 2 == 0)
    for _ in range(2):
        controller_outcomes_stream(stream, lambda _: complete, f"file://{tmp_path}/out", f"{tmp_path}/c", late="2 hours").awaitTermination(300)
    expected = session_outcomes(events, "controller", complete)
    assert {r.outcome for r in expected.collect()} == {"unknown", "completed", "failed"}
    assert sorted(map(str, Versions(spark, f"file://{tmp_path}/out").read("outcomes").collect())) == sorted(map(str, expected.collect()))


def test_controller_outcomes(spark):
    events = spark.createDataFrame([("a", 1, "message.completed", "hi"), ("a", 2, "session.failed", None), ("b", 1, "session.waiting", None), ("c", 1, "session.failed", None), ("c", 2, "session.completed", None)], "session_id string, seq long, type string, message string")
    done = spark.createDataFrame([("a", True), ("b", False)], "session_id string, complete boolean")
    got = {r.session_id: (r.outcome, r.message) for r in session_outcomes(events, "controller", done).collect()}
    assert got == {"a": ("completed", "hi"), "b": ("unknown", None), "c": ("failed", None)}


def test_ingest_reads_touched_buckets_and_registers_once(spark, tmp_path, monkeypatch):
    cols = "run_id string, artifact_kind string, storage_path string, content_sha256 string"
    source, folder = f"{tmp_path}/in", f"file://{tmp_path}/reg"
    write = lambda rows: spark.createDataFrame(rows, cols).coalesce(1).write.mode("append").parquet(source)
    start = lambda: ingest_packets_stream(spark.readStream.schema(cols).parquet(source), folder, f"{tmp_path}/c").awaitTermination(120)
    write([(f"r{k}", "web_context", "p", "h") for k in range(40)])
    start()
    write([("r1", "web_context", "p", "h"), ("r1", "initial_summary", "q", "i"), ("r1", "web_context", "p", "x"), ("r1", "web_context", "z", "h"), ("r1", "nonsense", "p", "h")])
    read, seen = Versions.read, []
    monkeypatch.setattr(Versions, "read", lambda self, name, buckets=None, number=None: (seen.append(read(self, name, buckets, number)), seen[-1])[1])
    start()
    assert len(seen) == 1 and all(f"/bucket={Versions(spark, folder).touched('registry', spark.sql('select "r1" as run_id'))[0]}/" in x for x in seen[0].inputFiles()) and seen[0].count() < 40
    for name in ("1", ".1.crc"):
        (tmp_path / "c" / "commits" / name).unlink(missing_ok=True)  # the last batch runs again
    start()
    store = Versions(spark, folder)
    assert store.read("registry").count() == 41 and store.numbers() == [0, 1]
    assert Counter(r.outcome for r in store.read("outcomes").collect()) == {"registered": 41, "identical": 1, "ARTIFACT_CONTENT_COLLISION": 1, "ARTIFACT_PATH_COLLISION": 1, "UNKNOWN_ARTIFACT_KIND": 1}


def test_search_ledger_takes_late_rows_apart(spark, tmp_path):
    at = lambda h, m=0: datetime.datetime(2024, 1, 1, h, m)
    files = [
        [("r", "s", "q", at(9)), ("r", "s", "q", at(9)), ("r", "s", None, at(9, 55)), ("r", "s", "q", at(10))],
        [("r", "s", "q", at(9, 55)), ("r", "s", None, at(9, 55)), ("r", "s", "q", at(9, 40)), ("r", "s", "q", at(11)), ("r", "s", "q", None), ("r", "s", "q", at(9, 50))],
        [("r", "s", "q", at(10)), ("r", "s", "q", at(10)), ("r", "s", "q", at(11)), ("t", "s", "q", at(11))],
    ]
    for rows in files:
        spark.createDataFrame(rows, SEARCH_SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        search_ledger_stream(spark.readStream.schema(SEARCH_SCHEMA).parquet(f"{tmp_path}/in"), f"file://{tmp_path}/out", f"{tmp_path}/c").awaitTermination(120)
    for name in ("2", ".2.crc"):
        (tmp_path / "c" / "commits" / name).unlink(missing_ok=True)
    search_ledger_stream(spark.readStream.schema(SEARCH_SCHEMA).parquet(f"{tmp_path}/in"), f"file://{tmp_path}/out", f"{tmp_path}/c").awaitTermination(120)
    store = Versions(spark, f"file://{tmp_path}/out")
    rows = lambda name: Counter((r.run_id, r.query, r.searched_at) for r in store.read(name).collect())
    assert rows("late") == Counter([("r", "q", at(9, 40)), ("r", "q", None), ("r", "q", at(10)), ("r", "q", at(10))])
    assert rows("ledger") == Counter([("r", "q", at(9)), ("r", None, at(9, 55)), ("r", "q", at(10)), ("r", "q", at(9, 55)), ("r", "q", at(11)), ("r", "q", at(9, 50)), ("t", "q", at(11))])


def test_versions_replace_append_and_retire(spark, tmp_path):
    folder = f"file://{tmp_path}/v"
    rows = spark.range(200).select("id", F.lit("old").alias("v"))
    store = Versions.create(spark, folder, {"t": rows, "log": rows.limit(0)}, {"t": "id", "log": "id"}, 8)
    assert Versions.create(spark, folder, {"t": rows.limit(0)}, {"t": "id"}).read("t").count() == 200
    (b,) = store.touched("t", spark.range(5, 6))
    new = store.read("t", [b]).withColumn("v", F.when(F.col("id") == 5, "new").otherwise(F.col("v")))
    store.commit(0, {"t": (new, [b])}, {"log": spark.range(3).select("id", F.lit("x").alias("v"))})
    assert store.read("t").count() == 200 and [r.id for r in store.read("t").where("v = 'new'").collect()] == [5] and store.read("t", number=-1).where("v = 'new'").isEmpty()
    size = new.count()
    before = {str(p) for p in (tmp_path / "v" / "data" / "t").glob("*/bucket=*")}
    assert len(before) == 9  # one bucket was written anew
    with pytest.raises(ValueError):
        store.commit(1, {"t": (rows, [b])})
    store.commit(1, {"t": (new.limit(0), [b])})
    assert store.read("t").count() == 200 - size and store.numbers() == [0, 1]
    assert not [p for p in (tmp_path / "v" / "data" / "t").glob(f"-1-*/bucket={b}")]  # only version -1 named it
    for n in range(2, 22):
        store.commit(n, append={"log": spark.range(1).select("id", F.lit(str(n)).alias("v"))})
    assert store.read("log").count() == 23 and max(map(len, store.manifest()["tables"]["log"]["parts"].values())) <= 16
    assert len(list((tmp_path / "v" / "versions").glob("*.json"))) == 2


def test_written_packets_are_what_comes_back(spark, tmp_path):
    """An input that differs each time it is computed gives hashes equal to the files."""
    rows = spark.range(20).select(F.concat(F.lit("pre-research/v2/v/r"), "id").alias("packet_storage_prefix"), F.lit("web_context").alias("artifact_kind"), F.concat(F.lit('{"x":'), F.rand(), F.lit("}")).alias("body"))
    written = packets.write_packets(rows, f"file://{tmp_path}/out")
    back = packets.read_packets(spark, f"file://{tmp_path}/out")
    assert {r.content_sha256 for r in written.collect()} == {r.content_sha256 for r in written.collect()} == {r.content_sha256 for r in back.collect()} and back.count() == 20


def test_packets_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    """Files of any depth but hidden ones, as Spark's own listing has them, which goes through the driver and passes over empty files."""
    root = f"file://{tmp_path}/out"
    rows = spark.range(300).select(F.concat(F.lit("pre-research/v2/v/r"), "id").alias("packet_storage_prefix"), F.lit("web_context").alias("artifact_kind"), F.lit("{}").alias("body"))
    packets.write_packets(rows, root)
    for name in ("_x/a.json", ".b.json", "c.json", "pre-research/v2/v/r/_d", "pre-research/_e=1/f.json", "g._COPYING_", "empty", "pre-research/v2/v/r1/initial-summary/60-initial-summary.json"):
        (tmp_path / "out" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "out" / name).write_text("" if "e" == name[:1] or "60" in name else "{}")
    both = lambda: (Counter(packets.read_storage_listing(spark, root, "b").collect()), Counter(packets.read_packets(spark, root).collect()))
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count("binaryFile")
    assert scans(packets.read_storage_listing(spark, root, "b")) == scans(packets.read_packets(spark, root)) == 0
    ours = both()
    monkeypatch.setattr(packets, "_opens", lambda root: False)
    theirs = both()
    assert [sorted(r.name if "name" in r else r for r in (a - b) + (b - a)) for a, b in zip(ours, theirs, strict=True)] == [["empty", "pre-research/v2/v/r1/initial-summary/60-initial-summary.json"], []]
    assert sum(ours[0].values()) == 304 and sum(ours[1].values()) == 300


def test_search_counts_and_apply_streams(spark, tmp_path):
    searches = Tables(spark, FOLDER).searches.select(F.col("searched_at").cast("timestamp").alias("searched_at"), "subagent")
    searches.write.parquet(f"{tmp_path}/s")
    stream = spark.readStream.schema(searches.schema).parquet(f"{tmp_path}/s")
    search_counts_stream(stream).writeStream.format("memory").queryName("counts").outputMode("complete").option("checkpointLocation", f"{tmp_path}/c1").trigger(availableNow=True).start().awaitTermination(120)
    assert spark.table("counts").agg(F.sum("searches")).first()[0] == searches.count()
    seen = []
    spark.createDataFrame([("i",), ("i",), ("j",)], "intent_id string").write.parquet(f"{tmp_path}/i")
    apply_stream(spark.readStream.schema("intent_id string").parquet(f"{tmp_path}/i"), lambda b, n: seen.extend(r.intent_id for r in b.collect()), f"{tmp_path}/c2").awaitTermination(120)
    assert sorted(seen) == ["i", "j"]


def test_apply_intents_stream_touches_few_buckets_and_replays(spark, tmp_path):
    """A stream of intents ends in the tables of one batch job; a replayed batch and a repeated intent change nothing."""
    from tests.test_operators import INTENT, intent_tables, rows_of

    folder = f"file://{tmp_path}/tables"
    tables_before = intent_tables(spark)
    more = spark.range(100).select(F.concat(F.lit("b"), "id").alias("analysis_id"), F.lit("other").alias("category_code"))
    tables_before["research_video_category"] = tables_before["research_video_category"].unionByName(more)
    Versions.create(spark, folder, tables_before, TABLE_KEYS, 16)
    schema = "intent_id string, run_id string, body string, applied_at timestamp"
    stamp = datetime.datetime(2024, 5, 1)
    decide = lambda tables, batch: batch.selectExpr("intent_id", "run_id", "if(intent_id = 'i3', 'refused', 'applied') as result")
    start = lambda: apply_intents_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), folder, decide, f"{tmp_path}/c").awaitTermination(300)
    folders = lambda name: {str(p) for p in (tmp_path / "tables" / "data" / name).glob("*/bucket=*")}
    for intents in (["i1", "i3"], ["i1", "i2"]):
        spark.createDataFrame([(i, "r" + i[1], INTENT % i, stamp) for i in intents], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        before = {n: folders(n) for n in tables_before}
        start()
        # one applied intent: one bucket a table, two where the refused or repeated one has another
        assert all(len(folders(n) - before[n]) <= (2 if n in ("ledger", "runs", "research_video_analysis", "research_video_category") else 1) for n in tables_before)
    store = Versions(spark, folder)
    last = {n: store.read(n) for n in tables_before}
    done = rows_of(last)
    assert {r.intent_id for r in last["ledger"].where("status = 'applied'").collect()} == {"i1", "i2"} and last["events"].count() == 6 and last["research_web_search_event"].count() == 2
    ids = {r.run_id: r.analysis_id for r in last["research_video_analysis"].collect()}
    assert {(r.analysis_id, r.category_code) for r in last["research_video_category"].where("category_code <> 'other'").collect()} == {(ids["r1"], "i1"), ("a2", "i2")} and last["research_video_category"].count() == 103
    for name in ("1", ".1.crc"):
        (tmp_path / "c" / "commits" / name).unlink(missing_ok=True)  # the last batch runs again
    start()
    assert rows_of({n: store.read(n) for n in done}) == done and store.numbers() == [0, 1]


def test_parts_of_a_stream_are_written_by_many_tasks_and_taken_in_turn(spark, tmp_path):
    from packetmill.plans.stream_queries import in_turn

    parts = [spark.range(start, start + 40, 1, 4) for start in (0, 40)]
    seen = []
    for stream in in_turn(parts, f"{tmp_path}/in"):
        take = lambda batch, number: seen.append((number, sorted(r.id for r in batch.collect()), len(batch.inputFiles())))
        stream.writeStream.foreachBatch(take).option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert [(n, ids) for n, ids, _ in seen] == [(0, list(range(40))), (1, list(range(40, 80)))] and len(list((tmp_path / "in").glob("*.parquet"))) == 8


def test_a_batch_parses_its_intents_once_and_leaves_no_steps(spark, tmp_path, monkeypatch):
    from packetmill.operators import apply
    from packetmill.plans.apply_queries import applied_tables

    t = Tables(spark, "/root/testdata/sf0.001")
    folder = f"file://{tmp_path}/tables"
    store = Versions.create(spark, folder, applied_tables(t), TABLE_KEYS, 4)
    parsed, payloads = [], apply.payload_items
    monkeypatch.setattr(apply, "payload_items", lambda ops, *rest: (parsed.append(ops), payloads(ops, *rest))[1])
    body = """'{"operations":[{"kind":"create_video_analysis","payload":{"difficulty":"expert"}},{"kind":"replace_lifecycle_assignments","payload":["design"]}]}'"""
    intents = t.sql(f"select 'i' || analysis_id as intent_id, run_id, {body} as body, cast('2024-01-01' as timestamp) as applied_at from {{analyses}} where cast(analysis_id as bigint) % 11 <> 0")
    apply.apply_batch(store, intents, 0, lambda tables, batch: batch.select("intent_id", "run_id", F.lit("applied").alias("result")))
    assert parsed and all("parse_json" not in df._jdf.queryExecution().optimizedPlan().toString() for df in parsed)
    assert not (tmp_path / "tables" / "scratch").exists() and store.read("ledger").where("status <> 'applied'").isEmpty()


def test_a_batch_joins_its_payloads_once(spark, tmp_path, monkeypatch):
    """Operations of all kinds, known, repeated or not, give the events of their rows; what is written takes no further join or exchange of theirs."""
    from packetmill.operators import apply
    from packetmill.operators.validate import explode_operations
    from tests.test_operators import INTENT, intent_tables

    odd = '{"operations":[{"kind":"record_web_search_events","payload":[{"query":"a"}]},{"kind":"nobody","payload":1.50},{"kind":"replace_organization_candidates","payload":[{"organization_candidate_id":"z"},{"organization_candidate_id":"y"}]},{"payload":[]},{"kind":"record_web_search_events"},{"kind":"record_web_search_events","payload":[{"query":"b"}]}]}'
    stamp = datetime.datetime(2024, 5, 1)
    rows = [("i1", "r1", INTENT % "i1", stamp), ("i2", "r2", odd, stamp), ("i3", "r3", None, stamp)]
    intents = spark.createDataFrame(rows, "intent_id string, run_id string, body string, applied_at timestamp")
    results = intents.select("intent_id", "run_id", F.lit("applied").alias("result"))
    before = intent_tables(spark)
    expected = apply.apply_intents(before, explode_operations(intents), results, F.lit(stamp).cast("timestamp"))
    store = Versions.create(spark, f"file://{tmp_path}/tables", before, TABLE_KEYS, 4)
    commit, plans = Versions.commit, {}

    def kept(self, number, replace=None, append=None, **rest):
        plans.update({name: df._jdf.queryExecution().optimizedPlan().toString() for name, df in (append or {}).items()})
        return commit(self, number, replace, append, **rest)

    monkeypatch.setattr(Versions, "commit", kept)
    apply.apply_batch(store, intents, 0, lambda tables, batch: results)
    assert plans and not any("Join" in plan or "Rebalance" in plan for plan in plans.values())
    for name in before:
        assert Counter(store.read(name).select(*before[name].columns).collect()) == Counter(expected[name].select(*before[name].columns).collect()), name
    assert store.read("events").where("intent_id = 'i2'").count() == 6
