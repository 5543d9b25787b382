"""Queries over what streams and writers left behind: each writes below the shared folder, and reads back what was published.

Streams take what is written part by part, so that later batches meet what earlier ones published.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocabulary as v
from ..operators.apply import TABLE_KEYS
from ..sources.packets import read_packets, read_storage_listing, write_packets
from ..sources.tables import SCHEMAS, read_table, shared_folder
from ..sources.versions import Versions
from ..streaming import apply_intents_stream, ingest_packets_stream, search_ledger_stream
from .apply_queries import _AFTER, _JSON, _WHOLE, applied_tables
from .derived import Tables
from .registered import query

BUCKETS = 8


def in_turn(parts: list[DataFrame], folder: str) -> Iterator[DataFrame]:
    """A stream for each part, over all that is written so far: run to its end under one checkpoint, it takes that part as one batch.

    Parts are written by as many tasks as they have, in place of one file a part.
    """
    for part in parts:
        part.write.mode("append").parquet(folder)
        yield part.sparkSession.readStream.schema(part.schema).parquet(folder)


def streamed_intents(t: Tables) -> Versions:
    """The tables of ``applied_tables`` after a stream of the same intents in two batches, some of the first again in the second."""
    folder = shared_folder(t.spark, "applied")
    store = Versions.create(t.spark, f"{folder}/tables", applied_tables(t), TABLE_KEYS, BUCKETS, gather=False)  # rows as they are read: few tasks for their size
    told = ", ".join(f"array_repeat('{{\"kind\":\"{kind}\",\"payload\":' || {payload} || '}}', int(c))" for kind, payload in _JSON.items())
    bodies = t.sql(f"""select intent_id, run_id, n, '{{"operations":[' || array_join(flatten(array({told})), ',') || ']}}' as body from (select intent_id, run_id, n, count(*) as c from ({_WHOLE}) group by intent_id, run_id, n)""")
    rows = bodies.withColumn("applied_at", F.lit("2024-01-01").cast("timestamp"))
    pick = lambda where: rows.where(where).drop("n")
    results = t.sql(f"select intent_id, run_id, result from ({_WHOLE})")
    for stream in in_turn([pick("n % 2 = 0"), pick("n % 2 = 1 or n % 10 = 4")], f"{folder}/in"):
        apply_intents_stream(stream, store.folder, lambda tables, batch: results, f"{folder}/checkpoint").awaitTermination()
    return store


@query("stream_apply_organizations", f"select aid as analysis_id, case when now then 'c' || n else 'o' || analysis_id end as organization_candidate_id, case when now then 1 else 9 end as source_rank from ({_AFTER}) where was or now")
def stream_apply_organizations(t: Tables) -> DataFrame:
    store = streamed_intents(t)
    candidates, sources = (store.read(v.OPERATION_TABLES[k]) for k in ("replace_organization_candidates", "replace_organization_sources"))
    return candidates.join(sources, "organization_candidate_id", "full").select("analysis_id", "organization_candidate_id", "source_rank")


@query("stream_apply_counts", f"""
select 'ledger' as table_name, count(*) as n, count(*) filter (now or result = 'already_applied') as done from ({_AFTER})
union all select 'runs', count(*), count(*) filter (now) from ({_AFTER})
union all select 'events', 1 + 6 * count(*) filter (now), 1 + 6 * count(*) filter (now) from ({_AFTER})
union all select 'searches', count(*) filter (was) + 2 * count(*) filter (now), 2 * count(*) filter (now) from ({_AFTER})
union all select 'categories', count(*) filter (was and not now) + 2 * count(*) filter (now), 2 * count(*) filter (now) from ({_AFTER})""")
def stream_apply_counts(t: Tables) -> DataFrame:
    store = streamed_intents(t)
    parts = [("ledger", "ledger", "status = 'applied'"), ("runs", "runs", "status = 'applied' and completed_at is not null"), ("events", "events", "status = 'applied'"), ("searches", v.OPERATION_TABLES["record_web_search_events"], "query <> 'before'"), ("categories", v.OPERATION_TABLES["replace_category_assignments"], "category_code <> 'old'")]
    counted = [store.read(table).agg(F.lit(name).alias("table_name"), F.count("*").alias("n"), F.count_if(F.expr(done)).alias("done")) for name, table, done in parts]
    out = counted[0]
    for part in counted[1:]:
        out = out.unionByName(part)
    return out


_NUMBERED = "(select a.run_id, a.artifact_kind, a.storage_path, a.content_sha256, k.kind_no, cast(substr(a.run_id, 2) as bigint) as doc_id from {artifacts} a join {kinds} k on a.artifact_kind = k.artifact_kind)"
_FIRST = f"select run_id, artifact_kind, storage_path, content_sha256 from {_NUMBERED} where doc_id % 2 = 0"
_SECOND = "select run_id, artifact_kind, case when doc_id % 4 = 0 and kind_no % 3 = 2 then 'moved' else storage_path end as storage_path, case when kind_no % 3 = 1 then SHA[['another']] else content_sha256 end as content_sha256 from " + f"{_NUMBERED} where doc_id % 3 = 0"
_OUTCOMES = """
select run_id, artifact_kind, storage_path, content_sha256, 'registered' as outcome from ({first}) union all
select s.run_id, s.artifact_kind, s.storage_path, s.content_sha256, case when f.run_id is null then 'registered' when f.content_sha256 <> s.content_sha256 then 'ARTIFACT_CONTENT_COLLISION' when f.storage_path <> s.storage_path then 'ARTIFACT_PATH_COLLISION' else 'identical' end
from ({second}) s left join ({first}) f on f.run_id = s.run_id and f.artifact_kind = s.artifact_kind""".replace("{first}", _FIRST).replace("{second}", _SECOND)


def streamed_packets(t: Tables) -> Versions:
    folder = shared_folder(t.spark, "registry")
    for stream in in_turn([t.sql(_FIRST), t.sql(_SECOND)], f"{folder}/in"):
        ingest_packets_stream(stream, f"{folder}/tables", f"{folder}/checkpoint", BUCKETS).awaitTermination()
    return Versions(t.spark, f"{folder}/tables")


@query("stream_registry", f"select run_id, artifact_kind, storage_path, content_sha256 from ({_OUTCOMES}) where outcome = 'registered'")
def stream_registry(t: Tables) -> DataFrame:
    return streamed_packets(t).read("registry")


@query("stream_registry_outcomes", _OUTCOMES)
def stream_registry_outcomes(t: Tables) -> DataFrame:
    return streamed_packets(t).read("outcomes")


_SEARCHES = "select run_id, subagent, 'q' || cast(n_results as string) as query, searched_at from {searches}"
_HALF = "(select max(searched_at) from {searches} where n_results < 5)"


def streamed_searches(t: Tables) -> Versions:
    folder = shared_folder(t.spark, "searches")
    part = lambda where: t.sql(f"select run_id, subagent, 'q' || cast(n_results as string) as query, cast(searched_at as timestamp) as searched_at from {{searches}} where {where}")
    for stream in in_turn([part("n_results < 5"), part("n_results >= 4")], f"{folder}/in"):
        search_ledger_stream(stream, f"{folder}/tables", f"{folder}/checkpoint", 864_000, BUCKETS).awaitTermination()
    return Versions(t.spark, f"{folder}/tables")


@query("stream_search_ledger", f"select distinct run_id, subagent, query, strftime(searched_at, '%Y-%m-%d %H:%M:%S.%f') as searched_at from ({_SEARCHES} where n_results < 5 union all {_SEARCHES} where n_results >= 4 and searched_at >= {_HALF} - interval '10' day)")
def stream_search_ledger(t: Tables) -> DataFrame:
    return streamed_searches(t).read("ledger").select("run_id", "subagent", "query", F.date_format("searched_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("searched_at"))


@query("stream_search_late", f"select subagent, query, count(*) as n from ({_SEARCHES} where n_results >= 4 and searched_at < {_HALF} - interval '10' day) group by 1, 2")
def stream_search_late(t: Tables) -> DataFrame:
    return streamed_searches(t).read("late").groupBy("subagent", "query").agg(F.count("*").alias("n"))


_BODIES = "select packet_storage_prefix, artifact_kind, body, run_id, video_id, doc_id from {bodies}"


@query("packets_written", """select b.video_id, b.run_id, b.artifact_kind, sha256(x.content) as content_sha256, strlen(x.content)::bigint as byte_count
from {bodies} b, lateral (select '{"evidence_ids":' || (b.body ->> '$.evidence_ids') || ',"kind":"' || b.artifact_kind || '","run_id":"' || b.run_id || '","video_id":"' || (b.body ->> '$.video_id') || '"}' || chr(10) as content) x where b.doc_id % 20 = 0""")
def packets_written(t: Tables) -> DataFrame:
    """Artifacts of the runs as files and read again, with the hashes of what lies there; one run in twenty is due for writing."""
    folder = shared_folder(t.spark, "packets")
    written = write_packets(t.sql(f"{_BODIES} where doc_id % 20 = 0"), folder)
    read = read_packets(t.spark, folder).select("video_id", "run_id", "artifact_kind", "content_sha256", "byte_count")
    listed = read_storage_listing(t.spark, folder, "b").select("name", "size")
    same = written.join(listed, (F.col("storage_path") == F.col("name")) & (F.col("byte_count") == F.col("size"))).select("content_sha256").distinct()
    return read.join(same, "content_sha256", "left_semi")


@query("declared_table", "select run_id, video_id, status, null::int as attempt, transcript_sha256 from {runs}")
def declared_table(t: Tables) -> DataFrame:
    """Runs written with some of their columns and read with all the declared ones, in their types."""
    folder = shared_folder(t.spark, "declared")
    t.runs.select("status", "run_id", "video_id", "transcript_sha256").write.parquet(f"{folder}/run.parquet")
    read = read_table(t.spark, folder, "run")
    return read.select("run_id", "video_id", "status", "attempt", "transcript_sha256") if len(read.columns) == SCHEMAS["run"].count(",") + 1 else read
