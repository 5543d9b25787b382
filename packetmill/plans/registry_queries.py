"""Queries over artifact registries, stored objects and packets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import registry as r
from ..vocabulary import APPLY_KINDS, ARTIFACT_KINDS, RESEARCH_KINDS
from .derived import Tables
from .registered import query

_INCOMING = "select run_id, artifact_kind, case when doc_id % 7 = 0 then 'moved/' || file_name else packet_storage_prefix || '/' || file_name end as storage_path, case when doc_id % 5 = 0 then SHA[['new']] else SHA[[body]] end as content_sha256 from {bodies} where doc_id % 2 = 0"
_EXISTING = "select run_id, artifact_kind, packet_storage_prefix || '/' || file_name as storage_path, SHA[[body]] as content_sha256 from {bodies} where doc_id % 3 = 0"


@query("register_artifacts", f"""
select i.*, case when e.run_id is null then 'registered' when e.content_sha256 <> i.content_sha256 then 'ARTIFACT_CONTENT_COLLISION' when e.storage_path <> i.storage_path then 'ARTIFACT_PATH_COLLISION' else 'identical' end as outcome
from ({_INCOMING}) i left join ({_EXISTING}) e on e.run_id = i.run_id and e.artifact_kind = i.artifact_kind""")
def register_artifacts(t: Tables) -> DataFrame:
    return r.register_artifacts(t.sql(_EXISTING), t.sql(_INCOMING))


@query("classify_uploads", """
select a.storage_bucket as bucket_id, a.storage_path as name, a.content_sha256, case when s.name is null then 'uploaded' when s.content_sha256 = a.content_sha256 then 'identical' else 'STORAGE_CONTENT_COLLISION' end as outcome
from {artifacts} a left join {stored} s on s.bucket_id = a.storage_bucket and s.name = a.storage_path""")
def classify_uploads(t: Tables) -> DataFrame:
    return r.classify_uploads(t.stored, t.artifacts.select(F.col("storage_bucket").alias("bucket_id"), F.col("storage_path").alias("name"), "content_sha256"))


def _complete(kinds: str) -> str:
    return f"""
select p.run_id, coalesce(string_agg(k.artifact_kind, ',' order by k.kind_no) filter (a.run_id is null), '') as missing, bool_and(a.run_id is not null) as complete
from (select distinct run_id from {{packet_runs}}) p cross join (select * from {{kinds}} where {kinds}) k
left join {{artifacts}} a on a.run_id = p.run_id and a.artifact_kind = k.artifact_kind and regexp_full_match(a.content_sha256, '[0-9a-f]{{64}}') group by p.run_id""".replace("{{64}}", "{64}")


def _completeness(t: Tables, kinds: tuple[str, ...]) -> DataFrame:
    return r.packet_completeness(t.packet_runs, t.artifacts, kinds).select("run_id", F.array_join("missing", ",").alias("missing"), "complete")


for _name, _kinds, _where in (("research", RESEARCH_KINDS, "kind_no < 7"), ("synthesis", ARTIFACT_KINDS[7:11], "kind_no between 7 and 10"), ("apply", APPLY_KINDS, "kind_no < 11"), ("full", ARTIFACT_KINDS, "true")):
    query(f"packet_completeness_{_name}", _complete(_where))(lambda t, kinds=_kinds: _completeness(t, kinds))


@query("verify_artifacts", """
select a.run_id, a.artifact_kind, case when a.storage_path <> p.packet_storage_prefix || '/' || k.file_name then 'ARTIFACT_PATH_MISMATCH' when s.name is null then 'ARTIFACT_MISSING' when s.content_sha256 <> a.content_sha256 then 'ARTIFACT_HASH_MISMATCH' end as code
from {artifacts} a join {packet_runs} p on p.run_id = a.run_id join {kinds} k on k.artifact_kind = a.artifact_kind left join {stored} s on s.bucket_id = a.storage_bucket and s.name = a.storage_path""")
def verify_artifacts(t: Tables) -> DataFrame:
    return r.verify_artifacts(t.artifacts, t.stored, t.packet_runs)


@query("artifact_marks", """
select a.run_id, a.artifact_kind, case when s.name is null then 'MISSING' when s.content_sha256 = a.content_sha256 then 'ok' else 'HASH_MISMATCH' end as mark, a.byte_count, s.size as actual_bytes
from {artifacts} a left join {stored} s on s.bucket_id = a.storage_bucket and s.name = a.storage_path""")
def artifact_marks(t: Tables) -> DataFrame:
    return r.artifact_marks(t.artifacts, t.stored)


@query("packet_manifest_hash", """
select p.run_id, sha256('{"artifacts":[' || string_agg('{"artifact_kind":"' || a.artifact_kind || '","content_sha256":"' || a.content_sha256 || '","storage_path":"' || a.storage_path || '"}', ',' order by a.artifact_kind) || '],"packet_storage_prefix":"' || p.packet_storage_prefix || '"}' || chr(10)) as packet_sha256
from {packet_runs} p join {artifacts} a on a.run_id = p.run_id group by p.run_id, p.packet_storage_prefix""")
def packet_manifest_hash(t: Tables) -> DataFrame:
    return r.packet_manifest_hash(t.artifacts, t.packet_runs)


@query("load_research_packets", """
select run_id, case when n < 7 then 'RESEARCH_CHECKPOINT_INCOMPLETE' when not same then 'ARTIFACT_HASH_MISMATCH' end as code, case when n = 7 and same then manifest end as run_manifest
from (select a.run_id, count(b.body) as n, bool_and(sha256(b.body) = a.content_sha256) as same, max(b.body) filter (a.artifact_kind = 'run_manifest') as manifest
  from {artifacts} a join {kinds} k on k.artifact_kind = a.artifact_kind and k.kind_no < 7 left join {bodies} b on b.run_id = a.run_id and b.artifact_kind = a.artifact_kind group by a.run_id)""")
def load_research_packets(t: Tables) -> DataFrame:
    return r.load_research_packets(t.artifacts, t.bodies).select("run_id", "code", "run_manifest")


_LEDGER = "select run_id, 'i' || cast(doc_id as string) as intent_id, SHA[[body]] as content_sha256, case doc_id % 4 when 0 then 'draft' when 1 then 'validated' when 2 then 'applied' else 'rejected' end as status from {bodies} where kind_no = 10 and doc_id % 3 <> 0"
_INTENTS = "select run_id, 'i' || cast(doc_id as string) as intent_id, case when doc_id % 5 = 0 then SHA[['other']] else SHA[[body]] end as content_sha256 from {bodies} where kind_no = 10 and doc_id % 2 = 0"


@query("upsert_intent_ledger", f"""
select coalesce(l.run_id, i.run_id) as run_id, coalesce(l.intent_id, i.intent_id) as intent_id, coalesce(l.content_sha256, i.content_sha256) as content_sha256,
  case when i.run_id is not null and (l.run_id is null or l.content_sha256 = i.content_sha256 and l.status in ('draft', 'validated')) then 'validated' else l.status end as status,
  case when i.run_id is null then 'kept' when l.run_id is null then 'inserted' when l.content_sha256 = i.content_sha256 and l.status in ('draft', 'validated') then 'updated' else 'INTENT_CONTENT_COLLISION' end as outcome
from ({_LEDGER}) l full join ({_INTENTS}) i on i.run_id = l.run_id""")
def upsert_intent_ledger(t: Tables) -> DataFrame:
    return r.upsert_intent_ledger(t.sql(_LEDGER), t.sql(_INTENTS))


@query("packet_objects", """
select c.video_id, o.bucket_id, o.name, o.size, o.kind from (select bucket_id, name, size, 'transcript' as kind, regexp_extract(name, '/([^/]+)\\.[^/.]*$', 1) as v from {storage_objects}
  union all select bucket_id, name, size, 'packet', split_part(name, '/', 3) from {stored}) o join {catalog} c on c.video_id = o.v""")
def packet_objects(t: Tables) -> DataFrame:
    return r.packet_objects(t.storage_objects.drop("content_sha256").unionByName(t.stored.drop("content_sha256")), t.catalog)
