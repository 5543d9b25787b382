"""Queries of the column functions, over texts, pages and packet bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as f
from ..sources.tables import load_taxonomy, load_video_context
from .derived import Tables
from .registered import query

_JSON = "select doc_id, '{\"b\":' || cast(doc_id as string) || '.50,\"a\":{\"z\":' || case when doc_id % 2 = 0 then 'true' else 'null' end || ',\"m\":[' || cast(n_chars as string) || ',2.0,\"' || lang || '\"]},\"evidence_id\":\"e' || cast(doc_id % 9 as string) || '\",\"n\":{\"evidence_ids\":[\"x\",\"e' || cast(doc_id % 9 as string) || '\"]' || case when doc_id % 3 = 0 then ',\"transcript_text\":\"' || source || '\"' else '' end || '}}' as body, lang, source, n_chars from {documents}"
_CANON = "'{\"a\":{\"m\":[' || n_chars || ',2,\"' || lang || '\"],\"z\":' || case when doc_id % 2 = 0 then 'true' else 'null' end || '},\"b\":' || doc_id || '.5,\"evidence_id\":\"e' || (doc_id % 9) || '\",\"n\":{\"evidence_ids\":[\"x\",\"e' || (doc_id % 9) || '\"]' || case when doc_id % 3 = 0 then ',\"transcript_text\":\"' || source || '\"' else '' end || '}}'"


@query("canonical_json", f"select doc_id, {_CANON} as canonical from {{documents}}")
def canonical_json(t: Tables) -> DataFrame:
    return t.sql(_JSON).select("doc_id", f.canonical_json(F.col("body")).alias("canonical"))


@query("hash_canonical_json", f"select doc_id, sha256({_CANON} || chr(10)) as sha256 from {{documents}}")
def hash_canonical_json(t: Tables) -> DataFrame:
    return t.sql(_JSON).select("doc_id", f.hash_canonical_json(F.col("body")).alias("sha256"))


@query("serialize_artifact", f"select doc_id, sha256({_CANON} || chr(10)) as sha256, octet_length(encode({_CANON} || chr(10)))::bigint as byte_count from {{documents}}")
def serialize_artifact(t: Tables) -> DataFrame:
    return t.sql(_JSON).select("doc_id", f.serialize_artifact(F.col("body")).alias("a")).select("doc_id", "a.sha256", "a.byte_count")


@query("contains_raw_transcript", "select doc_id, doc_id % 3 = 0 as raw from {documents}")
def contains_raw_transcript(t: Tables) -> DataFrame:
    return t.sql(_JSON).select("doc_id", f.contains_raw_transcript(F.col("body")).alias("raw"))


@query("collect_evidence_ids", "select doc_id, 'e' || (doc_id % 9) || ',x' as ids from {documents}")
def collect_evidence_ids(t: Tables) -> DataFrame:
    return t.sql(_JSON).select("doc_id", F.array_join(f.collect_evidence_ids(F.col("body")), ",").alias("ids"))


_KEYED = "select doc_id, '2.0.0' as schema_version, '{\"video_id\":\"v' || cast(doc_id as string) || '\",\"run_id\":\"r\"}' as source, '[\"said_in_transcript\"]' as grades, '[{\"payload\":[' || cast(n_chars as string) || '.0],\"kind\":\"k\"}]' as ops from {documents}"


@query("intent_idempotency_key", """select doc_id, sha256('{"evidence_grades_used":["said_in_transcript"],"operations":[{"kind":"k","payload":[' || n_chars || ']}],"schema_version":"2.0.0","source":{"run_id":"r","video_id":"v' || doc_id || '"}}' || chr(10)) as key from {documents}""")
def intent_idempotency_key(t: Tables) -> DataFrame:
    rows = t.sql(_KEYED)
    return rows.select("doc_id", f.intent_idempotency_key(F.col("schema_version"), F.col("source"), F.col("grades"), F.col("ops")).alias("key"))


_CANONICAL = """'{"evidence_grades_used":["said_in_transcript"],"operations":[{"kind":"k","payload":[' || cast(n_chars as string) || ']}],"schema_version":"2.0.0","source":{"run_id":"r","video_id":"v' || cast(doc_id as string) || '"}}' || chr(10)"""
#: Every third intent states its key, every third another one, and the others none.
_STATED = f"select doc_id, SHA[[{_CANONICAL}]] as key, case doc_id % 3 when 0 then SHA[[{_CANONICAL}]] when 1 then SHA[['old']] end as stated, n_chars from {{documents}}"


@query("rewrite_idempotency", f"select doc_id, key as idempotency_key, coalesce(stated <> key, true) as rewritten from ({_STATED})")
def rewrite_idempotency(t: Tables) -> DataFrame:
    body = """select doc_id, '{"operations":[{"payload":[' || cast(n_chars as string) || '.0],"kind":"k"}],"source":{"video_id":"v' || cast(doc_id as string) || '","run_id":"r"},"evidence_grades_used":["said_in_transcript"],"schema_version":"2.0.0"' || coalesce(',"idempotency_key":"' || stated || '"', '') || '}' as body"""
    rows = t.sql(f"{body} from ({_STATED})").select("doc_id", f.rewrite_idempotency(F.col("body")).alias("r"))
    return rows.select("doc_id", "r.idempotency_key", "r.rewritten")


# The given URLs have no escapes, ports or dot segments, so that SQL can follow the rules by hand.
_DROP = "regexp_replace(regexp_replace(url, '#.*$', ''), '([?&])utm_[^&]*(&|$)', '\\1', 'g')"
_TIDY = "regexp_replace(regexp_replace({0}, '[?&]$', ''), '([^/:])/(\\?|$)', '\\1\\2')"


@query("normalize_official_url", f"select page_id, {_TIDY.format(_DROP)} as url from {{pages}}")
def normalize_official_url(t: Tables) -> DataFrame:
    return t.pages.select("page_id", f.normalize_official_url(F.col("url")).alias("url"))


@query("normalize_url", "select page_id, regexp_replace(regexp_replace(url, '#.*$', ''), '([^/:])/(\\?|$)', '\\1\\2') as url from {pages}")
def normalize_url(t: Tables) -> DataFrame:
    return t.pages.select("page_id", f.normalize_url(F.col("url")).alias("url"))


@query("preview_text", "select doc_id, case when length(flat) > 220 then substr(flat, 1, 219) || '…' else flat end as preview from (select doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) as flat from {documents} where length(text) > 0)")
def preview_text(t: Tables) -> DataFrame:
    return t.documents.where("length(text) > 0").select("doc_id", f.preview_text(F.col("text")).alias("preview"))


@query("storage_paths", "select run_id, k.artifact_kind, packet_storage_prefix || '/' || k.file_name as path from {packet_runs} cross join {kinds} k")
def storage_paths(t: Tables) -> DataFrame:
    prefix = f.packet_storage_prefix(F.col("video_id"), F.col("run_id"))
    return t.packet_runs.crossJoin(F.broadcast(t.kinds)).select("run_id", "artifact_kind", f.artifact_storage_path(prefix, F.col("artifact_kind")).alias("path"))


@query("iso_times", "select event_id, strftime(ts, '%Y-%m-%d') as day, strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(((epoch_us(ts) // 1000) % 1000)::varchar, 3, '0') || 'Z' as at from {events}")
def iso_times(t: Tables) -> DataFrame:
    return t.events.select("event_id", f.iso_date(F.col("ts")).alias("day"), f.iso_datetime(F.col("ts")).alias("at"))


_LINKED = "select page_id, 'see ' || url || '. Also (' || url || ') and https://Example.org/a/?utm_source=x&q=' || cast(page_id % 7 as string) || ', or http:// nothing' as text from {pages}"


@query("extract_urls", f"select distinct page_id, url from (select page_id, {_TIDY.format(_DROP)} as url from {{pages}} union all select page_id, 'https://example.org/a?q=' || (page_id % 7) from {{pages}})")
def extract_urls(t: Tables) -> DataFrame:
    return f.extract_urls(t.sql(_LINKED), "page_id", "text")


@query("load_video_context", "select video_id, sha256(coalesce(transcript_text, '')) as transcript_sha256, coalesce(transcript_char_count, length(coalesce(transcript_text, ''))) as char_count, transcript_language from {catalog}")
def video_context(t: Tables) -> DataFrame:
    return load_video_context(t.catalog).select("video_id", "transcript_sha256", "char_count", "transcript_language")


_VERSIONS = "select distinct 't' || cast(n_nationkey % 3 as string) as taxonomy_version_id, cast(n_nationkey % 3 as string) || '.0.0' as version from {nation}"
_CATS = "select 't' || cast(n_nationkey % 3 as string) as taxonomy_version_id, n_name as category_code, cast(n_regionkey as int) as sort_order from {nation}"
_DOMS = "select 't' || cast(r_regionkey % 3 as string) as taxonomy_version_id, r_name as domain_code, cast(5 - r_regionkey as int) as sort_order, r_regionkey <> 3 as active from {region}"


@query("load_taxonomy", f"select (select string_agg(category_code, ',' order by sort_order, category_code) from ({_CATS}) where taxonomy_version_id = 't0') as categories, (select string_agg(domain_code, ',' order by sort_order, domain_code) from ({_DOMS}) where taxonomy_version_id = 't0' and active) as domains")
def taxonomy(t: Tables) -> DataFrame:
    out = load_taxonomy(t.sql(_VERSIONS), t.sql(_CATS), t.sql(_DOMS), "0.0.0")
    codes = lambda c, k: F.array_join(F.transform(c, lambda x: x[k]), ",")
    return out.select(codes("categories", "category_code").alias("categories"), codes("domains", "domain_code").alias("domains"))
