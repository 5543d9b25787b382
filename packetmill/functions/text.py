"""Paths, dates, previews, enum order and URL extraction with built-in functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..vocabulary import ARTIFACT_FILES, PACKET_VERSION
from .urls import normalize_official_url


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def ordinal(column: Column, values: Sequence[str]) -> Column:
    """Place of a code in its declared order, from 1; 0 for an unknown code, null for null."""
    return F.array_position(F.array(*map(F.lit, values)), column).cast("int")


def preview_text(text: Column, most: int = 220) -> Column:
    """White space collapsed and trimmed, cut to ``most`` characters of which the last is an ellipsis; null for null and empty text."""
    flat = F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
    return F.when(F.length(text) > 0, F.when(F.length(flat) > most, F.concat(F.substring(flat, 1, most - 1), F.lit("…"))).otherwise(flat))


def packet_storage_prefix(video_id: Column, run_id: Column, version: Column | str = PACKET_VERSION) -> Column:
    version = F.lit(version) if isinstance(version, str) else version
    return F.concat_ws("/", F.lit("pre-research"), F.when(version.startswith("1."), "v1").otherwise("v2"), video_id, run_id)


def artifact_storage_path(prefix: Column, kind: Column) -> Column:
    """Path of an artifact; one trailing slash of the prefix goes. Null for an unknown kind."""
    files = F.create_map(*[F.lit(x) for pair in ARTIFACT_FILES.items() for x in pair])
    return F.concat(F.regexp_replace(prefix, "/$", ""), F.lit("/"), files[kind])


def iso_date(column: Column) -> Column:
    return F.substring(column.cast("string"), 1, 10)


def iso_datetime(column: Column) -> Column:
    """A timestamp in UTC with milliseconds and Z (session time zone UTC)."""
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def extract_urls(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, url): the distinct normalised URLs of a text column; closing marks at a URL's end are not part of it."""
    found = F.explode(F.regexp_extract_all(text, F.lit(r"(https?://[^\s<>\"']+)"), 1))
    raw = df.select(key, found.alias("raw")).select(key, F.regexp_replace("raw", r"[.,;:!?)\]}]+$", "").alias("raw")).distinct()
    return raw.select(key, normalize_official_url(F.col("raw")).alias("url")).where("url is not null").distinct()
