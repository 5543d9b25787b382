"""Column functions: canonical JSON, hashes, URLs, paths and previews."""

from .json import canonical_json, collect_evidence_ids, contains_raw_transcript, hash_canonical_json, intent_idempotency_key, rewrite_idempotency, serialize_artifact
from .text import artifact_storage_path, extract_urls, iso_date, iso_datetime, ordinal, packet_storage_prefix, preview_text, sha256_hex
from .urls import normalize_official_url, normalize_url

__all__ = [
    "artifact_storage_path", "canonical_json", "collect_evidence_ids", "contains_raw_transcript", "extract_urls", "hash_canonical_json", "intent_idempotency_key", "iso_date", "iso_datetime",
    "normalize_official_url", "normalize_url", "ordinal", "packet_storage_prefix", "preview_text", "rewrite_idempotency", "serialize_artifact", "sha256_hex",
]
