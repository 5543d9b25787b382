"""All registered queries and their SQL."""

from . import apply_queries, contract_queries, function_queries, metrics_queries, qualify_queries, registry_queries, report_queries, stream_queries, validate_queries  # noqa: F401
from .registered import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
