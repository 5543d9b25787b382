"""Structured Streaming: session outcomes, packet intake, the search ledger and intent application."""

from .jobs import OUTCOME_SCHEMA, apply_intents_stream, apply_stream, controller_outcomes_stream, ingest_packets_stream, outcomes_stream, released_sessions, search_counts_stream, search_ledger_stream, session_outcomes

__all__ = ["OUTCOME_SCHEMA", "apply_intents_stream", "apply_stream", "controller_outcomes_stream", "ingest_packets_stream", "outcomes_stream", "released_sessions", "search_counts_stream", "search_ledger_stream", "session_outcomes"]
