"""Streams over session events, packets, searches and intents, and the batch form of the session fold."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.apply import apply_batch
from ..operators.registry import register_artifacts
from ..sources.versions import Versions

OUTCOME_SCHEMA = "session_id string, outcome string, message string, last_seq long"
_RUNNER = {"turn.failed": "failed", "session.failed": "failed", "turn.completed": "completed", "session.waiting": "completed"}
_CONTROLLER = {"session.failed": "failed", "session.completed": "completed"}


def _terminal(mode: str, complete: F.Column | None = None):
    """Outcome of an event's type, or null: the first such event of a session decides.

    The controller looks whether the phase's artifacts are all there: then failed and waiting sessions are complete.
    """
    kind = F.col("type")
    pick = lambda table: F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[kind]
    if mode == "runner":
        return pick(_RUNNER)
    done = F.coalesce(complete, F.lit(False)) if complete is not None else F.lit(False)
    return F.when(kind.isin("session.failed", "session.waiting") & done, "completed").otherwise(pick(_CONTROLLER))


def session_outcomes(events: DataFrame, mode: str = "runner", complete: DataFrame | None = None) -> DataFrame:
    """(session_id, outcome, message, last_seq): the first terminal event by seq decides; message is the last completed message before it.

    Sessions without one are unknown and keep their last message. complete: (session_id, complete) for the controller.
    """
    rows = events if complete is None else events.join(complete.select("session_id", "complete"), "session_id", "left")
    rows = rows.withColumn("o", _terminal(mode, F.col("complete") if complete is not None else None))
    ends = rows.where("o is not null").groupBy("session_id").agg(F.min("seq").alias("at"), F.min_by("o", "seq").alias("outcome"))
    said = (F.col("type") == "message.completed") & (F.length("message") > 0) & (F.col("at").isNull() | (F.col("seq") < F.col("at")))
    joined = rows.join(ends, "session_id", "left")
    out = joined.groupBy("session_id").agg(F.coalesce(F.first("outcome"), F.lit("unknown")).alias("outcome"), F.max_by(F.when(said, F.col("message")), F.when(said, F.col("seq"))).alias("message"), F.coalesce(F.first("at"), F.max("seq")).alias("last_seq"))
    return out.select("session_id", "outcome", "message", "last_seq")


_STATE = "rows string, at_end long, at_last long"
_RELEASED = "session_id string, complete boolean, outcome string, message string, last_seq long"


def _fold(rows: list[list], mode: str, complete: bool) -> tuple[str, str | None, int]:
    """Outcome, message and last seq of a session's rows (seq, type, message), as ``session_outcomes`` has them."""
    message, last = None, 0
    for seq, kind, text in sorted(rows, key=lambda r: r[0]):
        last = seq
        table = _RUNNER if mode == "runner" else _CONTROLLER | (dict.fromkeys(("session.failed", "session.waiting"), "completed") if complete else {})
        if kind in table:
            return table[kind], message, seq
        if kind == "message.completed" and text:
            message = text
    return "unknown", message, last


def released_sessions(events: DataFrame, mode: str = "runner", late: str = "10 minutes", ttl_seconds: int = 86_400) -> DataFrame:
    """(session_id, complete, outcome, message, last_seq) of a stream of (session_id, seq, type, message, at), whatever order it arrives in.

    A session's rows are held until the watermark, ``late`` behind the latest ``at``, has passed its earliest deciding event: then
    no earlier one can come any more, and the rows are folded in seq order. A session without one is released as unknown
    ``ttl_seconds`` after its last event. ``at`` must not fall as seq rises within a session; rows behind the watermark are
    passed over. In mode ``controller``, whose outcome depends on the artifacts, there is a row for either case of ``complete``.
    State is what a session said and how it ended, one entry a session, gone when it is released.
    """
    ends = set(_RUNNER if mode == "runner" else ("session.failed", "session.completed"))
    cases = (False,) if mode == "runner" else (False, True)

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows, at_end, at_last = state.get if state.exists else ("[]", None, 0)
        rows = json.loads(rows)
        if state.hasTimedOut:
            state.remove()
            made = [(key[0], case, *_fold(rows, mode, case)) for case in cases]
            yield pd.DataFrame(made, columns=["session_id", "complete", "outcome", "message", "last_seq"])
            return
        for batch in batches:
            for seq, kind, text, when in zip(batch["seq"], batch["type"], batch["message"], batch["ms"], strict=True):
                at_last = max(at_last, int(when))
                told = kind == "message.completed" and isinstance(text, str) and text
                rows.append([int(seq), kind, text if told else None])
                if kind in ends:
                    at_end = int(when) if at_end is None else min(at_end, int(when))
        state.update((json.dumps(rows), at_end, at_last))
        due = at_last + ttl_seconds * 1000 if at_end is None else at_end + 1
        state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))

    kept = events.select("session_id", "seq", "type", F.when(F.col("type") == "message.completed", F.col("message")).alias("message"), "at", F.unix_millis("at").alias("ms")).where("at is not null").withWatermark("at", late)
    return kept.groupBy("session_id").applyInPandasWithState(fold, _RELEASED, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def outcomes_stream(events: DataFrame, ttl_seconds: int = 86_400, late: str = "10 minutes") -> DataFrame:
    """The runner's outcomes over a stream, as ``session_outcomes`` gives them over a batch; see ``released_sessions``."""
    return released_sessions(events, "runner", late, ttl_seconds).select("session_id", "outcome", "message", "last_seq")


def controller_outcomes_stream(events: DataFrame, complete: Callable[[SparkSession], DataFrame], folder: str, checkpoint: str, ttl_seconds: int = 86_400, late: str = "10 minutes") -> StreamingQuery:
    """The controller's outcomes, appended to table ``outcomes`` of the ``Versions`` below ``folder``.

    ``complete`` is asked in every micro-batch for (session_id, complete), so that artifacts which arrived since then count.
    """
    spark = events.sparkSession
    store = Versions.create(spark, folder, {"outcomes": spark.createDataFrame([], OUTCOME_SCHEMA)}, {"outcomes": "session_id"})

    def write(batch: DataFrame, number: int) -> None:
        if number in store.numbers():
            return
        done = complete(batch.sparkSession).where("complete").select("session_id", F.lit(True).alias("_done")).distinct()
        rows = batch.join(done, "session_id", "left").where(F.col("complete") == F.coalesce("_done", F.lit(False)))
        store.commit(number, append={"outcomes": rows.select("session_id", "outcome", "message", "last_seq")})

    return released_sessions(events, "controller", late, ttl_seconds).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_packets_stream(packets: DataFrame, folder: str, checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """Register a stream of (run_id, artifact_kind, storage_path, content_sha256) artifacts in the ``Versions`` below ``folder``.

    Table ``registry`` has what is registered, ``outcomes`` the outcome of every artifact. A micro-batch reads the registry's
    buckets of its runs only and adds rows to them; a batch that is published already is passed over.
    """
    spark = packets.sparkSession
    empty = spark.createDataFrame([], "run_id string, artifact_kind string, storage_path string, content_sha256 string")
    store = Versions.create(spark, folder, {"registry": empty, "outcomes": empty.withColumn("outcome", F.lit("x"))}, {"registry": "run_id", "outcomes": "run_id"}, buckets)

    def register(batch: DataFrame, number: int) -> None:
        if number in store.numbers():
            return
        held = store.read("registry", store.touched("registry", batch.select("run_id")))
        result = register_artifacts(held, batch).persist()
        store.commit(number, append={"registry": result.where("outcome = 'registered'"), "outcomes": result})
        result.unpersist()

    return packets.writeStream.foreachBatch(register).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


SEARCH_SCHEMA = "run_id string, subagent string, query string, searched_at timestamp"


def search_ledger_stream(events: DataFrame, folder: str, checkpoint: str, late_seconds: int = 600, buckets: int = 64) -> StreamingQuery:
    """Append a stream of searches (run_id, subagent, query, searched_at) to table ``ledger`` of the ``Versions`` below ``folder``.

    A search counts once: repeats within a micro-batch and of the ledger's rows are passed over. Rows more than ``late_seconds``
    behind the latest search of all batches before, and rows without a time, go to table ``late``, as they are. So every
    row is in the ledger, late, or the repeat of one in the ledger. The ledger lies in buckets of hours, of which a batch reads
    those of its own searches. The latest time is published with each batch, so that a replay divides its rows alike.
    """
    spark = events.sparkSession
    columns = ["run_id", "subagent", "query", "searched_at"]
    empty = spark.createDataFrame([], SEARCH_SCHEMA).withColumn("hour", F.lit(0).cast("long"))
    store = Versions.create(spark, folder, {"ledger": empty, "late": empty}, {"ledger": "hour", "late": "hour"}, buckets)

    def add(batch: DataFrame, number: int) -> None:
        if number in store.numbers():
            return
        seen = store.manifest()["notes"].get("seen")  # microseconds
        micros = F.unix_micros("searched_at")
        rows = batch.select(*columns, F.floor(micros / 3_600_000_000).alias("hour")).persist()
        mark = F.lit(None if seen is None else seen - late_seconds * 1_000_000)
        behind = F.col("searched_at").isNull() | F.coalesce(micros < mark, F.lit(False))
        timely = rows.where(~behind).distinct()
        held = store.read("ledger", store.touched("ledger", timely.select("hour")))
        same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*columns, "hour")]
        fresh = timely.alias("a").join(held.alias("b"), same, "left_anti")
        latest = max((x for x in (seen, rows.agg(F.max(micros)).first()[0]) if x is not None), default=None)
        store.commit(number, append={"ledger": fresh, "late": rows.where(behind)}, notes={"seen": latest})
        rows.unpersist()

    return events.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def search_counts_stream(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """(window_start, subagent, searches) of a stream of (searched_at, subagent); rows later than ``late`` are dropped."""
    counted = events.withWatermark("searched_at", late).groupBy(F.window("searched_at", width), "subagent").agg(F.count("*").alias("searches"))
    return counted.select(F.col("window.start").alias("window_start"), "subagent", "searches")


def apply_intents_stream(intents: DataFrame, folder: str, decide: Callable[[dict[str, DataFrame], DataFrame], DataFrame], checkpoint: str) -> StreamingQuery:
    """Apply a stream of intents (intent_id, run_id, body, applied_at) to the ``Versions`` below ``folder``, batch by batch.

    Its tables are those that ``apply_intents`` wants, in the buckets of ``TABLE_KEYS``. Batch n reads and writes only the buckets that
    it touches and is published as version n at once, so that a replayed batch applies nothing twice. ``decide`` takes
    the tables, so pruned, and the batch, and returns (intent_id, run_id, result), as ``good_intents`` does; intents that the
    ledger has as applied are passed over whatever it says.
    """
    store = Versions(intents.sparkSession, folder)
    return intents.writeStream.foreachBatch(lambda batch, number: apply_batch(store, batch, number, decide)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def apply_stream(intents: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Apply a stream of intents batch by batch, each intent once within a batch; ``apply`` must itself pass over applied ones."""

    def one(batch: DataFrame, number: int) -> None:
        apply(batch.dropDuplicates(["intent_id"]), number)

    return intents.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
