"""Streaming jobs.  Scoring is row-local and shared with the batch operators; only what truly
needs history (sessions, admission) keeps keyed state."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from triagelake import brand_voice as B
from triagelake import fixed_values as V
from triagelake.functions.text import has_order_number, html_escape
from triagelake.functions.pii import mask_pii
from triagelake.operators.admission import admit_one, micros
from triagelake.operators.sessions import asks_for_order
from triagelake.operators.triage import with_triage
from triagelake.session import scratch_path


def triage_stream(scored: DataFrame, text: str = "text") -> DataFrame:
    """Stateless triage of rows that carry intent and intent_confidence."""
    return with_triage(scored, text)


def first_delivery(stream: DataFrame, ts: str, keys: list[str], lateness: str = "10 minutes") -> DataFrame:
    """Drop repeated deliveries of the same message inside the lateness bound."""
    return stream.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(keys)


CHAT_OUT = (
    "session_id string, turn long, intent string, intent_confidence double, decision string, "
    "escalation_category string, reason string, reply string, multi_turn boolean, follow_up boolean"
)
#: Processing time without traffic after which a key's state is dropped.  Bounded replays (``availableNow``) pass None: with such
#: a timeout Spark starts empty batches for ever, and a replay ends long before any key is idle.
IDLE = "1 day"
CHAT_STATE = "turns array<struct<customer:string,agent_reply:string,intent:string,escalation_category:string>>, asks boolean"


def _milliseconds(duration: str | None) -> int | None:
    return None if duration is None else int(pd.Timedelta(duration).total_seconds() * 1000)


def _timeout(idle_ms: int | None) -> str:
    return "NoTimeout" if idle_ms is None else "ProcessingTimeTimeout"


def _keep(state: GroupState, value: tuple, idle_ms: int | None) -> None:
    state.update(value)
    if idle_ms is not None:
        state.setTimeoutDuration(idle_ms)


def chat_stream(scored: DataFrame, max_turns: int = V.SESSION_TURNS, idle: str | None = IDLE, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per-session chat: the follow-up rule and the stored turns, in turn order.

    ``scored`` has session_id, turn, message, intent, intent_confidence, decision,
    escalation_category, reason and reply.  All text work happens before the exchange; the
    Python step compares flags and appends to an array of at most ``max_turns``.  Rows without a
    session have no place here; ``chat_responses`` answers them too.  A session without traffic for
    ``idle`` (processing time) is dropped and starts afresh afterwards.  ``carry`` names string columns
    that go along with their row.
    """
    rows = scored.where(F.col("session_id").isNotNull()).select(
        "session_id", F.col("turn").cast("long").alias("turn"), "intent", F.col("intent_confidence").cast("double").alias("intent_confidence"),
        "decision", "escalation_category", "reason", "reply",
        has_order_number(F.col("message")).alias("_order"),
        asks_for_order(F.col("reply")).alias("_asks"),
        html_escape(mask_pii(F.col("message"))).alias("_customer"),
        html_escape(F.col("reply")).alias("_escaped"), *carry,
    )
    follow_reply, follow_reason = B.FOLLOW_UP_REPLY, B.POLICY_REASONS["follow_up"]
    idle_ms = _milliseconds(idle)
    escalate, confidence = V.ESCALATE, V.FOLLOW_UP_CONFIDENCE

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        turns, asks = state.get if state.exists else ([], False)
        turns = [tuple(t) for t in turns]
        for pdf in _in_order(batches, "turn"):
            out = []
            for r in pdf.to_dict("records"):
                follow = bool(turns) and asks and bool(r["_order"])
                multi = bool(turns)
                if follow:
                    last = turns[-1]
                    r.update(intent=last[2], intent_confidence=confidence, decision=escalate,
                             escalation_category=last[3], reason=follow_reason, reply=follow_reply)
                    escaped, asks = follow_reply, False
                else:
                    escaped, asks = r["_escaped"], bool(r["_asks"])
                turns.append((r["_customer"], escaped, r["intent"], r["escalation_category"]))
                turns = turns[-max_turns:]
                out.append({**{c: r[c] for c in rows_out}, "multi_turn": multi, "follow_up": follow, **{c: r[c] for c in carry}})
            yield pd.DataFrame(out)
        _keep(state, (turns, asks), idle_ms)

    rows_out = [c.split()[0] for c in CHAT_OUT.split(", ")][:-2]
    schema = ", ".join([CHAT_OUT, *[f"{c} string" for c in carry]])
    return rows.groupBy("session_id").applyInPandasWithState(step, schema, CHAT_STATE, "append", _timeout(idle_ms))


EVIDENCE = "array<struct<conversation_id:string,similarity:double,support_reply:string,customer_text:string>>"


def chat_responses(scored: DataFrame, max_turns: int = V.SESSION_TURNS, idle: str | None = IDLE) -> DataFrame:
    """What a chat client gets for every message: the columns of ``chat_stream`` with the evidence, replies escaped.

    ``scored`` has the columns of ``chat_stream`` and ``evidence``.  Rows with a session keep its state; rows without one are
    answered from their own scores, in the same output and without any state.  A missing evidence is an empty list.
    """
    packed = scored.withColumn("evidence", F.to_json(F.coalesce(F.col("evidence").cast(EVIDENCE), F.expr(f"cast(array() as {EVIDENCE})"))))
    kept = chat_stream(packed, max_turns, idle, carry=("evidence",))
    alone = packed.where(F.col("session_id").isNull()).select(
        F.col("session_id").cast("string").alias("session_id"), F.col("turn").cast("long").alias("turn"), "intent",
        F.col("intent_confidence").cast("double").alias("intent_confidence"), "decision", "escalation_category", "reason", "reply",
        F.lit(False).alias("multi_turn"), F.lit(False).alias("follow_up"), "evidence",
    )
    both = kept.unionByName(alone)
    return both.withColumn("reply", html_escape(F.col("reply"))).withColumn("evidence", F.from_json("evidence", EVIDENCE))


def _in_order(batches: Iterator[pd.DataFrame], order: str) -> Iterator[pd.DataFrame]:
    """The rows one key received in one trigger, ordered.

    Spark hands over a key's batches in any order, so they are sorted here; the trigger
    size (``maxFilesPerTrigger`` and the like) bounds them.
    """
    parts = [p for p in batches if len(p)]
    if parts:
        yield pd.concat(parts).sort_values(order, kind="stable")


SESSION_OUT = "session_id string, n_turns long, turns array<struct<customer:string,agent_reply:string,intent:string,escalation_category:string>>"


def session_stream(turns: DataFrame, max_turns: int = V.SESSION_TURNS, idle: str | None = IDLE) -> DataFrame:
    """Bounded session table in update mode: session_id and its latest stored turns.

    ``turns`` has session_id, turn, message, reply, intent and escalation_category.  A session without traffic for ``idle``
    (processing time) is dropped and counts from 0 afterwards.
    """
    idle_ms = _milliseconds(idle)
    rows = turns.where(F.col("session_id").isNotNull()).select(
        "session_id", F.col("turn").cast("long").alias("turn"),
        html_escape(mask_pii(F.col("message"))).alias("customer"),
        html_escape(F.col("reply")).alias("agent_reply"), "intent", "escalation_category",
    )

    def step(key, batches, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        kept, seen = state.get if state.exists else ([], 0)
        kept = [tuple(t) for t in kept]
        for pdf in _in_order(batches, "turn"):
            for r in pdf.itertuples(index=False):
                kept = (kept + [(r.customer, r.agent_reply, r.intent, r.escalation_category)])[-max_turns:]
                seen += 1
        _keep(state, (kept, seen), idle_ms)
        names = ("customer", "agent_reply", "intent", "escalation_category")
        yield pd.DataFrame({"session_id": [key[0]], "n_turns": [seen], "turns": [[dict(zip(names, t)) for t in kept]]})

    state_type = "turns array<struct<customer:string,agent_reply:string,intent:string,escalation_category:string>>, seen long"
    return rows.groupBy("session_id").applyInPandasWithState(step, SESSION_OUT, state_type, "update", _timeout(idle_ms))


def admission_stream(
    events: DataFrame, key: str, ts: str, id_col: str, limit: int = V.ADMISSION_LIMIT, window_seconds: int = V.ADMISSION_WINDOW_SECONDS,
    idle: str | None = IDLE,
) -> DataFrame:
    """Streaming admission control; the state is at most ``limit`` time stamps per key.

    A key without traffic for ``idle`` and a window on top (processing time) is dropped: in a live stream its stamps lie
    outside of the window by then.
    """
    window = window_seconds * 1_000_000
    idle_ms = None if idle is None else _milliseconds(idle) + window_seconds * 1000
    rows = events.select(
        F.col(key).cast("string").alias("key"), F.col(id_col).cast("long").alias("id"),
        micros(events, ts).alias("t"),
    )

    def step(k, batches, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        stamps = deque(state.get[0] if state.exists else [])
        for pdf in _in_order(batches, ["t", "id"]):
            ok = [admit_one(stamps, int(t), limit, window) for t in pdf["t"]]
            yield pd.DataFrame({"key": k[0], "id": pdf["id"].to_numpy(), "admitted": ok})
        _keep(state, (list(stamps),), idle_ms)

    return rows.groupBy("key").applyInPandasWithState(
        step, "key string, id long, admitted boolean", "stamps array<long>", "append", _timeout(idle_ms)
    )


def active_sessions(turns: DataFrame, session: str = "session_id") -> DataFrame:
    """Streaming gauge input: turns seen per active session (complete or update mode); the state holds every session."""
    return turns.where(F.col(session).isNotNull()).groupBy(session).agg(F.count(F.lit(1)).alias("n_turns"))


def session_activity(turns: DataFrame, session: str, ts: str, gap: str = "30 minutes", lateness: str = "10 minutes") -> DataFrame:
    """(session, started, ended, n_turns): one row per stretch of activity, in append mode with bounded state.

    A stretch ends ``gap`` after its last turn.  It is given out, and its state dropped, once the watermark (``lateness``
    behind the newest turn) has passed that end; until then late turns still join or bridge stretches.
    """
    timed = turns.where(F.col(session).isNotNull()).withWatermark(ts, lateness)
    window = F.session_window(ts, gap)
    return timed.groupBy(window.alias("_stretch"), F.col(session)).agg(F.count(F.lit(1)).alias("n_turns")).select(
        session, F.col("_stretch.start").alias("started"), F.col("_stretch.end").alias("ended"), "n_turns"
    )


def run_to_table(stream: DataFrame, name: str) -> DataFrame:
    """Process everything available into parquet in the shared folder and read it back (append mode)."""
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    query = (
        stream.writeStream.outputMode("append").format("parquet")
        .option("path", f"{path}/data").option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/data")


def run_updates_to_table(
    stream: DataFrame, name: str, mode: str = "update", transform: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """As ``run_to_table`` for update or complete mode: one batch-numbered partition per trigger.

    ``transform`` is any batch function, for example end-to-end scoring, which joins and
    aggregates inside one trigger and therefore needs no stream state.
    """
    spark = stream.sparkSession
    path = scratch_path(spark, name)

    def save(batch: DataFrame, batch_id: int) -> None:
        # overwriting one partition per batch makes a replayed trigger harmless
        rows = batch if transform is None else transform(batch)
        rows.write.mode("overwrite").parquet(f"{path}/data/batch_id={batch_id}")

    query = (
        stream.writeStream.outputMode(mode).foreachBatch(save)
        .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{path}/data")
