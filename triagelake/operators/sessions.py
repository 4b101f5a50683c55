"""Session history: follow-ups, bounded turns, recent sessions and gauges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triagelake import brand_voice as B
from triagelake import fixed_values as V
from triagelake.functions.pii import mask_pii
from triagelake.functions.rules import contains_any
from triagelake.functions.text import has_order_number, html_escape
from triagelake.operators.topn import carry_forward, top_n_per_group
from triagelake.session import cut_lineage


def asks_for_order(reply: Column) -> Column:
    """The reply asked for an order number or for a direct message."""
    return contains_any(F.lower(reply), V.FOLLOW_UP_CUES)


def stored_turn(message: Column, reply: Column, intent: Column, category: Column) -> Column:
    """The turn a session keeps: masked and escaped texts plus the labels."""
    return F.struct(
        html_escape(mask_pii(message)).alias("customer"),
        html_escape(reply).alias("agent_reply"),
        intent.alias("intent"),
        category.alias("escalation_category"),
    )


def apply_follow_ups(
    scored: DataFrame, session="session_id", turn="turn", message="message", chunk_rows: int = 10_000
) -> DataFrame:
    """Override scored rows that answer a request for an order number.

    A row is a candidate when it carries an order number and the reply drafted for the turn before
    asked for one.  The fixed follow-up reply asks for nothing, so in a run of candidates
    only every second row, starting with the first, is a follow-up: the recursion
    over the session becomes the parity of the distance to the last non-candidate.
    Intent and category come from the turn before; its confidence is not kept.

    Sessions may be of any length (see ``carry_forward``); rows without one are stateless.
    """
    c = F.col
    stateless = scored.where(c(session).isNull()).withColumn("multi_turn", F.lit(False)).withColumn("follow_up", F.lit(False))
    # scored once; the passes below read only keys, flags and labels from the written table
    known = cut_lineage(
        scored.where(c(session).isNotNull())
        .withColumn("_asks", asks_for_order(c("reply")))
        .withColumn("_order", has_order_number(c(message))),
        "scored-turns",
    )
    narrow = known.select(session, turn, "_asks", "_order", c("intent").alias("_i"), c("escalation_category").alias("_c"))
    before = F.struct(c("_asks").alias("asks"), c("_i").alias("intent"), c("_c").alias("category"))
    prev = carry_forward(narrow, [session], turn, {"_prev": before}, chunk_rows)
    cand = prev.select(session, turn, "_prev", F.coalesce(c("_prev.asks") & c("_order"), F.lit(False)).alias("_cand"))
    marks = _alternate_candidates(cand, session, turn, chunk_rows)
    out = known.join(marks, [session, turn]).withColumn("multi_turn", c("_prev").isNotNull())
    f = c("follow_up")
    changes = {
        "intent": c("_prev.intent"),
        "intent_confidence": F.lit(V.FOLLOW_UP_CONFIDENCE),
        "decision": F.lit(V.ESCALATE),
        "escalation_category": c("_prev.category"),
        "reason": F.lit(B.POLICY_REASONS["follow_up"]),
        "reply": F.lit(B.FOLLOW_UP_REPLY),
    }
    for name, value in changes.items():
        out = out.withColumn(name, F.when(f, value).otherwise(c(name)))
    if "evidence" in out.columns:
        out = out.withColumn("evidence", F.when(~f, c("evidence")))
    return out.drop("_prev", "_asks", "_order").unionByName(stateless)


def _alternate_candidates(cand: DataFrame, session: str, turn: str, chunk_rows: int) -> DataFrame:
    """Add ``follow_up``: candidates at odd distance from the last non-candidate of their session.

    Positions count from the start of the session: the chunk's offset plus the rank inside the
    chunk; offsets and the last non-candidate before a chunk come from one row per chunk.
    """
    c = F.col
    inside = Window.partitionBy(session, "_ch").orderBy(turn)
    local = (
        cand.withColumn("_ch", F.floor(c(turn) / F.lit(chunk_rows)))
        .withColumn("_r", F.row_number().over(inside))
        .withColumn("_n", F.max(F.when(~c("_cand"), c("_r"))).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    )
    per_chunk = local.groupBy(session, "_ch").agg(F.max("_r").alias("_m"), F.max("_n").alias("_x"))
    earlier = Window.partitionBy(session).orderBy("_ch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_chunk.withColumn("_off", F.coalesce(F.sum("_m").over(earlier), F.lit(0)))
    offsets = offsets.withColumn("_before", F.last(c("_off") + c("_x"), ignorenulls=True).over(earlier))
    placed = local.join(offsets.select(session, "_ch", "_off", "_before"), [session, "_ch"])
    distance = c("_off") + c("_r") - F.coalesce(c("_off") + c("_n"), c("_before"))
    return placed.withColumn("follow_up", c("_cand") & (F.pmod(distance, F.lit(2)) == 1)).select(
        session, turn, "_prev", "follow_up"
    )


def apply_client_history(scored: DataFrame, history: str = "history", message: str = "message") -> DataFrame:
    """The follow-up rule for requests that bring their own history (array of string maps).

    A sent history replaces the stored one, so the rule is row-local.  Labels missing in its last
    turn get fixed defaults; rows without history keep their outcome.
    """
    c = F.col
    size = F.coalesce(F.size(history), F.lit(0))
    out = scored.withColumn("_last", F.when(size > 0, F.element_at(history, F.when(size > 0, -1).otherwise(1))))

    def sent(name: str) -> Column:
        return F.get(F.map_values(F.map_filter("_last", lambda k, _: k == name)), F.lit(0))

    asked = asks_for_order(F.coalesce(sent("agent_reply"), F.lit("")))
    out = out.withColumn("follow_up", F.coalesce((size > 0) & asked & has_order_number(c(message)), F.lit(False)))
    f = c("follow_up")
    confidence = F.coalesce(sent("intent_confidence").try_cast("double"), F.lit(V.FOLLOW_UP_CONFIDENCE))
    changes = {
        "intent": F.coalesce(sent("intent"), F.lit("DELIVERY_STATUS_DELAY")),
        "intent_confidence": F.round(confidence, 4),
        "decision": F.lit(V.ESCALATE),
        "escalation_category": F.coalesce(sent("escalation_category"), F.lit("ACCOUNT_SPECIFIC_PII_REQUIRED")),
        "reason": F.lit(B.POLICY_REASONS["follow_up"]),
        "reply": F.lit(B.FOLLOW_UP_REPLY),
    }
    for name, value in changes.items():
        out = out.withColumn(name, F.when(f, value).otherwise(c(name)))
    if "evidence" in out.columns:
        out = out.withColumn("evidence", F.when(~f, c("evidence")))
    return out.withColumn("multi_turn", size > 0).drop("_last")


def last_turns(df: DataFrame, session="session_id", turn="turn", n: int = V.SESSION_TURNS) -> DataFrame:
    """The n latest turns of every session; ``age`` 1 is the newest."""
    return top_n_per_group(df.where(F.col(session).isNotNull()), [session], [F.desc(turn)], n, rank="age")


def session_table(df: DataFrame, session="session_id", turn="turn", n: int = V.SESSION_TURNS) -> DataFrame:
    """(session, turns): at most n stored turns per session, oldest first."""
    kept = last_turns(df, session, turn, n)
    value = stored_turn(F.col("message"), F.col("reply"), F.col("intent"), F.col("escalation_category"))
    packed = kept.select(session, F.struct(F.col(turn).alias("turn"), value.alias("v")).alias("_t"))
    return packed.groupBy(session).agg(F.transform(F.sort_array(F.collect_list("_t")), lambda t: t["v"]).alias("turns"))


def recent_sessions(df: DataFrame, session: str, ts: str, n: int = V.SESSION_LIMIT) -> DataFrame:
    """The n most recently active sessions."""
    return (
        df.groupBy(session)
        .agg(F.max(ts).alias("last_active"), F.count(F.lit(1)).alias("n_turns"))
        .orderBy(F.desc("last_active"), session)
        .limit(n)
    )


def gauge(sessions: DataFrame, session: str, kb: DataFrame) -> DataFrame:
    """One row: active sessions and knowledge-base size."""
    active = sessions.where(F.col(session).isNotNull()).agg(F.count_distinct(session).alias("session_count"))
    return active.withColumn("kb_size", kb.agg(F.count(F.lit(1))).scalar())
