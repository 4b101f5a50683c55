"""Sessions, admission and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import duck as D
from bindings import inputs as I
from bindings.queries_text import requests
from bindings.registry import query
from triagelake import brand_voice as B
from triagelake import fixed_values as V
from triagelake.operators import admission, intake, sessions
from triagelake.sources import readers
from triagelake.streaming import streams

_ASKS = D.contains_any("lower(reply)", V.FOLLOW_UP_CUES)
# walks every session turn by turn with the previous stored turn as the state
_CHAT = [
    ("steps", f"""SELECT CAST(conv_id AS VARCHAR) AS session_id, turn, text, intent, intent_confidence, decision, escalation_category, reason, reply,
        {_ASKS} AS asks, {D.rx('text', V.ORDER_NUMBER)} AS has_order, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM scored"""),
]
_WALK = f"""walk(session_id, n, turn, text, intent, intent_confidence, decision, escalation_category, reason, reply, asks, follow_up) AS (
    SELECT session_id, n, turn, text, intent, intent_confidence, decision, escalation_category, reason, reply, asks, false FROM steps WHERE n = 1
    UNION ALL SELECT s.session_id, s.n, s.turn, s.text,
      CASE WHEN w.asks AND s.has_order THEN w.intent ELSE s.intent END,
      CASE WHEN w.asks AND s.has_order THEN {V.FOLLOW_UP_CONFIDENCE}::DOUBLE ELSE s.intent_confidence END,
      CASE WHEN w.asks AND s.has_order THEN 'ESCALATE' ELSE s.decision END,
      CASE WHEN w.asks AND s.has_order THEN w.escalation_category ELSE s.escalation_category END,
      CASE WHEN w.asks AND s.has_order THEN {D.q(B.POLICY_REASONS['follow_up'])} ELSE s.reason END,
      CASE WHEN w.asks AND s.has_order THEN {D.q(B.FOLLOW_UP_REPLY)} ELSE s.reply END,
      CASE WHEN w.asks AND s.has_order THEN false ELSE s.asks END, w.asks AND s.has_order
    FROM walk w JOIN steps s ON w.session_id = s.session_id AND s.n = w.n + 1)"""


def _chat_sql(select):
    return D.with_("scored", extra=_CHAT).replace("WITH ", "WITH RECURSIVE ", 1) + ", " + _WALK + " " + select


_CHAT_SELECT = """SELECT session_id, turn, intent, intent_confidence, decision, escalation_category, reason, reply, n > 1 AS multi_turn, follow_up FROM walk"""
_CHAT_COLS = ["session_id", "turn", "intent", "intent_confidence", "decision", "escalation_category", "reason", "reply", "multi_turn", "follow_up"]


def _session_rows(scored):
    return scored.withColumn("session_id", F.col("conv_id").cast("string")).withColumn("message", F.col("text"))


@query("follow_ups", _chat_sql(_CHAT_SELECT))
def follow_ups(spark, d):
    # three turns per chunk: even these short sessions cross chunk borders
    return sessions.apply_follow_ups(_session_rows(I.scored(spark, d)), chunk_rows=3).select(*_CHAT_COLS)


_SENT = f"{D.strings(I.REPLIES)}[(conv_id*5 + turn) % {len(I.REPLIES)} + 1]"
_FOLLOWS = f"(turn % 4 <> 0 AND {D.contains_any(f'lower({_SENT})', V.FOLLOW_UP_CUES)} AND {D.rx('text', V.ORDER_NUMBER)})"


@query("client_history", D.with_("scored") + f"""SELECT msg_id, {_FOLLOWS} AS follow_up, turn % 4 <> 0 AS multi_turn,
    CASE WHEN {_FOLLOWS} THEN CASE WHEN conv_id % 2 = 0 THEN 'REFUND_RETURN_EXCHANGE' ELSE 'DELIVERY_STATUS_DELAY' END ELSE intent END AS intent,
    CASE WHEN {_FOLLOWS} THEN CASE WHEN conv_id % 2 = 0 THEN 0.5::DOUBLE ELSE 0.95::DOUBLE END ELSE intent_confidence END AS intent_confidence,
    CASE WHEN {_FOLLOWS} THEN 'ACCOUNT_SPECIFIC_PII_REQUIRED' ELSE escalation_category END AS escalation_category FROM scored""")
def client_history(spark, d):
    reply = I._pick(I.REPLIES, F.col("conv_id") * 5 + F.col("turn"))
    full = F.create_map(F.lit("agent_reply"), reply, F.lit("intent"), F.lit("REFUND_RETURN_EXCHANGE"), F.lit("intent_confidence"), F.lit("0.5"))
    bare = F.create_map(F.lit("agent_reply"), reply)
    history = F.when(F.col("turn") % 4 != 0, F.array(F.when(F.col("conv_id") % 2 == 0, full).otherwise(bare)))
    out = sessions.apply_client_history(I.scored(spark, d).withColumn("history", history), message="text")
    return out.select("msg_id", "follow_up", "multi_turn", "intent", "intent_confidence", "escalation_category")


@query("session_tail", D.with_("inbox") + """SELECT conv_id, turn, age FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS age FROM inbox) WHERE age <= 3""")
def session_tail(spark, d):
    out = sessions.last_turns(I.inbox(spark, d), "conv_id", "turn", 3)
    return out.select("conv_id", "turn", F.col("age").cast("long").alias("age"))


_STORED = f"{D.escape(D.mask('text'))} || '|' || {D.escape('reply')} || '|' || intent || '|' || escalation_category"


@query("session_table", _chat_sql(f"""SELECT session_id, count(*) AS n_turns, md5(string_agg(v, '#' ORDER BY turn)) AS turns FROM (
    SELECT session_id, turn, {_STORED} AS v, row_number() OVER (PARTITION BY session_id ORDER BY turn DESC) AS age FROM walk) WHERE age <= 3 GROUP BY ALL"""))
def session_table(spark, d):
    chat = sessions.apply_follow_ups(_session_rows(I.scored(spark, d)))
    return _table_digest(sessions.session_table(chat, n=3))


def _table_digest(t):
    one = F.transform("turns", lambda x: F.concat_ws("|", x["customer"], x["agent_reply"], x["intent"], x["escalation_category"]))
    return t.select("session_id", F.size("turns").cast("long").alias("n_turns"), F.md5(F.array_join(one, "#")).alias("turns"))


@query("recent_sessions", "SELECT user_id, max(ts) AS last_active, count(*) AS n_turns FROM events GROUP BY ALL ORDER BY 2 DESC, 1 LIMIT 100")
def recent_sessions(spark, d):
    return sessions.recent_sessions(I.table(spark, d, "events"), "user_id", "ts", 100)


@query("session_gauge", D.with_("inbox", "pairs") + """SELECT count(DISTINCT conv_id) AS session_count, (SELECT count(*) FROM pairs) AS kb_size FROM inbox""")
def session_gauge(spark, d):
    return sessions.gauge(I.inbox(spark, d), "conv_id", I.pairs(spark, d))


_ADMISSION = """WITH RECURSIVE ev AS MATERIALIZED (SELECT user_id, event_id, ts, epoch_us(ts) AS t,
      row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
    w(user_id, n, event_id, ts, stamps, admitted) AS (
      SELECT user_id, n, event_id, ts, [t], true FROM ev WHERE n = 1
      UNION ALL SELECT e.user_id, e.n, e.event_id, e.ts,
        CASE WHEN len(kept) < 3 THEN list_append(kept, e.t) ELSE kept END, len(kept) < 3
      FROM (SELECT w.user_id, w.n, e.t AS t2, list_filter(w.stamps, lambda s: s >= e.t - 21600000000) AS kept
            FROM w JOIN ev e ON e.user_id = w.user_id AND e.n = w.n + 1) x
      JOIN ev e ON e.user_id = x.user_id AND e.n = x.n + 1)
    SELECT user_id, event_id, {ts}admitted FROM w"""


@query("admission_log", _ADMISSION.replace("{ts}", "ts, "))
def admission_log(spark, d):
    return admission.admission_log(I.table(spark, d, "events"), "user_id", "ts", "event_id", limit=3, window_seconds=6 * 3600)


# --- streams ---------------------------------------------------------------------------------


def _inbox_stream(spark, d):
    return I.inbox_of(readers.turn_stream(spark, d))


@query("stream_triage", D.with_("triaged") + "SELECT msg_id, intent, decision, escalation_category FROM triaged")
def stream_triage(spark, d):
    scored = streams.triage_stream(I.classified_of(_inbox_stream(spark, d)), "clean")
    return streams.run_to_table(scored.select("msg_id", "intent", "decision", "escalation_category"), "stream-triage")


@query("stream_chat", _chat_sql(_CHAT_SELECT))
def stream_chat(spark, d):
    out = streams.chat_stream(_session_rows(I.scored_of(_inbox_stream(spark, d))), idle=None)
    return streams.run_to_table(out, "stream-chat").select(*_CHAT_COLS)


@query("stream_sessions", D.with_("scored") + f"""SELECT session_id, count(*) AS n_turns, md5(string_agg(v, '#' ORDER BY turn)) AS turns FROM (
    SELECT CAST(conv_id AS VARCHAR) AS session_id, turn, {_STORED} AS v, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS age FROM scored)
    WHERE age <= 3 GROUP BY ALL""")
def stream_sessions(spark, d):
    rows = streams.session_stream(_session_rows(I.scored_of(_inbox_stream(spark, d))), max_turns=3, idle=None)
    updates = streams.run_updates_to_table(rows, "stream-sessions")
    # update mode emits a session once per trigger; the last one counts
    newest = updates.groupBy("session_id").agg(F.max_by("turns", "batch_id").alias("turns"))
    return _table_digest(newest)


@query("stream_admission", _ADMISSION.replace("{ts}", ""))
def stream_admission(spark, d):
    out = streams.admission_stream(readers.event_stream(spark, d), "user_id", "ts", "event_id", limit=3, window_seconds=6 * 3600, idle=None)
    return streams.run_to_table(out, "stream-admission").select(
        F.col("key").cast("long").alias("user_id"), F.col("id").alias("event_id"), "admitted"
    )


_RESPONSES = """SELECT session_id, turn, intent, intent_confidence, decision, escalation_category, {reply} AS reply, multi_turn, follow_up, md5(past_reply) AS evidence FROM (
    SELECT w.*, n > 1 AS multi_turn, s.past_reply FROM walk w JOIN scored s ON w.session_id = CAST(s.conv_id AS VARCHAR) AND w.turn = s.turn WHERE s.conv_id % 5 <> 0)
  UNION ALL SELECT NULL, turn, intent, intent_confidence, decision, escalation_category, {reply}, false, false, md5(past_reply) FROM scored WHERE conv_id % 5 = 0"""


@query("stream_chat_responses", _chat_sql(_RESPONSES.replace("{reply}", D.escape("reply"))))
def stream_chat_responses(spark, d):
    """Every fifth conversation comes without a session; each reply is escaped and has its evidence."""
    rows = _session_rows(I.scored_of(_inbox_stream(spark, d))).withColumn("session_id", F.when(F.col("conv_id") % 5 != 0, F.col("session_id")))
    hit = F.struct(F.col("msg_id").cast("string").alias("conversation_id"), "similarity", F.col("past_reply").alias("support_reply"), F.col("text").alias("customer_text"))
    out = streams.run_to_table(streams.chat_responses(rows.withColumn("evidence", F.array(hit)), idle=None), "stream-responses")
    return out.select(
        "session_id", "turn", "intent", "intent_confidence", "decision", "escalation_category", "reply", "multi_turn", "follow_up",
        F.md5(F.col("evidence")[0]["support_reply"]).alias("evidence"),
    )


@query("stream_activity", """WITH e AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh, event_id FROM events WHERE user_id IS NOT NULL),
    s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM e),
    w AS (SELECT user_id, min(ts) AS started, max(ts) + INTERVAL 30 MINUTE AS ended, count(*) AS n_turns FROM s GROUP BY user_id, n)
    SELECT user_id, epoch_us(started) AS started, epoch_us(ended) AS ended, n_turns FROM w WHERE ended <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def stream_activity(spark, d):
    events = readers.event_stream(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    out = streams.run_to_table(streams.session_activity(events, "user_id", "ts"), "stream-activity")
    return out.select("user_id", F.unix_micros("started").alias("started"), F.unix_micros("ended").alias("ended"), "n_turns")


@query("stream_dedup", "SELECT event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_dedup(spark, d):
    s = readers.event_stream(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    twice = s.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    once = streams.first_delivery(twice, "ts", ["event_id"], "10 minutes")
    return streams.run_to_table(once.select("event_id", "event_type"), "stream-dedup").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("stream_gauge", D.with_("inbox") + "SELECT CAST(conv_id AS VARCHAR) AS session_id, count(*) AS n_turns FROM inbox GROUP BY ALL")
def stream_gauge(spark, d):
    rows = _inbox_stream(spark, d).withColumn("session_id", F.col("conv_id").cast("string"))
    updates = streams.run_updates_to_table(streams.active_sessions(rows), "stream-gauge", "complete")
    return updates.groupBy("session_id").agg(F.max_by("n_turns", "batch_id").alias("n_turns"))


@query("answerable_queries", D.with_("inbox") + """SELECT msg_id FROM inbox WHERE (conv_id + turn) % 11 <> 0""")
def answerable_queries(spark, d):
    return intake.answerable(requests(spark, d), "message").select("msg_id")
