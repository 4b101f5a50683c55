"""Brand scorecard, reply graph and topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import duck as D
from bindings import inputs as I
from bindings.registry import query
from triagelake import fixed_values as V
from triagelake.operators import brand_audit, metrics, reply_graph, topics

_PAIRS = ("prs", """SELECT b.author_id, b.message_id AS reply_id, b.parent_id AS message_id, b.text AS reply_text, b.response_id, p.text AS customer_text
    FROM msgs b JOIN msgs p ON b.parent_id = p.message_id WHERE NOT b.inbound""")
_MENTIONS = ("men", " UNION ALL ".join(
    f"SELECT '{b}' AS author_id, message_id, text FROM msgs WHERE inbound AND contains(lower(text), '@{b}')" for b in I.BRANDS))
_REPLIED = ("rep", """SELECT DISTINCT b.author_id, b.parent_id AS message_id FROM msgs b JOIN msgs p ON b.parent_id = p.message_id
    WHERE NOT b.inbound AND p.inbound""")


def _pct(test, digits=1):
    return f"round(avg(CAST({test} AS DOUBLE)) * 100, {digits})"


@query("reply_pairs", D.with_("msgs", extra=[_PAIRS]) + """SELECT author_id, reply_id, message_id, md5(customer_text) AS customer_digest,
    md5(reply_text) AS reply_digest FROM prs""")
def reply_pairs(spark, d):
    return reply_graph.brand_pairs(I.messages(spark, d)).select(
        "author_id", "reply_id", "message_id", F.md5("customer_text").alias("customer_digest"), F.md5("reply_text").alias("reply_digest")
    )


@query("replied_customers", D.with_("msgs", extra=[_REPLIED]) + "SELECT author_id, message_id FROM rep")
def replied_customers(spark, d):
    return reply_graph.replied_customers(I.messages(spark, d)).select("author_id", "message_id")


@query("reach_count", D.with_("msgs", extra=[_REPLIED, _MENTIONS]) + """SELECT author_id, count(DISTINCT message_id) AS usable_customer_messages FROM (
    SELECT author_id, message_id FROM rep UNION ALL SELECT author_id, message_id FROM men) GROUP BY ALL""")
def reach_count(spark, d):
    return reply_graph.reach(I.messages(spark, d), I.BRANDS)


@query("reply_rates", D.with_("msgs", extra=[_PAIRS]) + f"""SELECT author_id, count(*) AS usable_pairs, round(avg(length(reply_text)), 1) AS avg_reply_length,
    {_pct(D.rx('reply_text', V.GRAPH_REDIRECT))} AS dm_redirect_rate, {_pct(D.rx('reply_text', V.GRAPH_ACTIONABLE))} AS actionable_reply_rate,
    {_pct('response_id IS NOT NULL')} AS multi_turn_pct FROM prs GROUP BY ALL""")
def reply_rates(spark, d):
    return reply_graph.reply_rates(reply_graph.brand_pairs(I.messages(spark, d)))


_ENTROPY = """SELECT {by}, count(*) AS vocab_size, round(log2(sum(c)) - sum(c * log2(c)) / sum(c), {digits}) AS {name} FROM (
    SELECT {by}, token, count(*) AS c FROM {source} GROUP BY ALL) GROUP BY ALL"""
_MTOK = f"unnest(list_filter(string_split({D.squeeze('text')}, ' '), lambda w: length(w) > 3 AND NOT starts_with(w, '@') AND NOT starts_with(w, 'http')))"


@query("mention_measures", D.with_("msgs", extra=[_MENTIONS, ("tok", f"SELECT author_id, lower({_MTOK}) AS token FROM men"),
    ("ent", _ENTROPY.format(by="author_id", source="tok", digits=2, name="vocab_entropy"))]) + f"""SELECT m.*, e.vocab_entropy, e.vocab_size FROM (
    SELECT author_id, round(avg(length(text)), 1) AS avg_cust_len, {_pct('length(text) < 20')} AS short_junk_pct,
      {_pct(D.rx('text', V.GRAPH_RISK))} AS high_risk_pct FROM men GROUP BY ALL) m JOIN ent e ON m.author_id = e.author_id""")
def mention_measures(spark, d):
    return reply_graph.mention_measures(reply_graph.mention_rows(I.messages(spark, d), I.BRANDS))


@query("outbound_volume", D.with_("msgs") + "SELECT author_id, count(*) AS n FROM msgs WHERE NOT inbound GROUP BY ALL")
def outbound_volume(spark, d):
    return reply_graph.outbound_volume(I.messages(spark, d))


@query("reply_graph_audit", D.with_("msgs", extra=[_PAIRS, _REPLIED, _MENTIONS]) + f"""SELECT v.author_id, v.outbound_messages, r.usable_customer_messages,
    p.usable_pairs, p.multi_turn_pct, s.first_pairs FROM
    (SELECT author_id, count(*) AS outbound_messages FROM msgs WHERE NOT inbound GROUP BY ALL) v
    JOIN (SELECT author_id, count(DISTINCT message_id) AS usable_customer_messages FROM (
        SELECT author_id, message_id FROM rep UNION ALL SELECT author_id, message_id FROM men) GROUP BY ALL) r USING (author_id)
    JOIN (SELECT author_id, count(*) AS usable_pairs, {_pct('response_id IS NOT NULL')} AS multi_turn_pct FROM prs GROUP BY ALL) p USING (author_id)
    JOIN (SELECT author_id, md5(string_agg(customer_text || '|' || reply_text, '#' ORDER BY reply_id)) AS first_pairs FROM (
        SELECT *, row_number() OVER (PARTITION BY author_id ORDER BY reply_id) AS rn FROM prs) WHERE rn <= 5 GROUP BY ALL) s USING (author_id)""")
def reply_graph_audit(spark, d):
    out = reply_graph.audit(I.messages(spark, d), I.BRANDS)
    texts = F.array_join(F.transform("sample_pairs", lambda p: F.concat_ws("|", p["customer_text"], p["reply_text"])), "#")
    return out.select(
        "author_id", "outbound_messages", "usable_customer_messages", "usable_pairs", "multi_turn_pct", F.md5(texts).alias("first_pairs")
    )


# --- scorecard ---------------------------------------------------------------------------


_TTOK = ("tok", f"SELECT brand, unnest({D.letters_of('customer_text', 3)}) AS token FROM threads")


@query("vocab_entropy", D.with_("threads", extra=[_TTOK]) + _ENTROPY.format(by="brand", source="tok", digits=4, name="entropy"))
def vocab_entropy(spark, d):
    from triagelake.functions.text import letter_tokens

    t = I.turn_threads(spark, d).select("brand", F.explode(letter_tokens(F.col("customer_text"), 3)).alias("token"))
    return brand_audit.token_entropy(t, ["brand"]).select("brand", "vocab_size", F.round("entropy", 4).alias("entropy"))


@query("thread_richness", D.with_("threads") + f"""SELECT brand, count(*) AS n, {_pct('turn_count >= 3', 2)} AS multi_turn_pct,
    round(avg(turn_count), 2) AS avg_turns FROM threads GROUP BY ALL""")
def thread_richness(spark, d):
    return brand_audit.thread_richness(I.turn_threads(spark, d))


_RES, _RED = D.rx("support_reply", V.AUDIT_RESOLUTION), D.rx("support_reply", V.AUDIT_REDIRECT)
_MEASURES = [
    _TTOK,
    ("ent", _ENTROPY.format(by="brand", source="tok", digits=2, name="vocab_entropy")),
    ("rates", f"""SELECT brand, count(*) AS total_conversations, {_pct(_RES, 2)} AS resolution_cov_pct, {_pct(f'({_RED} AND NOT {_RES})', 2)} AS dm_only_pct,
        {_pct('turn_count >= 3', 2)} AS multi_turn_pct, round(avg(turn_count), 2) AS avg_turns,
        round(sum(coalesce(length(customer_text), 0))::DOUBLE / count(*), 1) AS avg_cust_char_len,
        avg(CAST(coalesce(length(customer_text) < 20, false) AS DOUBLE)) * 100 AS junk, avg(CAST({D.rx('customer_text', V.AUDIT_RISK)} AS DOUBLE)) * 100 AS risk
        FROM threads GROUP BY ALL"""),
    ("meas", """SELECT r.* EXCLUDE (junk, risk), e.vocab_entropy, e.vocab_size, round(junk, 2) AS junk_pct, round(greatest(0, 100 - junk * 1.5), 1) AS data_quality_score,
        round(risk, 1) AS high_risk_escalation_pct, round(100 - abs(risk - 35) * 2.0, 1) AS diff_balance_score FROM rates r JOIN ent e USING (brand)"""),
]
_W = V.SCORECARD_WEIGHTS


SCORECARD_SQL = f"""SELECT * EXCLUDE (u, dv, t), round(u, 1) AS usable_conv_score, round(dv, 1) AS diversity_score,
    round(t, 1) AS thread_richness_score, round({_W['usable_conversations']} * u + {_W['resolution_coverage']} * resolution_cov_pct + {_W['issue_diversity']} * dv
      + {_W['thread_richness']} * t + {_W['data_quality']} * data_quality_score + {_W['evaluation_difficulty']} * diff_balance_score, 2) AS composite_score
    FROM (SELECT *, ln(total_conversations) / ln(max(total_conversations) OVER ()) * 100 AS u,
      (vocab_entropy - min(vocab_entropy) OVER ()) / (max(vocab_entropy) OVER () - min(vocab_entropy) OVER () + 1e-5) * 40 + 60 AS dv,
      (multi_turn_pct - min(multi_turn_pct) OVER ()) / (max(multi_turn_pct) OVER () - min(multi_turn_pct) OVER () + 1e-5) * 40 + 60 AS t FROM meas)"""


@query("brand_scorecard", D.with_("threads", extra=_MEASURES) + SCORECARD_SQL)
def brand_scorecard(spark, d):
    return brand_audit.scorecard(brand_audit.brand_measures(I.turn_threads(spark, d))).drop("sample_size")


@query("value_shares", "SELECT lang, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 1)::DOUBLE AS pct FROM documents GROUP BY lang")
def value_shares(spark, d):
    return metrics.value_shares(I.table(spark, d, "documents"), "lang")


@query("thread_samples", D.with_("threads") + f"""SELECT brand, conversation_id, sample_no FROM (
    SELECT *, row_number() OVER (PARTITION BY brand ORDER BY p) AS sample_no FROM (
      SELECT *, row_number() OVER (PARTITION BY brand ORDER BY {D.seeded('conversation_id')}, conversation_id) AS p FROM threads)
    WHERE p <= 15 AND turn_count >= 2) WHERE sample_no <= 3""")
def thread_samples(spark, d):
    out = brand_audit.sample_threads(I.turn_threads(spark, d))
    return out.select("brand", "conversation_id", F.col("sample_no").cast("long").alias("sample_no"))


# --- topics ----------------------------------------------------------------------------------


_TOPIC = D.labels([(n, D.rx(D.clean_topic("text"), p)) for n, p in V.TOPIC_PATTERNS])
_TOPICS = [("tp", f"SELECT msg_id, topics, coalesce(topics[1], 'UNMATCHED') AS topic FROM (SELECT msg_id, {_TOPIC} AS topics FROM inbox WHERE {D.english('text', V.ENGLISH_WORDS_TOPICS, 25)})")]


def _topics(spark, d):
    return topics.with_topics(topics.qualifying(I.inbox(spark, d), "text"), "text")


@query("topic_distribution", D.with_("inbox", extra=_TOPICS) + """SELECT topic, count(*) AS n, count(*) FILTER (len(topics) > 1) AS n_collisions,
    round(count(*) * 100.0 / sum(count(*)) OVER (), 1)::DOUBLE AS pct FROM tp GROUP BY topic""")
def topic_distribution(spark, d):
    return topics.distribution(_topics(spark, d))


@query("topic_samples", D.with_("inbox", extra=_TOPICS) + """SELECT sample_group, msg_id, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY sample_group ORDER BY msg_id) AS rank FROM (
      SELECT topic AS sample_group, msg_id FROM tp UNION ALL SELECT 'COLLISION', msg_id FROM tp WHERE len(topics) > 1))
    WHERE rank <= CASE WHEN sample_group IN ('COLLISION', 'UNMATCHED') THEN 10 ELSE 5 END""")
def topic_samples(spark, d):
    out = topics.samples(_topics(spark, d), "msg_id")
    return out.select("sample_group", "msg_id", F.col("rank").cast("long").alias("rank"))
