"""Intents, risk, triage, drafts, rubric and overlap."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import duck as D
from bindings import inputs as I
from bindings.registry import query
from triagelake import brand_voice as B
from triagelake import fixed_values as V
from triagelake.functions.rules import RulePack
from triagelake.functions.text import clean_for_query, signature, strip_negated
from triagelake.operators.rule_tables import match_rules
from triagelake.operators import intents, overlap, replies, rubric, triage


def _joined(col):
    return F.array_join(col, ",")


@query("intents_multi", D.with_("found") + "SELECT msg_id, array_to_string(detected, ',') AS detected FROM found")
def intents_multi(spark, d):
    return I.inbox(spark, d).select("msg_id", _joined(intents.detect(clean_for_query(F.col("text")))).alias("detected"))


@query("intents_raw", D.with_("found") + "SELECT msg_id, array_to_string(raw_detected, ',') AS detected FROM found")
def intents_raw(spark, d):
    return I.inbox(spark, d).select("msg_id", _joined(intents.detect_raw(clean_for_query(F.col("text")))).alias("detected"))


@query("intent_priority", D.with_("found") + f"SELECT {D.priority('detected')} AS intent, count(*) AS n FROM found GROUP BY ALL")
def intent_priority(spark, d):
    df = intents.with_intents(I.inbox(spark, d).withColumn("clean", clean_for_query(F.col("text"))), "clean")
    return df.groupBy("intent").agg(F.count(F.lit(1)).alias("n"))


_STRIP = D.sub(D.sub("text", V.NEGATED_BILLING, "", "gi"), V.NEGATED_REFUND, "", "gi")


@query("negation_strip", D.with_("inbox") + f"SELECT msg_id, {_STRIP} AS stripped FROM inbox")
def negation_strip(spark, d):
    return I.inbox(spark, d).select("msg_id", strip_negated(F.col("text")).alias("stripped"))


_RULES = [(i, name, pat) for i, (name, pat) in enumerate(V.TOPIC_PATTERNS)]
_VALUES = ", ".join(f"({i}, {D.q(n)}, {D.q(p)})" for i, n, p in _RULES)


@query("rule_table_join", D.with_("inbox") + f""", rules(position, label, pattern) AS (VALUES {_VALUES})
    SELECT label, count(*) AS n FROM inbox JOIN rules ON regexp_matches(text, pattern, 'i') GROUP BY ALL""")
def rule_table_join(spark, d):
    rules = spark.createDataFrame(_RULES, "position int, label string, pattern string")
    pack = RulePack.from_table(rules)
    return I.inbox(spark, d).select(F.explode(pack.all_labels(F.col("text"))).alias("label")).groupBy("label").agg(
        F.count(F.lit(1)).alias("n")
    )


_WORDS = """words AS MATERIALIZED (SELECT DISTINCT word FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS word FROM conversations))"""


@query("rule_index_join", D.with_("inbox") + ", " + _WORDS + """ SELECT word AS rule, msg_id FROM words JOIN (SELECT msg_id, lower(text) || ' ' AS t FROM inbox)
    ON contains(t, ' ' || word || ' ') OR contains(t, ' ' || word || 's ') OR contains(t, ' ' || word || 'ed ')
      OR contains(t, ' the ' || word || ',') OR contains(t, ' the ' || word || '.')""")
def rule_index_join(spark, d):
    """As many rules as the conversations have words, each with a suffix and an alternative, against every message."""
    words = I.turn_rows(spark, d).select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), F.lit(0))).alias("rule")).distinct()
    rules = words.withColumn("pattern", F.concat(F.lit(" ("), "rule", F.lit("(s|ed)? |the "), "rule", F.lit("[.,])")))
    box = I.inbox(spark, d).select("msg_id", F.concat("text", F.lit(" ")).alias("text"))
    return match_rules(box, rules, "msg_id")


@query("risk_category", D.with_("found") + f"SELECT msg_id, coalesce({D.risk('clean')}, 'NONE') AS category FROM found")
def risk_category(spark, d):
    t = clean_for_query(F.col("text"))
    return I.inbox(spark, d).select("msg_id", F.coalesce(triage.risk_category(t), F.lit("NONE")).alias("category"))


@query("triage_cascade", D.with_("triaged") + "SELECT msg_id, intent, intent_confidence, decision, escalation_category, reason FROM triaged")
def triage_cascade(spark, d):
    out = triage.with_triage(I.classified_of(I.inbox(spark, d)), "clean")
    return out.select("msg_id", "intent", "intent_confidence", "decision", "escalation_category", "reason")


@query("intent_hybrid", D.with_("classified") + """SELECT msg_id, intent, intent_confidence, round(list_sum(posterior), 6) AS total FROM classified""")
def intent_hybrid(spark, d):
    total = F.aggregate("posterior", F.lit(0.0), lambda a, v: a + v)
    return I.classified_of(I.inbox(spark, d)).select("msg_id", "intent", "intent_confidence", F.round(total, 6).alias("total"))


def _pred_sql(system):
    return D.with_("preds") + f"""SELECT case_id, pred_intent AS intent, pred_decision AS decision, reply, intent_confidence FROM preds
        WHERE system = '{system}'"""


@query("baseline_constant", _pred_sql("constant"))
def baseline_constant(spark, d):
    return I.predictions(spark, d)["constant"].select("case_id", "intent", "decision", "reply", "intent_confidence")


@query("baseline_keyword", _pred_sql("keyword"))
def baseline_keyword(spark, d):
    return I.predictions(spark, d)["keyword"].select("case_id", "intent", "decision", "reply", "intent_confidence")


# --- replies -------------------------------------------------------------------------


@query("reply_cues", D.with_("cued") + """SELECT msg_id, similarity, cue_signature, coalesce(cue_carrier, '-') AS cue_carrier, cue_neighbour FROM cued""")
def reply_cues(spark, d):
    return I.scored(spark, d).select(
        "msg_id", "similarity", "cue_signature", F.coalesce("cue_carrier", F.lit("-")).alias("cue_carrier"), "cue_neighbour"
    )


@query("reply_draft", D.with_("drafted") + "SELECT msg_id, draft FROM drafted")
def reply_draft(spark, d):
    c = F.col
    raw = replies.draft(
        c("clean"), c("intent"), c("decision"), c("escalation_category"), c("cue_signature"), c("cue_carrier"), c("cue_neighbour")
    )
    return I.scored(spark, d).select("msg_id", raw.alias("draft"))


@query("reply_sanitized", D.with_("pairs", extra=[("m", f"SELECT conversation_id, {D.sanitize('support_reply')} AS m FROM pairs")]) + f"""SELECT
    conversation_id, {D.add_signoff('m')} AS reply FROM m""")
def reply_sanitized(spark, d):
    return I.pairs(spark, d).select("conversation_id", replies.sanitize(F.col("support_reply")).alias("reply"))


@query("signatures", D.with_("pairs") + f"SELECT {D.signature('support_reply')} AS signature, count(*) AS n FROM pairs GROUP BY ALL")
def signatures(spark, d):
    return I.pairs(spark, d).groupBy(signature(F.col("support_reply")).alias("signature")).agg(F.count(F.lit(1)).alias("n"))


_R = D.rubric("reply", "pred_intent", "pred_decision")
_RUBRIC_COLS = ", ".join(f"{sql} AS {name}" for name, sql in _R.items())
RATED = [("rated", f"SELECT *, {_RUBRIC_COLS} FROM evals"), ("passed", f"SELECT *, {D.HUNDREDTHS} / 100.0::DOUBLE AS overall_score, {D.PASSED} AS passed FROM rated")]


def rated(spark, d):
    return rubric.with_scores(I.evaluation(spark, d), "reply", "pred_intent", "pred_decision")


@query("rubric_scores", D.with_("evals", extra=RATED) + """SELECT system, case_id, groundedness::BIGINT AS groundedness, tone::BIGINT AS tone,
    actionability::BIGINT AS actionability, pii_safety::BIGINT AS pii_safety, overall_score, passed FROM passed""")
def rubric_scores(spark, d):
    ints = [F.col(c).cast("long").alias(c) for c in ("groundedness", "tone", "actionability", "pii_safety")]
    return rated(spark, d).select("system", "case_id", *ints, "overall_score", "passed")


@query("rubric_pass_rate", D.with_("evals", extra=RATED) + """SELECT system, count(*) AS n, round(avg(passed::INT), 4) AS pass_rate FROM passed GROUP BY ALL""")
def rubric_pass_rate(spark, d):
    return rubric.pass_rate(rated(spark, d), ["system"])


@query("solicitation_rate", D.with_("pairs") + f"""SELECT brand, count(*) AS n, round(avg(CAST({D.rx('support_reply', V.SOLICIT_VERB_THEN_CREDENTIAL)}
    AND NOT {D.rx('support_reply', V.DO_NOT_SHARE)} AS INT)), 4) AS rate FROM pairs GROUP BY ALL""")
def solicitation_rate(spark, d):
    bad = replies.solicits_credentials(F.col("support_reply"))
    return I.pairs(spark, d).groupBy("brand").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(bad.cast("double")), 4).alias("rate")
    )


# --- overlap ------------------------------------------------------------------------------

_TOK = ("tok", f"SELECT conversation_id AS id, {D.tokens_of('customer_text')} AS h, {D.tokens_of('support_reply')} AS r FROM pairs")


def _ngram_cte(n):
    if n == 1:
        h, r = "h", "r"
    else:
        h = "CASE WHEN len(h) >= 2 THEN list_transform(range(1, len(h)), lambda i: h[i] || ' ' || h[i+1]) ELSE CAST([] AS VARCHAR[]) END"
        r = h.replace("len(h)", "len(r)").replace("h[i]", "r[i]").replace("h[i+1]", "r[i+1]")
    return [
        (f"hg{n}", f"SELECT id, g, count(*) AS c FROM (SELECT id, unnest({h}) AS g FROM tok) GROUP BY ALL"),
        (f"rg{n}", f"SELECT id, g, count(*) AS c FROM (SELECT id, unnest({r}) AS g FROM tok) GROUP BY ALL"),
        (f"ov{n}", f"""SELECT tok.id, coalesce(s.shared, 0)::DOUBLE / greatest(coalesce(t.total, 0), 1) AS p FROM tok
            LEFT JOIN (SELECT a.id, sum(least(a.c, b.c)) AS shared FROM hg{n} a JOIN rg{n} b ON a.id = b.id AND a.g = b.g GROUP BY 1) s ON tok.id = s.id
            LEFT JOIN (SELECT id, sum(c) AS total FROM hg{n} GROUP BY 1) t ON tok.id = t.id"""),
    ]


@query("ngram_precision", D.with_("pairs", extra=[_TOK, *_ngram_cte(1), *_ngram_cte(2)]) + """SELECT a.id AS conversation_id,
    round(a.p, 6) AS precision_1, round(b.p, 6) AS precision_2 FROM ov1 a JOIN ov2 b ON a.id = b.id""")
def ngram_precision(spark, d):
    p = I.pairs(spark, d)
    one = overlap.ngram_precision(p, "conversation_id", "customer_text", "support_reply", 1)
    two = overlap.ngram_precision(p, "conversation_id", "customer_text", "support_reply", 2)
    return one.join(two, "conversation_id").select(
        "conversation_id", F.round("ngram_precision_1", 6).alias("precision_1"), F.round("ngram_precision_2", 6).alias("precision_2")
    )


# one dynamic-programming row per token of h: list_reduce walks the tokens of r
_LCS = (
    D.with_("pairs", extra=[_TOK]).replace("WITH ", "WITH RECURSIVE ", 1)
    + """, lcs(id, i, dp) AS (SELECT id, 0, list_transform(r, lambda x: 0) FROM tok
    UNION ALL SELECT l.id, l.i + 1, list_reduce(list_transform(range(1, len(t.r) + 1), lambda j: {'row': [0], 'j': j}),
        lambda acc, x: {'row': list_append(acc.row, CASE WHEN t.h[l.i + 1] = t.r[x.j]
            THEN (CASE WHEN x.j > 1 THEN l.dp[x.j - 1] ELSE 0 END) + 1
            ELSE greatest(l.dp[x.j], acc.row[len(acc.row)]) END), 'j': x.j}, {'row': [0], 'j': 0::BIGINT}).row[2:]
    FROM lcs l JOIN tok t ON l.id = t.id WHERE l.i < len(t.h))
    SELECT id AS conversation_id, CASE WHEN c = 0 THEN 0.0::DOUBLE ELSE round(2 * (c / m) * (c / n) / (c / m + c / n), 6) END AS rouge_l FROM (
      SELECT l.id, coalesce(l.dp[len(l.dp)], 0)::DOUBLE AS c, len(t.h)::DOUBLE AS m, len(t.r)::DOUBLE AS n FROM lcs l JOIN tok t ON l.id = t.id WHERE l.i = len(t.h))"""
)


@query("rouge_l", _LCS)
def rouge_l(spark, d):
    out = overlap.with_rouge_l(I.pairs(spark, d), "customer_text", "support_reply")
    return out.select("conversation_id", F.round("rouge_l", 6).alias("rouge_l"))
