"""Metrics, reports, failure buckets, labelling and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import duck as D
from bindings import inputs as I
from bindings.queries_rules import RATED, rated
from bindings.registry import query
from triagelake import brand_voice as B
from triagelake import fixed_values as V
from triagelake.functions.text import sequence_id
from triagelake.operators import failures, labelling, metrics, sampling

_LABELS = "(VALUES " + ", ".join(f"('{x}')" for x in I.LANGS) + ")"
_INTENT_LABELS = "(VALUES " + ", ".join(f"('{x}')" for x in V.INTENTS) + ")"


@query("confusion", D.with_("langs") + f"""SELECT 'guess' AS system, g.l AS gold_intent, p.l AS pred_intent, count(x.doc_id) AS n
    FROM {_LABELS} g(l) CROSS JOIN {_LABELS} p(l) LEFT JOIN langs x ON x.gold_intent = g.l AND x.pred_intent = p.l GROUP BY ALL""")
def confusion(spark, d):
    return metrics.confusion(metrics.cells(I.doc_language(spark, d)), I.LANGS)


@query("confusion_matrix", D.with_("langs") + "SELECT 'guess' AS system, gold_intent, " + ", ".join(
    f"count(*) FILTER (pred_intent = '{x}') AS {x}" for x in I.LANGS) + " FROM langs GROUP BY ALL")
def confusion_matrix(spark, d):
    return metrics.confusion_matrix(metrics.cells(I.doc_language(spark, d)), I.LANGS)


def _prf(source, by, label_values):
    """(by, label, tp, predicted, support, precision, recall, f1)."""
    return f"""SELECT *, CASE WHEN predicted > 0 THEN tp::DOUBLE / predicted ELSE 0 END AS precision,
        CASE WHEN support > 0 THEN tp::DOUBLE / support ELSE 0 END AS recall,
        CASE WHEN predicted + support > 0 THEN 2.0::DOUBLE * tp / (predicted + support) ELSE 0 END AS f1 FROM (
        SELECT {by}, v.l AS label, count(*) FILTER (gold_intent = v.l AND pred_intent = v.l) AS tp,
          count(*) FILTER (pred_intent = v.l) AS predicted, count(*) FILTER (gold_intent = v.l) AS support
        FROM {source} CROSS JOIN {label_values} v(l) GROUP BY ALL)"""


@query("class_prf", D.with_("langs", extra=[("prf", _prf("langs", "system", _LABELS))]) + """SELECT system, label, support,
    round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1 FROM prf""")
def class_prf(spark, d):
    out = metrics.class_scores(metrics.cells(I.doc_language(spark, d)), I.LANGS)
    return out.select("system", "label", "support", *[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1")])


@query("macro_prf", D.with_("evals", extra=[("prf", _prf("evals", "system", _INTENT_LABELS))]) + """SELECT system, round(avg(precision), 4) AS macro_precision,
    round(avg(recall), 4) AS macro_recall, round(avg(f1), 4) AS macro_f1 FROM prf GROUP BY ALL""")
def macro_prf(spark, d):
    return metrics.macro_scores(metrics.cells(I.evaluation(spark, d)), V.INTENTS)


@query("accuracy", D.with_("langs") + "SELECT system, count(*) AS count, round(avg(CAST(gold_intent = pred_intent AS INT)), 4) AS accuracy FROM langs GROUP BY ALL")
def accuracy(spark, d):
    return metrics.accuracy(metrics.cells(I.doc_language(spark, d)))


_COUNTS = """SELECT system, count(*) FILTER (gold_decision = 'ESCALATE' AND pred_decision = 'ESCALATE') AS tp,
    count(*) FILTER (gold_decision = 'AUTO_HANDLE' AND pred_decision = 'ESCALATE') AS fp,
    count(*) FILTER (gold_decision = 'AUTO_HANDLE' AND pred_decision = 'AUTO_HANDLE') AS tn,
    count(*) FILTER (gold_decision = 'ESCALATE' AND pred_decision = 'AUTO_HANDLE') AS fn FROM evals GROUP BY ALL"""


def _rate(num, den):
    return f"round(CASE WHEN {den} > 0 THEN ({num})::DOUBLE / ({den}) ELSE 0 END, 4)"


_RATES = f"""SELECT *, {_rate('tp + tn', 'tp + fp + tn + fn')} AS triage_accuracy, {_rate('tp', 'tp + fp')} AS escalation_precision,
    {_rate('tp', 'tp + fn')} AS escalation_recall, {_rate('tn', 'tn + fn')} AS safe_auto_precision,
    {_rate('fn', 'tp + fn')} AS missed_escalation_rate, {_rate('fp', 'tn + fp')} AS false_escalation_rate FROM counts"""
TRIAGE_RATES_SQL = D.with_("evals", extra=[("counts", _COUNTS)]) + _RATES


@query("triage_rates", TRIAGE_RATES_SQL)
def triage_rates(spark, d):
    return metrics.triage_rates(metrics.triage_counts(metrics.cells(I.evaluation(spark, d))))


_TIERS = [
    ("lev", "SELECT system, tier, gold_intent, pred_intent FROM evals UNION ALL SELECT system, 'overall', gold_intent, pred_intent FROM evals"),
    ("prf", _prf("lev", "system, tier", _INTENT_LABELS)),
]


@query("tier_breakdown", D.with_("evals", extra=_TIERS) + """SELECT a.system, a.tier, a.count, a.accuracy, f.macro_f1 FROM
    (SELECT system, tier, count(*) AS count, round(avg(CAST(gold_intent = pred_intent AS INT)), 4) AS accuracy FROM lev GROUP BY ALL) a
    JOIN (SELECT system, tier, round(avg(f1), 4) AS macro_f1 FROM prf WHERE predicted + support > 0 GROUP BY ALL) f
    ON a.system = f.system AND a.tier = f.tier""")
def tier_breakdown(spark, d):
    return metrics.tier_breakdown(metrics.cells(I.evaluation(spark, d)))


_METRICS = ["triage_accuracy", "escalation_precision", "escalation_recall", "safe_auto_precision", "missed_escalation_rate", "false_escalation_rate"]
_REPORT = [
    ("counts", _COUNTS), ("rates", _RATES), ("prf", _prf("evals", "system", _INTENT_LABELS)),
    ("report", "SELECT system, 'macro_f1' AS metric, round(avg(f1), 4) AS value FROM prf GROUP BY ALL" + "".join(
        f" UNION ALL SELECT system, '{m}', {m} FROM rates" for m in _METRICS)
     + " UNION ALL SELECT system, 'accuracy', round(avg(CAST(gold_intent = pred_intent AS INT)), 4) FROM evals GROUP BY ALL"),
]


@query("system_comparison", D.with_("evals", extra=_REPORT) + "SELECT metric, " + ", ".join(
    f"max(value) FILTER (system = '{s}') AS {s}" for s in I.SYSTEMS) + " FROM report GROUP BY ALL")
def system_comparison(spark, d):
    c = metrics.cells(I.evaluation(spark, d))
    scope, label = F.lit("headline"), F.lit("")
    report = (
        metrics.long_report(metrics.macro_scores(c, V.INTENTS), scope, label, ["macro_f1"])
        .unionByName(metrics.long_report(metrics.accuracy(c), scope, label, ["accuracy"]))
        .unionByName(metrics.long_report(metrics.triage_rates(metrics.triage_counts(c)), scope, label, _METRICS))
    )
    return metrics.side_by_side(report, I.SYSTEMS).drop("scope", "label")


@query("ece", D.with_("evals") + """SELECT sum(n)::BIGINT AS n, round(sum(n * abs(mc - sc)) / sum(n), 6) AS ece FROM (
    SELECT least(floor(intent_confidence * 10), 9) AS b, count(*) AS n, avg(intent_confidence) AS mc, avg(CAST(gold_intent = pred_intent AS DOUBLE)) AS sc
    FROM evals WHERE system = 'hybrid' GROUP BY 1)""")
def ece(spark, d):
    e = I.evaluation(spark, d).where(F.col("system") == "hybrid")
    e = e.withColumn("correct", F.col("gold_intent") == F.col("pred_intent"))
    return metrics.expected_calibration_error(e, "intent_confidence", "correct")


_BUCKETED = [*RATED, ("buck", """SELECT system, case_id, unnest(list_filter([
    CASE WHEN gold_decision = 'ESCALATE' AND pred_decision = 'AUTO_HANDLE' THEN 'missed_escalations' END,
    CASE WHEN gold_decision = 'AUTO_HANDLE' AND pred_decision = 'ESCALATE' THEN 'false_escalations' END,
    CASE WHEN tier = 'difficult' AND len(all_applicable_intents) >= 2 THEN 'multi_intent_borderline' END,
    CASE WHEN tier = 'adversarial' THEN 'adversarial_edge_cases' END,
    CASE WHEN NOT passed THEN 'reply_quality_failures' END], lambda x: x IS NOT NULL)) AS bucket FROM passed WHERE system = 'hybrid'""")]


@query("failure_buckets", D.with_("evals", extra=_BUCKETED) + "SELECT bucket, count(*) AS n FROM buck GROUP BY ALL")
def failure_buckets(spark, d):
    return failures.bucket_counts(rated(spark, d).where(F.col("system") == "hybrid"))


@query("failure_samples", D.with_("evals", extra=_BUCKETED) + """SELECT bucket, case_id, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY case_id) AS rank FROM buck) WHERE rank <= 3""")
def failure_samples(spark, d):
    out = failures.bucket_samples(rated(spark, d).where(F.col("system") == "hybrid"), "case_id", 3)
    return out.select("bucket", "case_id", F.col("rank").cast("long").alias("rank"))


# --- labelling ---------------------------------------------------------------------------


@query("candidate_pools", D.with_("gold") + "SELECT case_id, pool, coalesce(adversarial_reason, '-') AS adversarial_reason FROM gold")
def candidate_pools(spark, d):
    return I.gold(spark, d).select("case_id", "pool", F.coalesce("adversarial_reason", F.lit("-")).alias("adversarial_reason"))


_Q = V.QUOTAS
_LONG = D.strings(V.LONG_PICK_INTENTS)
_SEED = D.seeded("case_id")
_STRATA = [
    ("k", f"SELECT case_id, pool, length(customer_text) AS len, {_SEED} AS k FROM gold"),
    ("r", "SELECT *, row_number() OVER (PARTITION BY pool ORDER BY k, case_id) AS rank FROM k"),
    ("adv", f"SELECT case_id, row_number() OVER (ORDER BY rank, case_id) AS n FROM r WHERE pool = 'adversarial' AND rank <= {_Q['adversarial']}"),
    ("longs", f"""SELECT case_id, list_position({_LONG}, pool) AS o FROM (SELECT *, row_number() OVER (PARTITION BY pool ORDER BY case_id) AS rn
        FROM k WHERE len > {V.LONG_TEXT_CHARS} AND list_contains({_LONG}, pool)) WHERE rn = 1"""),
    ("hard", f"""SELECT case_id, row_number() OVER (ORDER BY step, o, case_id) AS n FROM (
        SELECT case_id, CASE WHEN rank <= {_Q['collisions']} THEN 0 ELSE 2 END AS step, rank AS o FROM r WHERE pool = 'collision'
        UNION ALL SELECT case_id, 1, o FROM longs) ORDER BY step, o, case_id LIMIT {_Q['difficult']}"""),
    ("rest", f"""SELECT *, row_number() OVER (PARTITION BY pool ORDER BY k, case_id) AS rn FROM r
        WHERE list_contains({D.strings(V.INTENTS)}, pool) AND case_id NOT IN (SELECT case_id FROM hard)"""),
    ("easy", f"""SELECT case_id, row_number() OVER (ORDER BY step, o, k, case_id) AS n FROM (SELECT case_id, k,
        CASE WHEN rn <= {_Q['per_intent']} THEN 0 ELSE 1 END AS step,
        CASE WHEN rn <= {_Q['per_intent']} THEN list_position({D.strings(V.INTENTS)}, pool) ELSE 0 END AS o FROM rest)
        ORDER BY step, o, k, case_id LIMIT {_Q['normal']}"""),
    ("chosen", """SELECT case_id, tier, row_number() OVER (ORDER BY tn, n) AS position FROM (
        SELECT case_id, 'normal' AS tier, 1 AS tn, n FROM easy UNION ALL SELECT case_id, 'difficult', 2, n FROM hard
        UNION ALL SELECT case_id, 'adversarial', 3, n FROM adv)"""),
]


@query("stratified_sample", D.with_("gold", extra=_STRATA) + "SELECT printf('CANDIDATE-%03d', position) AS id, case_id, tier AS difficulty_tier FROM chosen")
def stratified_sample(spark, d):
    pooled = I.gold(spark, d).drop("difficulty_tier")
    out = sampling.stratified_cases(pooled, "case_id")
    return out.select(sequence_id("CANDIDATE", F.col("position")).alias("id"), "case_id", "difficulty_tier")


@query("proposed_labels", D.with_("gold") + """SELECT case_id, proposed_intent, array_to_string(all_applicable_intents, ',') AS intents, difficulty_tier,
    proposed_triage, proposed_escalation_category, proposed_escalation_reason FROM gold""")
def proposed_labels(spark, d):
    return I.gold(spark, d).select(
        "case_id", "proposed_intent", F.array_join("all_applicable_intents", ",").alias("intents"), "difficulty_tier",
        "proposed_triage", "proposed_escalation_category", "proposed_escalation_reason",
    )


def _struct(rule, i, dd, c, r, changed):
    return f"{{'rule': '{rule}', 'i': {i}, 'd': {dd}, 'c': {c}, 'r': {r}, 'changed': {changed}}}"


def _pass1():
    t, q, rx = "customer_text", D.q, D.rx
    same = lambda rule: _struct(rule, "i", "d", "c", "r", "false")
    why = B.PASS1_NOTES

    def fix(rule, cond, i, dd, c, r):
        return f"CASE WHEN {cond} THEN {_struct(rule, i, dd, c, r, 'true')} ELSE {same(rule)} END"

    G, D_, BI = q(V.GENERAL_INTENT), q("DAMAGED_WRONG_MISSING"), q("BILLING_SUBSCRIPTION_PRIME")
    E, A = q("ESCALATE"), q("AUTO_HANDLE")
    return f"""CASE WHEN {rx(t, V.PRAISE)} AND NOT {rx(t, V.NOT_PRAISE)} THEN {fix('praise', f'i <> {G}', G, A, q('NONE'), q(why['praise']))}
      WHEN {rx(t, V.PASS1_DELIVERED_MISSING)} THEN {fix('missing', f'i <> {D_}', D_, E, q('LOST_OR_STOLEN_DELIVERY'), q(why['missing']))}
      WHEN {rx(t, V.PASS1_WALLET)} THEN {fix('wallet', f'i <> {BI}', BI, E, q('FINANCIAL_OR_BILLING_DISPUTE'), q(why['wallet']))}
      WHEN {rx(t, V.PASS1_CHANGE)} AND NOT {rx(t, V.PASS1_RETURN_WORDS)} THEN {fix('change', "i <> 'ORDER_CHANGE_CANCEL'", q('ORDER_CHANGE_CANCEL'), 'd', 'c', 'r')}
      WHEN tier IN ('difficult', 'adversarial') AND {rx(t, V.PASS1_REFUND_DEMAND)} AND {rx(t, V.PASS1_LATENESS)}
        THEN {fix('refund', "i = 'DELIVERY_STATUS_DELAY'", q('REFUND_RETURN_EXCHANGE'), E, q('MANUAL_REFUND_OR_RETURN_OVERRIDE'), q(why['refund']))}
      ELSE {same('none')} END"""


def _pass2():
    t, q, rx = "customer_text", D.q, D.rx
    why = B.PASS2_REASONS
    E, A = q("ESCALATE"), q("AUTO_HANDLE")
    G, DM = q(V.GENERAL_INTENT), q("DAMAGED_WRONG_MISSING")
    low = D.contains_any(f"lower({t})", V.PASS2_BREAK_IN_PHRASES)
    return f"""CASE WHEN {rx(t, V.PASS2_MISCONDUCT)} THEN {_struct('misconduct', f'CASE WHEN {low} THEN {G} ELSE i END', E, q('CUSTOMER_AGITATION_OR_LEGAL_THREAT'), q(why['misconduct']), 'true')}
      WHEN {rx(t, V.PASS2_BLOCKED)} THEN {_struct('blocked', q('ACCOUNT_SECURITY_ACCESS'), E, q('ACCOUNT_SECURITY_RISK'), q(why['blocked']), 'true')}
      WHEN {rx(t, V.PASS2_OVERDUE_REFUND)} THEN {_struct('refund', q('REFUND_RETURN_EXCHANGE'), E, q('MANUAL_REFUND_OR_RETURN_OVERRIDE'), q(why['refund']), 'true')}
      WHEN {rx(t, V.PASS2_DELIVERED_MISSING)} THEN {_struct('missing', DM, E, q('LOST_OR_STOLEN_DELIVERY'), q(why['missing']), f'(i <> {DM} OR d <> {E})')}
      WHEN {rx(t, V.PRAISE)} AND NOT {rx(t, V.NOT_PRAISE)} THEN {_struct('praise', G, A, q('NONE'), q(why['praise']), f'(i <> {G} OR d <> {A})')}
      WHEN {rx(t, V.PASS2_CHANGE)} THEN {_struct('change', q('ORDER_CHANGE_CANCEL'), A, q('NONE'), q(why['change']), 'false')}
      WHEN {rx(t, V.PASS2_CHARGE)} THEN {_struct('charge', q('BILLING_SUBSCRIPTION_PRIME'), E, q('FINANCIAL_OR_BILLING_DISPUTE'), q(why['charge']), 'false')}
      WHEN i = 'DELIVERY_STATUS_DELAY' AND d = {A} THEN {_struct('delivery', 'i', 'd', 'c', q(why['delivery']), 'false')}
      WHEN i = 'TECHNICAL_PRODUCT_SUPPORT' THEN {_struct('technical', 'i', 'd', 'c', q(why['technical']), 'false')}
      ELSE {_struct('fallback', 'i', 'd', 'c', q(why['fallback']) + " || i || '. Triage: ' || d || '.'", 'false')} END"""


_NAMED = ("named", """SELECT case_id, customer_text, difficulty_tier AS tier, proposed_intent AS i, proposed_triage AS d,
    proposed_escalation_category AS c, proposed_escalation_reason AS r FROM gold""")
_P1 = ("p1", f"SELECT case_id, customer_text, tier, {_pass1()} AS x FROM named")
_P2 = ("p2", f"SELECT case_id, tier, {_pass2()} AS x FROM (SELECT case_id, customer_text, tier, x.i AS i, x.d AS d, x.c AS c, x.r AS r FROM p1)")
_OUT = "x.rule AS rule, x.i AS intent, x.d AS decision, x.c AS escalation_category, x.r AS reason, x.changed AS changed"


def _named(spark, d):
    return I.gold(spark, d).select(
        "case_id", "customer_text", "difficulty_tier", F.col("proposed_intent").alias("intent"), F.col("proposed_triage").alias("decision"),
        F.col("proposed_escalation_category").alias("escalation_category"), F.col("proposed_escalation_reason").alias("reason"),
        F.lit("").alias("annotation_notes"),
    )


_SHOW = ["case_id", "rule", "intent", "decision", "escalation_category", "reason", "changed", "annotation_notes"]


@query("relabel_pass1", D.with_("gold", extra=[_NAMED, _P1]) + f"""SELECT case_id, {_OUT},
    CASE WHEN x.changed THEN ' [reviewed: ' || x.rule || ']' ELSE '' END AS annotation_notes FROM p1""")
def relabel_pass1(spark, d):
    return labelling.review_pass1(_named(spark, d)).select(*_SHOW)


@query("relabel_pass2", D.with_("gold", extra=[_NAMED, _P1, _P2]) + f"""SELECT case_id, {_OUT}, 'Reviewed tier: ' || tier || '.' AS annotation_notes FROM p2""")
def relabel_pass2(spark, d):
    first = labelling.review_pass1(_named(spark, d)).drop("rule", "changed")
    return labelling.review_pass2(first).select(*_SHOW)


@query("relabel_counts", D.with_("gold", extra=[_NAMED, _P1, _P2]) + """SELECT pass, rule, count(*) AS n, sum(changed::INT)::BIGINT AS n_changed FROM (
    SELECT 1 AS pass, x.rule AS rule, x.changed AS changed FROM p1 UNION ALL SELECT 2, x.rule, x.changed FROM p2) GROUP BY ALL""")
def relabel_counts(spark, d):
    first = labelling.review_pass1(_named(spark, d))
    second = labelling.review_pass2(first.drop("rule", "changed"))
    return (
        labelling.change_counts(first).withColumn("pass", F.lit(1))
        .unionByName(labelling.change_counts(second).withColumn("pass", F.lit(2)))
    )


_STRIPPED = D.clean_query(D.sub(D.sub("text", V.NEGATED_BILLING, "", "gi"), V.NEGATED_REFUND, "", "gi"))


@query("weak_labels", D.with_("inbox") + f"""SELECT id, text, label FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY id) AS rn FROM (
      SELECT msg_id AS id, {_STRIPPED} AS text, {D.priority('det')} AS label FROM (SELECT *, {D.detect('text')} AS det FROM inbox) WHERE len(det) > 0))
    WHERE rn <= 20""")
def weak_labels(spark, d):
    return labelling.weak_labels(I.inbox(spark, d), "msg_id", "text", per_class=20)


@query("weak_labels_sampled", D.with_("inbox") + f"""SELECT id, text, {D.priority('det')} AS label FROM (
    SELECT msg_id AS id, text, {D.detect('text')} AS det FROM inbox ORDER BY {D.seeded('msg_id')}, msg_id LIMIT 100)""")
def weak_labels_sampled(spark, d):
    return labelling.weak_labels_sampled(I.inbox(spark, d), "msg_id", "text", n=100)


@query("sample_per_brand", D.with_("keyed") + f"""SELECT brand, conv_id FROM (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY {D.seeded('conv_id')}, conv_id) AS rn
    FROM (SELECT DISTINCT brand, conv_id FROM keyed)) WHERE rn <= 5""")
def sample_per_brand(spark, d):
    c = I.with_keys(I.table(spark, d, "conversations")).select("brand", "conv_id").distinct()
    return sampling.sample_per_group(c, ["brand"], "conv_id", 5)
