"""Labelling: pools, proposed labels, two review chains and weak training labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake import brand_voice as B
from triagelake import fixed_values as V
from triagelake.functions.rules import any_of, matches
from triagelake.functions.text import clean_for_query, seeded_key, strip_negated, whitespace_tokens
from triagelake.operators.intents import by_priority, detect, detect_raw
from triagelake.operators.topn import top_n_per_group
from triagelake.operators.triage import outcome, risk_category, risk_reason

CASE_LABELS = ["intent", "decision", "escalation_category", "reason"]


def with_pools(df: DataFrame, text: str = "customer_text") -> DataFrame:
    """Add detected, intent, adversarial_reason and pool ('adversarial', 'collision' or the intent)."""
    t = F.col(text)
    out = df.withColumn("detected", detect_raw(t)).withColumn("intent", by_priority(F.col("detected")))
    r = B.ADVERSARIAL_REASONS
    reason = (
        F.when(matches(t, V.ADVERSARIAL_HOSTILE), F.lit(r["hostile"]))
        .when(F.size("detected") >= 3, F.concat(F.lit(r["collision"]), F.array_join("detected", ", ")))
        .when((F.size(whitespace_tokens(t)) <= 4) & (F.col("intent") == V.GENERAL_INTENT), F.lit(r["terse"]))
        .when(matches(t, V.ADVERSARIAL_SARCASM), F.lit(r["sarcasm"]))
    )
    return out.withColumn("adversarial_reason", reason).withColumn(
        "pool",
        F.when(F.col("adversarial_reason").isNotNull(), F.lit("adversarial"))
        .when(F.size("detected") == 2, F.lit("collision"))
        .otherwise(F.col("intent")),
    )


_OWN_CATEGORY = {
    "DAMAGED_WRONG_MISSING": "DAMAGED_PHYSICAL_MERCHANDISE",
    "ACCOUNT_SECURITY_ACCESS": "ACCOUNT_SECURITY_RISK",
    "BILLING_SUBSCRIPTION_PRIME": "FINANCIAL_OR_BILLING_DISPUTE",
}


def proposed_outcome(text: Column, intent: Column, tier: Column, risk: Column) -> Column:
    """struct<decision,escalation_category,reason> proposed for a case."""
    why = B.PROPOSAL_REASONS

    def auto(key):
        return outcome(V.AUTO, "NONE", why[key])

    def split(test, category, hit, miss):
        return F.when(test, outcome(V.ESCALATE, category, why[hit])).otherwise(auto(miss))

    chain = F.when(risk.isNotNull(), outcome(V.ESCALATE, risk, risk_reason(risk)))
    for name, category in _OWN_CATEGORY.items():
        chain = chain.when(intent == name, outcome(V.ESCALATE, category, why[name]))
    return (
        chain.when(
            intent == "DELIVERY_STATUS_DELAY",
            split(matches(text, V.PROPOSE_DELIVERY_LOSS), "LOST_OR_STOLEN_DELIVERY", "delivery_loss", "delivery_auto"),
        )
        .when(
            intent == "ORDER_CHANGE_CANCEL",
            split(matches(text, V.PROPOSE_DISPATCHED), "MANUAL_REFUND_OR_RETURN_OVERRIDE", "change_dispatched", "change_auto"),
        )
        .when(
            intent == "REFUND_RETURN_EXCHANGE",
            split(matches(text, V.PROPOSE_REFUND_OVERDUE), "MANUAL_REFUND_OR_RETURN_OVERRIDE", "refund_overdue", "refund_auto"),
        )
        .when(intent == "TECHNICAL_PRODUCT_SUPPORT", auto("technical_auto"))
        .otherwise(
            split(
                (tier == "adversarial") | matches(text, V.PROPOSE_HOSTILE),
                "CUSTOMER_AGITATION_OR_LEGAL_THREAT", "feedback_hostile", "feedback_auto",
            )
        )
    )


def with_proposal(df: DataFrame, text="customer_text", tier="difficulty_tier") -> DataFrame:
    """Add proposed_* columns and all_applicable_intents to rows that went through ``with_pools``."""
    out = df.withColumn("_risk", risk_category(F.col(text)))
    out = out.withColumn("_p", proposed_outcome(F.col(text), F.col("intent"), F.col(tier), F.col("_risk")))
    return (
        out.withColumn("proposed_intent", F.col("intent"))
        .withColumn("proposed_triage", F.col("_p.decision"))
        .withColumn("proposed_escalation_category", F.col("_p.escalation_category"))
        .withColumn("proposed_escalation_reason", F.col("_p.reason"))
        .withColumn(
            "all_applicable_intents",
            F.when(F.size("detected") > 0, F.col("detected")).otherwise(F.array(F.col("intent"))),
        )
        .drop("_p", "_risk")
    )


# --- review chains -----------------------------------------------------------------


def _change(rule: str, intent, decision, category, reason, changed) -> Column:
    def c(v):
        return v if isinstance(v, Column) else F.lit(v)

    return F.struct(
        F.lit(rule).alias("rule"), c(intent).alias("intent"), c(decision).alias("decision"),
        c(category).alias("escalation_category"), c(reason).alias("reason"), c(changed).alias("changed"),
    )


def _first_change(chain: list[tuple[Column, Column]], default: Column) -> Column:
    out = F.when(chain[0][0], chain[0][1])
    for test, value in chain[1:]:
        out = out.when(test, value)
    return out.otherwise(default)


def review_pass1(df: DataFrame, text="customer_text", tier="difficulty_tier", notes="annotation_notes") -> DataFrame:
    """Five ordered corrections.  The first matching one ends the chain, even when the
    label already agrees and nothing changes."""
    t, i = F.col(text), F.col("intent")
    d, c, r = F.col("decision"), F.col("escalation_category"), F.col("reason")
    why = B.PASS1_NOTES

    def fix(rule, when_intent, intent, decision, category, reason):
        hit = _change(rule, intent, decision, category, reason, True)
        same = _change(rule, i, d, c, r, False)
        return F.when(when_intent, hit).otherwise(same)

    general, damaged, billing = V.GENERAL_INTENT, "DAMAGED_WRONG_MISSING", "BILLING_SUBSCRIPTION_PRIME"
    chain = [
        (matches(t, V.PRAISE) & ~matches(t, V.NOT_PRAISE),
         fix("praise", i != general, general, V.AUTO, "NONE", why["praise"])),
        (matches(t, V.PASS1_DELIVERED_MISSING),
         fix("missing", i != damaged, damaged, V.ESCALATE, "LOST_OR_STOLEN_DELIVERY", why["missing"])),
        (matches(t, V.PASS1_WALLET),
         fix("wallet", i != billing, billing, V.ESCALATE, "FINANCIAL_OR_BILLING_DISPUTE", why["wallet"])),
        (matches(t, V.PASS1_CHANGE) & ~matches(t, V.PASS1_RETURN_WORDS),
         fix("change", i != "ORDER_CHANGE_CANCEL", "ORDER_CHANGE_CANCEL", d, c, r)),
        (F.col(tier).isin("difficult", "adversarial")
         & matches(t, V.PASS1_REFUND_DEMAND) & matches(t, V.PASS1_LATENESS),
         fix("refund", i == "DELIVERY_STATUS_DELAY", "REFUND_RETURN_EXCHANGE", V.ESCALATE,
             "MANUAL_REFUND_OR_RETURN_OVERRIDE", why["refund"])),
    ]
    out = df.withColumn("_x", _first_change(chain, _change("none", i, d, c, r, False)))
    note = F.when(F.col("_x.changed"), F.concat(F.coalesce(F.col(notes), F.lit("")), F.lit(" [reviewed: "), F.col("_x.rule"), F.lit("]"))).otherwise(
        F.coalesce(F.col(notes), F.lit(""))
    )
    return _apply(out, notes, note).withColumn("human_verified", F.lit(True))


def review_pass2(
    df: DataFrame, text="customer_text", tier="difficulty_tier", notes="annotation_notes", annotator: str = "reviewer"
) -> DataFrame:
    """Nine ordered rules.  Rules 1-3 count every hit, 4-5 only real changes, 6-9 none."""
    t, i = F.col(text), F.col("intent")
    d, c = F.col("decision"), F.col("escalation_category")
    why = B.PASS2_REASONS
    low = F.lower(t)
    break_in = any_of([low.contains(p) for p in V.PASS2_BREAK_IN_PHRASES])
    general, damaged = V.GENERAL_INTENT, "DAMAGED_WRONG_MISSING"
    chain = [
        (matches(t, V.PASS2_MISCONDUCT),
         _change("misconduct", F.when(break_in, F.lit(general)).otherwise(i), V.ESCALATE,
                 "CUSTOMER_AGITATION_OR_LEGAL_THREAT", why["misconduct"], True)),
        (matches(t, V.PASS2_BLOCKED),
         _change("blocked", "ACCOUNT_SECURITY_ACCESS", V.ESCALATE, "ACCOUNT_SECURITY_RISK", why["blocked"], True)),
        (matches(t, V.PASS2_OVERDUE_REFUND),
         _change("refund", "REFUND_RETURN_EXCHANGE", V.ESCALATE, "MANUAL_REFUND_OR_RETURN_OVERRIDE", why["refund"], True)),
        (matches(t, V.PASS2_DELIVERED_MISSING),
         _change("missing", damaged, V.ESCALATE, "LOST_OR_STOLEN_DELIVERY", why["missing"],
                 (i != damaged) | (d != V.ESCALATE))),
        (matches(t, V.PRAISE) & ~matches(t, V.NOT_PRAISE),
         _change("praise", general, V.AUTO, "NONE", why["praise"], (i != general) | (d != V.AUTO))),
        (matches(t, V.PASS2_CHANGE),
         _change("change", "ORDER_CHANGE_CANCEL", V.AUTO, "NONE", why["change"], False)),
        (matches(t, V.PASS2_CHARGE),
         _change("charge", "BILLING_SUBSCRIPTION_PRIME", V.ESCALATE, "FINANCIAL_OR_BILLING_DISPUTE", why["charge"], False)),
        ((i == "DELIVERY_STATUS_DELAY") & (d == V.AUTO), _change("delivery", i, d, c, why["delivery"], False)),
        (i == "TECHNICAL_PRODUCT_SUPPORT", _change("technical", i, d, c, why["technical"], False)),
    ]
    fallback = F.concat(F.lit(why["fallback"]), i, F.lit(". Triage: "), d, F.lit("."))
    out = df.withColumn("_x", _first_change(chain, _change("fallback", i, d, c, fallback, False)))
    note = F.concat(F.lit("Reviewed tier: "), F.col(tier), F.lit("."))
    return (
        _apply(out, notes, note)
        .withColumn("human_annotator", F.lit(annotator))
        .withColumn("verification_status", F.lit("verified"))
    )


def _apply(df: DataFrame, notes: str, note: Column) -> DataFrame:
    out = df.withColumn("_note", note)
    for name in CASE_LABELS:
        out = out.withColumn(name, F.col(f"_x.{name}"))
    return (
        out.withColumn("rule", F.col("_x.rule"))
        .withColumn("changed", F.col("_x.changed"))
        .withColumn(notes, F.col("_note"))
        .drop("_x", "_note")
    )


def change_counts(reviewed: DataFrame) -> DataFrame:
    """Rows and counted changes per rule."""
    return reviewed.groupBy("rule").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("changed").cast("long")).alias("n_changed")
    )


# --- weak labels ----------------------------------------------------------------------


def weak_labels(df: DataFrame, id_col: str, text: str, per_class: int = V.TRAIN_PER_CLASS) -> DataFrame:
    """(id, text, label): rule labels on cleaned texts, at most n rows per class by id order."""
    labelled = (
        df.select(F.col(id_col).alias("id"), F.col(text).alias("_t"))
        .withColumn("_d", detect(F.col("_t")))
        .where(F.size("_d") > 0)
        .select("id", clean_for_query(strip_negated(F.col("_t"))).alias("text"), by_priority(F.col("_d")).alias("label"))
    )
    return top_n_per_group(labelled, ["label"], [F.col("id")], per_class).drop("rank")


def weak_labels_sampled(df: DataFrame, id_col: str, text: str, n: int = V.BASELINE_SAMPLE, seed: int = V.SEED) -> DataFrame:
    """(id, text, label) for a seeded sample; undetected rows get the general label."""
    base = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    sample = base.orderBy(seeded_key(seed, F.col("id")), "id").limit(n)
    return sample.withColumn("label", by_priority(detect(F.col("text"))))
