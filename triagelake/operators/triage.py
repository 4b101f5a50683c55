"""Triage: confidence gate, risk rules, human requests and per-intent policies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake import brand_voice as B
from triagelake import fixed_values as V
from triagelake.functions.rules import RulePack, matches

RISK_PACK = RulePack.of(V.RISK_PATTERNS)


def outcome(decision, category, reason) -> Column:
    def as_col(v):
        return v if isinstance(v, Column) else F.lit(v)

    return F.struct(
        as_col(decision).alias("decision"), as_col(category).alias("escalation_category"), as_col(reason).alias("reason")
    )


@dataclass(frozen=True)
class PolicyRow:
    """One line of a policy: fires when every pattern occurs (no pattern: always)."""

    decision: str
    category: str
    reason: str
    patterns: tuple[str, ...] = ()


P = B.POLICY_REASONS
POLICIES: dict[str, tuple[PolicyRow, ...]] = {
    "ACCOUNT_SECURITY_ACCESS": (PolicyRow(V.ESCALATE, "ACCOUNT_SECURITY_RISK", P["security"]),),
    "BILLING_SUBSCRIPTION_PRIME": (PolicyRow(V.ESCALATE, "FINANCIAL_OR_BILLING_DISPUTE", P["billing"]),),
    "DAMAGED_WRONG_MISSING": (
        PolicyRow(V.ESCALATE, "LOST_OR_STOLEN_DELIVERY", P["damaged_delivery"], (V.DAMAGED_DELIVERY,)),
        PolicyRow(V.ESCALATE, "DAMAGED_PHYSICAL_MERCHANDISE", P["damaged_goods"]),
    ),
    "DELIVERY_STATUS_DELAY": (
        PolicyRow(V.ESCALATE, "LOST_OR_STOLEN_DELIVERY", P["delivery_loss"], (V.DELIVERY_LOSS,)),
        PolicyRow(V.AUTO, "NONE", P["delivery_auto"]),
    ),
    "ORDER_CHANGE_CANCEL": (
        PolicyRow(
            V.ESCALATE, "LOST_OR_STOLEN_DELIVERY", P["change_dispatched"], (V.ORDER_DISPATCHED, V.WRONG_ADDRESS)
        ),
        PolicyRow(V.ESCALATE, "MANUAL_REFUND_OR_RETURN_OVERRIDE", P["change_dispatched"], (V.ORDER_DISPATCHED,)),
        PolicyRow(V.AUTO, "NONE", P["change_auto"]),
    ),
    "REFUND_RETURN_EXCHANGE": (
        PolicyRow(V.ESCALATE, "MANUAL_REFUND_OR_RETURN_OVERRIDE", P["refund_overdue"], (V.REFUND_DELAY,)),
        PolicyRow(V.AUTO, "NONE", P["refund_auto"]),
    ),
    "TECHNICAL_PRODUCT_SUPPORT": (PolicyRow(V.AUTO, "NONE", P["technical_auto"]),),
    "FEEDBACK_COMPLAINT_GENERAL": (
        PolicyRow(V.ESCALATE, "CUSTOMER_AGITATION_OR_LEGAL_THREAT", P["feedback_hostile"], (V.HOSTILITY,)),
        PolicyRow(V.AUTO, "NONE", P["feedback_auto"]),
    ),
}


def policy_outcome(
    text: Column, intent: Column, policies: dict[str, tuple[PolicyRow, ...]] = POLICIES, default: str = V.GENERAL_INTENT
) -> Column:
    """The first policy row that fires; an unknown intent uses the default policy."""

    def run(rows):
        chain = None
        for row in rows:
            value = outcome(row.decision, row.category, row.reason)
            if not row.patterns:
                return value if chain is None else chain.otherwise(value)
            test = matches(text, row.patterns[0])
            for extra in row.patterns[1:]:
                test = test & matches(text, extra)
            chain = F.when(test, value) if chain is None else chain.when(test, value)
        return chain

    branches = [(name, rows) for name, rows in policies.items() if name != default]
    chain = F.when(intent == branches[0][0], run(branches[0][1]))
    for name, rows in branches[1:]:
        chain = chain.when(intent == name, run(rows))
    return chain.otherwise(run(policies[default]))


def risk_category(text: Column, pack: RulePack = RISK_PACK) -> Column:
    """First matching risk category, null when none fires."""
    return pack.first_label(text)


def risk_reason(category: Column) -> Column:
    before, after = B.RISK_REASON.split("{category}")
    return F.concat(F.lit(before), F.replace(F.lower(category), F.lit("_"), F.lit(" ")), F.lit(after))


def triage(
    text: Column,
    intent: Column,
    confidence: Column,
    policies: dict[str, tuple[PolicyRow, ...]] = POLICIES,
    gate: float = V.CONFIDENCE_GATE,
    gate_first: bool = True,
    category: Column | None = None,
) -> Column:
    """struct<decision,escalation_category,reason>.

    ``gate_first=False`` lets the risk rules decide before the confidence gate.
    ``category`` may name a column that already holds the risk category.
    """
    if category is None:
        category = risk_category(text)
    low = F.when(
        confidence < gate,
        outcome(
            V.ESCALATE,
            "AMBIGUOUS_INQUIRY_NEEDS_CLARIFICATION",
            F.concat(F.lit(B.GATE_REASON[0]), F.format_number(confidence, 2), F.lit(B.GATE_REASON[1])),
        ),
    )
    risk = F.when(category.isNotNull(), outcome(V.ESCALATE, category, risk_reason(category)))
    human = F.when(
        matches(text, V.HUMAN_REQUEST), outcome(V.ESCALATE, "CUSTOMER_AGITATION_OR_LEGAL_THREAT", B.HUMAN_REASON)
    )
    policy = policy_outcome(text, intent, policies)
    return F.coalesce(*([low, risk, human, policy] if gate_first else [risk, human, low, policy]))


def with_triage(df: DataFrame, text="text", intent="intent", confidence="intent_confidence", **options) -> DataFrame:
    # the risk pack is the costly part: project it once, then only refer to it
    out = df.withColumn("_risk", risk_category(F.col(text)))
    found = triage(F.col(text), F.col(intent), F.col(confidence), category=F.col("_risk"), **options)
    return out.withColumn("_o", found).select(*df.columns, "_o.decision", "_o.escalation_category", "_o.reason")


def constant_baseline(df: DataFrame, brand: str, majority: str = V.INTENTS[0]) -> DataFrame:
    """The same answer for every message."""
    return (
        df.withColumn("intent", F.lit(majority))
        .withColumn("intent_confidence", F.lit(0.5))
        .withColumn("decision", F.lit(V.AUTO))
        .withColumn("escalation_category", F.lit("NONE"))
        .withColumn("reason", F.lit(B.POLICY_REASONS["constant"]))
        .withColumn("reply", F.lit(B.CONSTANT_REPLY.replace("{brand}", brand)))
    )


def keyword_baseline(df: DataFrame, text: str = "text", top_reply: str = "top_reply") -> DataFrame:
    """One keyword pattern decides; the reply is the best past reply, or a default."""
    hit = matches(F.col(text), V.KEYWORD_ESCALATE)
    return (
        df.withColumn("decision", F.when(hit, F.lit(V.ESCALATE)).otherwise(F.lit(V.AUTO)))
        .withColumn("escalation_category", F.when(hit, F.lit("ACCOUNT_SPECIFIC_PII_REQUIRED")).otherwise(F.lit("NONE")))
        .withColumn(
            "reason",
            F.when(hit, F.lit(B.POLICY_REASONS["keyword_hit"])).otherwise(F.lit(B.POLICY_REASONS["keyword_miss"])),
        )
        .withColumn("reply", F.coalesce(F.col(top_reply), F.lit(B.KEYWORD_DEFAULT_REPLY)))
    )
