"""Intent, risk and triage rules on literal messages."""

import pytest
from pyspark.sql import functions as F

from triagelake import fixed_values as V
from triagelake.functions.rules import RulePack
from triagelake.operators import intents, triage


def run(spark, texts, build):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r[0] for r in df.orderBy("i").select(build(F.col("text"))).collect()]


def test_label_sets_are_complete():
    assert len(V.INTENTS) == len(set(V.INTENTS)) == 8
    assert sorted(V.INTENTS) == sorted(V.INTENT_PRIORITY)
    assert V.INTENT_PRIORITY[:2] == ["ACCOUNT_SECURITY_ACCESS", "DAMAGED_WRONG_MISSING"]
    assert V.INTENT_PRIORITY[-1] == V.GENERAL_INTENT
    assert len(V.ESCALATION_CATEGORIES) == 9


def test_priority_resolves_collisions(spark):
    df = spark.createDataFrame(
        [(["REFUND_RETURN_EXCHANGE", "ACCOUNT_SECURITY_ACCESS"],), (["DELIVERY_STATUS_DELAY", "DAMAGED_WRONG_MISSING"],), ([],)],
        "d array<string>",
    )
    got = [r[0] for r in df.select(intents.by_priority(F.col("d"))).collect()]
    assert got == ["ACCOUNT_SECURITY_ACCESS", "DAMAGED_WRONG_MISSING", V.GENERAL_INTENT]


RISK = [
    ("It shows delivered but there is nothing, it is missing!", "LOST_OR_STOLEN_DELIVERY"),
    ("my account was hacked, card 4532 1234 5678 9012", "ACCOUNT_SECURITY_RISK"),
    ("the glass is shattered", "DAMAGED_PHYSICAL_MERCHANDISE"),
    ("there is an extra charge", "FINANCIAL_OR_BILLING_DISPUTE"),
    ("there was no extra charge", None),
    ("get me a real person", "CUSTOMER_AGITATION_OR_LEGAL_THREAT"),
    ("card 4532-1234-5678-9012", "ACCOUNT_SPECIFIC_PII_REQUIRED"),
    ("cvv: 123", "ACCOUNT_SPECIFIC_PII_REQUIRED"),
    ("when does my parcel arrive?", None),
    ("delivered\nbut not received", None),  # the gap stays on one line
]


def test_risk_categories(spark):
    assert run(spark, [t for t, _ in RISK], triage.risk_category) == [c for _, c in RISK]


def test_negated_mentions_are_ignored(spark):
    texts = [
        "I was not charged extra for my prime membership",
        "I do not want a refund, just send my package",
        "not charged twice but my subscription will renew",
    ]
    assert run(spark, texts, intents.detect) == [
        ["BILLING_SUBSCRIPTION_PRIME"],  # "membership" is left outside the negated span
        ["DELIVERY_STATUS_DELAY"],
        ["BILLING_SUBSCRIPTION_PRIME"],
    ]
    assert run(spark, ["I was not charged extra, thank you"], intents.detect) == [["FEEDBACK_COMPLAINT_GENERAL"]]
    assert "REFUND_RETURN_EXCHANGE" in run(spark, texts, intents.detect_raw)[1]


def test_unicode_word_borders(spark):
    # an accented letter belongs to the word, so no label fires inside one
    assert run(spark, ["éapp", "app", "APPÉ"], intents.detect) == [[], ["TECHNICAL_PRODUCT_SUPPORT"], []]


TRIAGE = [
    ("where is my parcel?", "DELIVERY_STATUS_DELAY", 0.9, "AUTO_HANDLE", "NONE"),
    ("someone stole it", "DELIVERY_STATUS_DELAY", 0.9, "ESCALATE", "LOST_OR_STOLEN_DELIVERY"),
    ("it was delivered to the wrong address", "ORDER_CHANGE_CANCEL", 0.9, "ESCALATE", "LOST_OR_STOLEN_DELIVERY"),
    ("it has already shipped? already shipped!", "ORDER_CHANGE_CANCEL", 0.9, "ESCALATE", "MANUAL_REFUND_OR_RETURN_OVERRIDE"),
    ("please cancel", "ORDER_CHANGE_CANCEL", 0.9, "AUTO_HANDLE", "NONE"),
    ("mera refund kab milega", "REFUND_RETURN_EXCHANGE", 0.9, "ESCALATE", "MANUAL_REFUND_OR_RETURN_OVERRIDE"),
    ("the lid is cracked", "DAMAGED_WRONG_MISSING", 0.9, "ESCALATE", "DAMAGED_PHYSICAL_MERCHANDISE"),
    ("it is missing", "DAMAGED_WRONG_MISSING", 0.9, "ESCALATE", "LOST_OR_STOLEN_DELIVERY"),
    ("the app shows an error", "TECHNICAL_PRODUCT_SUPPORT", 0.9, "AUTO_HANDLE", "NONE"),
    ("this is terrible", "FEEDBACK_COMPLAINT_GENERAL", 0.9, "ESCALATE", "CUSTOMER_AGITATION_OR_LEGAL_THREAT"),
    ("this is terrible", "NOT_AN_INTENT", 0.9, "ESCALATE", "CUSTOMER_AGITATION_OR_LEGAL_THREAT"),
    ("hello", "ACCOUNT_SECURITY_ACCESS", 0.9, "ESCALATE", "ACCOUNT_SECURITY_RISK"),
    ("hello", "BILLING_SUBSCRIPTION_PRIME", 0.4, "ESCALATE", "FINANCIAL_OR_BILLING_DISPUTE"),
    ("qwrt zxcv, hacked", "FEEDBACK_COMPLAINT_GENERAL", 0.39, "ESCALATE", "AMBIGUOUS_INQUIRY_NEEDS_CLARIFICATION"),
]


def test_triage_cascade(spark):
    df = spark.createDataFrame([(i, *t[:3]) for i, t in enumerate(TRIAGE)], "i int, text string, intent string, intent_confidence double")
    got = triage.with_triage(df).orderBy("i").collect()
    assert [(r["decision"], r["escalation_category"]) for r in got] == [t[3:] for t in TRIAGE]
    assert "0.39" in got[-1]["reason"]
    late = triage.with_triage(df, gate_first=False).orderBy("i").collect()
    assert late[-1]["escalation_category"] == "ACCOUNT_SECURITY_RISK"


def test_gate_text_rounds_half_even(spark):
    df = spark.createDataFrame([("x", "i", 0.125), ("x", "i", 0.375)], "text string, intent string, intent_confidence double")
    reasons = [r["reason"] for r in triage.with_triage(df).collect()]
    assert "0.12 " in reasons[0] and "0.38 " in reasons[1]


def test_hybrid_resolution(spark):
    classes = V.INTENTS
    p = [0.05, 0.1, 0.3, 0.1, 0.2, 0.05, 0.1, 0.1]
    df = spark.createDataFrame(
        [([], p), (["ACCOUNT_SECURITY_ACCESS", "REFUND_RETURN_EXCHANGE"], p), (["DELIVERY_STATUS_DELAY"], p),
         (["BILLING_SUBSCRIPTION_PRIME", "REFUND_RETURN_EXCHANGE"], p), (["DAMAGED_WRONG_MISSING", "ORDER_CHANGE_CANCEL"], p)],
        "d array<string>, p array<double>",
    )
    got = [tuple(r[0]) for r in df.select(intents.hybrid(F.col("d"), F.col("p"), classes)).collect()]
    assert got == [
        ("REFUND_RETURN_EXCHANGE", 0.3), ("ACCOUNT_SECURITY_ACCESS", 0.05), ("DELIVERY_STATUS_DELAY", 0.05),
        ("REFUND_RETURN_EXCHANGE", 0.3), ("DAMAGED_WRONG_MISSING", 0.1),
    ]


def test_rule_table_is_size_checked(spark):
    small = spark.createDataFrame([(2, "b", "two"), (1, "a", "one|two")], "position int, label string, pattern string")
    pack = RulePack.from_table(small)
    assert run(spark, ["ONE", "two"], pack.all_labels) == [["a"], ["a", "b"]]
    big = spark.range(RulePack.MAX_TABLE_RULES + 1).selectExpr("id as position", "'x' as label", "'x' as pattern")
    with pytest.raises(ValueError):
        RulePack.from_table(big)
