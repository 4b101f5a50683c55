"""Pools, proposals and review chains on literal messages."""

from pyspark.sql import functions as F

from triagelake import fixed_values as V
from triagelake.operators import labelling

POOLS = [
    ("my lawyer will hear about the parcel", "adversarial"),
    ("the parcel is broken, refund me and cancel it", "adversarial"),
    ("Hello there", "adversarial"),
    ("yeah right, that worked very well again today", "adversarial"),
    ("the parcel is late, please refund it to me", "collision"),
    ("when does the courier come to my street", "DELIVERY_STATUS_DELAY"),
    ("I like the colour of the new one a lot", V.GENERAL_INTENT),
]


def test_pools(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(POOLS)], "i int, customer_text string")
    assert [r["pool"] for r in labelling.with_pools(df).orderBy("i").collect()] == [p for _, p in POOLS]


PROPOSALS = [
    ("it was hacked", "normal", "ESCALATE", "ACCOUNT_SECURITY_RISK"),
    ("the lid is cracked", "normal", "ESCALATE", "DAMAGED_PHYSICAL_MERCHANDISE"),
    ("my otp does not come", "normal", "ESCALATE", "ACCOUNT_SECURITY_RISK"),
    ("the membership", "normal", "ESCALATE", "FINANCIAL_OR_BILLING_DISPUTE"),
    ("parcel delivered where", "normal", "ESCALATE", "LOST_OR_STOLEN_DELIVERY"),
    ("parcel is late", "normal", "AUTO_HANDLE", "NONE"),
    ("cancel it, too late", "normal", "ESCALATE", "MANUAL_REFUND_OR_RETURN_OVERRIDE"),
    ("cancel it", "normal", "AUTO_HANDLE", "NONE"),
    ("money back now", "normal", "ESCALATE", "MANUAL_REFUND_OR_RETURN_OVERRIDE"),
    ("return label", "normal", "AUTO_HANDLE", "NONE"),
    ("app crash", "adversarial", "AUTO_HANDLE", "NONE"),
    ("so so", "normal", "AUTO_HANDLE", "NONE"),
    ("so so", "adversarial", "ESCALATE", "CUSTOMER_AGITATION_OR_LEGAL_THREAT"),
]


def test_proposals(spark):
    df = spark.createDataFrame([(i, t, tier) for i, (t, tier, *_) in enumerate(PROPOSALS)], "i int, customer_text string, difficulty_tier string")
    got = labelling.with_proposal(labelling.with_pools(df)).orderBy("i").collect()
    assert [(r["proposed_triage"], r["proposed_escalation_category"]) for r in got] == [p[2:] for p in PROPOSALS]
    assert got[-1]["all_applicable_intents"] == [V.GENERAL_INTENT]


def cases(spark, rows):
    ddl = "i int, customer_text string, difficulty_tier string, intent string, decision string"
    return spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], ddl).select(
        "*", F.lit("NONE").alias("escalation_category"), F.lit("why").alias("reason"), F.lit("").alias("annotation_notes")
    )


G, D = V.GENERAL_INTENT, "DELIVERY_STATUS_DELAY"


def test_first_pass_stops_at_the_first_matching_rule(spark):
    rows = [
        ("thank you, cashback is here", "normal", G, "ESCALATE"),  # praise matches, label agrees: chain ends unchanged
        ("thank you, cashback is here", "normal", D, "ESCALATE"),
        ("thank you but still waiting for cashback", "normal", D, "AUTO_HANDLE"),
        ("it says delivered, but empty", "normal", D, "AUTO_HANDLE"),
        ("cancel my order", "normal", D, "AUTO_HANDLE"),
        ("cancel my order, return it", "normal", D, "AUTO_HANDLE"),
        ("want my money back, package is late", "difficult", D, "AUTO_HANDLE"),
        ("want my money back, package is late", "normal", D, "AUTO_HANDLE"),
    ]
    got = labelling.review_pass1(cases(spark, rows)).orderBy("i").collect()
    assert [(r["rule"], r["changed"], r["intent"], r["decision"]) for r in got] == [
        ("praise", False, G, "ESCALATE"), ("praise", True, G, "AUTO_HANDLE"), ("wallet", True, "BILLING_SUBSCRIPTION_PRIME", "ESCALATE"),
        ("missing", True, "DAMAGED_WRONG_MISSING", "ESCALATE"), ("change", True, "ORDER_CHANGE_CANCEL", "AUTO_HANDLE"),
        ("none", False, D, "AUTO_HANDLE"), ("refund", True, "REFUND_RETURN_EXCHANGE", "ESCALATE"), ("none", False, D, "AUTO_HANDLE"),
    ]
    assert all(r["human_verified"] for r in got)
    assert got[1]["annotation_notes"] and not got[0]["annotation_notes"]


def test_second_pass_counts_by_rule(spark):
    rows = [
        ("the driver broke the gate", "normal", D, "ESCALATE"), ("I call the police", "normal", D, "ESCALATE"),
        ("my account is blocked", "normal", "ACCOUNT_SECURITY_ACCESS", "ESCALATE"), ("where is my refund", "normal", D, "AUTO_HANDLE"),
        ("marked delivered, empty", "normal", "DAMAGED_WRONG_MISSING", "ESCALATE"), ("kudos", "normal", D, "AUTO_HANDLE"),
        ("before it ships", "normal", D, "ESCALATE"), ("prime charge", "normal", D, "AUTO_HANDLE"), ("late", "normal", D, "AUTO_HANDLE"),
        ("frozen", "normal", "TECHNICAL_PRODUCT_SUPPORT", "AUTO_HANDLE"), ("hm", "normal", G, "AUTO_HANDLE"),
    ]
    got = labelling.review_pass2(cases(spark, rows), annotator="qa").orderBy("i").collect()
    assert [(r["rule"], r["changed"]) for r in got] == [
        ("misconduct", True), ("misconduct", True), ("blocked", True), ("refund", True), ("missing", False), ("praise", True),
        ("change", False), ("charge", False), ("delivery", False), ("technical", False), ("fallback", False),
    ]
    assert [r["intent"] for r in got[:2]] == [G, D]
    assert got[6]["decision"] == "AUTO_HANDLE" and got[7]["decision"] == "ESCALATE"
    assert {r["human_annotator"] for r in got} == {"qa"}
    n = {r["rule"]: (r["n"], r["n_changed"]) for r in labelling.change_counts(labelling.review_pass2(cases(spark, rows))).collect()}
    assert n["misconduct"] == (2, 2) and n["charge"] == (1, 0)


def test_weak_labels_are_capped_and_cleaned(spark):
    df = spark.createDataFrame([(i, "my parcel is late @12 https://a.b") for i in range(9)] + [(99, "hm")], "id long, t string")
    got = labelling.weak_labels(df, "id", "t", per_class=4).collect()
    assert sorted(r["id"] for r in got) == [0, 1, 2, 3]
    assert {(r["text"], r["label"]) for r in got} == {("my parcel is late @User [link]", D)}
    assert {r["label"] for r in labelling.weak_labels_sampled(df, "id", "t", 100).collect()} == {D, G}
