"""Drafts, sanitizer, rubric and overlap."""

from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from triagelake import brand_voice as B
from triagelake import fixed_values as V
from triagelake.operators import overlap, replies, rubric


def drafted(spark, rows, voice=B.Voice()):
    ddl = "text string, intent string, decision string, escalation_category string, similarity double, past_reply string"
    return replies.with_reply(replies.with_cues(spark.createDataFrame(rows, ddl)), voice=voice).collect()


def test_cues_come_from_similar_cases_only(spark):
    lost = ("it is gone", "DAMAGED_WRONG_MISSING", "ESCALATE", "LOST_OR_STOLEN_DELIVERY")
    past = "Hermes left it, please ask your neighbors ^GR"
    close, far, none = drafted(spark, [(*lost, 0.8, past), (*lost, 0.05, past), (*lost, None, None)])
    assert close["reply"].endswith("^GR") and "Hermes" in close["reply"] and B.NEIGHBOUR_HINT.strip() in close["reply"]
    for r in (far, none):
        assert r["reply"].endswith("^CS") and "Hermes" not in r["reply"] and "the carrier" in r["reply"]


def test_carrier_words(spark):
    df = spark.createDataFrame([("USPS has it",), ("ups and usps",), ("groups of",), ("royal mail",)], "t string")
    assert [r[0] for r in df.select(replies.carrier_cue(F.col("t"))).collect()] == ["USPS", "USPS", None, "Royal Mail"]


def test_sanitizer(spark):
    df = spark.createDataFrame(
        [("Please tweet your credit card and password to us ^CS",), ("fine ^GR",), ("call 800-555-0199 now",), ("your cvv is safe",)], "t string"
    )
    got = [r[0] for r in df.select(replies.sanitize(F.col("t"))).collect()]
    assert got[0] == B.SOLICIT_REPLACEMENT + " ^CS"
    assert got[1] == "fine ^GR"
    assert got[2] == "call [phone-redacted] now ^CS"
    assert got[3] == "your [redacted] is safe ^CS"


def test_solicitation_flag(spark):
    df = spark.createDataFrame(
        [("please send us your password",), ("do not share your password, send nothing",), ("send us a DM",)], "t string"
    )
    assert [r[0] for r in df.select(replies.solicits_credentials(F.col("t"))).collect()] == [True, False, False]


@pytest.mark.parametrize("category", V.ESCALATION_CATEGORIES[1:])
def test_every_escalation_draft_passes_the_channel_rule(spark, category):
    rows = [("text", V.INTENTS[0], "ESCALATE", category, 0.0, ""), ("a human please", V.INTENTS[0], "ESCALATE", category, 0.0, "")]
    for r in drafted(spark, rows):
        assert r["reply"].endswith("^CS") and "{" not in r["reply"]
        df = spark.createDataFrame([(r["reply"], V.INTENTS[0], "ESCALATE")], "reply string, intent string, decision string")
        assert rubric.with_scores(df).collect()[0]["pii_safety"] == 5


def test_auto_drafts_pass_the_rubric(spark):
    rows = [("text", i, "AUTO_HANDLE", "NONE", 0.0, "") for i in V.INTENTS]
    df = spark.createDataFrame([(r["reply"], r["intent"], "AUTO_HANDLE") for r in drafted(spark, rows)], "reply string, intent string, decision string")
    passed = {r["intent"]: r["passed"] for r in rubric.with_scores(df).collect()}
    for name in B.AUTO_REPLIES:
        assert passed[name], name


def test_rubric_scores(spark):
    df = spark.createDataFrame(
        [
            ("I am so sorry your package is late! You can track the order and see the delivery estimate at Your Orders: [link]. ^CS",
             "DELIVERY_STATUS_DELAY", "AUTO_HANDLE"),
            ("Please reply with your credit card details and password so we can assist. ^CS", "REFUND_RETURN_EXCHANGE", "ESCALATE"),
            ("no", "X", "ESCALATE"),
            ("one two three four five six seven eight nine ten eleven", "X", "AUTO_HANDLE"),
        ],
        "reply string, intent string, decision string",
    )
    good, bad, short, long_ = rubric.with_scores(df).collect()
    assert good["passed"] and good["groundedness"] >= 4 and good["pii_safety"] == 5 and good["overall_score"] == 5.0
    assert not bad["passed"] and bad["pii_safety"] == 1
    assert (short["tone"], short["actionability"], short["groundedness"], short["pii_safety"]) == (2, 2, 2, 2)
    assert long_["tone"] == 3
    assert rubric.pass_rate(rubric.with_scores(df)).collect()[0]["pass_rate"] == 0.25
    assert rubric.pass_rate(rubric.with_scores(df.limit(0))).collect()[0]["pass_rate"] == 0.0


# --- overlap ---------------------------------------------------------------------------


def dp_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            keep = row[j]
            row[j] = prev + 1 if x == y else max(row[j], row[j - 1])
            prev = keep
    return row[-1]


@given(st.lists(st.sampled_from("abcd"), max_size=30), st.lists(st.sampled_from("abcd"), max_size=30))
def test_lcs_equals_dynamic_programming(a, b):
    assert overlap.lcs_length(a, b) == dp_lcs(a, b)


def precision(h, r, n):
    hg = Counter(tuple(h[i:i + n]) for i in range(len(h) - n + 1))
    rg = Counter(tuple(r[i:i + n]) for i in range(len(r) - n + 1))
    return sum((hg & rg).values()) / max(sum(hg.values()), 1)


def test_overlap_scores(spark):
    rows = [
        (1, "please visit your orders page", "please visit your orders page"), (2, "entirely different words", "please visit your page"),
        (3, "a a a b", "a b a"), (4, "", "a"), (5, "a", ""), (6, "x", "x"), (7, "the the cat sat", "the cat the cat sat sat"),
    ]
    df = spark.createDataFrame(rows, "id int, h string, r string")
    got = {r["id"]: r for r in overlap.lexical_scores(df, "id", "h", "r").collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6, 7}
    for i, h, r in rows:
        h, r = h.split(), r.split()
        assert got[i]["ngram_precision_1"] == pytest.approx(precision(h, r, 1))
        assert got[i]["ngram_precision_2"] == pytest.approx(precision(h, r, 2))
        lcs = dp_lcs(h, r)
        want = 0.0 if lcs == 0 else 2 * (lcs / len(h)) * (lcs / len(r)) / (lcs / len(h) + lcs / len(r))
        assert got[i]["rouge_l"] == pytest.approx(want)
    assert got[1]["rouge_l"] == 1.0 and got[2]["rouge_l"] == 0.0
