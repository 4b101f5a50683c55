"""Metric operators against published counts and hand-made cases."""

import pytest
from pyspark.sql import functions as F

from triagelake.operators import brand_audit, failures, metrics

RATES = [
    ((94, 10, 85, 11), (0.8952, 0.9038, 0.8947, 0.0962, 0.1146)),
    ((40, 64, 76, 20), (0.6667, 0.3846, 0.5429, 0.6154, 0.2083)),
    ((0, 104, 96, 0), (0.0, 0.0, 0.48, 1.0, 0.0)),
    ((0, 0, 0, 0), (0.0, 0.0, 0.0, 0.0, 0.0)),
]


@pytest.mark.parametrize("counts,want", RATES)
def test_triage_rates(frame, counts, want):
    r = metrics.triage_rates(frame("tp long, fn long, tn long, fp long", counts)).collect()[0]
    got = (r["escalation_precision"], r["escalation_recall"], r["safe_auto_precision"], r["missed_escalation_rate"], r["false_escalation_rate"])
    assert got == want


def rows(frame):
    return frame(
        "system string, tier string, gold_intent string, pred_intent string, gold_decision string, pred_decision string",
        ("s", "normal", "a", "a", "ESCALATE", "ESCALATE"), ("s", "normal", "a", "b", "ESCALATE", "AUTO_HANDLE"),
        ("s", "normal", "b", "b", "AUTO_HANDLE", "AUTO_HANDLE"), ("s", "difficult", "b", "c", "AUTO_HANDLE", "ESCALATE"),
    )


def test_class_and_macro_scores(frame):
    c = metrics.cells(rows(frame))
    got = {r["label"]: (r["precision"], r["recall"], round(r["f1"], 4), r["support"]) for r in metrics.class_scores(c, ["a", "b", "c", "d"]).collect()}
    assert got == {"a": (1.0, 0.5, 0.6667, 2), "b": (0.5, 0.5, 0.5, 2), "c": (0.0, 0.0, 0.0, 0), "d": (0.0, 0.0, 0.0, 0)}
    assert metrics.macro_scores(c, ["a", "b", "c", "d"]).collect()[0]["macro_f1"] == round((2 / 3 + 0.5) / 4, 4)


def test_tiers_average_present_labels_only(frame):
    got = {r["tier"]: (r["count"], r["accuracy"], r["macro_f1"]) for r in metrics.tier_breakdown(metrics.cells(rows(frame))).collect()}
    assert got["difficult"] == (1, 0.0, 0.0)
    assert got["normal"] == (3, 0.6667, 0.6667)
    assert got["overall"] == (4, 0.5, round((2 / 3 + 0.5 + 0) / 3, 4))


def test_confusion_keeps_zero_cells(frame):
    c = metrics.cells(rows(frame))
    grid = metrics.confusion(c, ["a", "b", "c"]).collect()
    assert len(grid) == 9 and sum(r["n"] for r in grid) == 4
    wide = {r["gold_intent"]: (r["a"], r["b"], r["c"]) for r in metrics.confusion_matrix(c, ["a", "b", "c"]).collect()}
    assert wide == {"a": (1, 1, 0), "b": (0, 1, 1), "c": (0, 0, 0)}


def test_counts_add_up(frame):
    r = metrics.triage_counts(metrics.cells(rows(frame))).collect()[0]
    assert (r["tp"], r["fn"], r["tn"], r["fp"]) == (1, 1, 1, 1)


def test_calibration_error(frame):
    df = frame("c double, ok boolean", (0.95, True), (0.95, False), (0.15, False), (1.0, True))
    r = metrics.expected_calibration_error(df, "c", "ok").collect()[0]
    assert r["n"] == 4
    assert r["ece"] == pytest.approx((3 * abs((0.95 * 2 + 1) / 3 - 2 / 3) + 0.15) / 4, abs=1e-6)


def test_report_pivots(frame):
    c = metrics.cells(rows(frame).unionByName(rows(frame).withColumn("system", F.lit("t"))))
    rep = metrics.long_report(metrics.accuracy(c), F.lit("headline"), F.lit(""), ["accuracy"])
    r = metrics.side_by_side(rep, ["s", "t"]).collect()[0]
    assert (r["metric"], r["s"], r["t"]) == ("accuracy", 0.5, 0.5)


def test_value_shares(frame):
    got = {r["v"]: (r["n"], r["pct"]) for r in metrics.value_shares(frame("v string", ("x",), ("x",), ("y",)), "v").collect()}
    assert got == {"x": (2, 66.7), "y": (1, 33.3)}


def test_failure_buckets(frame):
    df = frame(
        "case_id string, gold_decision string, pred_decision string, tier string, all_applicable_intents array<string>, passed boolean",
        ("1", "ESCALATE", "AUTO_HANDLE", "adversarial", ["a"], False), ("2", "AUTO_HANDLE", "ESCALATE", "difficult", ["a", "b"], True),
        ("3", "AUTO_HANDLE", "AUTO_HANDLE", "normal", ["a"], True),
    )
    got = {r["bucket"]: r["n"] for r in failures.bucket_counts(df).collect()}
    assert got == {n: 1 for n in failures.BUCKETS}


def test_scorecard_reproduces_published_composites(frame):
    # volume, resolution %, entropy, multi-turn %, quality, balance of the six published brands
    brands = [
        (81092, 42.44, 10.30, 60.10, 98.5, 51.8, 83.52), (76639, 53.58, 9.47, 32.98, 99.1, 42.5, 70.75),
        (41185, 25.62, 9.52, 33.72, 98.6, 75.2, 67.65), (25151, 26.98, 9.72, 38.96, 98.3, 42.8, 66.65),
        (27910, 29.26, 9.53, 36.60, 98.2, 44.8, 65.17), (22322, 27.06, 9.64, 34.66, 97.5, 44.6, 64.78),
    ]
    df = frame(
        "brand string, total_conversations long, resolution_cov_pct double, vocab_entropy double, multi_turn_pct double, "
        "data_quality_score double, diff_balance_score double",
        *[(f"b{i}", *b[:6]) for i, b in enumerate(brands)],
    )
    got = [(r["brand"], r["composite_score"]) for r in brand_audit.scorecard(df).collect()]
    assert [g[0] for g in got] == [f"b{i}" for i in range(6)]
    for (_, score), b in zip(got, brands):
        assert score == pytest.approx(b[6], abs=0.011)


def test_entropy(frame):
    df = frame("b string, token string", *[("x", t) for t in "aabbccdd"], ("y", "a"))
    got = {r["b"]: (r["vocab_size"], round(r["entropy"], 9)) for r in brand_audit.token_entropy(df, ["b"]).collect()}
    assert got == {"x": (4, 2.0), "y": (1, 0.0)}
