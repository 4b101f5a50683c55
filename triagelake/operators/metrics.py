"""Evaluation metrics, all derived from one grouped table of outcome cells.

``cells`` aggregates the aligned gold/prediction rows once; every metric below reads
that small table (systems x tiers x labels squared x decisions), never the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake import fixed_values as V

CELL = ["system", "tier", "gold_intent", "pred_intent", "gold_decision", "pred_decision"]


def align(gold: DataFrame, predictions: DataFrame, key: str = "case_id") -> DataFrame:
    """Gold joined to predictions on the case id, never by position."""
    return predictions.join(gold, key, "inner")


def stack_systems(named: dict[str, DataFrame]) -> DataFrame:
    """One table with a ``system`` column from several systems' predictions."""
    return reduce(
        lambda a, b: a.unionByName(b), [df.withColumn("system", F.lit(name)) for name, df in named.items()]
    )


def cells(aligned: DataFrame) -> DataFrame:
    have = set(aligned.columns)
    full = aligned
    for c in CELL:
        if c not in have:
            full = full.withColumn(c, F.lit("all"))
    return full.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n"))


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def accuracy(c: DataFrame, by: list[str] = ["system"]) -> DataFrame:
    hit = F.sum(F.when(F.col("gold_intent") == F.col("pred_intent"), F.col("n")).otherwise(0))
    return c.groupBy(*by).agg(F.sum("n").alias("count"), F.round(_ratio(hit, F.sum("n")), 4).alias("accuracy"))


def confusion(c: DataFrame, labels: list[str]) -> DataFrame:
    """(system, gold, predicted, n) with the zero cells of the declared label set kept."""
    names = F.array(*[F.lit(x) for x in labels])
    grid = (
        c.select("system").distinct()
        .select("system", F.explode(names).alias("gold_intent"))
        .select("system", "gold_intent", F.explode(names).alias("pred_intent"))
    )
    counts = c.groupBy("system", "gold_intent", "pred_intent").agg(F.sum("n").alias("n"))
    return grid.join(counts, ["system", "gold_intent", "pred_intent"], "left").select(
        "system", "gold_intent", "pred_intent", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def confusion_matrix(c: DataFrame, labels: list[str]) -> DataFrame:
    """The same as one row per gold label and one column per predicted label."""
    return confusion(c, labels).groupBy("system", "gold_intent").pivot("pred_intent", labels).agg(F.sum("n"))


def class_counts(c: DataFrame, by: list[str]) -> DataFrame:
    """(by..., label, tp, predicted, support) for every label seen on either side."""
    sides = F.array(
        F.struct(F.col("gold_intent").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("gold_intent") == F.col("pred_intent"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("pred_intent").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("long").alias("tp")),
    )
    return (
        c.select(*by, F.explode(sides).alias("s"))
        .groupBy(*by, F.col("s.label").alias("label"))
        .agg(F.sum("s.tp").alias("tp"), F.sum("s.predicted").alias("predicted"), F.sum("s.support").alias("support"))
    )


def _with_prf(df: DataFrame) -> DataFrame:
    p = _ratio(F.col("tp"), F.col("predicted"))
    r = _ratio(F.col("tp"), F.col("support"))
    f = _ratio(2 * F.col("tp"), F.col("predicted") + F.col("support"))
    return df.withColumn("precision", p).withColumn("recall", r).withColumn("f1", f)


def class_scores(c: DataFrame, labels: list[str], by: list[str] = ["system"]) -> DataFrame:
    """Precision, recall, F1 and support of every declared label, 0 where undefined."""
    names = F.array(*[F.lit(x) for x in labels])
    grid = c.select(*by).distinct().select(*by, F.explode(names).alias("label"))
    full = grid.join(class_counts(c, by), [*by, "label"], "left").na.fill(0, ["tp", "predicted", "support"])
    return _with_prf(full)


def macro_scores(c: DataFrame, labels: list[str], by: list[str] = ["system"]) -> DataFrame:
    """Macro average over all declared labels."""
    return class_scores(c, labels, by).groupBy(*by).agg(
        F.round(F.avg("precision"), 4).alias("macro_precision"),
        F.round(F.avg("recall"), 4).alias("macro_recall"),
        F.round(F.avg("f1"), 4).alias("macro_f1"),
    )


def tier_breakdown(c: DataFrame) -> DataFrame:
    """Count, accuracy and macro-F1 per (system, tier), and over all tiers.

    The macro average covers the labels present in that slice, on either side.  Each cell counts
    once for its tier and once for 'overall', so both levels come from one pass.
    """
    level = c.withColumn("tier", F.explode(F.array(F.col("tier"), F.lit("overall"))))
    present = _with_prf(class_counts(level, ["system", "tier"])).groupBy("system", "tier").agg(
        F.round(F.avg("f1"), 4).alias("macro_f1")
    )
    return accuracy(level, ["system", "tier"]).join(present, ["system", "tier"])


def triage_counts(c: DataFrame, by: list[str] = ["system"]) -> DataFrame:
    def total(gold, pred):
        hit = (F.col("gold_decision") == gold) & (F.col("pred_decision") == pred)
        return F.sum(F.when(hit, F.col("n")).otherwise(0))

    return c.groupBy(*by).agg(
        total(V.ESCALATE, V.ESCALATE).alias("tp"),
        total(V.AUTO, V.ESCALATE).alias("fp"),
        total(V.AUTO, V.AUTO).alias("tn"),
        total(V.ESCALATE, V.AUTO).alias("fn"),
    )


def triage_rates(counts: DataFrame) -> DataFrame:
    """Escalation and safety rates from tp/fp/tn/fn columns; 0 on an empty denominator."""
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))

    def r(num, den):
        return F.round(_ratio(num, den), 4)

    return (
        counts.withColumn("triage_accuracy", r(tp + tn, tp + fp + tn + fn))
        .withColumn("escalation_precision", r(tp, tp + fp))
        .withColumn("escalation_recall", r(tp, tp + fn))
        .withColumn("safe_auto_precision", r(tn, tn + fn))
        .withColumn("missed_escalation_rate", r(fn, tp + fn))
        .withColumn("false_escalation_rate", r(fp, tn + fp))
    )


def calibration_bins(df: DataFrame, confidence: str, correct: str, bins: int = 10) -> DataFrame:
    """Per confidence bin: size, mean confidence and share of correct answers."""
    b = F.least(F.floor(F.col(confidence) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(confidence).alias("mean_confidence"),
        F.avg(F.col(correct).cast("double")).alias("share_correct"),
    )


def expected_calibration_error(df: DataFrame, confidence: str, correct: str, bins: int = 10) -> DataFrame:
    b = calibration_bins(df, confidence, correct, bins)
    gap = F.sum(F.col("n") * F.abs(F.col("mean_confidence") - F.col("share_correct")))
    return b.agg(F.sum("n").alias("n"), F.round(gap / F.sum("n"), 6).alias("ece"))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Counts and percentages of every value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.round(F.col("n") * 100.0 / total, 1))


def long_report(wide: DataFrame, scope: Column, label: Column, metrics: list[str]) -> DataFrame:
    """(system, scope, label, metric, value) from a wide metrics table."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return wide.select(
        "system", scope.alias("scope"), label.alias("label"), F.explode(pairs).alias("m")
    ).select("system", "scope", "label", "m.metric", "m.value")


def side_by_side(report: DataFrame, systems: list[str]) -> DataFrame:
    """Metrics as rows, systems as columns."""
    return report.groupBy("scope", "label", "metric").pivot("system", systems).agg(F.first("value"))
