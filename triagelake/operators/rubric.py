"""Rule-based reply rubric with four scores, a weighted total and a pass flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake import fixed_values as V
from triagelake.functions.rules import contains_any, count_contained, matches
from triagelake.functions.text import strip, whitespace_tokens


def pii_safety(reply: Column, decision: Column) -> Column:
    return (
        F.when(matches(reply, V.RUBRIC_SENSITIVE), 1)
        .when((decision == V.ESCALATE) & ~matches(reply, V.RUBRIC_PRIVATE_CHANNEL), 2)
        .otherwise(5)
    )


def tone(reply: Column) -> Column:
    empathy = contains_any(F.lower(reply), V.EMPATHY_MARKERS)
    signed = strip(reply).rlike("(?d)" + V.SIGNATURE)
    return (
        F.when(empathy & signed, 5)
        .when(empathy | signed, 4)
        .when(F.size(whitespace_tokens(reply)) > 10, 3)
        .otherwise(2)
    )


def actionability(reply: Column) -> Column:
    n = count_contained(F.lower(reply), V.ACTION_MARKERS)
    return F.when(n >= 2, 5).when(n == 1, 4).otherwise(2)


def groundedness(reply: Column, intent: Column) -> Column:
    low = F.lower(reply)
    n = None
    for name, words in V.GROUNDING_KEYWORDS.items():
        count = count_contained(low, words)
        n = F.when(intent == name, count) if n is None else n.when(intent == name, count)
    n = n.otherwise(count_contained(low, V.DEFAULT_GROUNDING))
    return F.when(n >= 3, 5).when(n == 2, 4).when(n == 1, 3).otherwise(2)


def with_scores(df: DataFrame, reply="reply", intent="intent", decision="decision") -> DataFrame:
    """Add the four scores, ``overall_score`` and ``passed``."""
    w = V.RUBRIC_WEIGHTS
    out = (
        df.withColumn("groundedness", groundedness(F.col(reply), F.col(intent)))
        .withColumn("tone", tone(F.col(reply)))
        .withColumn("actionability", actionability(F.col(reply)))
        .withColumn("pii_safety", pii_safety(F.col(reply), F.col(decision)))
    )
    hundredths = (
        F.col("groundedness") * w["groundedness"]
        + F.col("actionability") * w["actionability"]
        + F.col("tone") * w["tone"]
        + F.col("pii_safety") * w["pii_safety"]
    )
    passed = (
        (F.col("groundedness") >= 4)
        & (F.col("actionability") >= 4)
        & (F.col("pii_safety") >= 4)
        & (hundredths >= V.RUBRIC_PASS_HUNDREDTHS)
    )
    return out.withColumn("overall_score", hundredths / F.lit(100.0)).withColumn("passed", passed)


def pass_rate(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Share of passed replies; 0 for an empty batch."""
    rate = F.round(F.coalesce(F.avg(F.col("passed").cast("double")), F.lit(0.0)), 4).alias("pass_rate")
    return scored.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n"), rate)
