"""Failure buckets of an evaluated system; one case may sit in several buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake import fixed_values as V
from triagelake.operators.topn import top_n_per_group

BUCKETS = [
    "missed_escalations",
    "false_escalations",
    "multi_intent_borderline",
    "adversarial_edge_cases",
    "reply_quality_failures",
]


def with_buckets(cases: DataFrame) -> DataFrame:
    """Add ``buckets``; needs gold/pred decision, tier, applicable intents and ``passed``."""
    c = F.col
    tests = [
        (c("gold_decision") == V.ESCALATE) & (c("pred_decision") == V.AUTO),
        (c("gold_decision") == V.AUTO) & (c("pred_decision") == V.ESCALATE),
        (c("tier") == "difficult") & (F.size("all_applicable_intents") >= 2),
        c("tier") == "adversarial",
        ~c("passed"),
    ]
    return cases.withColumn(
        "buckets", F.array_compact(F.array(*[F.when(t, F.lit(name)) for t, name in zip(tests, BUCKETS)]))
    )


def bucket_rows(cases: DataFrame) -> DataFrame:
    return with_buckets(cases).withColumn("bucket", F.explode("buckets")).drop("buckets")


def bucket_counts(cases: DataFrame) -> DataFrame:
    return bucket_rows(cases).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def bucket_samples(cases: DataFrame, key: str, per_bucket: int) -> DataFrame:
    """A top-k report: the first cases of every bucket by id."""
    return top_n_per_group(bucket_rows(cases), ["bucket"], [F.col(key)], per_bucket)
