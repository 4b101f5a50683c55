"""Disjointness and coverage checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake.functions.text import strip


def normalized(text: Column) -> Column:
    return F.lower(strip(text))


def shared_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys on both sides with the number of rows on each.

    Both sides are counted per key before they meet: one row per key and side, so many
    copies of one key never multiply.
    """
    a = left.groupBy(key).agg(F.count(F.lit(1)).alias("n_left"))
    b = right.groupBy(key).agg(F.count(F.lit(1)).alias("n_right"))
    return a.join(b, key)


def shared_texts(left: DataFrame, right: DataFrame, left_text: str, right_text: str) -> DataFrame:
    """Shared normalized texts as digests with the row counts."""
    a = left.select(F.md5(normalized(F.col(left_text))).alias("digest"))
    b = right.select(F.md5(normalized(F.col(right_text))).alias("digest"))
    return shared_keys(a, b, "digest")


def leaked_rows(left: DataFrame, right: DataFrame, left_text: str, right_text: str) -> DataFrame:
    """Rows of ``left`` whose normalized text also occurs on the right."""
    digests = right.select(F.md5(normalized(F.col(right_text))).alias("_digest")).distinct()
    return left.withColumn("_digest", F.md5(normalized(F.col(left_text)))).join(digests, "_digest", "left_semi").drop("_digest")


def assert_disjoint(left: DataFrame, right: DataFrame, key: str) -> None:
    """Raise when a key occurs on both sides; reads one row at most."""
    hit = shared_keys(left, right, key).select(key).take(1)
    if hit:
        raise ValueError(f"leakage: {key}={hit[0][0]!r} is on both sides")


def label_coverage(df: DataFrame, label: str, declared: list[str]) -> DataFrame:
    """(label, problem): declared labels never used, and used labels never declared."""
    names = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(x) for x in declared])).alias("label"))
    used = df.select(F.col(label).alias("label")).distinct()
    missing = names.exceptAll(used).select("label", F.lit("missing").alias("problem"))
    extra = used.exceptAll(names).select("label", F.lit("undeclared").alias("problem"))
    return missing.unionByName(extra)
