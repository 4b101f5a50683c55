"""Lexical overlap of a reply with the historical reply."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from triagelake.functions.text import whitespace_tokens
from triagelake.sources.readers import in_small_parts


def _grams(tokens: Column, n: int) -> Column:
    if n == 1:
        return tokens
    return F.when(
        F.size(tokens) >= n,
        F.transform(
            F.sequence(F.lit(1), F.size(tokens) - (n - 1)), lambda i: F.concat_ws(" ", F.slice(tokens, i, n))
        ),
    ).otherwise(F.array().cast("array<string>"))


def ngram_precision(df: DataFrame, key: str, hypothesis: str, reference: str, n: int) -> DataFrame:
    """(key, score): clipped n-gram overlap over the hypothesis' n-gram count.

    Both sides are exploded into one (key, gram, side) stream and counted together, so a
    single exchange by key serves both aggregations and no join is needed.
    """
    sides = F.array(
        F.struct(F.lit(1).alias("h"), F.lit(0).alias("r"), F.col(hypothesis).alias("t")),
        F.struct(F.lit(0).alias("h"), F.lit(1).alias("r"), F.col(reference).alias("t")),
    )
    # tokens are a column of their own, so that the n-gram lambda only indexes an array
    tokens = (
        in_small_parts(df.select(key, hypothesis, reference), key)
        .select(key, F.explode(sides).alias("s"))
        .select(key, "s.h", "s.r", whitespace_tokens(F.col("s.t")).alias("w"))
    )
    grams = tokens.select(key, "h", "r", F.explode_outer(_grams(F.col("w"), n)).alias("gram"))
    counts = grams.groupBy(key, "gram").agg(
        F.sum(F.when(F.col("gram").isNotNull(), F.col("h"))).alias("h"),
        F.sum(F.when(F.col("gram").isNotNull(), F.col("r"))).alias("r"),
    )
    total = F.coalesce(F.sum("h"), F.lit(0))
    shared = F.coalesce(F.sum(F.least("h", "r")), F.lit(0))
    return counts.groupBy(key).agg(
        F.when(total > 0, shared / total).otherwise(F.lit(0.0)).alias(f"ngram_precision_{n}")
    )


def lcs_length(a: list[str], b: list[str]) -> int:
    """Longest common subsequence, one big-integer step per token of ``b``.

    Bit i of ``row`` is 0 when the i-th token of ``a`` ends a longer common subsequence
    (the classic bit-vector recurrence), so whole texts of any length stay cheap.
    """
    where: dict[str, int] = {}
    for i, token in enumerate(a):
        where[token] = where.get(token, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for token in b:
        hit = row & where.get(token, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@F.pandas_udf(IntegerType())
def _lcs(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([lcs_length(list(x), list(y)) for x, y in zip(a, b)], dtype="int32")


def with_rouge_l(df: DataFrame, hypothesis: str, reference: str, name: str = "rouge_l") -> DataFrame:
    """Add the F1 of the longest common subsequence of the two token lists.

    Native higher-order functions would need len(a) * len(b) interpreted steps per row;
    an Arrow batch with one integer operation per token needs len(b).
    """
    out = df.withColumn("_h", whitespace_tokens(F.col(hypothesis))).withColumn("_r", whitespace_tokens(F.col(reference)))
    out = out.withColumn("_lcs", _lcs(F.col("_h"), F.col("_r")))
    precision = F.col("_lcs") / F.size("_h")
    recall = F.col("_lcs") / F.size("_r")
    score = F.when(F.col("_lcs") > 0, 2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0))
    return out.withColumn(name, score).drop("_h", "_r", "_lcs")


def lexical_scores(df: DataFrame, key: str, hypothesis: str, reference: str) -> DataFrame:
    """(key, ngram_precision_1, ngram_precision_2, rouge_l)."""
    rouge = with_rouge_l(df.select(key, hypothesis, reference), hypothesis, reference).select(key, "rouge_l")
    one = ngram_precision(df, key, hypothesis, reference, 1)
    two = ngram_precision(df, key, hypothesis, reference, 2)
    return one.join(two, key).join(rouge, key)
