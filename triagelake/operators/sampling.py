"""Seeded holdouts, per-group samples and the stratified case set."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triagelake import fixed_values as V
from triagelake.functions.text import seeded_key
from triagelake.operators.topn import top_n_per_group
from triagelake.session import cut_lineage


def holdout_split(df: DataFrame, id_col: str, size: int = V.HOLDOUT_SIZE, seed: int = V.SEED) -> tuple[DataFrame, DataFrame]:
    """Exactly ``size`` rows by seeded order, and the rest.

    Ordered limit keeps only ``size`` ids per task before the merge; no window over the whole table.
    """
    chosen = (
        df.select(id_col, seeded_key(seed, F.col(id_col)).alias("_k")).orderBy("_k", id_col).limit(size).select(id_col)
    )
    return df.join(chosen, id_col, "left_semi"), df.join(chosen, id_col, "left_anti")


def holdout_fraction(df: DataFrame, id_col: str, fraction: float, seed: int = V.SEED) -> tuple[DataFrame, DataFrame]:
    """Row-local split by hash threshold, when an approximate size is enough."""
    head = F.conv(F.substring(seeded_key(seed, F.col(id_col)), 1, 8), 16, 10).cast("long")
    inside = head < int(fraction * 2**32)
    return df.where(inside), df.where(~inside)


def sample_per_group(df: DataFrame, keys: list[str], id_col: str, n: int, seed: int = V.SEED) -> DataFrame:
    """n rows of every group in seeded order."""
    out = df.withColumn("_k", seeded_key(seed, F.col(id_col)))
    return top_n_per_group(out, keys, [F.col("_k"), F.col(id_col)], n).drop("_k", "rank")


def stratified_cases(
    pooled: DataFrame, id_col: str, quotas: dict = V.QUOTAS, long_intents: list[str] = V.LONG_PICK_INTENTS,
    intents: list[str] = V.INTENTS, long_chars: int = V.LONG_TEXT_CHARS, text: str = "customer_text", seed: int = V.SEED,
) -> DataFrame:
    """Seeded quota sample over pools; adds ``difficulty_tier`` and ``position``.

    ``pooled`` has ``pool``: 'adversarial', 'collision' or an intent label.  Every pool is first
    cut to the rows that could possibly be chosen, so all later ranking runs over a few
    hundred rows whatever the size of the table is.
    """
    normal, difficult = quotas["normal"], quotas["difficult"]
    # the pools come from many patterns: match them once and rank a narrow written table
    keyed = cut_lineage(
        pooled.select(id_col, "pool", F.length(text).alias("_len"), seeded_key(seed, F.col(id_col)).alias("_k")), "pools"
    )
    enough = max(normal + difficult, difficult, quotas["adversarial"])
    ranked = top_n_per_group(keyed, ["pool"], [F.col("_k"), F.col(id_col)], enough)

    adversarial = ranked.where((F.col("pool") == "adversarial") & (F.col("rank") <= quotas["adversarial"]))

    # difficult: collisions, then one long text per listed intent, then more collisions
    collisions = ranked.where(F.col("pool") == "collision").select(
        id_col, F.when(F.col("rank") <= quotas["collisions"], 0).otherwise(2).alias("_step"), F.col("rank").alias("_o")
    )
    place = F.array_position(F.array(*[F.lit(i) for i in long_intents]), F.col("pool"))
    long_ones = (
        top_n_per_group(
            keyed.where(F.col("pool").isin(*long_intents) & (F.col("_len") > long_chars)), ["pool"], [F.col(id_col)], 1
        ).select(id_col, F.lit(1).alias("_step"), place.cast("int").alias("_o"))
    )
    hard = (
        collisions.unionByName(long_ones)
        .orderBy("_step", "_o", id_col)
        .limit(difficult)
    )

    # normal: a quota per intent, then refill in seeded order
    rest = ranked.where(F.col("pool").isin(*intents)).join(hard.select(id_col), id_col, "left_anti")
    place = F.array_position(F.array(*[F.lit(i) for i in intents]), F.col("pool"))
    per_intent = rest.withColumn(
        "_r", F.row_number().over(Window.partitionBy("pool").orderBy("_k", id_col))
    )
    first = F.col("_r") <= quotas["per_intent"]
    easy = (
        per_intent.select(
            id_col,
            F.when(first, 0).otherwise(1).alias("_step"),
            F.when(first, place).otherwise(0).alias("_o"),
            "_k",
        )
        .orderBy("_step", "_o", "_k", id_col)
        .limit(normal)
    )

    def in_order(df, tier, *order):
        return df.select(
            id_col, F.lit(tier).alias("difficulty_tier"), F.row_number().over(Window.orderBy(*order, id_col)).alias("_n")
        )

    tiers = [
        in_order(easy, "normal", "_step", "_o", "_k"),
        in_order(hard, "difficult", "_step", "_o"),
        in_order(adversarial, "adversarial", "rank"),
    ]
    chosen = reduce(lambda a, b: a.unionByName(b), tiers)
    tier_no = F.array_position(F.array(*[F.lit(t) for t in V.TIERS]), F.col("difficulty_tier"))
    numbered = chosen.select(
        id_col, "difficulty_tier", F.row_number().over(Window.orderBy(tier_no, "_n")).alias("position")
    )
    return pooled.join(numbered, id_col)
