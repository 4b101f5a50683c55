"""Brand scorecard over conversation threads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triagelake import fixed_values as V
from triagelake.functions.rules import matches
from triagelake.functions.text import letter_tokens, seeded_key
from triagelake.operators.sampling import sample_per_group
from triagelake.operators.topn import top_n_per_group


def _share(test: Column) -> Column:
    """Percentage of all rows; null counts as a miss."""
    return F.avg(F.coalesce(test, F.lit(False)).cast("double")) * 100


def token_entropy(tokens: DataFrame, by: list[str]) -> DataFrame:
    """(by..., vocab_size, n_tokens, entropy in bits) from one exploded token per row.

    H = log2(N) - sum(c * log2(c)) / N needs only two sums over the token counts, so the
    large side is aggregated twice and never joined to its own total.
    """
    counts = tokens.groupBy(*by, "token").agg(F.count(F.lit(1)).alias("c"))
    n = F.sum("c")
    h = F.log2(n) - F.sum(F.col("c") * F.log2("c")) / n
    return counts.groupBy(*by).agg(F.count(F.lit(1)).alias("vocab_size"), n.alias("n_tokens"), h.alias("entropy"))


def thread_richness(threads: DataFrame) -> DataFrame:
    """Share of threads with three or more turns and the mean number of turns."""
    return threads.groupBy("brand").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(_share(F.col("turn_count") >= 3), 2).alias("multi_turn_pct"),
        F.round(F.avg("turn_count"), 2).alias("avg_turns"),
    )


def brand_measures(threads: DataFrame, sample_per_brand: int | None = None, seed: int = V.SEED) -> DataFrame:
    """The measures of every brand.

    All rates come from one aggregate over the threads; entropy is one more over the tokens of the
    first customer text.  Volume counts every thread, the rates may use a seeded sample per brand.
    """
    volume = threads.groupBy("brand").agg(F.count(F.lit(1)).alias("total_conversations"))
    base = threads
    if sample_per_brand is not None:
        base = sample_per_group(threads.drop("turns"), ["brand"], "conversation_id", sample_per_brand, seed)
    c, s = F.col("customer_text"), F.col("support_reply")
    resolved, redirect = matches(s, V.AUDIT_RESOLUTION), matches(s, V.AUDIT_REDIRECT)
    rates = base.groupBy("brand").agg(
        F.count(F.lit(1)).alias("sample_size"),
        F.round(_share(resolved), 2).alias("resolution_cov_pct"),
        F.round(_share(redirect & ~resolved), 2).alias("dm_only_pct"),
        F.round(_share(F.col("turn_count") >= 3), 2).alias("multi_turn_pct"),
        F.round(F.avg("turn_count"), 2).alias("avg_turns"),
        F.round(F.sum(F.coalesce(F.length(c), F.lit(0))) / F.count(F.lit(1)), 1).alias("avg_cust_char_len"),
        _share(F.length(c) < 20).alias("_junk"),
        _share(matches(c, V.AUDIT_RISK)).alias("_risk"),
    )
    tokens = base.select("brand", F.explode(letter_tokens(c, 3)).alias("token"))
    entropy = token_entropy(tokens, ["brand"]).select(
        "brand", F.round("entropy", 2).alias("_entropy"), F.col("vocab_size").alias("_vocab")
    )
    return (
        volume.join(rates, "brand").join(entropy, "brand", "left")
        .withColumn("vocab_entropy", F.coalesce("_entropy", F.lit(0.0)))
        .withColumn("vocab_size", F.coalesce("_vocab", F.lit(0)))
        .withColumn("junk_pct", F.round("_junk", 2))
        .withColumn("data_quality_score", F.round(F.greatest(F.lit(0.0), 100 - F.col("_junk") * 1.5), 1))
        .withColumn("high_risk_escalation_pct", F.round("_risk", 1))
        .withColumn("diff_balance_score", F.round(100 - F.abs(F.col("_risk") - 35) * 2.0, 1))
        .drop("_junk", "_risk", "_entropy", "_vocab")
    )


def scorecard(measures: DataFrame, weights: dict = V.SCORECARD_WEIGHTS) -> DataFrame:
    """Scores and the weighted composite, best brand first.

    Minima and maxima over the brands are window aggregates on the one-row-per-brand table.
    """
    every = Window.partitionBy()

    def scaled(name):
        low, high = F.min(name).over(every), F.max(name).over(every)
        return (F.col(name) - low) / (high - low + 1e-5) * 40 + 60

    usable = F.log("total_conversations") / F.log(F.max("total_conversations").over(every)) * 100
    out = (
        measures.withColumn("_u", usable)
        .withColumn("_d", scaled("vocab_entropy"))
        .withColumn("_t", scaled("multi_turn_pct"))
    )
    composite = (
        weights["usable_conversations"] * F.col("_u")
        + weights["resolution_coverage"] * F.col("resolution_cov_pct")
        + weights["issue_diversity"] * F.col("_d")
        + weights["thread_richness"] * F.col("_t")
        + weights["data_quality"] * F.col("data_quality_score")
        + weights["evaluation_difficulty"] * F.col("diff_balance_score")
    )
    return (
        out.withColumn("usable_conv_score", F.round("_u", 1))
        .withColumn("diversity_score", F.round("_d", 1))
        .withColumn("thread_richness_score", F.round("_t", 1))
        .withColumn("composite_score", F.round(composite, 2))
        .drop("_u", "_d", "_t")
        .orderBy(F.desc("composite_score"), "brand")
    )


def sample_threads(threads: DataFrame, per_brand: int = 3, pool: int = 15, seed: int = V.SEED) -> DataFrame:
    """Up to ``per_brand`` threads with two or more turns out of the first ``pool`` in seeded order."""
    keyed = threads.withColumn("_k", seeded_key(seed, F.col("conversation_id")))
    first = top_n_per_group(keyed, ["brand"], [F.col("_k"), F.col("conversation_id")], pool, rank="_p")
    kept = top_n_per_group(
        first.where(F.col("turn_count") >= 2), ["brand"], [F.col("_p")], per_brand, rank="sample_no"
    )
    return kept.drop("_k", "_p")
