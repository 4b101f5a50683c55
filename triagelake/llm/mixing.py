"""Mixing sources to target weights, with DataFrame functions only.

Tokens are summed per source.  A source's target is its weight's share of the mix, but at most `most_repeats` times its
size; what it cannot take is shared again by weight.  The repetition rate is target / size: every document comes
floor(rate) times, plus one Bernoulli copy whose probability is the fraction.  The Bernoulli draws are hashes of
(seed, document); of SEEDS seeds each source uses the one whose total comes nearest to its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triagelake.llm.names import unused
from triagelake.session import cut_lineage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_REPEATS = 2
DIGESTS, DRAWS_EACH = 8, 4
SEEDS = DIGESTS * DRAWS_EACH
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text) -> Column:
    """Number of words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _draws(key: Column) -> Column:
    """SEEDS numbers in [0, 2^32), fixed by the document's key."""
    digests = [F.md5(F.concat(key, F.lit(f":{k}"))) for k in range(DIGESTS)]
    return F.array(*[F.conv(F.substring(d, 1 + 8 * j, 8), 16, 10).cast("long") for d in digests for j in range(DRAWS_EACH)])


def source_targets(sizes: DataFrame, *, weights=WEIGHTS, share: float = SHARE, most: float = MOST_REPEATS) -> DataFrame:
    """(source, source_size) -> also weight, target and rate.  One row per source.

    The level L with sum(min(most * size, L * weight)) = share * sum(size) is found from running sums over the sources in
    order of most * size / weight: a source is full if its own bound lies below the level that the others would reach.
    """
    # the numbers of sources, not of documents, are ordered here
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    w = sizes.withColumn("weight", pick).withColumn("_full_at", F.lit(float(most)) * F.col("source_size") / F.col("weight"))
    order = Window.orderBy("_full_at", F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    w = (
        w.withColumn("_all", F.sum("source_size").over(everything))
        .withColumn("_gone", F.coalesce(F.sum(F.lit(float(most)) * F.col("source_size")).over(before), F.lit(0.0)))
        .withColumn("_rest", F.sum("weight").over(onward))
        .withColumn("_level", (F.lit(float(share)) * F.col("_all") - F.col("_gone")) / F.col("_rest"))
    )
    level = F.max(F.when(F.col("_full_at") >= F.col("_level"), F.col("_level"))).over(everything)
    w = w.withColumn("target", F.least(F.lit(float(most)) * F.col("source_size"), F.coalesce(level, F.lit(float("inf"))) * F.col("weight")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return w.select("source", "source_size", "weight", "target", rate.alias("rate"))


def mix_sources(
    docs: DataFrame, *, text: str = "text", source: str = "source", key: str = "doc_id", weights=WEIGHTS, share: float = SHARE, most: float = MOST_REPEATS
) -> DataFrame:
    """docs with mix_size, mix_source_size, mix_target and mix_copies (how often the mix holds the row).

    A null source is a source of its own, ordered last.  Null and wordless texts have size 0, and rows of a source whose
    texts are all wordless are not taken.  A null key draws as an empty one; rows with equal keys draw alike.  An empty
    table gives an empty mix.  Columns of docs named like the new ones are replaced.
    """
    new = ["mix_size", "mix_source_size", "mix_target", "mix_copies"]
    docs = docs.drop(*new)
    draw_key = F.coalesce(F.col(key).cast("string"), F.lit(""))
    sized = docs.select(F.col(source).alias("source"), word_count(text).alias("size"), draw_key.alias("key"))
    sized = cut_lineage(sized, "mix")  # narrow: texts are read once for the sums and once for the result
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = cut_lineage(source_targets(sizes, weights=weights, share=share, most=most), "targets").withColumns(
        {"_floor": F.floor("rate").cast("long"), "_bound": F.floor((F.col("rate") - F.floor("rate")) * F.lit(2**32)).cast("long")}
    )
    targets = targets.withColumnRenamed("source", "_source")
    match = F.col("source").eqNullSafe(F.col("_source"))
    own_source, own_size, own_target, floor, bound, seed = names = unused(docs.columns, "source", "size", "target", "floor", "bound", "seed")
    taken = F.array(*[F.sum(F.col("size") * (F.col("_floor") + (F.col("_draws")[k] < F.col("_bound")).cast("long"))) for k in range(SEEDS)])
    trials = (
        sized.join(targets, match).select("source", "target", "size", "_floor", "_bound", _draws(F.col("key")).alias("_draws"))
        .groupBy("source", "target").agg(taken.alias("_taken"))
    )
    miss = F.transform("_taken", lambda t, k: F.struct(F.abs(t - F.col("target")).alias("off"), k.alias("seed")))
    chosen = trials.select("source", F.array_min(miss)["seed"].alias("_seed"))
    plan = targets.join(chosen, match).select("_source", "source_size", "target", "_floor", "_bound", "_seed").toDF(*names)
    plan = cut_lineage(plan, "mixplan")
    out = docs.join(plan, docs[source].eqNullSafe(plan[own_source]), "left")
    draw = _draws(draw_key)[F.col(seed)]
    return out.select(
        *[docs[c] for c in docs.columns],
        word_count(text).alias("mix_size"),
        F.col(own_size).alias("mix_source_size"),
        F.col(own_target).alias("mix_target"),
        (F.col(floor) + (draw < F.col(bound)).cast("long")).alias("mix_copies"),
    )


def repeated(mixed: DataFrame, copy: str = "copy") -> DataFrame:
    """The mix itself: each row mix_copies times, numbered from 1 in `copy`."""
    return mixed.where(F.col("mix_copies") > 0).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_copies"))))
