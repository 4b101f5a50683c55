"""First-n-per-group and carry-forward without a single-task hot group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    n: int,
    rank: str = "rank",
    salts: int = 64,
) -> DataFrame:
    """The first ``n`` rows of every group, with their rank.

    Groups are ranked twice: inside (group, salt), then over the at most ``salts * n``
    survivors of a group.  No row of the answer can be dropped in the first round, so the
    result is exact.  The salt is the number of the input partition, which lets Spark cut each
    group to ``n`` rows inside every map task, before the exchange (for n below the session's
    ``windowGroupLimitThreshold``, 1000 by default); what is left of a group that holds a third of the
    table is then ranked by ``salts`` tasks instead of one.
    """
    local = Window.partitionBy(*keys, "_salt").orderBy(*order)
    whole = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_salt", F.spark_partition_id() % salts)
        .withColumn(rank, F.row_number().over(local))
        .where(F.col(rank) <= n)
        .drop("_salt")
        .withColumn(rank, F.row_number().over(whole))
        .where(F.col(rank) <= n)
    )


def keep_first(df: DataFrame, text: str, id_col: str) -> DataFrame:
    """One row per distinct text, the one with the smallest id; of rows that share text and id, one.

    The minimum id per text digest is pre-aggregated before the shuffle, so a text with millions of copies costs one row
    per task; rows of equal text and id are reduced to one in the map tasks as well.  A text whose ids are all null keeps
    one row.
    """
    digest = F.sha2(F.col(text), 256)
    first = df.select(digest.alias("_first_digest"), F.col(id_col).alias("_id")).groupBy("_first_digest").agg(F.min("_id").alias("_first_id"))
    rows = df.withColumn("_digest", digest)
    same = rows["_digest"].eqNullSafe(first["_first_digest"]) & rows[id_col].eqNullSafe(first["_first_id"])
    return rows.join(first, same, "left_semi").dropDuplicates(["_digest", id_col]).drop("_digest")


def carry_forward(
    df: DataFrame,
    keys: list[str],
    order: str,
    values: dict[str, Column],
    chunk_rows: int = 10_000,
) -> DataFrame:
    """For every row, the latest earlier non-null value of each expression in its group.

    ``order`` must be a non-negative integer column that is unique in the group.
    A plain window would sort a whole group in one task.  Here the group is cut into
    chunks of the order column: values are carried inside each chunk, and the last
    value of every chunk is carried across chunks on a table with one row per chunk.
    """
    chunked = df.withColumn("_chunk", F.floor(F.col(order) / F.lit(chunk_rows)))
    packed = {name: F.when(v.isNotNull(), F.struct(F.col(order).alias("o"), v.alias("v"))) for name, v in values.items()}
    for name, p in packed.items():
        chunked = chunked.withColumn(f"_p_{name}", p)
    last = chunked.groupBy(*keys, "_chunk").agg(
        *[F.max_by(f"_p_{n}", F.when(F.col(f"_p_{n}").isNotNull(), F.col(order))).alias(f"_l_{n}") for n in values]
    )
    over_chunks = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(
        *keys, "_chunk", *[F.last(f"_l_{n}", ignorenulls=True).over(over_chunks).alias(f"_c_{n}") for n in values]
    )
    inside = Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = chunked.join(carried, [*keys, "_chunk"], "left")
    for n in values:
        out = out.withColumn(n, F.coalesce(F.last(f"_p_{n}", ignorenulls=True).over(inside), F.col(f"_c_{n}"))["v"])
    helper = ["_chunk"] + [f"_p_{n}" for n in values] + [f"_c_{n}" for n in values]
    return out.drop(*helper)
