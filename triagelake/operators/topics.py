"""Topic discovery with anchor patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.functions.rules import RulePack
from triagelake.functions.text import clean_for_topics, is_english_topics
from triagelake.operators.intents import TOPIC_PACK
from triagelake.operators.topn import top_n_per_group

UNMATCHED = "UNMATCHED"


def qualifying(df: DataFrame, text: str) -> DataFrame:
    """English first messages that are long enough."""
    return df.where(is_english_topics(F.col(text)))


def first_messages(df: DataFrame, id_col: str, n: int) -> DataFrame:
    """The first n qualifying messages by id, for a manual audit."""
    return df.orderBy(id_col).limit(n)


def with_topics(df: DataFrame, text: str, pack: RulePack = TOPIC_PACK) -> DataFrame:
    """Add ``topics`` (all anchors that match the cleaned text) and ``topic`` (the first)."""
    return df.withColumn("topics", pack.all_labels(clean_for_topics(F.col(text)))).withColumn(
        "topic", F.coalesce(F.get("topics", F.lit(0)), F.lit(UNMATCHED))
    )


def distribution(topics: DataFrame) -> DataFrame:
    """(topic, n, pct, n_collisions), unmatched messages included."""
    counts = topics.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.size("topics") > 1).cast("long")).alias("n_collisions")
    )
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.round(F.col("n") * 100.0 / total, 1))


def samples(topics: DataFrame, id_col: str, per_topic: int = 5, collisions: int = 10, unmatched: int = 10) -> DataFrame:
    """First messages per topic, of the collisions and of the unmatched ones."""
    groups = F.array_compact(
        F.array(
            F.when(F.col("topic") != UNMATCHED, F.col("topic")).otherwise(F.lit(UNMATCHED)),
            F.when(F.size("topics") > 1, F.lit("COLLISION")),
        )
    )
    exploded = topics.withColumn("sample_group", F.explode(groups))
    ranked = top_n_per_group(
        exploded, ["sample_group"], [F.col(id_col)], max(per_topic, collisions, unmatched)
    )
    quota = (
        F.when(F.col("sample_group") == "COLLISION", collisions)
        .when(F.col("sample_group") == UNMATCHED, unmatched)
        .otherwise(per_topic)
    )
    return ranked.where(F.col("rank") <= quota)
