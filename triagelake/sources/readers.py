"""Readers for the library's inputs; filters and column lists reach the parquet scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triagelake import schemas as S


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all slots on a source that has fewer splits than the session has slots.

    One small file is one split, which would run all text work in a single task.  Large
    sources have plenty of splits and pass through untouched.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= slots else df.repartition(slots, key)


#: Terms or n-grams of a text take many times its room; so many parts are made of each input partition before they are listed.
PARTS = 16


def in_small_parts(df: DataFrame, key: str, parts: int = PARTS) -> DataFrame:
    """Deal rows out by a key into parts so small that what their texts expand to fits a task.

    The number follows the partitions of the source, so it grows with the input.  Left to the exchange's own size, the
    parts would be cut by the compressed texts.
    """
    return df.repartition(parts * max(1, df.rdd.getNumPartitions()), key)


def conversations(spark: SparkSession, path: str, brand: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """Conversation-grain parquet, optionally one brand (pushed down) and some columns."""
    df = spark.read.parquet(path)
    if brand is not None:
        df = df.where(F.col("company") == brand)
    return df.select(*(columns or S.CONVERSATIONS.names))


def messages(spark: SparkSession, path: str) -> DataFrame:
    """Message-grain parquet under the names the reply-graph operators use."""
    df = spark.read.parquet(path).select(*S.MESSAGES.names)
    return df.select(
        F.col("tweet_id").cast("string").alias("message_id"),
        F.col("in_response_to_tweet_id").cast("string").alias("parent_id"),
        F.col("author_id"),
        F.col("inbound"),
        F.col("text"),
        F.col("response_tweet_id").cast("string").alias("response_id"),
    )


def labelled_cases(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of labelled cases."""
    return spark.read.schema(S.GOLD_CASES).option("multiLine", True).json(path)


def kb_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Knowledge-base pairs; a missing customer text becomes empty."""
    return spark.read.parquet(path).withColumn("customer_text", F.coalesce("customer_text", F.lit("")))


def _file_stream(spark: SparkSession, schema, folder: str, pattern: str, files_per_trigger: int | None) -> DataFrame:
    """The files of a folder as a stream.  What the pattern names may also be a folder, as Spark writes a table: then its files are read.

    A pattern of names alone (``pathGlobFilter``) is held against the part files of such a table and drops them all.
    Files come in the order of their times, which says nothing about their rows.  So by default all files that wait make one
    trigger: turns of a session that lie in several files are ordered together, and no watermark passes between files of one
    table.  A live stream bounds its triggers by ``files_per_trigger``.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{folder.rstrip('/')}/{{{pattern}}}")


def turn_stream(spark: SparkSession, folder: str, pattern: str = "conversations.parquet", files_per_trigger: int | None = None) -> DataFrame:
    """One-row-per-turn parquet files as a stream."""
    return _file_stream(spark, S.TURN_ROWS, folder, pattern, files_per_trigger)


def event_stream(spark: SparkSession, folder: str, pattern: str = "events.parquet", files_per_trigger: int | None = None) -> DataFrame:
    return _file_stream(spark, S.EVENTS, folder, pattern, files_per_trigger)
