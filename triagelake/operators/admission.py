"""Sliding-window admission control: at most ``limit`` admitted events per key and window."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triagelake import fixed_values as V


def admit_one(stamps: deque, now: int, limit: int, window: int) -> bool:
    """One step.  Only admitted events leave a stamp; a stamp exactly one window old counts."""
    while stamps and stamps[0] < now - window:
        stamps.popleft()
    if len(stamps) >= limit:
        return False
    stamps.append(now)
    return True


def micros(df: DataFrame, ts: str):
    """Microseconds of a time column; wall-clock types do not pass through the session time zone."""
    if df.schema[ts].dataType.typeName() == "timestamp_ntz":
        since = F.expr(f"cast(`{ts}` - timestamp_ntz'1970-01-01 00:00:00' as interval second)")
        return (since.cast("decimal(20,6)") * 1_000_000).cast("long")
    return F.unix_micros(F.col(ts))


def admission_log(
    events: DataFrame,
    key: str,
    ts: str,
    id_col: str,
    limit: int = V.ADMISSION_LIMIT,
    window_seconds: int = V.ADMISSION_WINDOW_SECONDS,
) -> DataFrame:
    """(key, id, ts, admitted), in time order per key, ties by id.

    Whether an event is admitted depends on the earlier decisions, so a range window over all events
    would be wrong.  The work is still split inside a key: time is cut into bins of one
    window.  If the two bins before a bin hold at most ``limit`` events, everything in the bin before
    was admitted whatever happened earlier, so a new segment can start there with that
    bin as its known history ('warm' rows, at most ``limit``).  Segments are scanned
    in order, row batches at a time, with at most ``limit`` stamps in memory.
    """
    window = window_seconds * 1_000_000
    e = events.select(
        F.col(key).alias("key"), F.col(id_col).alias("id"), F.col(ts).alias("ts"), micros(events, ts).alias("t")
    ).withColumn("bin", F.floor(F.col("t") / F.lit(window)))

    in_key = Window.partitionBy("key").orderBy("bin")
    before = F.coalesce(F.sum("n").over(in_key.rangeBetween(-2, -1)), F.lit(0))
    bins = e.groupBy("key", "bin").agg(F.count(F.lit(1)).alias("n")).withColumn("cut", before <= limit)
    bins = bins.withColumn("seg", F.sum(F.col("cut").cast("long")).over(in_key))
    starts_next = (F.lead("bin").over(in_key) == F.col("bin") + 1) & F.lead("cut").over(in_key)
    bins = bins.withColumn("warm_seg", F.when(starts_next, F.col("seg") + 1)).select("key", "bin", "seg", "warm_seg")

    copies = F.array_compact(
        F.array(
            F.struct(F.col("seg").alias("seg"), F.lit(False).alias("warm")),
            F.when(F.col("warm_seg").isNotNull(), F.struct(F.col("warm_seg").alias("seg"), F.lit(True).alias("warm"))),
        )
    )
    rows = (
        e.join(bins, ["key", "bin"])
        .select("key", "id", "ts", "t", F.explode(copies).alias("c"))
        .select("key", "id", "ts", "t", "c.seg", "c.warm")
        .repartition("key", "seg")
        .sortWithinPartitions("key", "seg", "t", "id")
    )

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, stamps = None, deque()
        for pdf in batches:
            admitted = []
            for k, seg, t, warm in zip(pdf["key"], pdf["seg"], pdf["t"], pdf["warm"]):
                if (k, seg) != current:
                    current, stamps = (k, seg), deque()
                if warm:
                    stamps.append(t)
                    admitted.append(True)
                else:
                    admitted.append(admit_one(stamps, t, limit, window))
            pdf["admitted"] = admitted
            yield pdf[~pdf["warm"]][["key", "id", "ts", "admitted"]]

    types = {f.name: f.dataType.simpleString() for f in e.schema.fields}
    out = rows.mapInPandas(scan, f"key {types['key']}, id {types['id']}, ts {types['ts']}, admitted boolean")
    return out.select(F.col("key").alias(key), F.col("id").alias(id_col), F.col("ts").alias(ts), "admitted")
