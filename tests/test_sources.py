"""Scans, writers and streams."""

import time

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from __spark_entry__ import QUERIES
from bindings import inputs as I
from tests.conftest import SF
from triagelake import schemas as S
from triagelake.operators import admission
from triagelake.session import scratch_path
from triagelake.sources import readers, writers
from triagelake.streaming import streams


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_brand_filter_and_columns_reach_the_scan(spark):
    path = scratch_path(spark, "conv")
    writers.write_parquet(I.transcripts(spark, SF), path)
    p = plan(readers.conversations(spark, path, "brand_1", ["conversation_id"]))
    assert "EqualTo(company,brand_1)" in p and "ReadSchema: struct<company:string,conversation_id:string>" in p
    assert readers.conversations(spark, path).columns == S.CONVERSATIONS.names


def test_partitioned_pools_are_pruned(spark):
    path = scratch_path(spark, "pools")
    writers.write_parquet(I.with_keys(I.table(spark, SF, "conversations")), path, ["brand"])
    assert "PartitionFilters: [isnotnull(brand" in plan(spark.read.parquet(path).where("brand = 'brand_2'"))


def test_rule_matching_stays_in_one_stage_without_python(spark):
    p = plan(I.scored(spark, SF))
    assert "Python" not in p and "Pandas" not in p
    assert p.count("FileScan") == 1


def test_small_sources_are_spread_and_large_ones_left_alone(spark):
    small = I.table(spark, SF, "documents")
    assert readers.spread(small, "doc_id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    large = spark.range(0, 1000, 1, 64)
    assert readers.spread(large, "id") is large


def test_csv_keeps_any_text(spark, frame):
    texts = ['a "b"', "x\ny", "c,d", "e\\f", "é'", " lead "]
    df = frame("i int, t string, l array<string>", *[(i, t, [t]) for i, t in enumerate(texts)])
    path = scratch_path(spark, "csv")
    writers.write_csv(df, path)
    back = writers.read_csv(spark, path, "i int, t string, l string").orderBy("i")
    assert [r["t"] for r in back.collect()] == texts
    assert [r["l"][0] for r in back.select(F.from_json("l", "array<string>").alias("l")).collect()] == texts


def test_wall_clock_times_ignore_the_session_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00.123456' AS ts")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.select(admission.micros(df, "ts")).collect()[0][0] == 1710037800123456
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_sessions_across_triggers_equal_one_trigger(spark):
    """State carries over: one file per trigger gives the same turns as one file in all."""
    turns = I.scored(spark, SF).select(
        F.col("conv_id").cast("string").alias("session_id"), "turn", F.col("text").alias("message"), "intent", "intent_confidence",
        "decision", "escalation_category", "reason", "reply",
    )
    cols = ["session_id", "turn", "follow_up", "intent", "reply", "multi_turn"]
    got = {}
    for name, parts in (("one", [turns]), ("many", [turns.where("turn < 2"), turns.where("turn >= 2")])):
        path = scratch_path(spark, f"chat-{name}")
        for i, p in enumerate(parts):
            p.coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(turns.schema).option("maxFilesPerTrigger", 1).parquet(path)
        out = streams.run_to_table(streams.chat_stream(stream, idle=None), f"chat-out-{name}")
        got[name] = sorted(tuple(r) for r in out.select(*cols).collect())
    assert got["one"] == got["many"] and len(got["one"]) == turns.count()


def test_an_idle_session_is_dropped_and_starts_afresh(spark):
    """Rows without a session are answered all the same; replies come back escaped."""
    ddl = "session_id string, turn long, message string, intent string, intent_confidence double, decision string, escalation_category string, reason string, reply string, evidence array<struct<conversation_id:string,similarity:double,support_reply:string,customer_text:string>>"
    path, out, checkpoint = (scratch_path(spark, x) for x in ("idle-in", "idle-out", "idle-state"))

    def put(*rows):
        full = [(s, t, "hello", "A", 0.5, "AUTO_RESPOND", "NONE", "r", "<b>ok</b>", None) for s, t in rows]
        spark.createDataFrame(full, ddl).coalesce(1).write.mode("append").parquet(path)

    def seen():
        try:
            return {(r["session_id"], r["turn"]): r for r in spark.read.parquet(out).collect()}
        except AnalysisException:
            return {}

    def wait(n):
        end = time.time() + 90
        while len(seen()) < n:
            assert time.time() < end
            time.sleep(0.5)

    put(("s", 0), ("s", 1), (None, 7))
    stream = spark.readStream.schema(ddl).parquet(path)
    query = streams.chat_responses(stream, idle="3 seconds").writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    query = query.trigger(processingTime="500 milliseconds").start()
    try:
        wait(3)
        time.sleep(12)
        put(("s", 2), ("s", 3))
        wait(5)
    finally:
        query.stop()
    got = seen()
    assert {k: r["multi_turn"] for k, r in got.items()} == {("s", 0): False, ("s", 1): True, (None, 7): False, ("s", 2): False, ("s", 3): True}
    assert all(r["reply"] == "&lt;b&gt;ok&lt;/b&gt;" and r["evidence"] == [] for r in got.values())


def _as_folder(spark, name, table, **parts):
    """A data folder whose table lies in part files, one for each condition, written in this order."""
    d = scratch_path(spark, name)
    for where in parts.values():
        I.table(spark, SF, table).where(where).coalesce(1).write.mode("append").parquet(f"{d}/{table}.parquet")
    return d


def test_streams_read_tables_of_many_files(spark):
    """part files of a table were dropped by the pattern of names, so the stream was empty."""
    d = _as_folder(spark, "gauge", "conversations", a="conv_id % 3 = 0", b="conv_id % 3 > 0")
    whole = sorted(tuple(r) for r in QUERIES["stream_gauge"](spark, SF).collect())
    assert whole and sorted(tuple(r) for r in QUERIES["stream_gauge"](spark, d).collect()) == whole


def test_turns_and_events_in_many_files_are_replayed_in_order(spark):
    """a session's later turns may lie in an earlier file; later events must not make those of the next file late."""
    d = _as_folder(spark, "replay", "conversations", late="turn >= 2", early="turn < 2")
    events = I.table(spark, SF, "events")
    mid = events.selectExpr("percentile_approx(unix_micros(CAST(ts AS timestamp)), 0.5)").head()[0]
    for where in (f"unix_micros(CAST(ts AS timestamp)) >= {mid}", f"unix_micros(CAST(ts AS timestamp)) < {mid}"):
        events.where(where).coalesce(1).write.mode("append").parquet(f"{d}/events.parquet")
    for name in ("stream_sessions", "stream_chat", "stream_activity", "stream_admission"):
        whole = sorted(map(repr, QUERIES[name](spark, SF).collect()))
        assert whole and sorted(map(repr, QUERIES[name](spark, d).collect())) == whole, name
