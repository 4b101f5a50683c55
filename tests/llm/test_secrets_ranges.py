"""Weak ranges apart from strong ones: binary search against all pairs, and texts with very many of both."""

import random
from time import monotonic

from pyspark.sql import functions as F

from triagelake.llm import secrets


def _apart_ranges(r, n):
    cuts = sorted(r.sample(range(200), 2 * n))
    return [(cuts[2 * i], cuts[2 * i + 1]) for i in range(n)]


def test_apart_equals_all_pairs(spark):
    r = random.Random(4)
    rows = [(i, _apart_ranges(r, r.randint(0, 30)), _apart_ranges(r, r.randint(0, 30)), _apart_ranges(r, r.randint(0, 3))) for i in range(300)]
    ranges = "array<struct<start:bigint,end:bigint>>"
    got = spark.createDataFrame(rows, f"id int, w {ranges}, s {ranges}, t {ranges}").select("id", secrets._apart("w", "s", "t").alias("free")).collect()
    given = {i: (w, s + t) for i, w, s, t in rows}
    for row in got:
        weak, strong = given[row["id"]]
        assert [tuple(x) for x in row["free"]] == [(a, b) for a, b in weak if not any(a < d and c < b for c, d in strong)]


def test_many_parts_in_one_text(spark):
    text = " ".join(f"{i:032x} http://host{i}.example.org" for i in range(20_000))
    began = monotonic()
    row = secrets.scan_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string"), text="text", keep=["doc_id"]).selectExpr("size(hex) AS h", "size(endpoint) AS e").first()
    assert (row["h"], row["e"]) == (20_000, 0)
    assert monotonic() - began < 60
