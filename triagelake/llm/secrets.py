"""Secret scans with multipart credential linking, with DataFrame functions only.

Strong secrets are found in their row.  Weak parts (account names, unmarked tokens, addresses) are common in clean texts;
an interval join over (row, position bucket) reports them only where complementary parts stand within one scope:
a weak identifier beside a secret, a weak secret beside an identifier, an endpoint beside both.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake.session import cut_lineage

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
WEAK_ID = r"""(?<![A-Za-z0-9_])(?i:user(?:_?name)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}"""
WEAK_SECRET = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*[0-9])(?=[A-Z0-9+/_-]*[a-z])(?=[a-z0-9+/_-]*[A-Z])[A-Za-z0-9+/_-]{20,}"
ENDPOINT = r"""(?:[a-z][a-z0-9+]{1,9}://[A-Za-z0-9.-]+(?::[0-9]{1,5})?|(?<![A-Za-z0-9_])(?i:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+(?::[0-9]{1,5})?)"""
SHORTEST_ASSIGNED = 6
SCOPE = 240
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")
_BLOCK = 256


def _gaps(text: Column, pattern: str) -> Column:
    """Per match: characters since the last match, its length."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    both = F.zip_with(found, between, lambda m, g: F.struct(F.length(g).cast("long").alias("gap"), F.length(m).cast("long").alias("size")))
    kept = F.filter(both, lambda z: z["size"].isNotNull())  # one piece more than matches
    return F.when(text.rlike(pattern), kept)


def _located(gaps: str) -> Column:
    """Ranges from gaps.  Blocks keep the copying of growing arrays small in texts with very many matches."""
    spans = "array<struct<start:bigint,end:bigint>>"
    none = F.struct(F.lit(0).cast("long").alias("at"), F.expr(f"cast(array() as {spans})").alias("out"))

    def step(acc, z):
        start = acc["at"] + z["gap"]
        end = start + z["size"]
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end")))).alias("out"))

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(gaps) - 1) / _BLOCK).cast("int")),
        lambda b: F.aggregate(F.slice(gaps, b * _BLOCK + 1, F.lit(_BLOCK)), none, step),
    )
    nothing = F.struct(F.lit(0).cast("long").alias("at"), F.expr(f"cast(array() as array<{spans}>)").alias("out"))

    def put(acc, block):
        moved = F.transform(block["out"], lambda s: F.struct((s["start"] + acc["at"]).alias("start"), (s["end"] + acc["at"]).alias("end")))
        return F.struct((acc["at"] + block["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    located = F.flatten(F.aggregate(blocks, nothing, put)["out"])
    return F.when(F.size(gaps) > 0, located).otherwise(F.expr(f"cast(array() as {spans})"))


def _touched(x: Column, strong: str) -> Column:
    """Whether the range touches one of the strong ones, which are apart and in order: the first that ends behind its start decides."""
    def halve(acc, _):
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        behind = F.get(F.col(strong), middle)["end"] > x["start"]
        low = F.when((acc["low"] < acc["high"]) & ~behind, middle + 1).otherwise(acc["low"])
        high = F.when((acc["low"] < acc["high"]) & behind, middle).otherwise(acc["high"])
        return F.struct(low.alias("low"), high.alias("high"))

    rounds = F.sequence(F.lit(0), F.floor(F.log2(F.size(strong) + 1)).cast("int"))
    at = F.aggregate(rounds, F.struct(F.lit(0).alias("low"), F.size(strong).alias("high")), halve)["low"]
    return F.coalesce(F.get(F.col(strong), at)["start"] < x["end"], F.lit(False))


def _apart(weak: str, *strong: str) -> Column:
    """The weak ranges that touch no strong one."""
    return F.filter(weak, lambda x: ~reduce(or_, [(F.size(s) > 0) & _touched(x, s) for s in strong]))


def row_parts(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """One row per document: keep, and the ranges of each kind in code points."""
    t = F.col(text)
    patterns = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, WEAK_ID, WEAK_SECRET, ENDPOINT)))
    gaps = docs.select(
        *keep, *[_gaps(t, p).alias(f"_g_{k}") for k, p in patterns.items()],
        F.when(t.rlike(ASSIGN), F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(1))).alias("_values"),
    )
    spans = gaps.select(*keep, "_values", *[_located(f"_g_{k}").alias(k) for k in KINDS])
    long_enough = F.filter(
        F.zip_with("assign", "_values", lambda s, v: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.length(v).alias("n"))),
        lambda z: z["n"] >= SHORTEST_ASSIGNED,
    )
    strong = spans.withColumn("assign", F.transform(F.when(F.size("assign") > 0, long_enough).otherwise(F.expr("cast(array() as array<struct<start:bigint,end:bigint,n:int>>)")), lambda z: F.struct(z["start"].alias("start"), z["end"].alias("end"))))
    return strong.select(
        *keep, "assign", "access", "hex",
        _apart("weak_id", "assign", "access", "hex").alias("weak_id"),
        _apart("weak_secret", "assign", "access", "hex").alias("weak_secret"),
        _apart("endpoint", "assign", "access", "hex").alias("endpoint"),
    )


def _tagged(kind: str) -> Column:
    """The ranges of one kind with its name and number."""
    no = KINDS.index(kind)
    return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), F.lit(no).alias("no"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def _parts(rows: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    tagged = F.concat(*[_tagged(k) for k in kinds])
    return rows.select("_row", F.explode(tagged).alias("p")).select("_row", "p.kind", "p.start", "p.end")


def _beside(parts: DataFrame, others: DataFrame) -> DataFrame:
    """The parts with one of others within SCOPE characters: an interval join on (row, bucket of the start)."""
    a = parts.withColumn("_bucket", F.floor(F.col("start") / SCOPE))
    near = F.array(*[F.floor(F.col("start") / SCOPE) + k for k in (-1, 0, 1)])
    b = others.select(F.col("_row").alias("_o_row"), F.col("start").alias("_o_start"), F.explode(near).alias("_o_bucket"))
    together = (F.col("_row") == F.col("_o_row")) & (F.col("_bucket") == F.col("_o_bucket")) & (F.abs(F.col("start") - F.col("_o_start")) <= SCOPE)
    return a.join(b, together, "left_semi").drop("_bucket")


def scan_secrets(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """keep (default: all columns but the text) with one array of ranges per kind of KINDS.

    Ranges are code points, end exclusive.  Scopes are measured between starts.  Null and empty texts have no ranges;
    repeated rows and rows with equal or null ids are scanned each for itself; columns of docs named like a kind are
    replaced; an empty table gives an empty result.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c != text and c not in KINDS]
    keep = [f"given_{i}" for i in range(len(names))]  # so that no column of docs meets one of ours
    docs = docs.select(F.col(text).alias("text"), *[F.col(c).alias(k) for c, k in zip(names, keep)])
    rows = cut_lineage(row_parts(docs, "text", keep).withColumn("_row", F.monotonically_increasing_id()), "secrets")
    ids, secrets = _parts(rows, ("access", "weak_id")), _parts(rows, ("assign", "hex", "weak_secret"))
    linked = (
        _beside(_parts(rows, ("weak_id",)), secrets)
        .unionByName(_beside(_parts(rows, ("weak_secret",)), ids))
        .unionByName(_beside(_beside(_parts(rows, ("endpoint",)), ids), secrets))
    )
    reported = linked.groupBy("_row").agg(*[
        F.array_sort(F.collect_list(F.when(F.col("kind") == k, F.struct("start", "end")))).alias(k) for k in KINDS[3:]
    ])
    none = F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")
    base = rows.select(*keep, *KINDS[:3], "_row")
    return base.join(reported, "_row", "left").select(*[F.col(k).alias(c) for c, k in zip(names, keep)], *KINDS[:3], *[F.coalesce(k, none).alias(k) for k in KINDS[3:]])


def span_list(kinds: tuple[str, ...]) -> Column:
    """'kind:start:end' of all ranges by start, then by the order of kinds, joined by commas."""
    numbered = F.array_sort(F.concat(*[_tagged(k) for k in kinds]))
    return F.array_join(F.transform(numbered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
