"""The registered queries of the training-data operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triagelake.llm import centroids, decontaminate, language, licences, line_dedup, mixing, pages, pii, quality, secrets, shingle_join, suffix_dedup, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SIZES_SQL = r"""coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"""

OP4_SQL = f"""
WITH sized AS (SELECT doc_id, source, {SIZES_SQL} AS size FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS BIGINT)]::DOUBLE AS weight
  FROM sources),
bounded AS (SELECT *, 2::DOUBLE * source_size / weight AS full_at FROM weighed),
run AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
    - coalesce(sum(2::DOUBLE * source_size) OVER (ORDER BY full_at, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY full_at, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM bounded),
leveled AS (SELECT *, max(CASE WHEN full_at >= level THEN level END) OVER () AS chosen_level FROM run),
targets AS (
  SELECT source, source_size, least(2::DOUBLE * source_size, chosen_level * weight) AS target FROM leveled),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets),
bounds AS (
  SELECT *, CAST(floor(rate) AS BIGINT) AS whole, CAST(floor((rate - floor(rate)) * 4294967296) AS BIGINT) AS bound FROM rates),
draws AS (
  SELECT s.doc_id, s.size, b.*, k * 4 + j AS seed,
    ('0x' || substr(md5(coalesce(CAST(s.doc_id AS VARCHAR), '') || ':' || k), 1 + 8 * j, 8))::BIGINT AS draw
  FROM sized s JOIN bounds b ON s.source IS NOT DISTINCT FROM b.source,
    (SELECT unnest(range(8)) AS k), (SELECT unnest(range(4)) AS j)),
trials AS (
  SELECT source, target, seed, abs(sum(size * (whole + CASE WHEN draw < bound THEN 1 ELSE 0 END)) - target) AS off
  FROM draws GROUP BY source, target, seed),
chosen AS (SELECT source, arg_min(seed, (off, seed)) AS seed FROM trials GROUP BY source)
SELECT d.doc_id, d.size, d.source_size, d.target, CAST(d.size * (d.whole + CASE WHEN d.draw < d.bound THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM draws d JOIN chosen c ON d.source IS NOT DISTINCT FROM c.source AND d.seed = c.seed
"""


@query("op4_mix_sources", OP4_SQL)
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


_BENCH_WORDS = r"""coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"""

OP10_SQL = f"""
WITH d AS (SELECT doc_id, {_BENCH_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_BENCH_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n)),
found AS (SELECT dw.doc_id, dw.n, dw.s, bw.item_id FROM dw JOIN bw USING (n, win)),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS h FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op10_benchmark_windows", OP10_SQL)
def op10_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_benchmark(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("bench_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id", F.col("bench_words").alias("n_words"), n_hit.alias("n_hit"), F.size("bench_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("bench_items"), ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


@query("op7_linked_secrets")
def op7_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"), keep=["doc_id"])
    base = secrets.span_list(secrets.KINDS[:3])
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in secrets.KINDS[:3]],
        F.sha2(base, 256).alias("base_sha256"), secrets.span_list(secrets.KINDS).alias("spans"),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in secrets.KINDS[3:]],
    )


@query("op1_language")
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1
    model = language.fit(docs.where(~held_out))
    return language.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model, keep=["doc_id", "held_out"])


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 80 * (na.n + nb.n - i)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce((SELECT min(b) FROM reach WHERE reach.a = w.doc_id), w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id)
"""


@query("op3_shingle_join", OP3_SQL)
def op3_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shingle_join.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id")


@query("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, model, keep=["doc_id"]).select("doc_id", *quality.COUNTS, "base_failed", "kept", "quality_p")


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


OP9_SQL = rf"""
WITH notice(licence, t) AS (VALUES {', '.join(f'({_quoted(k)}, {_quoted(v)})' for k, v in sorted(licences.NOTICES.items()))}),
parts AS (
  SELECT DISTINCT doc_id, a, b, substr(text, a, b - a) AS t FROM (
    SELECT doc_id, text, unnest(list_concat(
      [{{'a': 1::BIGINT, 'b': 1 + len(text)}}],
      list_transform(range(1, len(p) + 1), lambda i: {{'a': 1 + coalesce(CAST(list_sum(list_transform(p[1 : i - 1], lambda x: len(x) + 2)) AS BIGINT), 0), 'b': 1 + coalesce(CAST(list_sum(list_transform(p[1 : i - 1], lambda x: len(x) + 2)) AS BIGINT), 0) + len(p[i])}}),
      list_transform(range(1, len(l) + 1), lambda i: {{'a': 1 + coalesce(CAST(list_sum(list_transform(l[1 : i - 1], lambda x: len(x) + 1)) AS BIGINT), 0), 'b': 1 + coalesce(CAST(list_sum(list_transform(l[1 : i - 1], lambda x: len(x) + 1)) AS BIGINT), 0) + len(l[i])}})
    ), recursive := true) FROM (SELECT doc_id, text, string_split(text, chr(10) || chr(10)) AS p, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL))),
words AS (
  SELECT doc_id, a, b, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM parts),
grams AS (SELECT DISTINCT doc_id, a, b, w[i] || ' ' || w[i + 1] AS g FROM (SELECT doc_id, a, b, w, unnest(range(1, len(w))) AS i FROM words WHERE len(w) > 1)),
size AS (SELECT doc_id, a, b, count(*) AS n FROM grams GROUP BY ALL),
nw AS (SELECT licence, regexp_extract_all(lower(t), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM notice),
ng AS (SELECT DISTINCT licence, w[i] || ' ' || w[i + 1] AS g FROM (SELECT licence, w, unnest(range(1, len(w))) AS i FROM nw)),
ns AS (SELECT licence, count(*) AS n FROM ng GROUP BY licence),
scored AS (
  SELECT doc_id, a, b, licence, 2.0::DOUBLE * count(*) / (any_value(size.n) + any_value(ns.n)) AS dice
  FROM grams JOIN ng USING (g) JOIN size USING (doc_id, a, b) JOIN ns USING (licence) GROUP BY doc_id, a, b, licence HAVING dice >= 0.75)
SELECT doc_id, licence, max(dice) AS dice, count(*) AS n_parts FROM scored s
WHERE NOT EXISTS (SELECT 1 FROM scored o WHERE o.doc_id = s.doc_id AND o.dice > s.dice AND 2 * (least(o.b, s.b) - greatest(o.a, s.a)) > least(o.b - o.a, s.b - s.a))
GROUP BY doc_id, licence
"""


@query("op9_licence_notices", OP9_SQL)
def op9_licence_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"))


@query("op8_suffix_dedup")
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@query("op2_personal_data")
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_personal_data(docs, pii.fit(docs), keep=["doc_id"])
    order = F.array(*[F.lit(k) for k in pii.KINDS])

    def listed(spans):
        numbered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("no"), s["end"].alias("end"), s["kind"].alias("kind"))))
        return F.array_join(F.transform(numbered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        "doc_id", *[_count_of(k) for k in pii.KINDS], F.sha2(listed(F.col("pii_base")), 256).alias("base_sha256"), listed(F.concat("pii_base", "pii_added")).alias("spans"),
        F.size("pii_added").cast("long").alias("n_added"),
    )


def _count_of(kind: str):
    return F.size(F.filter("pii_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


@query("op5_page_text")
def op5_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def _centroid_sql() -> str:
    """Five unrolled rounds over all pairs of vector and centroid."""
    off = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    nearest = f"SELECT vec_id, x, arg_min(c, (d, c)) AS cluster, min(d) AS distance FROM (SELECT v.vec_id, v.x, c.c, {off} AS d FROM kept v, {{of}} c) GROUP BY vec_id, x"
    steps = [
        "kept AS (SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(256 * e::DOUBLE) AS BIGINT)) AS x FROM embeddings "
        "WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64)",
        "c0 AS (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, x FROM kept QUALIFY c < 40)",
    ]
    for k in range(5):
        steps += [
            f"a{k} AS ({nearest.format(of=f'c{k}')})",
            f"m{k} AS (SELECT cluster AS c, list(m ORDER BY j) AS x FROM (SELECT cluster, j, CAST(floor(sum(x[j])::DOUBLE / count(*)) AS BIGINT) AS m "
            f"FROM a{k}, (SELECT unnest(range(1, 65)) AS j) GROUP BY cluster, j) GROUP BY cluster)",
            f"c{k + 1} AS (SELECT c, coalesce(m{k}.x, c{k}.x) AS x FROM c{k} LEFT JOIN m{k} USING (c))",
        ]
    steps.append(f"last AS ({nearest.format(of='c5')})")
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, cluster::INTEGER AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c5.x, ',')) AS centroid_sha256
FROM last JOIN c5 ON c5.c = last.cluster"""


@query("op11_centroids", _centroid_sql())
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"), keep=["vec_id"])


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), keep=["vec_id"])


OP13_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(range(len(a))) AS p, unnest(a) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)),
k AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT doc_id, p, line, coalesce(doc_id <> first, false) AS dropped FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(sum(dropped::INT) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query("op13_line_dedup", OP13_SQL)
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
