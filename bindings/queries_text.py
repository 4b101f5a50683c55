"""Sources, filters, turns, cleaning, masking, dedup, splits and leakage."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bindings import duck as D
from bindings import inputs as I
from bindings.registry import query
from triagelake import fixed_values as V
from triagelake.functions import pii, text as X
from triagelake.operators import intake, leakage, sampling, topn, turns
from triagelake.session import scratch_path
from triagelake.sources import readers, writers

_FIRST = D.with_("threads")


@query("english_pairs", _FIRST + f"""SELECT brand, conversation_id, turn_count::BIGINT AS turn_count, customer_text FROM threads
    WHERE customer_text <> '' AND support_reply <> '' AND {D.english('customer_text', V.ENGLISH_WORDS_STRICT, 15)}""")
def english_pairs(spark, d):
    t = I.turn_threads(spark, d)
    keep = (F.col("customer_text") != "") & (F.col("support_reply") != "") & X.is_english_strict(F.col("customer_text"))
    return t.where(keep).select("brand", "conversation_id", F.col("turn_count").cast("long").alias("turn_count"), "customer_text")


@query("english_strict", f"""SELECT doc_id, {D.english('text', V.ENGLISH_WORDS_STRICT, 15)} AS strict_english,
    {D.english('text', V.ENGLISH_WORDS_TOPICS, 25)} AS topic_english FROM documents""")
def english_strict(spark, d):
    t = F.col("text")
    return I.documents(spark, d).select(
        "doc_id", X.is_english_strict(t).alias("strict_english"), X.is_english_topics(t).alias("topic_english")
    )


_LINES = """lines AS MATERIALIZED (SELECT conversation_id, line, pos FROM (SELECT conversation_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos
    FROM (SELECT conversation_id, string_split('greeting line' || chr(10) || 'Customer: ' || customer_text || chr(10) || 'Support:  ' || support_reply
      || chr(10) || 'last line' || chr(10) || 'Customer: ok ' || conversation_id, chr(10)) AS l FROM pairs)))"""


@query("transcript_strict", D.with_("pairs") + ", " + _LINES + f""", t AS (
    SELECT conversation_id, pos, CASE WHEN starts_with(line, 'Customer: ') THEN 'Customer' ELSE 'Support' END AS role,
      {D.strip("substr(line, CASE WHEN starts_with(line, 'Customer: ') THEN 11 ELSE 10 END)")} AS text
    FROM lines WHERE starts_with(line, 'Customer: ') OR starts_with(line, 'Support: '))
    SELECT conversation_id, count(*) AS turn_count, arg_min(text, pos) FILTER (role = 'Customer') AS customer_text,
      arg_min(text, pos) FILTER (role = 'Support') AS support_reply FROM t GROUP BY ALL""")
def transcript_strict(spark, d):
    t = turns.threads_from_transcripts(I.transcripts(spark, d), turns.strict_turns(F.col("conversation")))
    return t.select("conversation_id", F.col("turn_count").cast("long").alias("turn_count"), "customer_text", "support_reply")


@query("transcript_joined", D.with_("pairs") + ", " + _LINES + f""", n AS (
    SELECT *, sum(CAST(starts_with(line, 'Customer: ') OR starts_with(line, 'Support: ') AS INT)) OVER (PARTITION BY conversation_id ORDER BY pos) AS no FROM lines),
    b AS (SELECT conversation_id, no, string_agg(line, ' ' ORDER BY pos) AS line FROM n WHERE no > 0 GROUP BY ALL)
    SELECT conversation_id, no::BIGINT AS turn_no, CASE WHEN starts_with(line, 'Customer: ') THEN 'Customer' ELSE 'Support' END AS role,
      {D.strip("substr(line, CASE WHEN starts_with(line, 'Customer: ') THEN 11 ELSE 10 END)")} AS text FROM b""")
def transcript_joined(spark, d):
    t = I.transcripts(spark, d).select("conversation_id", F.posexplode(turns.joined_turns(F.col("conversation"))).alias("p", "t"))
    return t.select("conversation_id", (F.col("p") + 1).cast("long").alias("turn_no"), "t.role", "t.text")


@query("clean_kb", D.with_("inbox") + f"SELECT msg_id, {D.clean_kb('text')} AS cleaned FROM inbox")
def clean_kb(spark, d):
    return I.inbox(spark, d).select("msg_id", X.clean_for_kb(F.col("text")).alias("cleaned"))


@query("clean_query", D.with_("inbox") + f"SELECT msg_id, {D.clean_query('text')} AS cleaned FROM inbox")
def clean_query(spark, d):
    return I.inbox(spark, d).select("msg_id", X.clean_for_query(F.col("text")).alias("cleaned"))


@query("clean_topic", D.with_("inbox") + f"SELECT msg_id, {D.clean_topic('text')} AS cleaned FROM inbox")
def clean_topic(spark, d):
    return I.inbox(spark, d).select("msg_id", X.clean_for_topics(F.col("text")).alias("cleaned"))


@query("parquet_roundtrip", "SELECT lang, count(*) AS n, sum(length(text))::BIGINT AS chars FROM documents GROUP BY ALL")
def parquet_roundtrip(spark, d):
    path = scratch_path(spark, "roundtrip")
    writers.write_parquet(I.table(spark, d, "documents").select("doc_id", "text", "lang"), path, ["lang"])
    return spark.read.parquet(path).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")
    )


_LABEL_SQL = D.with_("found") + """SELECT msg_id, text, array_to_string(detected, ',') AS detected, len(detected)::BIGINT AS n FROM found"""


def _detected(spark, d):
    return I.classified_of(I.inbox(spark, d)).select("msg_id", "text", "detected")


@query("json_roundtrip", _LABEL_SQL)
def json_roundtrip(spark, d):
    path = scratch_path(spark, "roundtrip")
    writers.write_json(_detected(spark, d), path)
    schema = T.StructType.fromDDL("msg_id string, text string, detected array<string>")
    back = spark.read.schema(schema).json(path)
    return back.select("msg_id", "text", F.array_join("detected", ",").alias("detected"), F.size("detected").cast("long").alias("n"))


@query("csv_roundtrip", _LABEL_SQL)
def csv_roundtrip(spark, d):
    path = scratch_path(spark, "roundtrip")
    writers.write_csv(_detected(spark, d), path)
    back = writers.read_csv(spark, path, T.StructType.fromDDL("msg_id string, text string, detected string"))
    lst = F.from_json("detected", "array<string>")
    return back.select("msg_id", "text", F.array_join(lst, ",").alias("detected"), F.size(lst).cast("long").alias("n"))


@query("brand_slice", D.with_("keyed") + "SELECT conv_id, turn, role, text FROM keyed WHERE brand = 'brand_3'")
def brand_slice(spark, d):
    path = scratch_path(spark, "by-brand")
    writers.write_parquet(I.with_keys(I.table(spark, d, "conversations")), path, ["brand"])
    return spark.read.parquet(path).where(F.col("brand") == "brand_3").select("conv_id", "turn", "role", "text")


@query("message_graph", D.with_("msgs") + """SELECT inbound, count(*) AS n, count(parent_id) AS with_parent, count(response_id) AS with_response,
    count(DISTINCT author_id) AS authors, sum(length(text))::BIGINT AS chars FROM msgs GROUP BY ALL""")
def message_graph(spark, d):
    path = scratch_path(spark, "messages")
    m = I.messages(spark, d)
    writers.write_parquet(
        m.select(
            F.col("message_id").alias("tweet_id"), "author_id", "inbound", F.lit("2024-01-01").alias("created_at"), "text",
            F.col("response_id").alias("response_tweet_id"), F.col("parent_id").alias("in_response_to_tweet_id"),
        ),
        path,
    )
    return readers.messages(spark, path).groupBy("inbound").agg(
        F.count(F.lit(1)).alias("n"), F.count("parent_id").alias("with_parent"), F.count("response_id").alias("with_response"),
        F.count_distinct("author_id").alias("authors"), F.sum(F.length("text")).alias("chars"),
    )


@query("token_variants", f"""SELECT doc_id, len({D.tokens_of('text')})::BIGINT AS whitespace, len({D.letters_of('text', 2)})::BIGINT AS letters2,
    len({D.letters_of('text', 3)})::BIGINT AS letters3,
    len(list_filter(string_split({D.squeeze('text')}, ' '), lambda w: length(w) > 3 AND NOT starts_with(w, '@') AND NOT starts_with(w, 'http')))::BIGINT AS message,
    len({D.words_of('text', 2)})::BIGINT AS terms FROM documents""")
def token_variants(spark, d):
    t = F.col("text")

    def n(tokens):
        return F.size(tokens).cast("long")

    return I.documents(spark, d).select(
        "doc_id", n(X.whitespace_tokens(t)).alias("whitespace"), n(X.letter_tokens(t, 2)).alias("letters2"),
        n(X.letter_tokens(t, 3)).alias("letters3"), n(X.message_tokens(t)).alias("message"), n(X.term_tokens(t)).alias("terms"),
    )


# --- boundary checks --------------------------------------------------------------

_SESSION_SQL = """CASE (conv_id + turn) % 7 WHEN 0 THEN '  s' || conv_id || '  ' WHEN 1 THEN '   ' WHEN 2 THEN '../../etc/x'
    WHEN 3 THEN repeat('s', 200) WHEN 4 THEN NULL ELSE 'chat-' || conv_id || '_' || turn || '.a' END"""
_MESSAGE_SQL = "CASE WHEN (conv_id + turn) % 11 = 0 THEN '' WHEN (conv_id + turn) % 13 = 0 THEN repeat(text, 60) ELSE text END"


def requests(spark, d):
    m = (F.col("conv_id") + F.col("turn"))
    session = (
        F.when(m % 7 == 0, F.concat(F.lit("  s"), F.col("conv_id").cast("string"), F.lit("  ")))
        .when(m % 7 == 1, "   ").when(m % 7 == 2, "../../etc/x").when(m % 7 == 3, F.repeat(F.lit("s"), 200)).when(m % 7 == 4, None)
        .otherwise(F.concat(F.lit("chat-"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string"), F.lit(".a")))
    )
    text = F.when(m % 11 == 0, "").when(m % 13 == 0, F.repeat(F.col("text"), 60)).otherwise(F.col("text"))
    return I.inbox(spark, d).select("msg_id", text.alias("message"), session.alias("session_id"))


_REQ = f"""req AS MATERIALIZED (SELECT msg_id, message, nullif({D.strip('session0')}, '') AS session_id FROM (
    SELECT msg_id, {_MESSAGE_SQL} AS message, {_SESSION_SQL} AS session0 FROM inbox)),
    checked AS MATERIALIZED (SELECT *, CASE WHEN coalesce(message, '') = '' THEN 'empty_message' WHEN length(message) > 4096 THEN 'message_too_long'
      WHEN session_id IS NOT NULL AND NOT regexp_full_match(session_id, '[a-zA-Z0-9_.-]{{1,128}}') THEN 'bad_session_id' END AS reject_reason FROM req)"""


@query("input_quarantine", D.with_("inbox") + ", " + _REQ + """SELECT msg_id, coalesce(session_id, '-') AS session_id, coalesce(reject_reason, 'ok') AS status,
    CASE WHEN reject_reason IS NULL THEN '-' ELSE 'SYSTEM_ERROR_FALLBACK' END AS intent,
    CASE WHEN reject_reason IS NULL THEN '-' ELSE 'HUMAN_AGENT_REQUEST' END AS escalation_category FROM checked""")
def input_quarantine(spark, d):
    r = intake.with_validity(requests(spark, d))
    good = intake.accepted(r).withColumn("intent", F.lit("-")).withColumn("escalation_category", F.lit("-"))
    bad = intake.to_human(intake.quarantined(r))
    cols = ["msg_id", F.coalesce("session_id", F.lit("-")).alias("session_id"),
            F.coalesce("reject_reason", F.lit("ok")).alias("status"), "intent", "escalation_category"]
    return good.select(*cols).unionByName(bad.select(*cols))


# --- dedup, split, leakage ------------------------------------------------------------


@query("dedup_first", "SELECT min(doc_id) AS doc_id, md5(text) AS digest FROM documents GROUP BY text")
def dedup_first(spark, d):
    docs = I.table(spark, d, "documents").select("doc_id", "text")
    return topn.keep_first(docs, "text", "doc_id").select("doc_id", F.md5("text").alias("digest"))


@query("holdout_split", f"""SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {D.seeded('doc_id')}, doc_id) <= 120 THEN 'holdout' ELSE 'kb' END AS part FROM documents""")
def holdout_split(spark, d):
    docs = I.table(spark, d, "documents").select("doc_id")
    pool, kb = sampling.holdout_split(docs, "doc_id", 120)
    return pool.withColumn("part", F.lit("holdout")).unionByName(kb.withColumn("part", F.lit("kb")))


@query("leak_ids", """SELECT doc_id, n_left, n_right FROM (SELECT doc_id, count(*) AS n_left FROM documents GROUP BY 1)
    JOIN (SELECT doc_id, count(*) AS n_right FROM labels GROUP BY 1) USING (doc_id)""")
def leak_ids(spark, d):
    return leakage.shared_keys(I.table(spark, d, "documents").select("doc_id"), I.table(spark, d, "labels").select("doc_id"), "doc_id")


def _paragraphs(df, text):
    return df.select(F.explode(F.split(text, "\n")).alias("line")).where(F.trim("line") != "")


_NORM = f"md5(lower({D.strip('line')}))"


@query("leak_text", f"""SELECT digest, n_left, n_right FROM
    (SELECT {_NORM} AS digest, count(*) AS n_left FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) WHERE trim(line) <> '' GROUP BY 1)
    JOIN (SELECT {_NORM} AS digest, count(*) AS n_right FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM benchmark) WHERE trim(line) <> '' GROUP BY 1) USING (digest)""")
def leak_text(spark, d):
    docs, bench = I.documents(spark, d), I.table(spark, d, "benchmark")
    return leakage.shared_texts(_paragraphs(docs, "text"), _paragraphs(bench, "text"), "line", "line")


@query("leaked_rows", f"""SELECT doc_id, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
    WHERE trim(line) <> '' AND {_NORM} IN (SELECT {_NORM} FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM benchmark)
      WHERE trim(line) <> '') GROUP BY 1""")
def leaked_rows(spark, d):
    docs = I.documents(spark, d).select("doc_id", F.explode(F.split("text", "\n")).alias("line")).where(F.trim("line") != "")
    bench = _paragraphs(I.table(spark, d, "benchmark"), "text")
    return leakage.leaked_rows(docs, bench, "line", "line").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


@query("label_coverage", """SELECT * FROM (SELECT label, 'missing' AS problem FROM (VALUES ('en'), ('fr'), ('it'), ('es')) v(label) WHERE label NOT IN (SELECT lang FROM documents)
    UNION ALL SELECT DISTINCT lang, 'undeclared' FROM documents WHERE lang NOT IN ('en', 'fr', 'it', 'es'))""")
def label_coverage(spark, d):
    return leakage.label_coverage(I.table(spark, d, "documents"), "lang", ["en", "fr", "it", "es"])


# --- personal data, escaping, order numbers ------------------------------------------------


@query("pii_mask", D.with_("inbox") + f"""SELECT 'doc' || doc_id AS id, {D.mask('text')} AS masked FROM documents
    UNION ALL SELECT 'msg' || msg_id, {D.mask('text')} FROM inbox""")
def pii_mask(spark, d):
    docs = I.documents(spark, d).select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("id"), "text")
    box = I.inbox(spark, d).select(F.concat(F.lit("msg"), "msg_id").alias("id"), "text")
    return docs.unionByName(box).select("id", pii.mask_pii(F.col("text")).alias("masked"))


_KINDS = [("card", "[card-redacted]"), ("cvv", "[cvv-redacted]"), ("ssn", "[ssn-redacted]"), ("email", "[email-redacted]"),
          ("phone", "[phone-redacted]"), ("credential", "[redacted]")]


@query("pii_counts", D.with_("inbox", extra=[("m", f"""SELECT 'documents' AS source, {D.mask('text')} AS t FROM documents
    UNION ALL SELECT 'inbox', {D.mask('text')} FROM inbox""")]) + "SELECT source, kind, count(*) AS n FROM (" + " UNION ALL ".join(
        f"SELECT source, '{k}' AS kind FROM m WHERE contains(t, {D.q(label)})" for k, label in _KINDS) + ") GROUP BY ALL")
def pii_counts(spark, d):
    docs = I.documents(spark, d).select(F.lit("documents").alias("source"), "text")
    box = I.inbox(spark, d).select(F.lit("inbox").alias("source"), "text")
    masked = docs.unionByName(box).select("source", pii.mask_pii(F.col("text")).alias("masked"))
    kinds = masked.select("source", F.explode(pii.masked_kinds(F.col("masked"))).alias("kind"))
    return kinds.groupBy("source", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("html_escape", f"SELECT page_id, md5({D.escape('html')}) AS digest, length({D.escape('html')})::BIGINT AS n_chars FROM pages")
def html_escape(spark, d):
    e = X.html_escape(F.col("html"))
    return I.table(spark, d, "pages").select("page_id", F.md5(e).alias("digest"), F.length(e).cast("long").alias("n_chars"))


@query("order_refs", D.with_("inbox") + f"SELECT msg_id, {D.rx('text', V.ORDER_NUMBER)} AS has_order_number FROM inbox")
def order_refs(spark, d):
    return I.inbox(spark, d).select("msg_id", X.has_order_number(F.col("text")).alias("has_order_number"))
