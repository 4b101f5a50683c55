"""The composite jobs over whole tables, each next to SQL for all its steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import duck as D
from bindings import inputs as I
from bindings import queries_audit as QA
from bindings import queries_eval as QE
from bindings.registry import query
from triagelake import fixed_values as V
from triagelake.operators import topics
from triagelake.plans import jobs
from triagelake.session import cut_lineage, scratch_path
from triagelake.sources import readers, writers

# --- corpus preparation and topics out of whole conversations ---------------------------

_HOLDOUT = 40
# the strict parser takes the line of a turn, without what follows a line break
_RAW = ("raw", f"""SELECT brand, conversation_id, turn_count, {D.strip("split_part(customer_text, chr(10), 1)")} AS customer_text,
    {D.strip("split_part(support_reply, chr(10), 1)")} AS support_reply FROM threads""")
_CLEAN = ("clean_pairs", f"""SELECT * FROM (SELECT conversation_id, {D.clean_kb('customer_text')} AS customer_text, {D.clean_kb('support_reply')} AS support_reply,
    turn_count::BIGINT AS turn_count FROM raw WHERE customer_text <> '' AND support_reply <> '' AND {D.english('customer_text', V.ENGLISH_WORDS_STRICT, 15)})
    QUALIFY row_number() OVER (PARTITION BY customer_text ORDER BY conversation_id) = 1""")


@query("job_prepare_corpus", D.with_("threads", extra=[_RAW, _CLEAN]) + f"""SELECT CASE WHEN row_number() OVER (ORDER BY {D.seeded('conversation_id')}, conversation_id)
    <= {_HOLDOUT} THEN 'holdout' ELSE 'kb' END AS part, * FROM clean_pairs""")
def job_prepare_corpus(spark, d):
    """Parsed, filtered, cleaned, without repeats, split, checked for leaks, written and read back."""
    pool, kb = jobs.prepare_corpus(I.whole_transcripts(spark, d), scratch_path(spark, "corpus"), holdout=_HOLDOUT)
    cols = ["conversation_id", "customer_text", "support_reply", F.col("turn_count").cast("long").alias("turn_count")]
    return pool.select(F.lit("holdout").alias("part"), *cols).unionByName(kb.select(F.lit("kb").alias("part"), *cols))


_JOB_TOPIC = D.labels([(n, D.rx(D.clean_topic("customer_text"), p)) for n, p in V.TOPIC_PATTERNS])
_JOB_TOPICS = ("tp", f"""SELECT conversation_id, topics, coalesce(topics[1], 'UNMATCHED') AS topic FROM (SELECT conversation_id, {_JOB_TOPIC} AS topics
    FROM raw WHERE {D.english('customer_text', V.ENGLISH_WORDS_TOPICS, 25)})""")


@query("job_discover_topics", D.with_("threads", extra=[_RAW, _JOB_TOPICS]) + """SELECT conversation_id, topic, array_to_string(topics, ',') AS topics FROM tp""")
def job_discover_topics(spark, d):
    return jobs.discover_topics(I.whole_transcripts(spark, d)).select("conversation_id", "topic", F.array_join("topics", ",").alias("topics"))


@query("job_topic_summary", D.with_("threads", extra=[_RAW, _JOB_TOPICS]) + """SELECT d.*, s.ids FROM (SELECT topic, count(*) AS n, count(*) FILTER (len(topics) > 1) AS n_collisions,
      round(count(*) * 100.0 / sum(count(*)) OVER (), 1)::DOUBLE AS pct FROM tp GROUP BY topic) d
    JOIN (SELECT topic, string_agg(conversation_id, ',' ORDER BY conversation_id) AS ids FROM (
      SELECT *, row_number() OVER (PARTITION BY topic ORDER BY conversation_id) AS rank FROM tp) WHERE rank <= CASE WHEN topic = 'UNMATCHED' THEN 10 ELSE 5 END GROUP BY topic) s
    ON d.topic = s.topic""")
def job_topic_summary(spark, d):
    """Shares of the topics next to their sample conversations."""
    shares, samples = jobs.discovery_summary(cut_lineage(jobs.discover_topics(I.whole_transcripts(spark, d)), "topics"))
    ids = samples.where(F.col("sample_group") != "COLLISION").groupBy(F.col("sample_group").alias("topic")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conversation_id")), lambda i: i.cast("string")), ",").alias("ids")
    )
    return shares.join(ids, "topic")


@query("first_messages", D.with_("threads", extra=[_RAW]) + f"""SELECT conversation_id, customer_text FROM raw
    WHERE {D.english('customer_text', V.ENGLISH_WORDS_TOPICS, 25)} ORDER BY conversation_id LIMIT 30""")
def first_messages(spark, d):
    """The audit's first qualifying messages by id: the limit is the feature."""
    t = jobs.threads_from_transcripts(I.whole_transcripts(spark, d), jobs.strict_turns(F.col("conversation")))
    return topics.first_messages(topics.qualifying(t.select("conversation_id", "customer_text"), "customer_text"), "conversation_id", 30)


# --- candidates, review, gold -----------------------------------------------------------------

_CAND = ("cand", f"""SELECT printf('CANDIDATE-%03d', position) AS id, case_id, customer_text, tier, all_applicable_intents, proposed_intent AS i, o.d AS d, o.c AS c, o.r AS r
    FROM (SELECT *, {D.propose('customer_text', 'proposed_intent', 'tier', 'risk')} AS o FROM (
      SELECT k.case_id, k.tier, k.position, g.customer_text, g.proposed_intent, g.all_applicable_intents, {D.risk('g.customer_text')} AS risk
      FROM chosen k JOIN gold g ON k.case_id = g.case_id))""")
_CANDIDATES = [*QE._STRATA, _CAND]
_REVIEW = [*_CANDIDATES, ("p1", f"SELECT id, customer_text, tier, {QE._pass1()} AS x FROM cand"),
           ("p2", f"SELECT id, tier, p, {QE._pass2()} AS x FROM (SELECT id, customer_text, tier, x.rule AS p, x.i AS i, x.d AS d, x.c AS c, x.r AS r FROM p1)")]


def _pool(spark, d):
    return I.inbox(spark, d).select(F.col("msg_id").alias("conversation_id"), F.col("text").alias("customer_text"), F.concat(F.lit("re: "), "msg_id").alias("support_reply"))


@query("job_candidates", D.with_("gold", extra=_CANDIDATES) + """SELECT id, case_id AS conversation_id, customer_text, tier AS difficulty_tier, i AS proposed_intent,
    array_to_string(all_applicable_intents, ',') AS intents, d AS proposed_triage, c AS proposed_escalation_category, r AS proposed_escalation_reason,
    're: ' || case_id AS historical_brand_reply, false AS human_verified FROM cand""")
def job_candidates(spark, d):
    """Sampled, labelled, written as JSON and read back."""
    path = scratch_path(spark, "candidates")
    jobs.write_candidates(jobs.candidate_cases(_pool(spark, d)), path)
    out = spark.read.json(f"{path}/candidates.json")
    return out.select(
        "id", "conversation_id", "customer_text", "difficulty_tier", "proposed_intent", F.array_join("all_applicable_intents", ",").alias("intents"),
        "proposed_triage", "proposed_escalation_category", "proposed_escalation_reason", "historical_brand_reply", "human_verified",
    )


@query("job_review", D.with_("gold", extra=_REVIEW) + """SELECT id, p AS pass1_rule, x.rule AS pass2_rule, x.i AS intent, x.d AS decision, x.c AS escalation_category,
    x.r AS reason, x.changed AS pass2_changed, 'Reviewed tier: ' || tier || '.' AS annotation_notes FROM p2""")
def job_review(spark, d):
    return jobs.review_cases(jobs.candidate_cases(_pool(spark, d))).select(
        "id", "pass1_rule", "pass2_rule", "intent", "decision", "escalation_category", "reason", "pass2_changed", "annotation_notes"
    )


@query("labelled_cases", D.with_("gold", extra=_REVIEW) + """SELECT id, tier AS difficulty_tier, x.i AS golden_intent, x.d AS golden_triage, x.c AS golden_escalation_category,
    true AS human_verified FROM p2""")
def labelled_cases(spark, d):
    """The reviewed cases, written as one JSON array and read as labelled cases."""
    gold = jobs.gold_cases(jobs.review_cases(jobs.candidate_cases(_pool(spark, d))))
    path = scratch_path(spark, "gold")
    # at most as many rows as the quotas sum up to
    gold.agg(F.to_json(F.collect_list(F.struct("*"))).alias("value")).write.text(path)
    return readers.labelled_cases(spark, path).select("id", "difficulty_tier", "golden_intent", "golden_triage", "golden_escalation_category", "human_verified")


@query("kb_pairs", D.with_("pairs") + """SELECT conversation_id, CASE WHEN turn % 4 = 0 THEN '' ELSE customer_text END AS customer_text, support_reply FROM pairs""")
def kb_pairs(spark, d):
    """A knowledge base with missing customer texts, written and read."""
    path = scratch_path(spark, "kb")
    writers.write_parquet(I.pairs(spark, d).select("conversation_id", F.when(F.col("turn") % 4 != 0, F.col("customer_text")).alias("customer_text"), "support_reply"), path)
    return readers.kb_pairs(spark, path).select("conversation_id", "customer_text", "support_reply")


# --- evaluation, failures, audits ---------------------------------------------------------------

_TIER_ROWS = [(n if n != "prf" else "tier_prf", s) for n, s in QE._TIERS]
_LONG = [*QE._REPORT, *_TIER_ROWS, ("full_report", "SELECT system, 'headline' AS scope, '' AS label, metric, value FROM report WHERE metric IN ('macro_f1', 'accuracy')"
    + "".join(f" UNION ALL SELECT system, 'headline', '', 'macro_{m}', round(avg({m}), 4) FROM prf GROUP BY system" for m in ("precision", "recall"))
    + " UNION ALL SELECT system, 'headline', '', 'count', count(*) FROM evals GROUP BY system"
    + "".join(f" UNION ALL SELECT system, 'triage', '', '{m}', {m} FROM rates" for m in ["tp", "fp", "tn", "fn", *QE._METRICS])
    + "".join(f" UNION ALL SELECT system, 'class', label, '{m}', round({m}, 4) FROM prf" for m in ("precision", "recall", "f1", "support"))
    + " UNION ALL SELECT system, 'tier', tier, 'count', count(*) FROM lev GROUP BY system, tier"
    + " UNION ALL SELECT system, 'tier', tier, 'accuracy', round(avg(CAST(gold_intent = pred_intent AS INT)), 4) FROM lev GROUP BY system, tier"
    + " UNION ALL SELECT system, 'tier', tier, 'macro_f1', round(avg(f1), 4) FROM tier_prf WHERE predicted + support > 0 GROUP BY system, tier")]


def _gold(spark, d):
    return I.gold(spark, d).select(
        F.col("case_id").alias("id"), F.col("proposed_intent").alias("golden_intent"), F.col("proposed_triage").alias("golden_triage"), "difficulty_tier",
        "all_applicable_intents", F.col("customer_text").alias("historical_brand_reply"),
    )


@query("job_evaluate", D.with_("evals", extra=_LONG) + "SELECT system, scope, label, metric, value::DOUBLE AS value FROM full_report")
def job_evaluate(spark, d):
    """The long report of three systems as written; rubric and lexical rows have queries of their own (rubric_pass_rate, ngram_precision, rouge_l)."""
    path = scratch_path(spark, "report")
    jobs.evaluate(_gold(spark, d), I.predictions(spark, d), path)
    own = F.col("metric").isin("pii_safety_rate", "reply_pass_rate") | (F.col("scope") == "lexical")
    return spark.read.json(f"{path}/metrics.json").where(~own).select("system", "scope", "label", "metric", F.col("value").cast("double").alias("value"))


@query("job_failures", D.with_("evals", extra=QE._BUCKETED) + "SELECT bucket, case_id FROM buck")
def job_failures(spark, d):
    return jobs.analyse_failures(_gold(spark, d), I.predictions(spark, d)["hybrid"]).select("bucket", "case_id")


_RAW_MEASURES = [_RAW, *[(n, s.replace("FROM threads", "FROM raw")) for n, s in QA._MEASURES]]


@query("job_brand_audit", D.with_("threads", extra=_RAW_MEASURES) + f"""SELECT b.*, coalesce(s.n_samples, 0) AS n_samples FROM ({QA.SCORECARD_SQL}) b LEFT JOIN (
    SELECT brand, count(*) AS n_samples FROM (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY p) AS sample_no FROM (
      SELECT *, row_number() OVER (PARTITION BY brand ORDER BY {D.seeded('conversation_id')}, conversation_id) AS p FROM threads)
      WHERE p <= 15 AND turn_count >= 2) WHERE sample_no <= 3 GROUP BY brand) s ON b.brand = s.brand""")
def job_brand_audit(spark, d):
    """Scorecard and sample threads out of the raw transcripts."""
    threads = jobs.threads_from_transcripts(I.whole_transcripts(spark, d), jobs.strict_turns(F.col("conversation")))
    out = jobs.audit_brands(cut_lineage(threads, "threads"))
    return out.withColumn("n_samples", F.coalesce(F.size("sample_threads"), F.lit(0)).cast("long")).drop("sample_size", "sample_threads")


_ABSENT = "brand_none"


@query("job_reply_graph", D.with_("msgs", extra=[QA._PAIRS, QA._REPLIED, QA._MENTIONS]) + f"""SELECT l.author_id, coalesce(v.n, 0) AS outbound_messages,
    coalesce(r.n, 0) AS usable_customer_messages, coalesce(p.n, 0) AS usable_pairs, least(coalesce(p.n, 0), 5) AS n_samples
    FROM (SELECT unnest({D.strings([*I.BRANDS, _ABSENT])}) AS author_id) l
    LEFT JOIN (SELECT author_id, count(*) AS n FROM msgs WHERE NOT inbound GROUP BY ALL) v ON v.author_id = l.author_id
    LEFT JOIN (SELECT author_id, count(DISTINCT message_id) AS n FROM (SELECT author_id, message_id FROM rep UNION ALL SELECT author_id, message_id FROM men) GROUP BY ALL) r
      ON r.author_id = l.author_id
    LEFT JOIN (SELECT author_id, count(*) AS n FROM prs GROUP BY ALL) p ON p.author_id = l.author_id""")
def job_reply_graph(spark, d):
    """Every listed brand comes back, one without any message too."""
    return jobs.audit_reply_graph(I.messages(spark, d), [*I.BRANDS, _ABSENT]).select(
        "author_id", "outbound_messages", "usable_customer_messages", "usable_pairs", F.coalesce(F.size("sample_pairs"), F.lit(0)).cast("long").alias("n_samples")
    )
