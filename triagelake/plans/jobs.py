"""End-to-end jobs, each a composition of the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake import brand_voice as B
from triagelake import fixed_values as V
from triagelake.functions.text import clean_for_kb, clean_for_query, is_english_strict, sequence_id
from triagelake.operators import brand_audit, failures, labelling, metrics, reply_graph, rubric, topics, triage
from triagelake.operators.intent_model import IntentModel, with_top_class
from triagelake.operators.leakage import assert_disjoint
from triagelake.operators.overlap import lexical_scores
from triagelake.operators.replies import solicits_credentials, with_cues, with_reply
from triagelake.operators.sampling import holdout_split, stratified_cases
from triagelake.operators.similar import TermIndex, evidence, top_k, with_case_texts
from triagelake.operators.topn import keep_first
from triagelake.operators.turns import strict_turns, threads_from_transcripts
from triagelake.session import cut_lineage, run_folder
from triagelake.sources import writers


# --- corpus preparation ------------------------------------------------------------


def clean_pairs(conversations: DataFrame, brand: str | None = None) -> DataFrame:
    """Cleaned, English, complete and unique pairs out of raw transcripts."""
    raw = conversations if brand is None else conversations.where(F.col("company") == brand)
    threads = threads_from_transcripts(raw, strict_turns(F.col("conversation")))
    c, s = F.col("customer_text"), F.col("support_reply")
    complete = threads.where((c != "") & (s != "") & is_english_strict(c))
    pairs = complete.select(
        "conversation_id",
        clean_for_kb(c).alias("customer_text"),
        clean_for_kb(s).alias("support_reply"),
        c.alias("raw_customer_text"),
        s.alias("raw_support_reply"),
        "turn_count",
    )
    return keep_first(pairs, "customer_text", "conversation_id")


def prepare_corpus(
    conversations: DataFrame, out: str, brand: str | None = None, holdout: int = V.HOLDOUT_SIZE, seed: int = V.SEED
) -> tuple[DataFrame, DataFrame]:
    """Write the disjoint holdout pool and knowledge base; returns both as read back.  No scratch table stays."""
    spark = conversations.sparkSession
    with run_folder(spark, "corpus"):
        pairs = cut_lineage(clean_pairs(conversations, brand), "clean-pairs")
        pool, kb = holdout_split(pairs, "conversation_id", holdout, seed)
        assert_disjoint(pool, kb, "conversation_id")
        writers.write_parquet(pool, f"{out}/holdout")
        writers.write_parquet(kb, f"{out}/kb")
    return spark.read.parquet(f"{out}/holdout"), spark.read.parquet(f"{out}/kb")


# --- end-to-end scoring ---------------------------------------------------------------


@dataclass(frozen=True)
class Desk:
    """What scoring needs: a classifier, an index and the cases it points to."""

    model: IntentModel
    index: TermIndex
    kb: DataFrame  # conversation_id, customer_text, support_reply
    index_stop_words: list[str]
    voice: B.Voice = B.Voice()


def score_messages(df: DataFrame, desk: Desk, id_col: str = "case_id", text_col: str = "text", k: int = 2) -> DataFrame:
    """clean -> classify -> similar cases -> triage -> draft -> sanitize, for batches and micro-batches."""
    # written once: the classifier, the search and the result read it, and else each would deal the messages out anew
    base = cut_lineage(df, "messages").withColumn("_clean", clean_for_query(F.col(text_col)))
    found = desk.model.classify(base, id_col, "_clean")
    queries = desk.index.queries(base, id_col, "_clean", desk.index_stop_words)
    hits = with_case_texts(top_k(queries, desk.index, k), desk.kb, "conversation_id", "customer_text", "support_reply")
    best = evidence(hits).withColumnRenamed("query_id", id_col)
    decided = triage.with_triage(found.join(best, id_col, "left"), "_clean")
    replied = with_reply(with_cues(decided), "_clean", desk.voice)
    return replied.select(
        *df.columns, "intent", "intent_confidence", "detected", "decision", "escalation_category", "reason", "reply",
        F.coalesce("evidence", F.expr(f"cast(array() as {best.schema['evidence'].dataType.simpleString()})")).alias("evidence"), F.coalesce("similarity", F.lit(0.0)).alias("top_similarity"),
    )


def keyword_baseline(df: DataFrame, desk: Desk, model: IntentModel, id_col="case_id", text_col="text") -> DataFrame:
    """Uncalibrated model, one keyword pattern, and the best past reply as it is."""
    scored = with_top_class(model.posteriors(df, id_col, text_col), model.classes)
    queries = desk.index.queries(df, id_col, text_col, desk.index_stop_words)
    hits = with_case_texts(top_k(queries, desk.index, 1), desk.kb, "conversation_id", "customer_text", "support_reply")
    top = hits.select(F.col("query_id").alias(id_col), F.col("support_reply").alias("top_reply"))
    out = triage.keyword_baseline(scored.join(top, id_col, "left"), text_col)
    return out.withColumn("intent", F.col("model_intent")).withColumn("intent_confidence", F.round("model_confidence", 4))


# --- labelled cases --------------------------------------------------------------------


def candidate_cases(pool: DataFrame, quotas: dict = V.QUOTAS, seed: int = V.SEED, prefix: str = "CANDIDATE") -> DataFrame:
    """Stratified sample with proposed labels and sequence ids."""
    pooled = labelling.with_pools(pool)
    chosen = stratified_cases(pooled, "conversation_id", quotas, seed=seed)
    labelled = labelling.with_proposal(chosen)
    return labelled.select(
        sequence_id(prefix, F.col("position")).alias("id"), "conversation_id", "customer_text", "proposed_intent",
        "all_applicable_intents", "difficulty_tier", "proposed_triage", "proposed_escalation_category",
        "proposed_escalation_reason", F.col("support_reply").alias("historical_brand_reply"),
        F.lit(False).alias("human_verified"), F.lit("Proposed by rules; waits for review.").alias("audit_status"),
    )


def write_candidates(candidates: DataFrame, out: str) -> None:
    writers.write_json(candidates, f"{out}/candidates.json")
    writers.write_csv(candidates, f"{out}/candidates.csv")


def review_cases(candidates: DataFrame, annotator: str = "reviewer") -> DataFrame:
    """Both review chains over proposed labels."""
    named = candidates.select(
        "id", "conversation_id", "customer_text", "all_applicable_intents", "difficulty_tier", "historical_brand_reply",
        F.col("proposed_intent").alias("intent"), F.col("proposed_triage").alias("decision"),
        F.col("proposed_escalation_category").alias("escalation_category"),
        F.col("proposed_escalation_reason").alias("reason"), F.lit("").alias("annotation_notes"),
    )
    first = labelling.review_pass1(named).withColumnRenamed("rule", "pass1_rule").withColumnRenamed("changed", "pass1_changed")
    second = labelling.review_pass2(first, annotator=annotator)
    return second.withColumnRenamed("rule", "pass2_rule").withColumnRenamed("changed", "pass2_changed")


def gold_cases(reviewed: DataFrame) -> DataFrame:
    """Reviewed cases under the names of the labelled set."""
    return reviewed.select(
        "id", "conversation_id", "customer_text", F.col("intent").alias("golden_intent"), "all_applicable_intents",
        "difficulty_tier", F.col("decision").alias("golden_triage"),
        F.col("escalation_category").alias("golden_escalation_category"),
        F.col("reason").alias("golden_escalation_reason"), "historical_brand_reply", "human_verified",
        "annotation_notes", "human_annotator", "verification_status",
    )


# --- evaluation ---------------------------------------------------------------------------


def evaluation_rows(gold: DataFrame, systems: dict[str, DataFrame]) -> DataFrame:
    """Gold joined to every system's predictions by case id, with rubric and safety flags."""
    g = gold.select(
        F.col("id").alias("case_id"), F.col("golden_intent").alias("gold_intent"), F.col("golden_triage").alias("gold_decision"),
        F.col("difficulty_tier").alias("tier"), "all_applicable_intents", "historical_brand_reply",
    )
    wanted = {n: p.select("case_id", F.col("intent").alias("pred_intent"), F.col("decision").alias("pred_decision"), "reply") for n, p in systems.items()}
    aligned = metrics.align(g, metrics.stack_systems(wanted))
    scored = rubric.with_scores(aligned, "reply", "pred_intent", "pred_decision")
    return scored.withColumn("pii_violation", solicits_credentials(F.col("reply")))


def evaluation_report(rows: DataFrame, labels: list[str] = V.INTENTS) -> DataFrame:
    """Long table (system, scope, label, metric, value) of every metric."""
    c = metrics.cells(rows)
    none = F.lit("")
    keyed = rows.withColumn("_key", F.concat_ws("|", "system", "case_id"))
    lexical = lexical_scores(keyed, "_key", "reply", "historical_brand_reply").withColumn(
        "system", F.substring_index("_key", "|", 1)
    )
    parts = [
        metrics.long_report(metrics.macro_scores(c, labels), F.lit("headline"), none, ["macro_precision", "macro_recall", "macro_f1"]),
        metrics.long_report(metrics.accuracy(c), F.lit("headline"), none, ["accuracy", "count"]),
        metrics.long_report(
            metrics.triage_rates(metrics.triage_counts(c)), F.lit("triage"), none,
            ["tp", "fp", "tn", "fn", "triage_accuracy", "escalation_precision", "escalation_recall", "safe_auto_precision",
             "missed_escalation_rate", "false_escalation_rate"],
        ),
        metrics.long_report(metrics.tier_breakdown(c), F.lit("tier"), F.col("tier"), ["count", "accuracy", "macro_f1"]),
        metrics.long_report(
            metrics.class_scores(c, labels), F.lit("class"), F.col("label"), ["precision", "recall", "f1", "support"]
        ).withColumn("value", F.round("value", 4)),
        metrics.long_report(
            rows.groupBy("system").agg(
                F.round(F.avg((~F.col("pii_violation")).cast("double")), 4).alias("pii_safety_rate"),
                F.round(F.avg(F.col("passed").cast("double")), 4).alias("reply_pass_rate"),
            ),
            F.lit("headline"), none, ["pii_safety_rate", "reply_pass_rate"],
        ),
        metrics.long_report(
            lexical.groupBy("system").agg(
                F.round(F.avg("ngram_precision_1"), 4).alias("ngram_precision_1"),
                F.round(F.avg("ngram_precision_2"), 4).alias("ngram_precision_2"),
                F.round(F.avg("rouge_l"), 4).alias("rouge_l"),
            ),
            F.lit("lexical"), none, ["ngram_precision_1", "ngram_precision_2", "rouge_l"],
        ),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def evaluate(gold: DataFrame, systems: dict[str, DataFrame], out: str | None = None) -> DataFrame:
    """The long report.  With out it is written as JSON, next to its side-by-side form, and read back: no scratch table stays."""
    if out is None:
        return evaluation_report(cut_lineage(evaluation_rows(gold, systems), "evaluation-rows"))
    spark = gold.sparkSession
    with run_folder(spark, "evaluation"):
        report = cut_lineage(evaluation_report(cut_lineage(evaluation_rows(gold, systems), "evaluation-rows")), "evaluation-report")
        writers.write_json(report, f"{out}/metrics.json")
        writers.write_csv(metrics.side_by_side(report, list(systems)), f"{out}/side_by_side.csv")
    return spark.read.schema(report.schema).json(f"{out}/metrics.json")


def analyse_failures(gold: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row per (case, bucket)."""
    return failures.bucket_rows(evaluation_rows(gold, {"system": predictions}))


# --- audits ---------------------------------------------------------------------------------


def audit_brands(threads: DataFrame, sample_per_brand: int | None = None, seed: int = V.SEED) -> DataFrame:
    """Scorecard with up to three sample threads per brand."""
    card = brand_audit.scorecard(brand_audit.brand_measures(threads, sample_per_brand, seed))
    if "turns" not in threads.columns:
        return card
    samples = brand_audit.sample_threads(threads, seed=seed).groupBy("brand").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("sample_no", "turns"))), lambda s: s["turns"]).alias("sample_threads")
    )
    return card.join(samples, "brand", "left").orderBy(F.desc("composite_score"), "brand")


def audit_reply_graph(messages: DataFrame, brands: list[str], sample: int | None = None) -> DataFrame:
    return reply_graph.audit(messages, brands, sample)


def discover_topics(conversations: DataFrame, brand: str | None = None, audit_size: int | None = None) -> DataFrame:
    """First messages with their topics; ``audit_size`` None takes every qualifying message."""
    raw = conversations if brand is None else conversations.where(F.col("company") == brand)
    threads = threads_from_transcripts(raw, strict_turns(F.col("conversation")))
    first = topics.qualifying(threads.select("conversation_id", "customer_text"), "customer_text")
    if audit_size is not None:
        first = topics.first_messages(first, "conversation_id", audit_size)
    return topics.with_topics(first, "customer_text")


def discovery_summary(topic_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return topics.distribution(topic_rows), topics.samples(topic_rows, "conversation_id")
