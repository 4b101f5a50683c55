"""TF-IDF, similar cases, snapshots and the classifier."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from bindings import duck as D
from bindings import inputs as I
from bindings.registry import query
from triagelake import brand_voice as B
from triagelake import fixed_values as V
from triagelake.functions.text import clean_for_query, strip_negated
from triagelake.operators import intent_model as M
from triagelake.operators import labelling, similar, vectors
from triagelake.operators.replies import with_cues
from triagelake.plans import jobs
from triagelake.session import cut_lineage, scratch_path, shared_folder
from triagelake.sources import snapshots

_N = "SELECT count(*) FROM documents"
_INDEX = [
    ("tf", D.terms("documents", "doc_id")),
    ("voc", D.vocab("tf", _N, None)),
    ("post", D.vectors("tf", "voc")),
]
_HITS = _INDEX + [
    ("qtf", D.terms("benchmark", "item_id")),
    ("qv", D.vectors("qtf", "voc")),
    ("hits", """SELECT query_id, rank, doc_id, round(s, 4) AS similarity FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc_id) AS rank FROM (
          SELECT q.id AS query_id, p.id AS doc_id, round(sum(q.w * p.w), 10) AS s FROM qv q JOIN post p ON q.term = p.term GROUP BY ALL) WHERE s > 0)
        WHERE rank <= 3"""),
]


def _docs(spark, d):
    return I.table(spark, d, "documents").select("doc_id", "text")


def _index(spark, d):
    return similar.build_index(_docs(spark, d), "doc_id", "text", I.STOP_WORDS, max_terms=None)


def _packed_index(spark, d, written=True):
    return similar.build_index(_docs(spark, d), "doc_id", "text", I.STOP_WORDS, max_terms=None, packed=True, written=written)


def _queries(spark, d, index):
    return index.vectors(I.table(spark, d, "benchmark"), "item_id", "text", I.STOP_WORDS)


@query("tfidf_vocab", D.with_(extra=_INDEX[:2]) + "SELECT term, total_tf, df, round(idf, 6) AS idf FROM voc")
def tfidf_vocab(spark, d):
    counts = vectors.term_counts(_docs(spark, d), "doc_id", "text", I.STOP_WORDS)
    v = vectors.vocabulary(counts, vectors.document_count(_docs(spark, d)), None)
    return v.select("term", "total_tf", "df", F.round("idf", 6).alias("idf"))


@query("tfidf_weights", D.with_(extra=_INDEX) + "SELECT id, count(*) AS n_terms, round(sum(w), 6) AS total, round(max(w), 6) AS top FROM post GROUP BY ALL")
def tfidf_weights(spark, d):
    return _index(spark, d).postings.groupBy("id").agg(
        F.count(F.lit(1)).alias("n_terms"), F.round(F.sum("w"), 6).alias("total"), F.round(F.max("w"), 6).alias("top")
    )


def _hits(spark, d, k=3):
    index = _index(spark, d)
    return similar.top_k(_queries(spark, d, index), index, k)


def _shown(hits):
    return hits.select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", "similarity")


@query("similar_cases", D.with_(extra=_HITS) + "SELECT * FROM hits")
def similar_cases(spark, d):
    return _shown(_hits(spark, d))


@query("similar_cases_pruned", D.with_(extra=_HITS) + "SELECT * FROM hits")
def similar_cases_pruned(spark, d):
    """The same answer in many small rounds."""
    index = _index(spark, d)
    return _shown(similar.top_k(_queries(spark, d, index), index, 3, budget=100, growth=4))


@query("case_evidence", D.with_(extra=_HITS) + f"""SELECT query_id, rank, doc_id, similarity, md5({D.mask('text')}) AS masked_digest
    FROM hits JOIN documents USING (doc_id)""")
def case_evidence(spark, d):
    kb = _docs(spark, d).withColumn("reply", F.col("text"))
    hits = similar.with_case_texts(_hits(spark, d), kb, "doc_id", "text", "reply")
    return hits.select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", "similarity", F.md5("customer_text").alias("masked_digest"))


@query("top1_similarity", D.with_(extra=_HITS) + """SELECT count(*) AS n_queries, round(sum(round(coalesce(similarity, 0) * 10000)::BIGINT)::DOUBLE / count(*)) / 10000 AS mean_top1_similarity
    FROM benchmark b LEFT JOIN hits h ON b.item_id = h.query_id AND h.rank = 1""")
def top1_similarity(spark, d):
    return similar.mean_top1(_hits(spark, d, 1), I.table(spark, d, "benchmark"), "item_id")


@query("index_reload", D.with_(extra=_HITS) + "SELECT step, hits.* FROM hits, (VALUES ('built'), ('reloaded'), ('forced')) s(step)")
def index_reload(spark, d):
    root = scratch_path(spark, "index")
    out = None
    for step, force in (("built", False), ("reloaded", False), ("forced", True)):
        index = snapshots.term_index(spark, root, lambda: _packed_index(spark, d, written=False), force)
        hits = _shown(similar.top_k(_queries(spark, d, index), index, 3)).withColumn("step", F.lit(step))
        out = hits if out is None else out.unionByName(hits)
    return out


# --- classifier -------------------------------------------------------------------------


def weak_rows(spark, d, per_class=V.TRAIN_PER_CLASS):
    return labelling.weak_labels(I.inbox(spark, d), "msg_id", "text", per_class)


def uncalibrated_model(spark, d):
    """The classifier of the keyword baseline and the rows it was fitted on."""
    sample = labelling.weak_labels_sampled(I.inbox(spark, d), "msg_id", "text")
    return M.train(sample, vectors.standard_stop_words(), V.BASELINE_TERMS, sublinear=False, calibrated=False), sample


@query("intent_model")
def intent_model(spark, d):
    """Uncalibrated classifier over the whole inbox."""
    model, _ = uncalibrated_model(spark, d)
    out = M.with_top_class(model.posteriors(I.inbox(spark, d), "msg_id", "text"), model.classes)
    return out.select("msg_id", "model_intent", F.round("model_confidence", 4).alias("model_confidence"))


def calibrated_model(spark, d):
    """Trained once per application and data folder, then read from its snapshot."""
    root = f"{shared_folder(spark)}/models-{spark.sparkContext.applicationId}/{os.path.basename(d.rstrip('/'))}"
    return snapshots.intent_model(spark, root, lambda: M.train(weak_rows(spark, d), vectors.classifier_stop_words()))


@query("intent_calibrated")
def intent_calibrated(spark, d):
    model = calibrated_model(spark, d)
    out = model.classify(I.inbox(spark, d), "msg_id", "text")
    return out.select("msg_id", "intent", "intent_confidence")


#: Largest entry of a gradient at which a fit counts as the optimum.
OPTIMAL = 1e-4


def _optimum(model, weak):
    checked = M.optimality(model, weak)
    return checked.select("fold", "label", "n_trained", ((F.col("gradient") < OPTIMAL) & (F.col("sigmoid_gradient") < OPTIMAL)).alias("optimal"))


_WEAK_CAPPED = f"""SELECT label FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY id) AS rn FROM (
    SELECT msg_id AS id, {D.priority('det')} AS label FROM (SELECT msg_id, {D.detect('text')} AS det FROM inbox) WHERE len(det) > 0))
  WHERE rn <= {V.TRAIN_PER_CLASS}"""


@query("intent_calibrated_optimum", D.with_("inbox") + f"""SELECT fold::INTEGER AS fold, label, CASE WHEN n < 5 THEN n ELSE n - (n // 5 + CASE WHEN fold < n % 5 THEN 1 ELSE 0 END) END AS n_trained, true AS optimal
  FROM (SELECT label, count(*) AS n FROM ({_WEAK_CAPPED}) GROUP BY label), (SELECT unnest(range(5)) AS fold)""")
def intent_calibrated_optimum(spark, d):
    """The calibrated classifier of `intent_calibrated` is the optimum of its rows: gradients of five fits and all sigmoids."""
    return _optimum(calibrated_model(spark, d), weak_rows(spark, d))


@query("intent_model_optimum", D.with_("inbox") + f"""SELECT 0 AS fold, {D.priority('det')} AS label, count(*) AS n_trained, true AS optimal FROM (
    SELECT {D.detect('text')} AS det FROM inbox ORDER BY {D.seeded('msg_id')}, msg_id LIMIT {V.BASELINE_SAMPLE}) GROUP BY ALL""")
def intent_model_optimum(spark, d):
    """The classifier of `intent_model` is the optimum of its rows."""
    return _optimum(*uncalibrated_model(spark, d))


def desk(spark, d) -> jobs.Desk:
    # written once: the vocabulary, the index and the texts of its hits read it, and else each would join the turns anew
    kb = cut_lineage(I.pairs(spark, d).select("conversation_id", "customer_text", "support_reply"), "cases")
    stop = vectors.standard_stop_words()
    index = similar.build_index(kb, "conversation_id", "customer_text", stop)
    return jobs.Desk(calibrated_model(spark, d), index, kb, stop)


@query("scored_messages")
def scored_messages(spark, d):
    out = jobs.score_messages(I.inbox(spark, d), desk(spark, d), "msg_id", "text")
    return out.select(
        "msg_id", "intent", "intent_confidence", "decision", "escalation_category", "reason", "reply", "top_similarity",
        F.size("evidence").alias("n_evidence"),
    )


# --- replies and the keyword baseline on retrieved cases -------------------------------------

_BOX_INDEX = [
    ("ktf", D.terms("pairs", "conversation_id", "customer_text")),
    ("kvoc", D.vocab("ktf", "SELECT count(*) FROM pairs", None)),
    ("kpost", D.vectors("ktf", "kvoc")),
]


def _box_hits(source: str, text: str, k: int):
    return [
        *_BOX_INDEX,
        ("btf", D.terms(source, "msg_id", text)),
        ("bv", D.vectors("btf", "kvoc")),
        ("found_cases", f"""SELECT query_id, rank, doc_id, round(s, 4) AS similarity FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, doc_id) AS rank FROM (
              SELECT q.id AS query_id, p.id AS doc_id, round(sum(q.w * p.w), 10) AS s FROM bv q JOIN kpost p ON q.term = p.term GROUP BY ALL) WHERE s > 0)
            WHERE rank <= {k}"""),
    ]


def _case_base(spark, d):
    return I.pairs(spark, d).select("conversation_id", "customer_text", "support_reply")


def _case_index(spark, d):
    return similar.build_index(_case_base(spark, d), "conversation_id", "customer_text", I.STOP_WORDS, max_terms=None)


_BEST_OTHER = ("best", f"""SELECT m.msg_id, coalesce(h.similarity, 0.0) AS similarity, coalesce(h.doc_id, '-') AS case_id,
    CASE WHEN h.similarity >= {V.EVIDENCE_GATE} THEN {D.mask('p.support_reply')} ELSE '' END AS past FROM cleaned m
    LEFT JOIN (SELECT query_id, min_by(doc_id, rank) AS doc_id, min_by(similarity, rank) AS similarity FROM found_cases WHERE doc_id <> query_id GROUP BY query_id) h
      ON h.query_id = m.msg_id LEFT JOIN pairs p ON p.conversation_id = h.doc_id""")
_CLEANED = ("cleaned", f"SELECT msg_id, {D.clean_query('text')} AS clean FROM inbox")


@query("reply_cues_retrieved", D.with_("inbox", "pairs", extra=[_CLEANED, *_box_hits("cleaned", "clean", 2), _BEST_OTHER]) + f"""SELECT msg_id, similarity, case_id,
    {D.signature('past')} AS cue_signature, coalesce({D.carrier('past')}, '-') AS cue_carrier, {D.rx('past', V.NEIGHBOUR_CHECK)} AS cue_neighbour FROM best""")
def reply_cues_retrieved(spark, d):
    """Cues of the best past case that the index finds for each message, its own case left out."""
    base = I.inbox(spark, d).select("msg_id", clean_for_query(F.col("text")).alias("clean"))
    index = _case_index(spark, d)
    hits = similar.top_k(index.vectors(base, "msg_id", "clean", I.STOP_WORDS), index, 2).where(F.col("doc_id") != F.col("query_id"))
    found = similar.evidence(similar.with_case_texts(hits, _case_base(spark, d), "conversation_id", "customer_text", "support_reply"))
    best = base.join(found.withColumnRenamed("query_id", "msg_id"), "msg_id", "left")
    case = F.get(F.col("evidence"), F.lit(0))["conversation_id"]
    out = with_cues(best.withColumn("similarity", F.coalesce("similarity", F.lit(0.0))).withColumn("case_id", F.coalesce(case, F.lit("-"))))
    return out.select("msg_id", "similarity", "case_id", "cue_signature", F.coalesce("cue_carrier", F.lit("-")).alias("cue_carrier"), "cue_neighbour")


@query("keyword_baseline_retrieved", D.with_("inbox", "pairs", extra=_box_hits("inbox", "text", 1)) + f"""SELECT m.msg_id,
    CASE WHEN {D.rx('m.text', V.KEYWORD_ESCALATE)} THEN 'ESCALATE' ELSE 'AUTO_HANDLE' END AS decision,
    CASE WHEN {D.rx('m.text', V.KEYWORD_ESCALATE)} THEN 'ACCOUNT_SPECIFIC_PII_REQUIRED' ELSE 'NONE' END AS escalation_category,
    CASE WHEN h.doc_id IS NULL THEN {D.q(B.KEYWORD_DEFAULT_REPLY)} ELSE {D.mask('p.support_reply')} END AS reply, true AS known_intent
    FROM inbox m LEFT JOIN found_cases h ON h.query_id = m.msg_id LEFT JOIN pairs p ON p.conversation_id = h.doc_id""")
def keyword_baseline_retrieved(spark, d):
    """The keyword baseline with its trained classifier and the index; SQL follows all but the classifier's choice (`intent_model`)."""
    model, _ = uncalibrated_model(spark, d)
    desk = jobs.Desk(model, _case_index(spark, d), _case_base(spark, d), I.STOP_WORDS)
    out = jobs.keyword_baseline(I.inbox(spark, d), desk, model, "msg_id", "text")
    known = F.col("intent").isin(model.classes) & F.col("intent_confidence").between(0, 1)
    return out.select("msg_id", "decision", "escalation_category", "reply", known.alias("known_intent"))


@query("intent_hybrid_model", D.with_("found") + f"""SELECT msg_id, array_to_string(detected, ',') AS detected,
    CASE WHEN list_contains(detected, {D.q(V.SECURITY_INTENT)}) THEN {D.q(V.SECURITY_INTENT)} WHEN len(detected) = 1 THEN detected[1] ELSE '-' END AS forced_intent,
    true AS agrees FROM found""")
def intent_hybrid_model(spark, d):
    """Rules blended with the calibrated classifier: what rules force alone, and whether each other choice is the posterior's best."""
    model = calibrated_model(spark, d)
    base = I.inbox(spark, d).select("msg_id", clean_for_query(F.col("text")).alias("clean"))
    odds = model.posteriors(base.withColumn("ml", strip_negated(F.col("clean"))), "msg_id", "ml").select("msg_id", "posterior")
    both = model.classify(base, "msg_id", "clean").join(odds, "msg_id")
    names = F.array(*[F.lit(c) for c in model.classes])
    by_label = F.map_from_arrays(names, F.col("posterior"))
    security = F.array_contains("detected", V.SECURITY_INTENT)
    rivals = F.when(F.size("detected") == 0, names).when(security, F.array(F.lit(V.SECURITY_INTENT))).otherwise(F.col("detected"))
    best = F.array_max(F.transform(rivals, lambda c: F.coalesce(F.try_element_at(by_label, c), F.lit(0.0))))
    mine = F.coalesce(F.try_element_at(by_label, F.col("intent")), F.lit(0.0))
    # a lone label that the model has not learnt is reported with the model's top probability
    stated = F.when(F.array_contains(names, F.col("intent")), mine).otherwise(F.array_max("posterior"))
    agrees = F.array_contains(rivals, F.col("intent")) & (mine == best) & (F.abs(F.col("intent_confidence") - stated) <= 0.000051)
    forced = F.when(security | (F.size("detected") == 1), F.col("intent")).otherwise("-")
    return both.select("msg_id", F.array_join("detected", ",").alias("detected"), forced.alias("forced_intent"), agrees.alias("agrees"))
