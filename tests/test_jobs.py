"""End-to-end jobs, snapshots and the classifier on the small tables."""

import dataclasses
import shutil
import glob
import os

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from bindings import inputs as I
from tests.conftest import SF
from triagelake import fixed_values as V
from triagelake.operators import intent_model, labelling, similar, vectors
from triagelake.operators.leakage import label_coverage
from triagelake.plans import jobs
from triagelake.session import cut_lineage, scratch_path
from triagelake.sources import readers, snapshots, writers


@pytest.fixture(scope="module")
def corpus(spark):
    """Three copies of the exchanges with distinct ids, so that quotas can fill."""
    t = I.transcripts(spark, SF)
    many = t.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(3)))).select(
        "company", F.concat_ws("-", "conversation_id", "n").alias("conversation_id"),
        F.replace("conversation", F.lit("\nSupport:  "), F.concat(F.lit(" variant "), F.col("n").cast("string"), F.lit("\nSupport:  "))).alias("conversation"),
    )
    return cut_lineage(many, "corpus")


@pytest.fixture(scope="module")
def desk(spark, corpus):
    pairs = cut_lineage(jobs.clean_pairs(corpus), "pairs")
    stop = vectors.standard_stop_words()
    index = similar.build_index(pairs, "conversation_id", "customer_text", stop)
    weak = labelling.weak_labels(pairs, "conversation_id", "customer_text")
    model = intent_model.train(weak, vectors.classifier_stop_words(), max_iter=30, folds=3)
    return jobs.Desk(model, index, pairs.select("conversation_id", "customer_text", "support_reply"), stop)


def test_prepare_corpus(spark, corpus):
    out = scratch_path(spark, "corpus-out")
    pool, kb = jobs.prepare_corpus(corpus, out, holdout=10)
    assert pool.count() == 10
    assert pool.join(kb, "conversation_id").count() == 0
    assert pool.select(F.lower("customer_text").alias("t")).join(kb.select(F.lower("customer_text").alias("t")), "t").count() == 0
    back = readers.kb_pairs(spark, f"{out}/kb")
    assert back.columns == ["conversation_id", "customer_text", "support_reply", "raw_customer_text", "raw_support_reply", "turn_count"]
    one = jobs.clean_pairs(corpus, "brand_1")
    assert 0 < one.count() < jobs.clean_pairs(corpus).count()


def test_message_scoring(spark, desk):
    texts = [
        ("a", "Where is my parcel, and when will it arrive?"), ("b", "Someone hacked my account"),
        ("c", "xqzt"), ("d", "the vase came shattered and the box was torn"),
    ]
    df = spark.createDataFrame(texts, "case_id string, text string")
    got = {r["case_id"]: r for r in jobs.score_messages(df, desk).collect()}
    assert set(got) == {"a", "b", "c", "d"}
    assert got["a"]["intent"] == "DELIVERY_STATUS_DELAY" and len(got["a"]["evidence"]) == 2
    assert got["b"]["intent"] == "ACCOUNT_SECURITY_ACCESS" and got["b"]["decision"] == "ESCALATE"
    assert got["c"]["evidence"] == [] and got["c"]["top_similarity"] == 0.0
    assert got["c"]["intent_confidence"] < V.CONFIDENCE_GATE
    assert got["c"]["escalation_category"] == "AMBIGUOUS_INQUIRY_NEEDS_CLARIFICATION"
    for r in got.values():
        assert 0.0 <= r["intent_confidence"] <= 1.0
        assert r["reply"] and "{" not in r["reply"]


def test_stream_scoring_equals_batch_scoring(spark, desk):
    from triagelake.streaming import streams

    msgs = desk.kb.select(F.col("conversation_id").alias("case_id"), F.col("customer_text").alias("text")).orderBy("case_id").limit(12)
    path = scratch_path(spark, "msgs")
    msgs.coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(msgs.schema).parquet(path)
    out = streams.run_updates_to_table(stream, "scored", transform=lambda b: jobs.score_messages(b, desk))
    cols = ["case_id", "intent", "intent_confidence", "decision", "escalation_category", "reply", "top_similarity"]
    got = sorted(tuple(r) for r in out.select(*cols).collect())
    assert got == sorted(tuple(r) for r in jobs.score_messages(msgs, desk).select(*cols).collect()) and len(got) == 12


def test_posteriors_sum_to_one(spark, desk):
    df = desk.model.posteriors(desk.kb, "conversation_id", "customer_text")
    for r in df.select("posterior").collect():
        assert sum(r["posterior"]) == pytest.approx(1.0) and min(r["posterior"]) >= 0
    assert sum(desk.model.empty_posterior()) == pytest.approx(1.0)


def test_model_recovers_its_weak_labels(spark, desk):
    labelled = labelling.weak_labels(desk.kb, "conversation_id", "customer_text")
    got = intent_model.with_top_class(desk.model.posteriors(labelled, "id", "text"), desk.model.classes)
    assert got.where(F.col("label") == F.col("model_intent")).count() > 0.7 * got.count()


def test_fit_is_the_optimum_and_folds_hold_every_class(spark, desk):
    weak = labelling.weak_labels(desk.kb, "conversation_id", "customer_text")
    model = intent_model.train(weak, vectors.classifier_stop_words(), folds=3)
    got = intent_model.optimality(model, weak).collect()
    assert len(got) == 3 * len(model.classes) and all(r["gradient"] < 1e-4 and r["sigmoid_gradient"] < 1e-6 for r in got)
    worse = dataclasses.replace(model, intercepts=[[v + 0.1 * j for j, v in enumerate(row)] for row in model.intercepts])
    assert max(r["gradient"] for r in intent_model.optimality(worse, weak).collect()) > 1e-3
    dealt = intent_model.with_folds(weak, model.classes, 3, 42).groupBy("label", "fold").count().collect()
    sizes = {}
    for r in dealt:
        sizes.setdefault(r["label"], []).append(r["count"])
    assert all(max(v) - min(v) <= 1 for v in sizes.values() if len(v) == 3)


@pytest.mark.parametrize("calibrated", [True, False])
def test_a_class_with_one_row_trains_and_scores(spark, calibrated):
    texts = [(i, f"parcel late number{i % 5}", "A") for i in range(9)] + [(20 + i, f"card charged twice{i % 4}", "B") for i in range(8)] + [(90, "strange zebra", "Z")]
    weak = spark.createDataFrame(texts, "id long, text string, label string")
    model = intent_model.train(weak, [], folds=3, calibrated=calibrated)
    assert model.classes == ["A", "B", "Z"]
    got = {r["id"]: r for r in intent_model.with_top_class(model.posteriors(weak, "id", "text"), model.classes).collect()}
    assert all(len(r["posterior"]) == 3 and abs(sum(r["posterior"]) - 1) < 1e-9 for r in got.values())
    assert got[0]["model_intent"] == "A" and got[20]["model_intent"] == "B" and (calibrated or got[90]["model_intent"] == "Z")
    checked = intent_model.optimality(model, weak).collect()
    assert all(r["gradient"] < 1e-4 and r["sigmoid_gradient"] < 1e-6 for r in checked) and {r["n_trained"] for r in checked if r["label"] == "Z"} == {1}
    one = intent_model.train(weak.where("label = 'A'"), [], folds=3, calibrated=calibrated)
    assert [r["posterior"] for r in one.posteriors(weak.limit(1), "id", "text").collect()] == [[1.0]]


def test_sigmoid_fit_is_a_stationary_point():
    rng = np.random.default_rng(0)
    m = rng.normal(size=500)
    y = rng.random(500) < 1 / (1 + np.exp(-(2 * m - 0.5)))
    a, b = intent_model.fit_sigmoid(m, y)
    p = 1 / (1 + np.exp(a * m + b))
    t = np.where(y, (y.sum() + 1) / (y.sum() + 2), 1 / ((~y).sum() + 2))
    assert abs(np.sum(t - p)) < 1e-5 and abs(np.sum((t - p) * m)) < 1e-5
    assert a == pytest.approx(-2, abs=0.5)
    assert intent_model.fit_sigmoid(m, np.zeros(500, bool))[1] > 0  # a class without cases stays unlikely


def test_candidates_review_and_evaluation(spark, corpus, desk):
    pool = jobs.clean_pairs(corpus)
    quotas = {"normal": 30, "per_intent": 3, "difficult": 10, "collisions": 6, "adversarial": 5}
    cand = cut_lineage(jobs.candidate_cases(pool, quotas), "candidates")
    rows = cand.orderBy("id").collect()
    assert rows[0]["id"] == "CANDIDATE-001" and len({r["id"] for r in rows}) == len(rows)
    out = scratch_path(spark, "cases")
    jobs.write_candidates(cand, out)
    assert spark.read.json(f"{out}/candidates.json").count() == len(rows)
    assert writers.read_csv(spark, f"{out}/candidates.csv", cand.withColumn("all_applicable_intents", F.lit("")).schema).count() == len(rows)
    gold = cut_lineage(jobs.gold_cases(jobs.review_cases(cand)), "gold")
    assert gold.count() == len(rows) and gold.where(~F.col("human_verified")).count() == 0
    assert label_coverage(gold, "difficulty_tier", V.TIERS).count() == 0

    msgs = gold.select(F.col("id").alias("case_id"), F.col("customer_text").alias("text"))
    hybrid = cut_lineage(jobs.score_messages(msgs, desk), "hybrid")
    simple = cut_lineage(jobs.keyword_baseline(msgs, desk, desk.model), "simple")
    report = jobs.evaluate(gold, {"hybrid": hybrid, "keyword": simple}, scratch_path(spark, "report"))
    value = {(r["system"], r["scope"], r["label"], r["metric"]): r["value"] for r in report.collect()}
    for s in ("hybrid", "keyword"):
        assert sum(value[(s, "triage", "", m)] for m in ("tp", "fp", "tn", "fn")) == len(rows)
        assert value[(s, "headline", "", "count")] == len(rows)
        assert 0 <= value[(s, "lexical", "", "rouge_l")] <= 1
    assert value[("hybrid", "headline", "", "pii_safety_rate")] == 1.0
    buckets = jobs.analyse_failures(gold, hybrid)
    adversarial = buckets.where(F.col("bucket") == "adversarial_edge_cases").count()
    assert adversarial == gold.where(F.col("difficulty_tier") == "adversarial").count()


def test_labelled_cases_reader(spark):
    path = scratch_path(spark, "gold-json")
    os.makedirs(path)
    with open(f"{path}/cases.json", "w") as f:
        f.write('[{"id": "G-1", "customer_text": "a\\nb", "all_applicable_intents": ["x", "y"], "human_verified": true},\n {"id": "G-2"}]')
    got = {r["id"]: r for r in readers.labelled_cases(spark, path).collect()}
    assert got["G-1"]["all_applicable_intents"] == ["x", "y"] and got["G-2"]["customer_text"] is None


def test_audits(spark, corpus):
    from triagelake.operators.turns import joined_turns, threads_from_transcripts

    threads = threads_from_transcripts(corpus, joined_turns(F.col("conversation")))
    card = jobs.audit_brands(threads, sample_per_brand=50).collect()
    assert [r["composite_score"] for r in card] == sorted((r["composite_score"] for r in card), reverse=True)
    assert all(r["sample_size"] <= 50 and 1 <= len(r["sample_threads"]) <= 3 for r in card)
    graph = jobs.audit_reply_graph(I.messages(spark, SF), I.BRANDS).collect()
    assert all(r["usable_pairs"] <= r["outbound_messages"] and len(r["sample_pairs"]) <= 5 for r in graph)


def test_topic_discovery(spark, corpus):
    found = jobs.discover_topics(corpus, audit_size=40)
    dist, samples = jobs.discovery_summary(found)
    assert dist.agg(F.sum("n")).collect()[0][0] == found.count() <= 40
    assert samples.where(F.col("rank") > 10).count() == 0


# --- snapshots ------------------------------------------------------------------------------


def test_snapshot_is_reused_forced_and_rebuilt(spark):
    root, calls = scratch_path(spark, "snap"), []

    def build():
        calls.append(1)
        return {"t": spark.range(3).withColumn("v", F.lit(len(calls)))}, {"n": len(calls)}

    assert snapshots.load_or_build(spark, root, build)[1] == {"n": 1}
    assert snapshots.load_or_build(spark, root, build)[1] == {"n": 1} and len(calls) == 1
    assert snapshots.load_or_build(spark, root, build, force=True)[1] == {"n": 2}
    tables, meta = snapshots.load_or_build(spark, root, build)
    assert meta == {"n": 2} and tables["t"].collect()[0]["v"] == 2
    for part in glob.glob(f"{root}/versions/*/t/*.parquet"):
        with open(part, "wb") as f:
            f.write(b"broken")
    for crc in glob.glob(f"{root}/versions/*/t/.*.crc"):
        with open(crc, "wb") as f:
            f.write(b"")
    assert snapshots.load_or_build(spark, root, build)[1] == {"n": 3}


def test_model_snapshot_gives_the_same_posteriors(spark, desk):
    root = scratch_path(spark, "model")
    again = snapshots.intent_model(spark, root, lambda: desk.model)
    df = desk.kb.orderBy("conversation_id").limit(5)
    a = desk.model.posteriors(df, "conversation_id", "customer_text").orderBy("conversation_id").collect()
    b = again.posteriors(df, "conversation_id", "customer_text").orderBy("conversation_id").collect()
    for x, y in zip(a, b):
        assert x["posterior"] == pytest.approx(y["posterior"])


def _part_files(root, version_of="numbers"):
    return sorted(os.path.join(d, f) for d, _, files in os.walk(root) for f in files if f.endswith(".parquet") and os.path.basename(d) == version_of)


@pytest.mark.parametrize("damage", ["garbage", "other rows", "gone", "one more"])
def test_a_damaged_second_file_is_rebuilt_and_logged(spark, caplog, damage):
    root = scratch_path(spark, "damaged")
    calls = []

    def build():
        calls.append(1)
        return {"numbers": spark.range(0, 1000, 1, 4).withColumn("v", F.col("id") * 2), "names": spark.createDataFrame([("a",)], "n string")}, {"built": len(calls)}

    snapshots.load_or_build(spark, root, build)
    files = _part_files(root)
    assert len(files) == 4 and "no snapshot" in caplog.text
    crc = os.path.join(os.path.dirname(files[1]), f".{os.path.basename(files[1])}.crc")
    if damage in ("garbage", "gone"):
        os.remove(files[1])
        os.remove(crc)
    if damage == "garbage":
        with open(files[1], "wb") as f:
            f.write(b"not parquet at all")
    if damage in ("other rows", "one more"):
        other = scratch_path(spark, "other")
        spark.range(250).withColumn("v", F.col("id") * 3).coalesce(1).write.parquet(other)
        target = files[1] if damage == "other rows" else os.path.join(os.path.dirname(files[1]), "part-99999-more.snappy.parquet")
        if os.path.exists(crc) and damage == "other rows":
            os.remove(crc)
        shutil.copy(_part_files(os.path.dirname(other), os.path.basename(other))[0], target)
    with pytest.raises(snapshots.DamagedSnapshot):
        snapshots.load(spark, root)
    caplog.clear()
    tables, meta = snapshots.load_or_build(spark, root, build)
    assert meta == {"built": 2} and "rebuilding the snapshot" in caplog.text and tables["numbers"].agg(F.sum("v")).head()[0] == 999000
    assert snapshots.load_or_build(spark, root, build)[1] == {"built": 2}


def test_missing_rights_and_own_errors_surface(spark):
    with pytest.raises(PySparkException), snapshots._reading("x"):
        raise PySparkException("org.apache.hadoop.security.AccessControlException: Permission denied: user=a")
    with pytest.raises(snapshots.DamagedSnapshot), snapshots._reading("x"):
        raise PySparkException("not a parquet file")

    def broken():
        raise KeyError("own mistake")

    with pytest.raises(KeyError):
        snapshots.load_or_build(spark, scratch_path(spark, "none"), broken)
