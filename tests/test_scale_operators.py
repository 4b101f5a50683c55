"""Operators that split hot groups, against brute force."""

import random
from collections import defaultdict, deque

import pytest
from pyspark.sql import functions as F

from triagelake import fixed_values as V
from triagelake.operators import admission, leakage, sampling, sessions, similar, topn, vectors
from triagelake.streaming import streams


def test_top_n_of_a_hot_group(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") < 2500, "hot").otherwise("cold").alias("g"), F.md5(F.col("id").cast("string")).alias("k"))
    got = topn.top_n_per_group(df, ["g"], [F.col("k")], 7).collect()
    rows = df.collect()
    for g in ("hot", "cold"):
        want = sorted(r["k"] for r in rows if r["g"] == g)[:7]
        assert [r["k"] for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["rank"])] == want


@pytest.mark.parametrize("n", [5, 1200])
def test_limits_are_cut_in_the_map_tasks(spark, n):
    before = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    df = spark.range(0, 5000, 1, 5).select("id", (F.col("id") % 2).alias("g"))
    out = topn.top_n_per_group(df, ["g"], [F.col("id")], n)
    if n < int(before):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in plan.split("FileScan")[0] and "Partial" in plan
    assert out.count() == 2 * n and out.agg(F.max("id")).collect()[0][0] == 2 * n - 1
    assert spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold") == before  # a caller's session stays as it is


def test_keep_first(frame):
    df = frame("id long, t string", (3, "a"), (1, "b"), (2, "a"), (5, "b"), (4, "c"))
    assert sorted(r["id"] for r in topn.keep_first(df, "t", "id").collect()) == [1, 2, 4]


@pytest.mark.parametrize("chunk", [1, 4, 1000])
def test_carry_forward(spark, chunk):
    rng = random.Random(chunk)
    rows = [(g, o, rng.choice([None, None, o * 10])) for g in ("hot", "b") for o in rng.sample(range(200), 120 if g == "hot" else 5)]
    df = spark.createDataFrame(rows, "g string, o long, v long")
    got = {(r["g"], r["o"]): r["prev"] for r in topn.carry_forward(df, ["g"], "o", {"prev": F.col("v")}, chunk).collect()}
    last = {}
    for g, o, v in sorted(rows):
        assert got[(g, o)] == last.get(g)
        if v is not None:
            last[g] = v


def chat_by_hand(rows):
    out, state = {}, {}
    for s, t, msg, reply, intent, cat in sorted(rows):
        prev = state.get(s)
        order = "112-9876543-1234567" in msg
        follow = bool(prev and prev[0] and order)
        if follow:
            out[(s, t)] = (True, prev[1], prev[2])
            state[s] = (False, prev[1], prev[2])
        else:
            out[(s, t)] = (False, intent, cat)
            state[s] = ("order number" in reply or "direct message" in reply, intent, cat)
    return out


@pytest.mark.parametrize("chunk", [2, 1000])
def test_follow_ups_match_a_turn_by_turn_walk(spark, chunk):
    rng = random.Random(5)
    rows = []
    for s, n in (("hot", 150), ("b", 7), ("c", 1)):
        for t in sorted(rng.sample(range(400), n)):
            msg = "my order 112-9876543-1234567" if rng.random() < 0.7 else "hello"
            reply = "send a direct message" if rng.random() < 0.7 else "fine"
            rows.append((s, t, msg, reply, f"i{t}", f"c{t}"))
    ddl = "session_id string, turn long, message string, reply string, intent string, escalation_category string"
    df = spark.createDataFrame(rows + [(None, 1, "order 112-9876543-1234567", "x", "i", "c")], ddl)
    df = df.withColumn("intent_confidence", F.lit(0.7)).withColumn("decision", F.lit("AUTO_HANDLE")).withColumn("reason", F.lit("r"))
    got = sessions.apply_follow_ups(df, chunk_rows=chunk).collect()
    want = chat_by_hand(rows)
    assert len(got) == len(rows) + 1
    for r in got:
        if r["session_id"] is None:
            assert not r["follow_up"] and not r["multi_turn"]
            continue
        assert (r["follow_up"], r["intent"], r["escalation_category"]) == want[(r["session_id"], r["turn"])]
        if r["follow_up"]:
            assert r["intent_confidence"] == V.FOLLOW_UP_CONFIDENCE and r["decision"] == "ESCALATE"


def test_sent_history_decides_follow_ups(spark):
    order = "Order # 112-9876543-1234567"
    ask = {"agent_reply": "Please send us a direct message with your order number", "intent": "DAMAGED_WRONG_MISSING",
           "escalation_category": "LOST_OR_STOLEN_DELIVERY"}
    rows = [(order, [{"agent_reply": "x"}, ask]), (order, [ask, {"agent_reply": "x"}]), ("hi", [ask]), (order, []), (order, None),
            (order, [{"agent_reply": "your order number?", "intent_confidence": "0.61238"}])]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, message string, history array<map<string,string>>").select(
        "*", F.lit("I").alias("intent"), F.lit(0.7).alias("intent_confidence"), F.lit("AUTO_HANDLE").alias("decision"),
        F.lit("NONE").alias("escalation_category"), F.lit("r").alias("reason"), F.lit("reply").alias("reply"),
    )
    got = sessions.apply_client_history(df).orderBy("i").collect()
    assert [r["follow_up"] for r in got] == [True, False, False, False, False, True]
    assert [r["multi_turn"] for r in got] == [True, True, True, False, False, True]
    assert (got[0]["intent"], got[0]["escalation_category"], got[0]["intent_confidence"]) == ("DAMAGED_WRONG_MISSING", "LOST_OR_STOLEN_DELIVERY", 0.95)
    assert (got[5]["intent"], got[5]["escalation_category"], got[5]["intent_confidence"]) == ("DELIVERY_STATUS_DELAY", "ACCOUNT_SPECIFIC_PII_REQUIRED", 0.6124)
    assert got[1]["intent"] == "I" and "the number is with the specialist" in got[0]["reply"]


def test_session_bounds(spark):
    df = spark.range(15).select(
        F.lit("s").alias("session_id"), F.col("id").alias("turn"), F.concat(F.lit("<b>"), F.col("id").cast("string")).alias("message"),
        F.lit("ok & fine").alias("reply"), F.lit("i").alias("intent"), F.lit("c").alias("escalation_category"),
    )
    turns = sessions.session_table(df, n=5).collect()[0]["turns"]
    assert [t["customer"] for t in turns] == [f"&lt;b&gt;{i}" for i in range(10, 15)]
    assert turns[0]["agent_reply"] == "ok &amp; fine"


def test_least_recent_session_drops_out(frame):
    df = frame("s string, ts long", ("1", 1), ("2", 2), ("3", 3), ("4", 4), ("1", 5), ("5", 6))
    kept = [r["s"] for r in sessions.recent_sessions(df, "s", "ts", 4).collect()]
    assert kept == ["5", "1", "4", "3"]


def admitted_by_hand(rows, limit, window):
    stamps, out = defaultdict(deque), {}
    for k, t, i in sorted(rows):
        s = stamps[k]
        while s and s[0] < t - window:
            s.popleft()
        out[i] = len(s) < limit
        if out[i]:
            s.append(t)
    return out


@pytest.mark.parametrize("limit,window", [(3, 10), (1, 5), (5, 60)])
def test_admission_matches_a_sequential_scan(spark, limit, window):
    rng = random.Random(limit)
    rows, i = [], 0
    for key, n, span in (("hot", 600, 900), ("saturated", 300, 60), ("sparse", 20, 4000)):
        for _ in range(n):
            rows.append((key, rng.randrange(span), i))
            i += 1
    df = spark.createDataFrame(rows, "key string, sec long, id long").withColumn("ts", F.timestamp_seconds("sec"))
    got = {r["id"]: r["admitted"] for r in admission.admission_log(df, "key", "ts", "id", limit, window).collect()}
    assert got == admitted_by_hand(rows, limit, window)


def test_fourth_of_three_is_rejected_and_leaves_no_stamp():
    stamps = deque()
    assert [admission.admit_one(stamps, t, 3, 60) for t in (0, 1, 2, 3, 60, 61)] == [True, True, True, False, False, True]


# --- retrieval ----------------------------------------------------------------------------


def corpus(n, seed, vocabulary=40):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    return [(i, " ".join(rng.choice(words[: 4 if rng.random() < 0.5 else vocabulary]) for _ in range(rng.randrange(3, 12)))) for i in range(n)]


def brute(kb, queries, k, max_terms=10_000):
    import math

    def terms(t):
        w = t.split()
        return w + [f"{a} {b}" for a, b in zip(w, w[1:])]

    tf, df = defaultdict(int), defaultdict(int)
    for _, t in kb:
        for g in terms(t):
            tf[g] += 1
        for g in set(terms(t)):
            df[g] += 1
    vocab = sorted(tf, key=lambda g: (-tf[g], g))[:max_terms]
    idf = {g: math.log((1 + len(kb)) / (1 + df[g])) + 1 for g in vocab}

    def vec(t):
        c = defaultdict(int)
        for g in terms(t):
            if g in idf:
                c[g] += 1
        w = {g: (1 + math.log(n)) * idf[g] for g, n in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        return {g: x / norm for g, x in w.items()} if norm else {}

    docs = [(i, vec(t)) for i, t in kb]
    out = {}
    for q, t in queries:
        v = vec(t)
        s = [(-round(sum(x * d.get(g, 0.0) for g, x in v.items()), 10), i) for i, d in docs]
        out[q] = [(i, round(-x, 4)) for x, i in sorted(s)[:k] if x < 0]
    return out


@pytest.mark.parametrize("budget, growth, part_rows", [(2_000, 8, 50_000), (1, 2, 3), (20, 3, 10), (100_000, 8, 1)])
def test_top_k_equals_brute_force(spark, budget, growth, part_rows):
    kb, queries = corpus(150, 1), corpus(25, 2) + [(900, "unknown words only"), (901, "")]
    d = spark.createDataFrame(kb, "id long, t string")
    q = spark.createDataFrame(queries, "id long, t string")
    index = similar.build_index(d, "id", "t", [], part_rows=part_rows)
    v = index.vectors(q, "id", "t", [])
    hits = similar.top_k(v, index, 3, budget, growth)
    got = defaultdict(list)
    for r in hits.orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["doc_id"], r["similarity"]))
    want = {q: h for q, h in brute(kb, queries, 3).items() if h}
    assert dict(got) == want
    assert 900 not in got and 901 not in got  # no arbitrary rows for a query without a known term
    assert similar.top_k(v.limit(0), index, 3).count() == 0


def test_a_term_of_all_documents_is_not_paired(spark):
    rng = random.Random(6)
    kb = [(i, "always everywhere " + " ".join(f"rare{i % 100}x{j}" for j in range(4)) + f" own{i}") for i in range(2000)]
    queries = [(i, "always everywhere " + " ".join(f"rare{rng.randrange(100)}x{j}" for j in range(4))) for i in range(40)] + [(77, "always everywhere")]
    d, q = spark.createDataFrame(kb, "id long, t string"), spark.createDataFrame(queries, "id long, t string")
    index = similar.build_index(d, "id", "t", [], max_terms=None, part_rows=500)
    assert index.blocks.agg(F.max("parts")).head()[0] == 4
    emitted = []
    got = defaultdict(list)
    for r in similar.top_k(index.vectors(q, "id", "t", []), index, 3, budget=200, emitted=emitted).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["doc_id"], r["similarity"]))
    assert dict(got) == brute(kb, queries, 3)
    assert sum(emitted) < 0.15 * len(kb) * len(queries)  # all documents only for the query that has nothing else


def test_mean_of_the_best_similarity(spark):
    d = spark.createDataFrame(corpus(60, 3), "id long, t string")
    index = similar.build_index(d, "id", "t", [])
    hits = similar.top_k(index.vectors(d, "id", "t", []), index, 1)
    assert all(r["similarity"] == 1.0 for r in hits.collect())
    mean = similar.mean_top1(hits, d.union(spark.createDataFrame([(999, "zz")], d.schema)), "id").collect()[0]
    assert mean["n_queries"] == 61 and mean["mean_top1_similarity"] == round(60 / 61, 4)


def test_vectors_are_unit_length_and_vocabulary_is_bounded(spark):
    d = spark.createDataFrame(corpus(40, 4), "id long, t string")
    index = similar.build_index(d, "id", "t", ["w1"], max_terms=25)
    assert index.vocab.count() == 25
    assert not index.vocab.where(F.col("term").contains("w1 ") | (F.col("term") == "w1")).count()
    for r in index.postings.groupBy("id").agg(F.sum(F.col("w") * F.col("w")).alias("n")).collect():
        assert r["n"] == pytest.approx(1.0)


def test_stop_word_lists(spark):
    words = vectors.classifier_stop_words()
    assert "not" not in words and "never" not in words and "http" in words
    assert "not" in vectors.standard_stop_words()


# --- sampling and leakage -------------------------------------------------------------------


def test_holdout_is_exact_and_disjoint(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("id"))
    pool, kb = sampling.holdout_split(df, "id", 60)
    assert pool.count() == 60 and kb.count() == 440
    leakage.assert_disjoint(pool, kb, "id")
    with pytest.raises(ValueError):
        leakage.assert_disjoint(pool, df, "id")
    inside, outside = sampling.holdout_fraction(df, "id", 0.2)
    assert 50 < inside.count() < 150 and inside.count() + outside.count() == 500


def test_stratified_cases(spark):
    pools = ["adversarial"] * 40 + ["collision"] * 33 + [V.INTENTS[i % 8] for i in range(400)]
    rows = [(f"c{i:04d}", p, "x" * (150 if i % 3 == 0 else 20)) for i, p in enumerate(pools)]
    df = spark.createDataFrame(rows, "conversation_id string, pool string, customer_text string")
    out = sampling.stratified_cases(df, "conversation_id").collect()
    tiers = defaultdict(list)
    for r in sorted(out, key=lambda r: r["position"]):
        tiers[r["difficulty_tier"]].append(r)
    assert {t: len(v) for t, v in tiers.items()} == {"normal": 140, "difficult": 37, "adversarial": 20}
    assert len({r["conversation_id"] for r in out}) == len(out)
    assert [r["position"] for r in sorted(out, key=lambda r: r["position"])] == list(range(1, 198))
    assert [r["pool"] for r in tiers["difficult"]][30:34] == V.LONG_PICK_INTENTS
    per = defaultdict(int)
    for r in tiers["normal"]:
        per[r["pool"]] += 1
    assert set(per) == set(V.INTENTS) and min(per.values()) >= 17


def test_shared_texts_and_coverage(frame):
    a, b = frame("t string", (" Hello ",), ("hello",), ("x",)), frame("t string", ("HELLO",), ("y",))
    r = leakage.shared_texts(a, b, "t", "t").collect()
    assert [(x["n_left"], x["n_right"]) for x in r] == [(2, 1)]
    assert sorted(x["t"] for x in leakage.leaked_rows(a, b, "t", "t").collect()) == [" Hello ", "hello"]
    got = {(x["label"], x["problem"]) for x in leakage.label_coverage(frame("l string", ("a",), ("z",)), "l", ["a", "b"]).collect()}
    assert got == {("b", "missing"), ("z", "undeclared")}


def test_streaming_rows_are_ordered_inside_a_trigger():
    import pandas as pd

    parts = [pd.DataFrame({"t": [3, 1]}), pd.DataFrame({"t": []}), pd.DataFrame({"t": [2]})]
    assert [list(p["t"]) for p in streams._in_order(iter(parts), "t")] == [[1, 2, 3]]
    assert list(streams._in_order(iter([]), "t")) == []


def test_keep_first_keeps_one_row_of_repeated_ids(frame):
    from triagelake.operators.topn import keep_first

    df = frame("id long, text string", (1, "a"), (1, "a"), (2, "a"), (3, "b"), (None, "c"), (None, "c"), (4, None))
    assert sorted((r.text or "", r.id or 0) for r in keep_first(df, "text", "id").collect()) == [("", 4), ("a", 1), ("b", 3), ("c", 0)]


def test_hybrid_reports_the_top_probability_for_an_unknown_class(frame):
    from pyspark.sql import functions as F

    from triagelake import fixed_values as V
    from triagelake.operators.intents import hybrid

    classes = [i for i in V.INTENTS if i != V.SECURITY_INTENT]
    df = frame("detected array<string>, posterior array<double>", ([V.SECURITY_INTENT], [0.7] + [0.05] * (len(classes) - 1)))
    got = df.select(hybrid(F.col("detected"), F.col("posterior"), classes).alias("h")).head().h
    assert got.intent == V.SECURITY_INTENT and got.confidence == 0.7


def test_audit_returns_a_brand_that_is_only_mentioned(frame):
    from triagelake.operators import reply_graph

    df = frame(
        "message_id string, parent_id string, author_id string, inbound boolean, text string, response_id string",
        ("1", None, "c1", True, "hello there @ghost please answer", None), ("2", None, "c2", True, "question for @brand now", "3"), ("3", "2", "brand", False, "a reply", None),
    )
    got = {r.author_id: r for r in reply_graph.audit(df, ["brand", "ghost"]).collect()}
    assert got["ghost"].outbound_messages == 0 and got["ghost"].usable_pairs == 0 and got["brand"].outbound_messages == 1
