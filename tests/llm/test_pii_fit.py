"""Rare kinds reach the tagger's training rows."""

import numpy as np

from triagelake.llm import pii


def test_a_kind_of_a_single_document_is_trained_on(spark):
    plain = spark.range(30_000).selectExpr("concat('order ', id, ' was sent on day ', id % 31, ' of the month') AS text")
    mail = spark.range(2_000).selectExpr("concat('write to user', id, '@example', id % 7, '.org about it') AS text")
    card = spark.createDataFrame([("pay with 4532 0151 1283 0366 please",)], "text string")
    rows = pii.training_rows(plain.union(mail).union(card), windows=40)
    kinds = [{(t - 1) // 2 for t in np.frombuffer(tags, dtype=np.uint8).tolist() if t} for _, tags in rows]
    assert sum({2} <= k for k in kinds) == 1 and sum({0} <= k for k in kinds) == 39 and sum(not k for k in kinds) == 40
    assert rows == pii.training_rows(card.union(mail).union(plain).repartition(5), windows=40)
    assert pii.training_rows(plain) == [] and pii.fit(plain) is None
    assert pii.fit(plain.union(card)) is not None


def test_overlaps_by_running_ends_equal_all_pairs():
    rng = np.random.default_rng(2)
    for _ in range(200):
        spans = sorted((int(a), 0, int(a + n)) for a, n in zip(rng.integers(0, 60, 6), rng.integers(1, 25, 6)))
        taken = pii._overlap_test(spans)
        for s, e in zip(rng.integers(0, 80, 20), rng.integers(1, 9, 20)):
            assert taken(s, s + e) == any(s < y and x < s + e for x, _, y in spans)
    assert not pii._overlap_test([])(0, 5)
