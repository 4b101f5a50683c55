"""The tagger finds values in spellings that no fixed pattern knows, and leaves other numbers alone."""

from collections import Counter

import numpy as np
import pytest

from triagelake.llm import pii

WORDS = "the order came late and we wrote back about it from this place near that house over there with some other people".split()
VALUES = ["{w}.{n}@mail{k}.example.com", "{a}.{b}.{k}.{n}", "{card}", "+1 ({c}) 555-{f}"]


def _prose(rng, n):
    return " ".join(WORDS[i] for i in rng.integers(0, len(WORDS), n))


def _value(kind, rng):
    n = {c: int(rng.integers(lo, hi)) for c, lo, hi in (("a", 11, 255), ("b", 1, 255), ("k", 0, 9), ("n", 10, 99), ("c", 200, 999), ("f", 1000, 9999))}
    return VALUES[kind].format(w=WORDS[int(rng.integers(len(WORDS)))], card=pii._checked(rng, 16), **n)


@pytest.fixture(scope="module")
def tagger(spark):
    rng = np.random.default_rng(1)
    texts = [f"{_prose(rng, 8)} {_value(i % 4, rng)} {_prose(rng, 8)}" for i in range(400)]
    texts += [f"{_prose(rng, 8)} {rng.integers(1, 9999)} {_prose(rng, 8)}" for _ in range(200)]
    return pii.fit(spark.createDataFrame([(t,) for t in texts], "text string"))


def test_altered_values_are_found_whole(tagger):
    rng = np.random.default_rng(77)
    texts, truth = [], []
    for i in range(600):
        body, lead = pii.altered(i % 4, _value(i % 4, rng), rng), _prose(rng, 9) + " "
        text = f"{lead}{body} {_prose(rng, 9)}"
        span = (len(lead), i % 4, len(lead) + len(body))
        if span not in pii.base_spans(text):
            texts.append(text)
            truth.append(span)
    found, total = Counter(), Counter(k for _, k, _ in truth)
    for span, (base, added) in zip(truth, pii.tag_texts(texts, tagger)):
        assert not set(base) & set(added)
        found[span[1]] += span in added
    assert sum(found.values()) >= 0.9 * len(truth), (found, total)
    assert all(found[k] >= 0.75 * total[k] for k in total), (found, total)


def test_other_numbers_and_prose_stay_clean(tagger):
    rng = np.random.default_rng(78)
    texts = [f"{_prose(rng, 9)} {pii.decoy(rng)} {_prose(rng, 9)}" for _ in range(500)]
    texts += [f"{_prose(rng, 30)} {rng.integers(1, 10**6)}." for _ in range(500)]
    assert sum(len(added) for _, added in pii.tag_texts(texts, tagger)) <= 10


def test_spans_of_long_texts_equal_those_of_decoded_windows(tagger):
    """tag_texts against plain steps: every window alone, all pairs of overlaps, all sets of spans by size."""
    rng = np.random.default_rng(79)
    text = " ".join(f"{_prose(rng, 5)} {pii.altered(i % 4, _value(i % 4, rng), rng)}" for i in range(24))
    trans, pieces = tagger.p["trans"], []
    for w in [w for w in range(0, len(text), pii.STRIDE) if w in set(pii.window_starts(text))]:
        tags, scores = tagger.decode(pii._padded(text, w)[None])
        pieces += [(k, s + w, min(e + w, len(text)), m) for k, s, e, m in pii._tagged(tags[0], scores[0], trans) if s + w < len(text)]
    merged = True
    while merged:
        merged = False
        for x in pieces:
            y = next((y for y in pieces if y is not x and y[0] == x[0] and y[1] < x[2] and x[1] < y[2]), None)
            if y:
                pieces = [z for z in pieces if z is not x and z is not y] + [(x[0], min(x[1], y[1]), max(x[2], y[2]), max(x[3], y[3]))]
                merged = True
                break
    pieces = sorted((p for p in pieces if p[3] > pii.MARGIN), key=lambda p: p[1])

    def best(i, free):
        if i == len(pieces):
            return 0.0, []
        skip = best(i + 1, free)
        if pieces[i][1] < free:
            return skip
        weight, rest = best(i + 1, pieces[i][2])
        return (weight + pieces[i][3], [pieces[i], *rest]) if weight + pieces[i][3] > skip[0] else skip

    base, want = pii.base_spans(text), []
    for k, s, e, _ in best(0, 0)[1]:
        s, e = pii.settled(k, text, s, e)
        if s < e and (not want or want[-1][2] <= s) and not any(s < y and x < e for x, _, y in base) and pii.sound(k, text, s, e):
            want.append((s, k, e))
    assert len(want) > 10 and pii.tag_texts([text], tagger) == [(base, want)]


def test_spelled_addresses_without_digit_are_read(spark, tagger):
    docs = spark.createDataFrame([(1, "please write to lee.max (at) shop [dot] org about that house"), (2, "no such value in this text"), (3, None), (4, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_personal_data(docs, tagger, mask=True).collect()}
    assert got[1].text == "please write to <EMAIL> about that house" and got[1].pii_base == []
    assert [got[k].text for k in (2, 3, 4)] == ["no such value in this text", None, ""] and not any(got[k].pii_added for k in (2, 3, 4))


def test_ends_and_soundness():
    text = "call (212) 555-0199, or 4111-1111-1111-1112."
    at = text.index("212")
    assert pii.settled(3, text, at + 1, at + 15) == (5, 19) and pii.sound(3, text, 5, 19)
    assert not pii.sound(2, text, 24, 43) and not pii.sound(3, text, 24, 43)
    assert pii.settled(0, "mail from jo (at) shop dot org now", 5, 22) == (10, 30)
    assert not pii.sound(0, "a@" + "a." * 200 + "org", 0, 405)
