"""Words, suffix structures, tagger and page text against plain versions."""

import random
import re

import numpy as np
import pyarrow as pa

from triagelake.llm import pages, pii, tagger
from triagelake.llm.arrow_text import ALNUM, NOT_SPACE, Words, text_bytes
from triagelake.llm.suffixes import FMIndex, longest_previous_factor, neighbour_lcp, suffix_order


def test_words_equal_patterns():
    texts = ["Ab cd\tEF", "", None, "é9-x _ ÉA", " \n ", "one"]
    raw, offsets = text_bytes(pa.array(texts))
    spaced, alnum = Words(raw, offsets, NOT_SPACE, False), Words(raw, offsets, ALNUM, True)
    assert spaced.per_doc.tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    assert alnum.per_doc.tolist() == [len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())) for t in texts]
    h = Words(*text_bytes(pa.array(["same other", "x same"])), NOT_SPACE, False).hashes()
    assert h[0] == h[3] and len(set(h.tolist())) == 3


def test_longest_previous_factor_equals_brute_force():
    rng = random.Random(5)
    for _ in range(20):
        seq = np.array([rng.randrange(3) for _ in range(rng.randrange(1, 60))] + [9])
        order, ranks = suffix_order(seq)
        got = longest_previous_factor(order, neighbour_lcp(order, ranks))
        for i in range(len(seq)):
            want = 0
            for j in range(i):
                k = 0
                while i + k < len(seq) and seq[i + k] == seq[j + k]:
                    k += 1
                want = max(want, k)
            assert got[i] == want


def test_fm_index_finds_every_place():
    rng = np.random.default_rng(3)
    seq = rng.integers(0, 4, 300)
    index = FMIndex(seq, 4)
    patterns = np.array([[a, b, c] for a in range(4) for b in range(4) for c in range(4)])
    which, lo, hi = index.search(patterns)
    found = {int(w): sorted(index.locate(np.arange(a, b)).tolist()) for w, a, b in zip(which, lo, hi)}
    for w, p in enumerate(patterns):
        want = [i for i in range(298) if (seq[i : i + 3] == p).all()]
        assert found.get(w, []) == want


def test_tagger_gradient_and_training():
    model = tagger.Tagger(1, embed=3, hidden=3)
    x = np.array([[1, 2, 3, 4], [4, 3, 2, 1]])
    gold = np.array([[0, 1, 2, 0], [0, 0, 1, 2]])
    weight = np.array([0.5, 0.5], dtype=np.float32)
    grads, _ = model._gradients(x, gold, weight)
    for name in ("wh_f", "wx_b", "out", "trans", "embed"):
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        eps, keep = 1e-2, model.p[name][at]
        model.p[name][at] = keep + eps
        up = model._gradients(x, gold, weight)[1]
        model.p[name][at] = keep - eps
        down = model._gradients(x, gold, weight)[1]
        model.p[name][at] = keep
        assert abs((up - down) / (2 * eps) - grads[name][at]) < 2e-2
    losses = model.train(x, gold, epochs=150, rate=0.05)
    assert losses[-1] < 0.1 * losses[0] and (model.decode(x)[0] == gold).all()


def test_base_spans_and_reconciling():
    text = "a@b.c@d.e x@y 1.2.3.4.5.6.7.8 999.1.1.1 x 4532 0151 1283 0366 +1 (743) 555-3824"
    got = [(pii.KINDS[k], text[s:e]) for s, k, e in pii.base_spans(text)]
    assert got == [("email", "a@b.c"), ("ip", "1.2.3.4"), ("ip", "5.6.7.8"), ("card", "4532 0151 1283 0366"), ("phone", "+1 (743) 555-3824")]
    assert pii.base_spans("1" * 100_000 + "@" * 1000) == []
    assert pii.reconcile([(0, 5, 9, 6.0), (0, 7, 12, 5.0), (1, 11, 30, 5.5), (1, 40, 42, 1.0)]) == [(5, 0, 12)]


def test_main_text_keeps_the_article_alone():
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><a href=x>Menu</a></nav><div class='cookie-notice'>We use cookies</div>"
        "<article><h1>Head &amp; more</h1><p>A <b>lo</b>ng   first paragraph of this text.<p>Short.<br>Next<form><input>Search</form><aside>Side</aside>"
        "<div id=comments><p>First!</p></div></article><div class='ad'>Buy</div><footer>&copy; me</footer><script>var a='</p>';</script></body></html>"
    )
    assert pages.main_text(page) == "Head & more A long first paragraph of this text. Short. Next"
    assert pages.main_text(None) == "" and pages.main_text("<p") in ("", "<p") and pages.main_text("<nav>x</nav>") == ""
    plain = "<body><div class=menu><a>x</a></div><div><p>Some words that are the text of the page.</p><p>End</p></div><div class=footer>f</div>"
    assert pages.main_text(plain) == "Some words that are the text of the page. End"
