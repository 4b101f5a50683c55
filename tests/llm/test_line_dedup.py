"""Repeated lines against a plain version, and odd tables."""

import collections
import random
import re
import time

from triagelake.llm import line_dedup
from triagelake.llm.names import unused

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def plain(rows, min_chars=10, min_docs=2):
    """[(kept text, n_lines, n_dropped)] of (doc_id, text) rows."""
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACE))
    holders = collections.defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(holders.get(key(x), ())) < min_docs or min(holders[key(x)] - {None}) == d]
        out.append((d, t if len(stay) == len(lines) else "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=repr)


def found(df, **kw):
    return sorted(((r[0], r[1], r[2], r[3]) for r in line_dedup.drop_repeated_lines(df, **kw).select("doc_id", "text", "n_lines", "n_dropped").collect()), key=repr)


ODD = [
    (1, "A shared line here\n\n  a SHARED line here \nown words of one"), (1, "other text of one\na shared line here"), (2, "a shared line here\t"), (2, "a shared line here\t"),
    (3, None), (4, ""), (5, "\n\n"), (None, "a shared line here\nlast words of all"), (None, "last words of all"), (6, "\x0ba shared line here\r\nÉTÉ À LA MER\nété à la mer"),
    (7, "ÉTÉ À LA MER\n a shared line here\nnine char\nnine char"), (8, "nine char\nlast words of all\nshort"),
]


def test_odd_rows_equal_plain(frame):
    df = frame("doc_id long, text string", *ODD)
    assert found(df) == plain(ODD)
    assert found(df, min_chars=5, min_docs=3) == plain(ODD, 5, 3)
    assert found(df.limit(0)) == []


def test_random_rows_equal_plain(frame):
    rng = random.Random(4)
    pool = [f"line number {i} of the pool" for i in range(40)] + ["", "  ", "short"]
    rows = [(i, "\n".join(rng.choice(pool).upper() if rng.random() < 0.2 else rng.choice(pool) for _ in range(rng.randrange(12)))) for i in range(60)]
    assert found(frame("doc_id long, text string", *rows)) == plain(rows)


def test_text_ids_and_clashing_names(frame):
    names = ["line_doc", "line_digest", "line_drops", "own", "doc", "digest", "pos", "key", "h1", "h2", "n", "first", "line", "n_lines", "Line_Doc_"]
    df = frame("doc_id string, text string, " + ", ".join(f"{c} int" for c in names), ("b", "one line of text\nx", *range(15)), ("a", "one line of text", *range(15)))
    out = line_dedup.drop_repeated_lines(df)
    assert out.columns == [*[c for c in df.columns if c != "n_lines"], "n_lines", "n_dropped"]
    assert {r.doc_id: (r.text, r.n_dropped, r["key"], r["Line_Doc_"]) for r in out.collect()} == {"a": ("one line of text", 0, 7, 14), "b": ("x", 1, 7, 14)}
    assert unused(["A", "a_"], "a", "b", "b") == ["a__", "b", "b_"]


def test_one_line_in_many_documents_and_a_long_text(frame):
    long = "\n".join(f"line {i} of a long text" if i % 3 else "the common line" for i in range(200_000))
    rows = [(0, "the common line"), *[(i, f"the common line\nwords of {i} alone") for i in range(1, 3000)], (9000, long)]
    t0 = time.time()
    got = {r[0]: r for r in found(frame("doc_id long, text string", *rows))}
    assert time.time() - t0 < 60
    assert got[0][3] == 0 and all(got[i][1:] == (f"words of {i} alone", 2, 1) for i in range(1, 3000))
    assert got[9000][2:] == (200_000, 66_667) and got[9000][1] == "\n".join(x for x in long.split("\n") if x != "the common line")
