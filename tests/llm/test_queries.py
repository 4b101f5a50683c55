"""The queries against SQL or plain versions, and odd tables through every operator."""

import collections
import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bindings.check import TABLES, rows_of
from tests.conftest import SF
from triagelake.llm import decontaminate, language, licences, mixing, pages, pii, quality, secrets, shingle_join, suffix_dedup
from triagelake.llm.queries import ORACLES, QUERIES

LONG = " ".join(f"w{i % 97} common" for i in range(3000))
ODD = [
    (1, "the cat sat on the mat and then it went home again", "en", "a"), (1, "the cat sat on the mat and then it went home again", "en", "a"),
    (2, None, None, None), (3, "", "en", None), (None, "lone words here", "fr", "a"), (4, LONG, "en", "b"), (5, LONG + " tail", None, "b"), (6, " \n ", "de", "c"),
]
DDL = "doc_id long, text string, lang string, source string, kept int, copy int, spans int, gram int, sid int, label int"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6) for r in ODD], DDL)


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLES[name])
    cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, cur.fetchall())


def test_language_held_out_accuracy(spark):
    got = QUERIES["op1_language"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got) and all(0 <= r.score <= 1 for r in got)


def _digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans)).encode()).hexdigest()


def test_personal_data_base(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op2_personal_data"](spark, SF).collect()}
    for i, t in texts.items():
        s = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        s += [(m.start(), 1, m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) < 256 for p in m[0].split("."))]
        s += [(m.start(), 2, m.end(), "card") for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and pii.luhn(d)]
        s += [(m.start(), 3, m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
        assert got[i].base_sha256 == _digest(s)


def test_quality_counts(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op6_quality_rules"](spark, SF).collect()}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        seen = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        covered = {p for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for p in range(k, k + 8)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert tuple(got[i][c] for c in quality.COUNTS) == want
        assert got[i].base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w)) and not (got[i].base_failed and got[i].kept)


def test_secret_base_and_links(spark, texts, frame):
    got = {r.doc_id: r for r in QUERIES["op7_linked_secrets"](spark, SF).collect()}
    key = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in k) for k in ("password", "passwd", "secret", "token", "api_?key"))
    for i, t in texts.items():
        s = [(m.start(), 0, m.end(), "assign") for m in re.finditer(rf"""(?:{key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[1]) >= 6]
        s += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        s += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
        assert got[i].base_sha256 == _digest(s)
    token = "aB3" * 8
    df = frame("doc_id long, text string", (1, f"user: someone {token} https://h.example.org/x"), (2, f"só {token}"), (3, "user: someone"), (4, f"user: a1b {'x ' * 400} {token}"), (5, "secret=token : abcdefg"))
    found = {r.doc_id: r for r in secrets.scan_secrets(df).collect()}
    assert [len(found[1][k]) for k in secrets.KINDS] == [0, 0, 0, 1, 1, 1]
    assert all(not any(len(found[i][k]) for k in secrets.KINDS[3:]) for i in (2, 3, 4)) and len(found[5].assign) == 0


def test_repeats_equal_brute_force(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op8_suffix_dedup"](spark, SF).collect()}
    seen = set()
    for i in sorted(texts):
        b = texts[i].encode()
        mark = bytearray(len(b))
        for s in range(len(b) - 99):
            if b[s : s + 100] in seen:
                mark[s : s + 100] = b"\1" * 100
            seen.add(b[s : s + 100])
        kept = bytes(x for x, m in zip(b, mark) if not m)
        assert (got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (sum(mark), len([x for x in bytes(mark).split(b"\0") if x]), hashlib.sha256(kept).hexdigest())


def test_large_groups_are_compared_across_tasks(spark, frame, monkeypatch):
    passage = "".join(hashlib.md5(f"p{i}".encode()).hexdigest() for i in range(5))[:140]
    df = frame("doc_id long, text string", *[(i, hashlib.md5(str(i).encode()).hexdigest() + passage + hashlib.md5(f"-{i}".encode()).hexdigest()) for i in range(40)])
    whole = sorted((r.doc_id, r.n_removed) for r in suffix_dedup.remove_repeats(df).collect())
    monkeypatch.setattr(suffix_dedup, "GROUP", 8)
    assert sorted((r.doc_id, r.n_removed) for r in suffix_dedup.remove_repeats(df).collect()) == whole
    assert whole[0][1] == 0 and all(n >= 140 for _, n in whole[1:])  # the passage stays once


def test_odd_tables(spark, odd):
    empty = odd.limit(0)
    labels = spark.createDataFrame([(1, 1), (4, 0), (None, 0), (5, None)], "doc_id long, quality int")
    items = spark.createDataFrame([(1, "cat sat on the mat and then it went home"), (2, None), (None, "words here")], "item_id long, text string")
    model = language.fit(odd)
    ways = {
        "language": lambda d: language.identify(d, language.fit(d)), "pii": lambda d: pii.find_personal_data(d, pii.fit(d), mask=True),
        "join": lambda d: shingle_join.near_duplicates(d), "mix": lambda d: mixing.mix_sources(d), "quality": lambda d: quality.judge(d, quality.fit(d, labels)),
        "secrets": lambda d: secrets.scan_secrets(d), "repeats": lambda d: suffix_dedup.remove_repeats(d), "bench": lambda d: decontaminate.find_benchmark(d, items),
        "pages": lambda d: pages.extract(d, html="text"),
    }
    for name, way in ways.items():
        assert way(odd).count() == len(ODD), name
        assert way(empty).count() == 0, name
    assert licences.scan_licences(odd).count() == 0 and licences.scan_licences(empty).count() == 0
    assert decontaminate.find_benchmark(odd, items.limit(0)).where(F.size("bench_spans") > 0).count() == 0
    by_id = collections.defaultdict(list)
    for r in shingle_join.near_duplicates(odd).collect():
        by_id[r.doc_id].append((r.n_shingles, r.component_id))
    assert by_id[1] == [(8, 1), (8, 1)] and by_id[2] == [(0, 2)] and by_id[5][0][1] == 4 and by_id[None] == [(1, None)]
    assert sorted(r.doc_id or 0 for r in shingle_join.keep_representatives(odd).collect()) == [0, 1, 2, 3, 4, 6]
    assert {r.lang_pred for r in language.identify(odd, model).where("doc_id in (2, 3, 6)").collect()} == {"und"}
    hits = {r.doc_id: len(r.bench_items) for r in decontaminate.find_benchmark(odd, items).collect()}
    assert hits[1] == 1 and hits[None] == 1 and hits[4] == 0
    cut = {r.doc_id: r.text for r in decontaminate.find_benchmark(odd, items, cut=True).collect()}
    assert cut[1] == "the  again" and cut[2] is None


def test_near_copies_link_through_any_member(spark, frame):
    base = [f"word{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    for k in range(1, 30):
        w = list(base)
        for j in range(k % 7):
            w[(k * 31 + j * 23) % 200] = f"edit{k}_{j}"
        rows.append((k, " ".join(w)))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(196)} for i, t in rows}
    label = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                lo, hi = sorted((label[a], label[b]))
                label = {i: lo if v == hi else v for i, v in label.items()}
    got = {r.doc_id: r.component_id for r in shingle_join.near_duplicates(frame("doc_id long, text string", *rows)).collect()}
    assert got == {i: min(j for j in label if label[j] == label[i]) for i in label}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = corpus_pipeline.keep_good(spark, docs, SF)
    assert good.columns == docs.columns and 0 < good.count() < docs.count()
    out = corpus_pipeline.run(spark, SF).collect()
    assert out and len(corpus_pipeline.STAGES) == 5 and all(not pii.base_spans(r.text) for r in out)
    assert max(collections.Counter(r.doc_id for r in out).values()) <= 2
