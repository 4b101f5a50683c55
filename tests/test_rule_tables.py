"""Large rule tables: the pieces are necessary, and the matches are those of the patterns tested one by one."""

import re
import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bindings.inputs import MESSAGES
from triagelake import fixed_values as V
from triagelake.functions.rules import matches
from triagelake.operators.rule_tables import match_rules, required_pieces


@pytest.mark.parametrize("text,pieces", [
    (r"\brefund(s|ed)?\b", ["refund"]), ("(?:late|delayed) parcel", [" parcel"]), ("(cat|lion)s?", ["cat", "lion"]), ("(cat|li)", None),
    ("a+b*", None), ("(abc)?def{2}", None), ("xx(abcd)+", ["abcd"]), ("straße", ["stra"]),
    (r"\Qabc\E", None), ("(?x) a b c", None), ("[abc&&[b]]dddd", None), ("(?=ahead)x", None), ("(", None), ("", None), (None, None), ("ABC", ["abc"]),
])
def test_pieces(text, pieces):
    assert required_pieces(text) == pieces


_atoms = st.one_of(st.text("abcd", min_size=1, max_size=5), st.sampled_from(["[ab]", ".", "(?:abc|bcd)", "(abcd|ab)?", "(bcda)+", "a*", "(?:dcb){2}"]))


@settings(max_examples=300, deadline=None)
@given(st.lists(_atoms, min_size=1, max_size=4).map("".join), st.text("abcd", max_size=40))
def test_every_match_holds_a_piece(pat, text):
    pieces = required_pieces(pat)
    if pieces and re.search(pat, text):
        assert any(p in text for p in pieces)


def _brute(spark, texts, rules):
    df = spark.createDataFrame(texts, "id long, text string")
    hits = F.array_compact(F.array(*[F.when(matches(F.col("text"), p), F.lit(r)) for r, p in rules if p is not None]))
    return {tuple(r) for r in df.select("id", F.explode(hits)).collect()}


def test_equals_all_patterns_on_all_texts(spark):
    texts = [(i, t) for i, t in enumerate(MESSAGES)] + [(100, ""), (101, None), (102, "ab"), (103, "STRAſſE KELVIN ısland İsland"), (1, "a refund for all")]
    rules = [(i, p) for i, (_, p) in enumerate([*V.TOPIC_PATTERNS, *V.INTENT_PATTERNS])]
    rules += [(900, "kelvin"), (901, "strasse"), (902, "island"), (903, r"\d+"), (904, ""), (905, None), (906, "zzzz"), (907, "^hello (there|you)$"), (907, "refund"), (908, r"\w+@\w+")]
    rules += [(1000 + i, w) for i, w in enumerate(sorted({w for m in MESSAGES for w in re.findall("[a-z]+", m)}))]
    inbox = spark.createDataFrame(texts + texts[:3], "id long, text string")
    table = spark.createDataFrame(rules + rules[:2], "rule long, pattern string")
    got = [tuple(r) for r in match_rules(inbox, table, block=7).collect()]
    assert len(got) == len(set(got)) and set(got) == _brute(spark, texts, rules)
    assert {(103, 900), (103, 901), (103, 902)} <= set(got)
    empty = table.limit(0)
    assert match_rules(inbox, empty).count() == 0 and match_rules(inbox.limit(0), table).count() == 0


def test_twenty_thousand_rules(spark):
    """Rules that a third of the texts match, rules of single texts and rules of none."""
    letters = string.ascii_lowercase
    names = [f"{a}{b}{c}{d}" for a in letters for b in letters for c in letters[:10] for d in letters[:3]][:20_000]
    texts = spark.range(3_000).select("id", F.concat(F.lit("case "), F.element_at(F.array(*[F.lit(n) for n in names[:500]]), (F.col("id") % 500 + 1).cast("int")), F.when(F.col("id") % 3 == 0, " hot word").otherwise("")).alias("text"))
    rules = spark.createDataFrame([(n, rf"\b{n}\b") for n in names] + [("hot", r"\bhot\b word")], "rule string, pattern string")
    got = match_rules(texts, rules).groupBy("rule").count().collect()
    assert {r["rule"]: r["count"] for r in got} == {**{n: 6 for n in names[:500]}, "hot": 1000}
