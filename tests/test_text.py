"""Cleaning, tokens, masking, turns and intake."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from triagelake import fixed_values as V
from triagelake.functions import pii, text as X
from triagelake.operators import intake, turns


def one(spark, value, build):
    return spark.createDataFrame([(value,)], "t string").select(build(F.col("t"))).collect()[0][0]


def test_cleaning(spark):
    t = "  hi @115821 see https://t.co/ab1 and https://x.org/y\n now "
    assert one(spark, t, X.clean_for_kb) == "hi @User see [link] and https://x.org/y now"
    assert one(spark, t, X.clean_for_query) == "hi @User see [link] and [link] now"
    assert one(spark, "@some_one a  b https://x.y ", X.clean_for_topics) == "a  b"


def test_tokenizers(spark):
    t = "The CAFÉ's app-store x2 @me http://a.b wonderful"
    assert one(spark, t, X.whitespace_tokens) == t.lower().split()
    assert one(spark, "  ", X.whitespace_tokens) == []
    assert one(spark, t, lambda c: X.letter_tokens(c, 3)) == ["the", "app", "store", "http", "wonderful"]
    assert one(spark, t, X.message_tokens) == ["café's", "app-store", "wonderful"]
    assert one(spark, t, X.term_tokens) == re.findall(r"\w\w+", t.lower())
    assert one(spark, "a", lambda c: X.with_bigrams(F.split(c, " "))) == ["a"]
    assert one(spark, "a b c", lambda c: X.with_bigrams(F.split(c, " "))) == ["a", "b", "c", "a b", "b c"]


def test_english(spark):
    assert one(spark, "where is my order please", X.is_english_strict)
    assert not one(spark, "my my my my my my my", X.is_english_strict)  # one distinct word
    assert not one(spark, "is my", X.is_english_strict)  # too short
    assert not one(spark, "élis émy quatre vingt dix", X.is_english_strict)
    assert not one(spark, "where is my stuff now", X.is_english_topics)  # under 25 characters


def test_masks_every_kind(spark):
    t = (
        "Visa 4532 1234 5678 9012, Amex 3782-822463-10005, CVV: 789, id 000-12-3456, "
        "mail some.one@mail.example.org, phone +1-800-555-0199, my password"
    )
    masked = one(spark, t, pii.mask_pii)
    for secret in ("4532", "3782", "789", "000-12", "some.one", "0199", "password"):
        assert secret not in masked
    assert masked.count("[card-redacted]") == 2
    for label in ("cvv", "ssn", "email", "phone"):
        assert f"[{label}-redacted]" in masked
    kinds = one(spark, masked, pii.masked_kinds)
    assert kinds == ["card", "cvv", "ssn", "email", "phone", "credential"]


def test_order_number_survives_masking(spark):
    t = "order 112-9876543-1234567 please"
    assert one(spark, t, pii.mask_pii) == t
    assert one(spark, t, X.has_order_number)
    assert one(spark, None, pii.mask_pii) == ""


def test_luhn(spark):
    assert one(spark, "4532015112830366", pii.luhn_valid)
    assert not one(spark, "4532015112830367", pii.luhn_valid)


def test_masking_equals_plain_regexes(spark):
    parts = ["call 800-555-0199", "5551234567 5551234568", "x-1234567890", "a@b.co", "cvv 1234", "[cvv-redacted]", "-555-123-4567-",
             "1234567890123456", "credit card", "word", "(800) 555 0199", "112-9876543-1234567"]
    texts = [" ".join(parts[(i * 7 + j * 3) % len(parts)] for j in range(5)) for i in range(60)]

    def plain(t):
        for p, label in pii.MASKS:
            t = re.sub(p, label, t)
        return t

    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", pii.mask_pii(F.col("t")).alias("m"))
    for r in df.collect():
        assert r["m"] == plain(r["t"])


def test_escape_and_signature(spark):
    assert one(spark, "<b>\"x\" & 'y'</b>", X.html_escape) == "&lt;b&gt;&quot;x&quot; &amp; &#x27;y&#x27;&lt;/b&gt;"
    assert one(spark, "fine now ^GR \n", X.signature) == "^GR"
    assert one(spark, "fine ^GR now", X.signature) == "^CS"
    assert one(spark, "fine ^longer", X.signature) == "^CS"


TRANSCRIPT = "noise\nCustomer: hello\nmore words\nSupport:  hi \n\nstray\nCustomer: bye"


def test_strict_turns(spark):
    got = one(spark, TRANSCRIPT, turns.strict_turns)
    assert [tuple(r) for r in got] == [("Customer", "hello"), ("Support", "hi"), ("Customer", "bye")]
    assert one(spark, TRANSCRIPT, lambda c: turns.first_text(turns.strict_turns(c), "Support")) == "hi"
    assert one(spark, "no prefix", turns.strict_turns) == []


def reference_join(text):
    """Line by line: a prefix opens a turn, other lines continue it."""
    out = []
    for line in text.strip().split("\n"):
        for s in ("Customer", "Support"):
            if line.startswith(s + ": "):
                out.append([s, line[len(s) + 2:]])
                break
        else:
            if out:
                out[-1][1] += " " + line
    return [(s, t.strip()) for s, t in out]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.sampled_from(["Customer: a", "Support: b ", "x", "", " Customer: c", "Support:d", "Customer: "]), max_size=7))
def test_joined_turns_match_a_line_scan(spark, lines):
    text = "\n".join(lines)
    assert [tuple(r) for r in one(spark, text, turns.joined_turns)] == reference_join(text)


def test_intake(frame):
    rows = frame(
        "message string, session_id string, history array<string>",
        ("ok", " s1 ", []), ("ok", "   ", []), ("ok", "../../x", []), ("x" * 4097, None, []), ("", "a", []),
        ("ok", "s" * 200, []), ("ok", "a.b-c_9", ["t"] * 31), ("x" * 4096, None, ["t"] * 30),
    )
    got = intake.with_validity(rows, history="history").collect()
    assert [r["reject_reason"] for r in got] == [
        None, None, "bad_session_id", "message_too_long", "empty_message", "bad_session_id", "history_too_long", None
    ]
    assert got[0]["session_id"] == "s1" and got[1]["session_id"] is None
    human = intake.to_human(intake.quarantined(intake.with_validity(rows, history="history"))).collect()
    assert len(human) == 5
    assert {(r["decision"], r["escalation_category"], r["intent_confidence"]) for r in human} == {("ESCALATE", "HUMAN_AGENT_REQUEST", 0.0)}


def test_threads_from_rows_equal_threads_from_transcripts(spark, frame):
    rows = frame(
        "brand string, conversation_id string, turn int, role string, text string",
        ("b", "1", 0, "system", "s"), ("b", "1", 1, "Customer", "c1"), ("b", "1", 2, "Support", "a1"), ("b", "1", 3, "Customer", "c2"),
        ("b", "2", 0, "Support", "a"),
    )
    got = {r["conversation_id"]: r for r in turns.threads_from_turn_rows(rows).collect()}
    assert (got["1"]["customer_text"], got["1"]["support_reply"], got["1"]["turn_count"]) == ("c1", "a1", 3)
    assert (got["2"]["customer_text"], got["2"]["support_reply"], got["2"]["turn_count"]) == (None, "a", 1)
    assert V.SEED == 42
