"""Text cleaning, tokenizing and small scalar functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from triagelake import fixed_values as V
from triagelake.functions.rules import matches, word_list

_WORD = r"[\p{L}\p{N}_]"


def squeeze(col: Column) -> Column:
    """Collapse every whitespace run to one blank and strip the ends."""
    return F.trim(F.regexp_replace(col, r"(?U)\s+", " "))


def strip(col: Column) -> Column:
    """Strip Unicode whitespace at both ends, keeping the inside."""
    return F.regexp_replace(col, r"(?U)\A\s+|\s+\z", "")


def clean_for_kb(col: Column) -> Column:
    """Numeric handles and platform short links become tokens; whitespace collapses."""
    t = F.regexp_replace(col, r"@\d+", "@User")
    t = F.regexp_replace(t, r"(?U)https?://t\.co/\S+", "[link]")
    return squeeze(t)


def clean_for_query(col: Column) -> Column:
    """As for the knowledge base, but every URL becomes a link token."""
    t = F.regexp_replace(col, r"@\d+", "@User")
    t = F.regexp_replace(t, r"(?U)https?://\S+", "[link]")
    return squeeze(t)


def clean_for_topics(col: Column) -> Column:
    """Drop handles and URLs; inner whitespace is kept."""
    t = F.regexp_replace(col, r"(?U)@\w+", "")
    t = F.regexp_replace(t, r"(?U)https?://\S+", "")
    return strip(t)


def strip_negated(col: Column) -> Column:
    """Remove negated billing and refund spans."""
    t = F.regexp_replace(col, "(?iuUd)" + V.NEGATED_BILLING, "")
    return F.regexp_replace(t, "(?iuUd)" + V.NEGATED_REFUND, "")


# --- tokenizers -----------------------------------------------------------------


def whitespace_tokens(col: Column) -> Column:
    """Lowercased whitespace tokens."""
    return F.filter(F.split(squeeze(F.lower(col)), " "), lambda w: w != "")


def letter_tokens(col: Column, min_len: int) -> Column:
    """Lowercased words made only of basic letters, at least ``min_len`` long."""
    words = F.regexp_extract_all(F.lower(col), F.lit(_WORD + "+"), F.lit(0))
    return F.filter(words, lambda w: w.rlike("^[a-z]{%d,}$" % min_len))


def message_tokens(col: Column) -> Column:
    """Lowercased whitespace tokens longer than three, without handles and URLs."""
    t = squeeze(col)
    parts = F.filter(
        F.split(t, " "),
        lambda w: (F.length(w) > 3) & ~w.startswith("@") & ~w.startswith("http"),
    )
    return F.transform(parts, F.lower)


def term_tokens(col: Column) -> Column:
    """Lowercased word tokens of two or more word characters (the TF-IDF tokenizer)."""
    return F.regexp_extract_all(F.lower(col), F.lit(_WORD + "{2,}"), F.lit(0))


def with_bigrams(tokens: Column) -> Column:
    """Unigrams followed by the bigrams of the same sequence."""
    return F.concat(
        tokens,
        F.when(
            F.size(tokens) >= 2,
            F.zip_with(
                F.slice(tokens, 1, F.size(tokens) - 1),
                F.slice(tokens, 2, F.size(tokens) - 1),
                lambda a, b: F.concat_ws(" ", a, b),
            ),
        ).otherwise(F.array().cast("array<string>")),
    )


# --- English tests ----------------------------------------------------------------


def _distinct_hits(col: Column, words: list[str]) -> Column:
    tokens = F.regexp_extract_all(F.lower(col), F.lit(_WORD + "+"), F.lit(0))
    return F.size(F.array_intersect(tokens, word_list(words)))


def is_english_strict(col: Column, words: list[str] = V.ENGLISH_WORDS_STRICT, min_chars: int = 15) -> Column:
    """At least ``min_chars`` characters and two distinct listed words."""
    return F.coalesce((F.length(col) >= min_chars) & (_distinct_hits(col, words) >= 2), F.lit(False))


def is_english_topics(col: Column) -> Column:
    return is_english_strict(col, V.ENGLISH_WORDS_TOPICS, 25)


# --- small scalars -----------------------------------------------------------------


def html_escape(col: Column) -> Column:
    t = F.replace(col, F.lit("&"), F.lit("&amp;"))
    t = F.replace(t, F.lit("<"), F.lit("&lt;"))
    t = F.replace(t, F.lit(">"), F.lit("&gt;"))
    t = F.replace(t, F.lit('"'), F.lit("&quot;"))
    return F.replace(t, F.lit("'"), F.lit("&#x27;"))


def has_order_number(col: Column) -> Column:
    return matches(col, V.ORDER_NUMBER)


def signature(reply: Column, default: str = V.DEFAULT_SIGNATURE) -> Column:
    """The agent's trailing sign-off, or the default one."""
    found = F.regexp_extract(strip(reply), "(?d)" + V.SIGNATURE, 1)
    return F.when(found != "", F.concat(F.lit("^"), found)).otherwise(F.lit(default))


def mentions(col: Column, handle: str) -> Column:
    """Case-insensitive ``@handle`` mention; null text counts as no mention."""
    return F.coalesce(F.lower(col).contains("@" + handle.lower()), F.lit(False))


def sequence_id(prefix: str, position: Column) -> Column:
    return F.format_string(prefix + "-%03d", position)


def seeded_key(seed: int, *ids: Column) -> Column:
    """Reproducible pseudo-random order: md5 over seed and id."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[i.cast("string") for i in ids]))
