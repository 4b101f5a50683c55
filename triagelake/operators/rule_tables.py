"""Rule tables of any size: an index of text pieces that a match must hold, then the patterns of the candidates only.

``RulePack`` compiles a short list into one expression.  A table of many thousand rules is joined instead.  Each pattern
yields a clause: pieces of literal text, one of which stands in every match.  Each piece is looked up by its rarest
gram among the texts (six characters, three in shorter pieces), so a rule meets only texts that hold it, and only these are tested.  Rules without
such a clause (``a+b*``, ``\\d+``) are tested on all texts, a block of rules at a time.
"""

from __future__ import annotations

import re
from re import _constants as op
from re import _parser as parser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake.functions.rules import matches, pattern
from triagelake.session import cut_lineage

GRAM = 3
#: Pieces of so many characters are looked up by grams of this length, which few texts share by chance.
LONG_GRAM = 6
BLOCK = 200
# spellings that Java and Python read differently, or flags that change what a literal means
_UNSURE = re.compile(r"&&|\[[^\]]*\[|\\[QEGhHRXNcekpPxuU0-9]|\(\?(?![:=!>]|<[=!])")
_REPEATS = (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT)


def _better(a: list[str] | None, b: list[str] | None) -> list[str] | None:
    """Of two clauses that both hold, the one with longer pieces, then with fewer."""
    known = [c for c in (a, b) if c]
    return max(known, key=lambda c: (min(map(len, c)), -len(c))) if known else None


def _clause(nodes) -> list[str] | None:
    best, run = None, ""
    for kind, value in [*nodes, (None, None)]:
        if kind is op.LITERAL and value < 128:
            run += chr(value).lower()
            continue
        if len(run) >= GRAM:
            best = _better(best, [run])
        run = ""
        if kind is op.SUBPATTERN:
            best = _better(best, _clause(value[3]))
        elif kind is op.ATOMIC_GROUP:
            best = _better(best, _clause(value))
        elif kind in _REPEATS and value[0] > 0:
            best = _better(best, _clause(value[2]))
        elif kind is op.BRANCH:
            parts = [_clause(b) for b in value[1]]
            if all(parts):
                best = _better(best, sorted({p for part in parts for p in part}))
    return best


def required_pieces(text: str | None) -> list[str] | None:
    """Lower-case pieces of three or more characters, one of which is in every match; None where no such list is sure."""
    if text is None or _UNSURE.search(text):
        return None
    try:
        return _clause(parser.parse(text, re.IGNORECASE))
    except (re.error, OverflowError, RecursionError):
        return None


def _folded(text: Column) -> Column:
    """In lower case; the four other characters that a case-blind pattern takes for ASCII letters become these letters."""
    return F.lower(F.translate(text, "\u0130\u0131\u017f\u212a", "iisk"))


def _grams(text: Column, n: int = GRAM) -> Column:
    """The different n-grams of a text; none in shorter ones."""
    places = F.sequence(F.lit(1), F.length(text) - (n - 1))
    found = F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(n))))
    return F.when(F.length(text) >= n, found).otherwise(F.array().cast("array<string>"))


def _piece_grams(piece: Column) -> Column:
    return F.when(F.length(piece) >= LONG_GRAM, _grams(piece, LONG_GRAM)).otherwise(_grams(piece))


def _clauses(rules: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            yield pd.DataFrame({"rule": batch["rule"], "pattern": batch["pattern"], "pieces": [required_pieces(p) for p in batch["pattern"]]})

    kind = rules.schema["rule"].dataType.simpleString()
    return rules.mapInPandas(run, f"rule {kind}, pattern string, pieces array<string>")


def _tested_in_blocks(texts: DataFrame, rules: DataFrame, block: int) -> list[DataFrame]:
    """Rules without pieces, on every text: one projection for each block of rules."""
    out, own = [], []
    for row in [*rules.toLocalIterator(), None]:
        if row is not None:
            own.append(row)
        if own and (row is None or len(own) == block):
            kind = rules.schema["rule"].dataType
            hits = F.array_compact(F.array(*[F.when(matches(F.col("text"), r["pattern"]), F.lit(r["rule"]).cast(kind)) for r in own]))
            out.append(texts.select("id", F.explode(hits).alias("rule")))
            own = []
    return out


def match_rules(
    df: DataFrame, rules: DataFrame, id_col: str = "id", text_col: str = "text", rule_col: str = "rule", pattern_col: str = "pattern",
    block: int = BLOCK,
) -> DataFrame:
    """(id_col, rule_col) of every text that a rule's pattern occurs in, as ``rlike`` with the library's flags says.

    Null texts, null ids and rules without pattern match nothing; an empty pattern matches all.  Repeated rows count once;
    of a repeated id, and of a rule with several patterns, any match counts.  A pattern that is no regular expression
    raises as soon as it is tested.  Texts, rules and matches may be of any number: nothing is collected but the rules
    without pieces, a block at a time.
    """
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    given = rules.select(F.col(rule_col).alias("rule"), F.col(pattern_col).alias("pattern")).where("rule IS NOT NULL AND pattern IS NOT NULL")
    table = cut_lineage(_clauses(given.distinct()), "rule-clauses")
    pieces = table.where("pieces IS NOT NULL").select("rule", "pattern", F.explode("pieces").alias("piece"))
    spelled = pieces.select("piece").distinct().select("piece", F.explode(_piece_grams(F.col("piece"))).alias("gram"))
    folded = texts.select("id", _folded(F.col("text")).alias("t"))
    in_texts = folded.select("id", F.explode(F.concat(_grams(F.col("t")), _grams(F.col("t"), LONG_GRAM))).alias("gram"))
    held = cut_lineage(in_texts.join(spelled.select("gram").distinct(), "gram", "left_semi"), "text-grams")
    counts = held.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    # a piece with a gram that no text holds occurs nowhere
    rarest = spelled.join(counts, "gram", "left").groupBy("piece").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("r"))
    chosen = pieces.join(rarest.where("r.n > 0").select("piece", "r.gram"), "piece").select("rule", "pattern", "gram").distinct()
    # dealt out by id once: repeats go, and texts join, where the candidates then lie
    candidates = held.join(chosen, "gram").select("id", "rule", "pattern").repartition("id").distinct()
    flagged = F.concat(F.lit(pattern("")), F.col("pattern"))
    found = candidates.join(texts, "id").where(F.rlike("text", flagged)).select("id", "rule")
    for part in _tested_in_blocks(texts, table.where("pieces IS NULL").select("rule", "pattern"), block):
        found = found.unionByName(part)
    return found.distinct().select(F.col("id").alias(id_col), F.col("rule").alias(rule_col))
