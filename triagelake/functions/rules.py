"""Rule packs: ordered (label, pattern) lists compiled into one Column.

Users add rows, not code.  A pack becomes an unrolled chain of ``rlike`` tests,
so matching stays inside code generation, needs no join and no Python worker.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# i: ignore case, u/U: Unicode case folding and word classes, d: only \n ends a line
_FLAGS = "(?iuUd)"


def pattern(text: str) -> str:
    """A rule pattern with the library's matching flags."""
    return _FLAGS + text


def matches(col: Column, text: str) -> Column:
    """True when the pattern occurs in the column (null stays null)."""
    return col.rlike(pattern(text))


def remove(col: Column, text: str, by: str = "") -> Column:
    """Replace every occurrence of the pattern."""
    return F.regexp_replace(col, pattern(text), by)


def any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def contains_any(col: Column, words: list[str]) -> Column:
    """Plain substring test against a short list."""
    return any_of([col.contains(w) for w in words])


def count_contained(col: Column, words: list[str]) -> Column:
    """How many distinct list entries occur as substrings."""
    return reduce(lambda a, b: a + b, [col.contains(w).cast("int") for w in words])


def word_list(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str
    negated: str | None = None  # spans removed before the second test


@dataclass(frozen=True)
class RulePack:
    rules: tuple[Rule, ...]

    MAX_TABLE_RULES = 1000

    @classmethod
    def of(cls, pairs, negations: dict[str, str] | None = None) -> "RulePack":
        negations = negations or {}
        return cls(tuple(Rule(label, pat, negations.get(label)) for label, pat in pairs))

    @classmethod
    def from_table(cls, rules: DataFrame, position="position", label="label", pattern="pattern") -> "RulePack":
        """Compile a small rule table (one row per rule, ordered by position).

        The table is configuration, so its size is checked before it reaches the
        driver; a pack that is too long for one expression is refused
        (``operators.rule_tables.match_rules`` joins tables of any size).
        """
        rows = rules.select(position, label, pattern).orderBy(position).limit(cls.MAX_TABLE_RULES + 1).collect()
        if len(rows) > cls.MAX_TABLE_RULES:
            raise ValueError(f"a pack holds at most {cls.MAX_TABLE_RULES} rules; operators.rule_tables.match_rules takes tables of any size")
        return cls(tuple(Rule(r[label], r[pattern]) for r in rows))

    @property
    def labels(self) -> list[str]:
        return [r.label for r in self.rules]

    def without_negation(self) -> "RulePack":
        return RulePack(tuple(Rule(r.label, r.pattern) for r in self.rules))

    def _test(self, rule: Rule, text: Column) -> Column:
        hit = matches(text, rule.pattern)
        if rule.negated is None:
            return hit
        # without a negated span the removal is a no-op, so one formula covers both cases
        return hit & matches(remove(text, rule.negated), rule.pattern)

    def all_labels(self, text: Column) -> Column:
        """array<string> of every matching label, in pack order."""
        return F.array_compact(F.array(*[F.when(self._test(r, text), F.lit(r.label)) for r in self.rules]))

    def first_label(self, text: Column) -> Column:
        """The first matching label or null; later patterns are not evaluated."""
        return F.coalesce(*[F.when(self._test(r, text), F.lit(r.label)) for r in self.rules])
