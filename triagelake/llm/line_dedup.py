"""Lines that stand in several documents: kept in the first one, dropped from the others.

Lines are exploded with their position, normalised and hashed to 128 bits.  Distinct documents per hash are counted in two
steps, by (hash, document) and then by hash with partial sums, so a line of a third of all documents sends one row per map
task to the last step.  Hashes over the threshold join the lines back, in a join that Spark splits where one line is skewed;
only positions to drop travel on, and each text meets its own positions once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.llm.names import unused
from triagelake.session import cut_lineage

MIN_CHARS = 10
MIN_DOCS = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def line_key(line):
    """The line without white space at its ends, A-Z lower-cased."""
    return F.translate(F.trim(line, F.lit(SPACES)), UPPER, LOWER)


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _without(lines, drops):
    """The lines joined again, but those at the sorted, distinct positions: linear in the lines."""
    before = lambda p, j: p - F.when(j == 0, F.lit(-1)).otherwise(F.get(drops, j - 1)) - 1
    flags = F.flatten(F.transform(drops, lambda p, j: F.concat(F.array_repeat(F.lit(False), before(p, j)), F.array(F.lit(True)))))
    return F.array_join(F.zip_with(lines, flags, lambda line, drop: F.when(~F.coalesce(drop, F.lit(False)), line)), "\n")


def drop_repeated_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """docs with ``text`` rebuilt from the lines that stay, and with n_lines (before) and n_dropped.

    A line whose key has at least ``min_chars`` code points and is found in at least ``min_docs`` documents is dropped
    everywhere but in the document with the smallest key.  Rows with the same key are one document, and so are all rows
    without one, which come last in that order; a line repeated inside one document alone stays.  A null or empty text is
    one empty line and stays as it is; other columns pass through, those named n_lines or n_dropped are replaced; an empty
    table gives an empty result.
    """
    keep = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    doc, digest, drops = unused(keep, "line_doc", "line_digest", "line_drops")
    # rows of one document may differ in their text: positions belong to a document and a text
    named = docs.select(*keep, F.xxhash64(F.lit("text"), F.col(text)).alias(digest))
    lines = named.select(F.col(key).alias("doc"), F.col(digest).alias("digest"), F.posexplode(_lines(F.col(text))).alias("pos", "line"))
    keyed = lines.select("doc", "digest", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    hashed = keyed.select("doc", "digest", "pos", F.xxhash64(F.lit(1), "key").alias("h1"), F.xxhash64(F.lit(2), "key").alias("h2"))
    per_hash = hashed.select("h1", "h2", "doc").distinct().groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("first"))
    # written, so that both sides of the join come from a shuffle of their own and Spark can split a line that is everywhere
    repeated = cut_lineage(per_hash.where(F.col("n") >= min_docs).select("h1", "h2", "first"), "repeated-lines")
    gone = hashed.join(repeated, ["h1", "h2"]).where(~F.col("doc").eqNullSafe(F.col("first")))
    by_text = gone.groupBy(F.col("doc").alias(doc), F.col("digest").alias("own")).agg(F.array_sort(F.collect_set("pos")).alias(drops))
    met = named.join(by_text, named[key].eqNullSafe(by_text[doc]) & (named[digest] == by_text["own"]), "left")
    kept = F.when(F.col(drops).isNull(), F.col(text)).otherwise(_without(_lines(F.col(text)), F.col(drops)))
    return met.select(
        *[kept.alias(c) if c == text else named[c] for c in keep],
        F.size(_lines(F.col(text))).cast("long").alias("n_lines"),
        F.coalesce(F.size(drops), F.lit(0)).cast("long").alias("n_dropped"),
    )
