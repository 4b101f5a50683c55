"""Quality rules: fixed counts of a text, and a calibrated logistic regression over hashed word and character n-grams.

The classifier is fitted on at most `per_class` labelled rows of each class, picked by a hash of the row (a parameter of
the fit); its margins are calibrated on rows kept out of the fit, weighted to the classes' true shares.  Every text is
scored whole, in Arrow batches, against a fixed threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triagelake.llm.arrow_text import NOT_SPACE, Words, mix, pieces, small_batches, text_bytes, windows
from triagelake.session import cut_lineage

BITS = 15
PER_CLASS = 800
THRESHOLD = 0.4
FEWEST_WORDS = 20
MOST_REPEATED_PERCENT = 30
REPEAT_WINDOW = 8
SYMBOLS = "#*$%&|<>"
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_NOT_NEWLINE = np.ones(256, dtype=bool)
_NOT_NEWLINE[0x0A] = False
_LEAD = np.ones(256, dtype=bool)
_LEAD[0x80:0xC0] = False
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_doc(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    run = np.concatenate([[0], np.cumsum(values)])
    return run[offsets[1:]] - run[offsets[:-1]]


def _grouped(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, start of each group of equal (document, hash) in that order)."""
    key = hashes ^ mix(doc.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    return order, starts


def base_counts(raw: np.ndarray, offsets: np.ndarray, words: Words, hashes: np.ndarray) -> list[np.ndarray]:
    """COUNTS of some documents."""
    n = len(offsets) - 1
    own = raw[offsets[0] : offsets[-1]]
    at = offsets - offsets[0]
    lines = Words(raw, offsets, _NOT_NEWLINE, lower=False)
    full = np.zeros(0, dtype=np.int64)
    if len(lines.starts):
        filled = np.concatenate([[0], np.cumsum(words.inside)])
        full = np.flatnonzero(filled[lines.ends] > filled[lines.starts])
    line_doc = lines.doc[full]
    order, starts = _grouped(line_doc, lines.hashes()[full])
    duplicates = np.bincount(line_doc, minlength=n) - np.bincount(line_doc[order[starts]], minlength=n)
    wide = windows(hashes, REPEAT_WINDOW)
    covered = np.zeros(len(hashes) + 1, dtype=np.int64)
    if len(wide):
        inside = np.flatnonzero(words.doc[: len(wide)] == words.doc[REPEAT_WINDOW - 1 :])
        order, starts = _grouped(words.doc[inside], wide[inside])
        many = np.diff(np.concatenate([starts, [len(order)]]))
        again = inside[order[np.repeat(many > 1, many)]]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + REPEAT_WINDOW, -1)
    repeated = np.cumsum(covered)[:-1] > 0
    return [
        words.per_doc, _per_doc(words.inside & _LEAD[own], at), _per_doc(_SYMBOL[own], at), duplicates,
        np.bincount(words.doc[repeated], minlength=n),
    ]


def _features(raw, offsets, words: Words, hashes: np.ndarray):
    """Hashed features as (document, column): words and word pairs in the first half, character trigrams in the second."""
    size = np.uint64((1 << BITS) - 1)
    pairs = windows(hashes, 2)
    same = words.doc[: len(pairs)] == words.doc[1:] if len(pairs) else np.zeros(0, dtype=bool)
    own = raw[offsets[0] : offsets[-1]].astype(np.uint64)
    at = offsets - offsets[0]
    tri = mix(own[:-2] | (own[1:-1] << np.uint64(8)) | (own[2:] << np.uint64(16))) if len(own) > 2 else np.zeros(0, dtype=np.uint64)
    begin = np.zeros(len(own) + 1, dtype=np.int64)
    np.add.at(begin, at[1:-1], 1)
    char_doc = np.cumsum(begin)[: len(own)]
    inside = char_doc[: len(tri)] == char_doc[2:] if len(tri) else np.zeros(0, dtype=bool)
    return (
        (words.doc, (hashes & size).astype(np.int64)),
        (words.doc[: len(pairs)][same], (pairs[same] & size).astype(np.int64)),
        (char_doc[: len(tri)][inside], (tri[inside] & size).astype(np.int64) + (1 << BITS)),
    )


@dataclass
class QualityModel:
    weights: np.ndarray  # 2 << BITS
    bias: float
    slope: float
    offset: float

    def probability(self, raw, offsets, words: Words, hashes: np.ndarray) -> np.ndarray:
        """Calibrated probability of good quality; means over the text's features, so length does not matter."""
        n = len(offsets) - 1
        margin = np.full(n, self.bias)
        (d1, f1), (d2, f2), (d3, f3) = _features(raw, offsets, words, hashes)
        for parts in (((d1, f1), (d2, f2)), ((d3, f3),)):
            total = sum(np.bincount(d, weights=self.weights[f], minlength=n) for d, f in parts)
            many = sum(np.bincount(d, minlength=n) for d, _ in parts)
            margin += total / np.maximum(many, 1)
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.offset, -50, 50)))


def _vectors(text: str, label: str):
    """Labelled rows as sparse vectors of mean frequencies."""
    def run(batches):
        for batch in batches:
            raw, offsets = text_bytes(batch.column(text))
            columns, values = [], []
            for i, j in pieces(offsets):
                part = offsets[i : j + 1]
                words = Words(raw, part, NOT_SPACE, lower=False)
                (d1, f1), (d2, f2), (d3, f3) = _features(raw, part, words, words.hashes())
                doc = np.concatenate([d1, d2, d3])
                column = np.concatenate([f1, f2, f3])
                cells, counts = np.unique(doc * (2 << BITS) + column, return_counts=True)
                doc, column = cells // (2 << BITS), cells % (2 << BITS)
                half = column >> BITS
                totals = np.bincount(doc * 2 + half, weights=counts, minlength=2 * (j - i))
                value = (counts / totals[doc * 2 + half]).astype(np.float32)
                for k in range(j - i):
                    lo, hi = np.searchsorted(doc, [k, k + 1])
                    columns.append(column[lo:hi].astype(np.int32))
                    values.append(value[lo:hi])
            yield pa.RecordBatch.from_arrays(
                [batch.column(label), pa.array(columns, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))], names=["label", "columns", "values"]
            )

    return run


def _descend(rows, columns, values, y, weight, n, steps=150, rate=0.5, shrink=1e-4, scale=30.0):
    """Logistic regression by Adam over sparse rows."""
    w, b = np.zeros(2 << BITS), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    x = values * scale
    for t in range(1, steps + 1):
        z = np.bincount(rows, weights=x * w[columns], minlength=n) + b
        error = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y)
        g = np.append(np.bincount(columns, weights=x * error[rows], minlength=len(w)) + shrink * w, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8) * 0.1
        w, b = w - step[:-1], b - step[-1]
    return w * scale, b


def _platt(margin, y, weight):
    """Slope and offset of the sigmoid over margins, by Newton steps on smoothed targets."""
    a, c = 1.0, 0.0
    good, bad = (weight * y).sum(), (weight * (1 - y)).sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + c, -50, 50)))
        g = np.array([(weight * (p - target) * margin).sum(), (weight * (p - target)).sum()])
        h = weight * p * (1 - p)
        hess = np.array([[(h * margin * margin).sum(), (h * margin).sum()], [(h * margin).sum(), h.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, g)
        a, c = a - step[0], c - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(max(a, 0.0)), float(c)


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", per_class: int = PER_CLASS) -> QualityModel | None:
    """Learn from labelled rows; None where a class has no row.  A key labelled twice counts with its lower label."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("_key")).agg((F.min(label) > 0).cast("int").alias("label"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    share = F.when(F.col("label") == 0, min(1.0, per_class / counts[0])).otherwise(min(1.0, per_class / counts[1]))
    drawn = cut_lineage(known.where(F.pmod(F.xxhash64(F.lit("quality"), "_key"), F.lit(1 << 30)) < share * (1 << 30)), "labels")
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).where(F.col("text").isNotNull()).join(drawn, "_key")
    got = rows.select("_key", "text", "label").mapInArrow(_vectors("text", "label"), "label int, columns array<int>, values array<float>").toArrow()
    y = got.column("label").to_numpy().astype(np.float64)
    if len(set(y.tolist())) < 2:
        return None
    where = np.concatenate([[0], np.cumsum(np.array([len(c) for c in got.column("columns")]))])
    order = sorted(range(len(y)), key=lambda i: (y[i], got.column("columns")[i].as_py()[:64], where[i + 1] - where[i]))  # the same rows in any order
    columns = [np.asarray(got.column("columns")[i].values) for i in order]
    values = [np.asarray(got.column("values")[i].values, dtype=np.float64) for i in order]
    y = y[order]
    weight = np.where(y > 0, counts[1] / (y > 0).sum(), counts[0] / (y == 0).sum())
    weight = weight / weight.sum()
    out = np.arange(len(y)) % 4 == 3

    def stacked(chosen):
        rows = np.repeat(np.arange(len(chosen)), [len(columns[i]) for i in chosen])
        return rows, np.concatenate([columns[i] for i in chosen]), np.concatenate([values[i] for i in chosen])

    fit_on, rest = np.flatnonzero(~out), np.flatnonzero(out)
    if len(set(y[fit_on])) < 2 or len(set(y[rest])) < 2:
        fit_on = rest = np.arange(len(y))
    even = np.where(y[fit_on] > 0, 0.5 / max(1, (y[fit_on] > 0).sum()), 0.5 / max(1, (y[fit_on] == 0).sum()))
    w, b = _descend(*stacked(fit_on), y[fit_on], even, len(fit_on))
    r, c, v = stacked(rest)
    margin = np.bincount(r, weights=v * w[c], minlength=len(rest)) + b
    slope, offset = _platt(margin, y[rest], weight[rest] * len(rest) / weight[rest].sum())
    return QualityModel(w, b, slope, offset)


def judge(docs: DataFrame, model: QualityModel | None, *, text: str = "text", threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """keep (default: all columns) with COUNTS, base_failed, quality_p and kept.

    Null and empty texts have no words and fail; repeated rows are judged alike; without a model only the counts decide
    (quality_p is null); columns of docs named like the new ones are replaced; an empty table gives an empty result.
    """
    new = [*COUNTS, "base_failed", "quality_p", "kept"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    given = docs.select(*keep) if text in keep else docs.select(*keep, text)  # the text crosses once
    fields = [*docs.select(*keep).schema.fields, *[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("quality_p", T.DoubleType())]

    def run(batches):
        for batch in small_batches(batches, text):
            raw, offsets = text_bytes(batch.column(text))
            counts, chances = [[] for _ in COUNTS], []
            for i, j in pieces(offsets):
                part = offsets[i : j + 1]
                words = Words(raw, part, NOT_SPACE, lower=False)
                hashes = words.hashes()
                for got, now in zip(counts, base_counts(raw, part, words, hashes)):
                    got.append(now.astype(np.int64))
                chances.append(shared.value.probability(raw, part, words, hashes) if shared.value is not None else np.full(j - i, np.nan))
            none = np.zeros(0, dtype=np.int64)
            p = np.concatenate([np.zeros(0), *chances])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], *[pa.array(np.concatenate([none, *c])) for c in counts], pa.array(p, from_pandas=True)], names=[*keep, *COUNTS, "quality_p"]
            )

    failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return given.mapInArrow(run, T.StructType(fields)).withColumn("base_failed", failed).withColumn("kept", ~failed & (F.coalesce("quality_p", F.lit(1.0)) >= threshold))
