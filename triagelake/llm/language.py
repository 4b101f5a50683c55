"""Language identification by words first, then by shorter and shorter character n-grams.

A known word adds its log frequency in each language.  An unseen word is cut into n-grams of its letters (with a mark at
either end); the longest n with a known n-gram decides, with the mean log frequency of its known n-grams.

The model is fitted on at most `per_language` labelled rows of each language (picked by a hash of the row) and keeps the
`most_words` commonest words and `most_grams` commonest n-grams of each length; these bounds are parameters of the fit and
bound what is sent to the tasks.  Every row is scored over its whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triagelake.llm.arrow_text import PIECE_BYTES, mix, powers, signed, small_batches
from triagelake.session import cut_lineage

LENGTHS = (5, 4, 3, 2, 1)
PER_LANGUAGE = 1500
MOST_WORDS = 60_000
MOST_GRAMS = 30_000
UNSEEN_WEIGHT = 0.5
UNDETERMINED = "und"

_letter_table: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _letter_table
    if _letter_table is None:
        _letter_table = np.array([chr(c).isalpha() for c in range(0x110000)], dtype=bool)
    return _letter_table


class LetterWords:
    """Words (runs of letters) of lower-cased texts as code points."""

    def __init__(self, texts: list[str]):
        lowered = [t.lower() for t in texts]
        self.points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in lowered])]).astype(np.int64)
        inside = _letters()[self.points]
        total = len(inside)
        edge = np.zeros(total + 1, dtype=bool)
        edge[self.offsets] = True
        before = np.zeros(total, dtype=bool)
        after = np.zeros(total, dtype=bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[edge[:-1]] = False
        after[edge[1:]] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.lengths = np.flatnonzero(inside & ~after) + 1 - self.starts
        self.doc = np.searchsorted(self.offsets, self.starts, side="right") - 1

    def hashes(self) -> np.ndarray:
        """Hash of every word."""
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        heads = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        within = np.arange(self.lengths.sum()) - np.repeat(heads, self.lengths)
        at = np.repeat(self.starts, self.lengths) + within
        sums = np.add.reduceat((self.points[at].astype(np.uint64) + np.uint64(1)) * powers(int(self.lengths.max()))[within], heads)
        return mix(sums + self.lengths.astype(np.uint64))

    def grams(self, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, index into words) of all n-grams of these words with their end marks."""
        lengths = self.lengths[words] + 2
        heads = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        owner = np.repeat(np.arange(len(words)), lengths)
        within = np.arange(len(owner)) - heads[owner]
        points = np.ones(len(owner), dtype=np.uint64)
        body = (within > 0) & (within < lengths[owner] - 1)
        points[body] = self.points[self.starts[words][owner[body]] + within[body] - 1].astype(np.uint64) + np.uint64(1)
        full = np.flatnonzero(within + n <= lengths[owner])
        out = np.full(len(full), n, dtype=np.uint64)
        for k in range(n):
            out = (out ^ points[full + k]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(32)
        return mix(out), owner[full]


def _batches(batch, text: str):
    """Pieces of a batch as (first row, texts)."""
    texts = ["" if t is None else t for t in batch.column(text).to_pylist()]
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= PIECE_BYTES):
            size += len(texts[j])
            j += 1
        yield i, texts[i:j]
        i = j


class Lookup:
    """A sorted table of hashes with one row of log frequencies each."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order].astype(np.float32)
        self.sieve = np.zeros(1 << 20, dtype=bool)
        self.sieve[(self.keys & np.uint64(0xFFFFF)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Row numbers, -1 for unknown hashes."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        likely = np.flatnonzero(self.sieve[(hashes & np.uint64(0xFFFFF)).astype(np.int64)])
        if len(likely) and len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, hashes[likely]), len(self.keys) - 1)
            right = self.keys[at] == hashes[likely]
            out[likely[right]] = at[right]
        return out


@dataclass
class LanguageModel:
    languages: list[str]
    words: Lookup
    grams: dict[int, Lookup]

    def score(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        n, k = len(texts), len(self.languages)
        words = LetterWords(texts)
        sums = np.zeros((n, k))
        per_doc = np.bincount(words.doc, minlength=n)
        if len(words.starts) and k:
            row = self.words.find(words.hashes())
            known = np.flatnonzero(row >= 0)
            self._add(sums, words.doc[known], self.words.values[row[known]])
            unseen = np.flatnonzero(row < 0)
            for length in LENGTHS:
                if not len(unseen):
                    break
                table = self.grams[length]
                found = np.zeros(len(unseen), dtype=np.int64)
                value = np.zeros((len(unseen), k))
                hashes, owner = words.grams(unseen, length)
                row = table.find(hashes)
                hit = row >= 0
                found += np.bincount(owner[hit], minlength=len(unseen))
                for lang in range(k):
                    value[:, lang] = np.bincount(owner[hit], weights=table.values[row[hit], lang], minlength=len(unseen))
                done = found > 0
                self._add(sums, words.doc[unseen[done]], UNSEEN_WEIGHT * value[done] / found[done, None])
                unseen = unseen[~done]
        labels, scores = [], np.zeros(n)
        best = sums.argmax(axis=1) if k else np.zeros(n, dtype=int)
        for i in range(n):
            if not per_doc[i] or not k:
                labels.append(UNDETERMINED)
                continue
            labels.append(self.languages[best[i]])
            scores[i] = 1.0 / np.exp(np.clip(sums[i] - sums[i, best[i]], -60, 0)).sum()
        return labels, scores

    @staticmethod
    def _add(sums, doc, values):
        for lang in range(sums.shape[1]):
            sums[:, lang] += np.bincount(doc, weights=values[:, lang], minlength=len(sums))


def _counter(text: str, lang: str):
    def run(batches):
        for batch in batches:
            langs = np.array(batch.column(lang).to_pylist(), dtype=object)
            for first, texts in _batches(batch, text):
                words = LetterWords(texts)
                if not len(words.starts):
                    continue
                names, code = np.unique(langs[first : first + len(texts)].astype(str), return_inverse=True)
                for n in (0, *LENGTHS):
                    hashes, owner = (words.hashes(), np.arange(len(words.starts))) if n == 0 else words.grams(np.arange(len(words.starts)), n)
                    pairs = pd.DataFrame({"gram": signed(hashes), "code": code[words.doc[owner]]}).value_counts().reset_index()
                    yield pa.RecordBatch.from_pydict({
                        "n": pa.array(np.full(len(pairs), n), pa.int32()), "gram": pa.array(pairs["gram"].to_numpy()),
                        "lang": pa.array(names[pairs["code"].to_numpy()], pa.string()), "seen": pa.array(pairs["count"].to_numpy().astype(np.int64)),
                    })

    return run


def fit(
    labelled: DataFrame, *, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE, most_words: int = MOST_WORDS, most_grams: int = MOST_GRAMS
) -> LanguageModel:
    """Learn from text and lang of labelled rows; rows with null text or lang teach nothing."""
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    seen = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for name, n in seen.items():
        share = F.when(F.col("lang") == name, min(1.0, per_language / n)).otherwise(share)
    drawn = F.pmod(F.xxhash64(F.lit("language"), "text"), F.lit(1 << 30)) < share * (1 << 30)
    counts = rows.where(drawn).mapInArrow(_counter("text", "lang"), "n int, gram long, lang string, seen long").groupBy("n", "gram", "lang").agg(F.sum("seen").alias("seen"))
    by_gram = counts.groupBy("n", "gram").agg(F.sum("seen").alias("total"), F.map_from_entries(F.collect_list(F.struct("lang", "seen"))).alias("by"))
    by_gram = cut_lineage(by_gram.where(F.col("total") > 1), "grams")
    names = sorted(seen)
    tables = {}
    for n in (0, *LENGTHS):
        top = by_gram.where(F.col("n") == n).orderBy(F.desc("total"), "gram").limit(most_words if n == 0 else most_grams)
        got = top.select("gram", *[F.coalesce(F.col("by")[name], F.lit(0)).alias(f"c{i}") for i, name in enumerate(names)]).toPandas()
        keys = got["gram"].to_numpy(dtype=np.int64).view(np.uint64)
        table = got[[f"c{i}" for i in range(len(names))]].to_numpy(dtype=np.float64).reshape(len(keys), len(names))
        total = table.sum(axis=0) + 0.5 * max(1, len(keys))
        tables[n] = Lookup(keys, np.log((table + 0.5) / total) if len(names) else table)
    return LanguageModel(names, tables[0], {n: tables[n] for n in LENGTHS})


def identify(docs: DataFrame, model: LanguageModel, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """keep (default: all columns of docs) with lang_pred and score (0 to 1).

    A text that is null or has no letter gets 'und' and score 0, as does every text if the model has learnt nothing.
    Ties go to the first language by name.  Columns of docs named lang_pred or score are replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    given = docs.select(*keep) if text in keep else docs.select(*keep, text)  # the text crosses once
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in small_batches(batches, text):
            labels, scores = [], []
            for _, texts in _batches(batch, text):
                a, b = shared.value.score(texts)
                labels += a
                scores.append(b)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(labels, pa.string()), pa.array(np.concatenate([np.zeros(0), *scores]))], names=[*keep, "lang_pred", "score"]
            )

    return given.mapInArrow(run, schema)
