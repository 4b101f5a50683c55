"""Benchmark decontamination with an FM-index per training shard.

A shard is one Arrow batch of documents.  Words that no benchmark item has cannot lie in a window, so a shard's text is
its runs of benchmark words that are as long as the shortest window; a separator stands between runs.  An FM-index over
that text is searched backwards for all windows at once; positions come from sampled suffixes and are merged to spans.

The benchmark is a stated query set.  It is read in blocks of at most BLOCK_BYTES of text (a single longer item is a
block's only one), and only one block's windows are sent to the tasks at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triagelake.llm.arrow_text import ALNUM, Words, pieces, replaced, small_batches, text_bytes
from triagelake.llm.names import unused
from triagelake.llm.suffixes import FMIndex
from triagelake.session import cut_lineage

WINDOW = 10
#: Text per FM-index.
INDEX_BYTES = 16 << 20
BLOCK_BYTES = 8 << 20
SPANS = "array<struct<start:bigint,end:bigint>>"


class WindowSet:
    """The distinct windows of a block of items, as numbers of its words."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        texts = pa.array([t for _, t in items], pa.large_string())
        raw, offsets = text_bytes(texts)
        words = Words(raw, offsets, ALNUM, lower=True)
        self.vocabulary, ids = np.unique(words.hashes(), return_inverse=True)
        ids = ids.astype(np.int64) + 1
        found: dict[tuple, set[int]] = {}
        for k in range(len(items)):
            own = ids[words.first[k] : words.first[k + 1]]
            for s in range(max(1, len(own) - window + 1) if len(own) else 0):
                found.setdefault(tuple(own[s : s + window]), set()).add(k)
        self.ids = [i for i, _ in items]
        self.shortest = min(map(len, found), default=0)
        self.by_length: list[tuple[int, np.ndarray, list[list[int]]]] = []
        for length in sorted({len(w) for w in found}):
            own = sorted(w for w in found if len(w) == length)
            self.by_length.append((length, np.array(own, dtype=np.int64), [sorted(found[w]) for w in own]))
        self.sieve = np.zeros(1 << 16, dtype=bool)
        self.sieve[(self.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Each word's number in the block, 0 for others."""
        out = np.zeros(len(hashes), dtype=np.int64)
        likely = np.flatnonzero(self.sieve[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.searchsorted(self.vocabulary, hashes[likely])
        at[at == len(self.vocabulary)] = 0
        right = self.vocabulary[at] == hashes[likely]
        out[likely[right]] = at[right] + 1
        return out


def _runs(numbers: np.ndarray, doc: np.ndarray, least: int) -> np.ndarray:
    """Indexes of words in runs of at least `least` known words of one document."""
    known = numbers > 0
    new = np.ones(len(numbers), dtype=bool)
    new[1:] = ~(known[1:] & known[:-1] & (doc[1:] == doc[:-1]))
    run = np.cumsum(new) - 1
    lengths = np.bincount(run, minlength=1)
    return np.flatnonzero(known & (lengths[run] >= least))


def scan_texts(raw: np.ndarray, offsets: np.ndarray, block: WindowSet):
    """(words per document, hit words' (document, word, first byte, byte behind), (document, item) pairs)."""
    n = len(offsets) - 1
    counts = np.zeros(n, dtype=np.int64)
    parts = []
    for i, j in pieces(offsets):
        words = Words(raw, offsets[i : j + 1], ALNUM, lower=True)
        counts[i:j] = words.per_doc
        if not block.shortest or not len(words.starts):
            continue
        numbers = block.numbers(words.hashes())
        kept = _runs(numbers, words.doc, block.shortest)
        base = offsets[i] - offsets[0]
        parts.append((numbers[kept], words.doc[kept] + i, kept - words.first[words.doc[kept]], words.starts[kept] + base, words.ends[kept] + base))
    empty = np.zeros(0, dtype=np.int64)
    if not parts or not sum(len(p[0]) for p in parts):
        return counts, (empty, empty, empty, empty), np.zeros((0, 2), dtype=np.int64)
    number, doc, word, first, behind = (np.concatenate(x) for x in zip(*parts))
    cut = np.ones(len(number), dtype=np.int64)
    cut[1:] = (doc[1:] != doc[:-1]) | (word[1:] != word[:-1] + 1)
    place = np.arange(len(number)) + np.cumsum(cut)  # a separator before each run
    text = np.zeros(place[-1] + 1, dtype=np.int64)
    text[place] = number
    back = np.zeros(len(text), dtype=np.int64)
    back[place] = np.arange(len(number))
    index = FMIndex(text, len(block.vocabulary) + 1)
    covered = np.zeros(len(text) + 1, dtype=np.int64)
    pairs = []
    for length, patterns, owners in block.by_length:
        which, lo, hi = index.search(patterns)
        if not len(which):
            continue
        many = hi - lo
        rows = np.repeat(lo - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        at = index.locate(rows)
        np.add.at(covered, at, 1)
        np.add.at(covered, at + length, -1)
        seen = np.unique(np.repeat(which, many) * n + doc[back[at]])
        pairs += [(d, item) for w, d in zip((seen // n).tolist(), (seen % n).tolist()) for item in owners[w]]
    hit = np.cumsum(covered)[:-1][place] > 0
    pairs = np.unique(np.array(pairs, dtype=np.int64).reshape(-1, 2), axis=0)
    return counts, (doc[hit], word[hit], first[hit], behind[hit]), pairs


def _merged(doc: np.ndarray, word: np.ndarray):
    """Starts and ends (indexes) of runs of neighbouring hit words."""
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (word[1:] != word[:-1] + 1)
    starts = np.flatnonzero(new)
    return starts, np.concatenate([starts[1:], [len(doc)]]) - 1


def _scanner(shared, text: str, names: list[str]):
    def run(batches):
        block = shared.value
        for batch in small_batches(batches, text, INDEX_BYTES):
            raw, offsets = text_bytes(batch.column(text))
            counts, (doc, word, _, _), pairs = scan_texts(raw, offsets, block)
            starts, lasts = _merged(doc, word)
            spans: dict[int, list] = {}
            for s, e in zip(starts.tolist(), lasts.tolist()):
                spans.setdefault(int(doc[s]), []).append({"start": int(word[s]), "end": int(word[e]) + 1})
            items: dict[int, list] = {}
            for d, k in pairs.tolist():
                items.setdefault(d, []).append(block.ids[k])
            n = batch.num_rows
            columns = {name: batch.column(name) for name in batch.schema.names}
            span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*columns.values(), pa.array(counts), pa.array([spans.get(d, []) for d in range(n)], span_type),
                 pa.array([items.get(d, []) for d in range(n)], pa.list_(pa.string()))],
                names=[*columns, *names],
            )

    return run


def _cutter(text: str):
    """Takes the words of bench_spans out of the text."""

    def run(batches):
        for batch in small_batches(batches, text):
            spans = batch.column("bench_spans").to_pylist()
            hit = [d for d, s in enumerate(spans) if s]
            columns = {name: batch.column(name) for name in batch.schema.names}
            if hit:
                raw, offsets = text_bytes(columns[text])
                texts = {}
                for d in hit:
                    own, at, left = raw[offsets[d] : offsets[d + 1]].tobytes(), 0, []
                    words = Words(raw, offsets[d : d + 2], ALNUM, lower=True)
                    for s in spans[d]:
                        left.append(own[at : int(words.starts[s["start"]])])
                        at = int(words.ends[s["end"] - 1])
                    texts[d] = b"".join([*left, own[at:]]).decode("utf-8", "replace")
                columns[text] = replaced(columns[text], texts)
            yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    return run


def benchmark_blocks(items: DataFrame, item_id: str, text: str, block_bytes: int = BLOCK_BYTES) -> list[list[tuple[str, str]]]:
    """Yields the items in blocks of about block_bytes; an item without id has the id ''."""
    known = items.where(F.col(text).isNotNull()).select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t")).distinct()
    total = known.agg(F.sum(F.octet_length("t"))).head()[0] or 0
    n = -(-total // block_bytes)
    for k in range(n):
        yield [(r.i, r.t) for r in known.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).sort("i", "t").collect()]


def find_benchmark(
    docs: DataFrame, items: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, cut: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """docs with bench_words (count), bench_spans (hit word ranges, merged) and bench_items (ids of items found).

    With cut, the hit words are taken out of the text (what lies between two hit neighbours goes with them) once all blocks
    were searched, so hits and bench_spans are those of the uncut text.  Null and empty texts have no words and no hits; repeated rows are
    judged alone; other columns pass through, and columns of docs named like the new ones are replaced.  Items with null
    or wordless text are no windows; an empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    new = ["bench_words", "bench_spans", "bench_items"]
    out = docs.drop(*new)
    kept = out.columns
    state = out.withColumns({"bench_words": F.lit(0).cast("long"), "bench_spans": F.expr(f"cast(array() as {SPANS})"), "bench_items": F.expr("cast(array() as array<string>)")})
    blocks = benchmark_blocks(items, item_id, item_text, block_bytes)
    words, spans, ids = now = unused(state.columns, "words", "spans", "items")
    for k, block in enumerate([*_first_or_empty(blocks)]):
        if k:
            state = cut_lineage(state, "bench")
        shared = spark.sparkContext.broadcast(WindowSet(block, window))
        schema = T.StructType([*state.schema.fields, T.StructField(words, T.LongType()), T.StructField(spans, T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))), T.StructField(ids, T.ArrayType(T.StringType()))])
        found = state.mapInArrow(_scanner(shared, text, now), schema)
        state = found.select(
            *kept,
            (F.col(words) if k == 0 else F.col("bench_words")).alias("bench_words"),
            (F.col(spans) if k == 0 else _union_spans("bench_spans", spans)).alias("bench_spans"),
            (F.col(ids) if k == 0 else F.array_union("bench_items", ids)).alias("bench_items"),
        )
    return state.mapInArrow(_cutter(text), state.schema) if cut else state


def _first_or_empty(blocks):
    empty = True
    for b in blocks:
        empty = False
        yield b
    if empty:
        yield []


def _union_spans(a: str, b: str):
    """Union of two lists of ranges, as disjoint ranges in order."""
    both = F.array_sort(F.concat(a, b))
    start = F.expr(f"cast(array() as {SPANS})")

    def put(acc, x):
        last = F.element_at(acc, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] >= x["start"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(longer))).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(both, start, put)
