"""Removal of repeated byte strings with longest-previous-factor arrays.

A byte goes if a string of LEAST bytes covers it that also starts earlier (smaller document, or earlier in the same one).

1. Every string of LEAST bytes has an anchor: the K bytes in it with the smallest hash (the leftmost, if several).  Equal
   strings have equal anchors, so only strings with one anchor are ever compared.  Neighbouring strings share an anchor;
   together they are its context, LEAST to LEAST + 60 bytes long.
2. Equal contexts: all but the first go.  (Copies inside a batch are settled there and are not shuffled.)
3. Anchors with different contexts: the first of each context are laid out in reading order, a separator between any two.
   The suffix array of that text gives the previous and next smaller position of each suffix and so the longest previous
   factor; a string whose factor has LEAST bytes or more is a later copy.
4. An anchor with more than GROUP different contexts is dealt to several tasks.  What is first in a task is then compared
   across tasks by a digest of the string, and the smallest position stays.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.llm.arrow_text import mix, pieces, powers, signed, text_bytes
from triagelake.llm.suffixes import longest_previous_factor, neighbour_lcp, suffix_order
from triagelake.session import cut_lineage

LEAST = 100
K = 40
GROUP = 16_384
CHUNK = 1 << 20
NO_ID = -(2**63)
_SPANS = "array<struct<start:bigint,end:bigint>>"

_inverse = np.ones(1, dtype=np.uint64)


def _inverse_powers(n: int) -> np.ndarray:
    global _inverse
    if len(_inverse) < n:
        base = int(powers(2)[1])
        table = np.full(max(4096, 2 * n), pow(base, -1, 1 << 64), dtype=np.uint64)
        table[0] = 1
        _inverse = np.cumprod(table, dtype=np.uint64)
    return _inverse[:n]


def _smallest(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values."""
    span = 1
    while span * 2 <= width:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    return np.minimum(key[: len(key) - (width - span)], key[width - span :]) if width > span else key


def contexts(raw: np.ndarray, offsets: np.ndarray, least: int = LEAST, k: int = K):
    """(document, anchor hash, context hash, first byte, last string's first byte) of all contexts."""
    own = raw[offsets[0] : offsets[-1]]
    at = (offsets - offsets[0]).astype(np.int64)
    n, many = len(own), np.maximum(np.diff(at) - least + 1, 0)
    total = int(many.sum())
    if total == 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    run = np.empty(n + 1, dtype=np.uint64)
    run[0] = 0
    np.cumsum((own.astype(np.uint64) + np.uint64(1)) * powers(n), out=run[1:])
    back = _inverse_powers(n + 1)
    grams = mix((run[k:] - run[:-k]) * back[: n - k + 1])
    bits = np.uint64(max(16, n.bit_length()))
    key = ((grams >> bits) << bits) | np.arange(len(grams), dtype=np.uint64)
    chosen = (_smallest(key, least - k + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(many)[:-1]])
    starts = np.repeat(at[:-1] - begin, many) + np.arange(total)
    anchor = chosen[starts]
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    last = np.concatenate([first[1:], [total]]) - 1
    anchor, lo, hi = anchor[first], starts[first], starts[last]
    doc = np.searchsorted(at, lo, side="right") - 1
    body = (run[hi + least] - run[lo]) * back[lo]
    body = mix(mix(body) + ((anchor - lo) * 1024 + (hi - lo)).astype(np.uint64))
    return doc, grams[anchor], body, lo - at[doc], hi - at[doc]


def _groups(*keys: np.ndarray) -> np.ndarray:
    """Starts of runs of equal rows in sorted keys."""
    if not len(keys[0]):
        return np.zeros(0, dtype=np.int64)
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Ranges of each document, joined where they touch."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((end, start, doc))
    doc, start, end = doc[order], start[order], end[order]
    _, code = np.unique(doc, return_inverse=True)
    shift = code.astype(np.int64) * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + shift)
    new = np.concatenate([[True], (start + shift)[1:] > reach[:-1]])
    heads = np.flatnonzero(new)
    return doc[heads], start[heads], (reach - shift)[np.concatenate([heads[1:], [len(doc)]]) - 1]


def _batch_contexts(batch, least, k):
    """Contexts of a batch, and which of them are the first of their kind in it."""
    raw, offsets = text_bytes(batch.column("text"))
    ids = batch.column("doc").to_numpy()
    got = []
    for i, j in pieces(offsets):
        doc, h, c, lo, hi = contexts(raw, offsets[i : j + 1], least, k)
        got.append((ids[doc + i], h, c, lo, hi))
    doc, h, c, lo, hi = (np.concatenate(x) for x in zip(*got)) if got else (np.zeros(0, dtype=np.int64),) * 5
    order = np.lexsort((lo, doc, c, h))
    doc, h, c, lo, hi = doc[order], h[order], c[order], lo[order], hi[order]
    first = np.zeros(len(doc), dtype=bool)
    heads = _groups(h, c)
    first[heads] = True
    return doc, h, c, lo, hi, first, heads


def _dealt(least: int, k: int):
    def run(batches):
        for batch in batches:
            doc, h, c, lo, hi, first, _ = _batch_contexts(batch, least, k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(h[first])), pa.array(signed(c[first])), pa.array(doc[first]), pa.array((lo * 64 + (hi - lo))[first])], names=["h", "c", "doc", "place"]
            )

    return run


def _settled(least: int, k: int):
    """Ranges of contexts that are later copies inside their batch."""
    def run(batches):
        for batch in batches:
            doc, _, _, lo, hi, first, heads = _batch_contexts(batch, least, k)
            own = np.repeat(heads, np.diff(np.concatenate([heads, [len(doc)]])))
            later = ~first & ((doc != doc[own]) | (lo != lo[own]))
            yield _span_batch(*_merged(doc[later], lo[later], hi[later] + least))

    return run


def _span_batch(doc, start, end):
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, dtype=np.int64)) for x in (doc, start, end)], names=["doc", "start", "end"])


def _judged(least: int):
    """Per partition of anchors: later copies of equal contexts (parts 0), and first ones of anchors with several."""
    def run(batches):
        got = [[b.column(c).to_numpy() for c in ("h", "c", "doc", "place")] for b in batches]
        if not got:
            return
        h, c, doc, place = (np.concatenate(x) for x in zip(*got))
        order = np.argsort(h, kind="stable")
        heads = _groups(h[order])
        many = np.diff(np.concatenate([heads, [len(h)]]))
        own = order[np.repeat(many > 1, many)]
        order = own[np.lexsort((place[own], doc[own], c[own], h[own]))]
        h, c, doc, place = h[order], c[order], doc[order], place[order]
        once = _groups(h, c, doc, place)
        h, c, doc, place = h[once], c[once], doc[once], place[once]
        heads = _groups(h, c)
        first = np.zeros(len(h), dtype=bool)
        first[heads] = True
        group = _groups(h)
        kinds = np.add.reduceat(first.astype(np.int64), group) if len(group) else group
        kinds = np.repeat(kinds, np.diff(np.concatenate([group, [len(h)]])))
        lo = place >> 6
        end = lo + (place & 63) + least
        suspect = first & (kinds > 1)
        chosen = ~first | suspect
        parts = np.where(suspect, -(-kinds // GROUP), 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(h[chosen]), pa.array(doc[chosen]), pa.array(lo[chosen]), pa.array(end[chosen]), pa.array(parts[chosen])], names=["h", "doc", "start", "end", "parts"]
        )

    return run


def _cut_out(batches):
    """The bytes of each suspect context of a document."""
    for batch in batches:
        raw, offsets = text_bytes(batch.column("text"))
        ids = batch.column("doc").to_pylist()
        out = {"h": [], "part": [], "parts": [], "doc": [], "start": [], "body": []}
        for d, places in enumerate(batch.column("places").to_pylist()):
            own = raw[offsets[d] : offsets[d + 1]].tobytes()
            for p in places:
                if p["end"] <= len(own):
                    out["h"].append(p["h"])
                    out["parts"].append(p["parts"])
                    out["part"].append(int((ids[d] ^ (p["start"] * 0x9E3779B1)) % p["parts"]))
                    out["doc"].append(ids[d])
                    out["start"].append(p["start"])
                    out["body"].append(own[p["start"] : p["end"]])
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))


def _factors(bodies: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray]:
    """(body, offset) of the strings of `least` bytes that start earlier too, for bodies in reading order."""
    lengths = np.array([len(b) for b in bodies], dtype=np.int64)
    heads = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    seq = np.zeros(int((lengths + 1).sum()), dtype=np.int64)
    ends = heads + lengths
    inside = np.ones(len(seq), dtype=bool)
    inside[ends] = False
    seq[inside] = np.frombuffer(b"".join(bodies), dtype=np.uint8)
    seq[ends] = 256 + np.arange(len(bodies))
    order, ranks = suffix_order(seq, depth=least)
    factor = longest_previous_factor(order, neighbour_lcp(order, ranks))
    later = np.flatnonzero(factor >= least)
    body = np.searchsorted(heads, later, side="right") - 1
    return body, later - heads[body]


def _compared(least: int):
    def run(batches):
        got = pa.Table.from_batches(list(batches), pa.schema([(n, pa.binary() if n == "body" else pa.int64()) for n in ("h", "part", "parts", "doc", "start", "body")]))
        h, part, parts, doc, start = (got.column(c).to_numpy() for c in ("h", "part", "parts", "doc", "start"))
        body = got.column("body").to_pylist()
        order = np.lexsort((start, doc, part, h))
        once = order[_groups(h[order], part[order], doc[order], start[order])]
        sizes = np.array([len(body[i]) + 1 for i in once], dtype=np.int64)
        heads = _groups(h[once], part[once])
        tails = np.concatenate([heads[1:], [len(once)]])
        run_size = np.concatenate([[0], np.cumsum(sizes)])
        i = 0
        while i < len(heads):
            j = i + 1
            while j < len(heads) and run_size[tails[j]] - run_size[heads[i]] <= CHUNK:
                j += 1
            rows = once[heads[i] : tails[j - 1]] if j else once
            rows = rows[np.lexsort((start[rows], doc[rows]))]
            bodies = [body[r] for r in rows]
            which, off = _factors(bodies, least)
            yield _compared_batch(*_merged(doc[rows][which], start[rows][which] + off, start[rows][which] + off + least))
            split = np.flatnonzero(parts[rows] > 1)
            if len(split):
                gone = set(zip(which.tolist(), off.tolist()))
                left = [(r, o) for r in split.tolist() for o in range(len(bodies[r]) - least + 1) if (r, o) not in gone]
                digests = np.frombuffer(b"".join(hashlib.blake2b(bodies[r][o : o + least], digest_size=16).digest() for r, o in left), dtype=np.int64).reshape(-1, 2)
                at = np.array([int(start[rows[r]]) + o for r, o in left], dtype=np.int64)
                yield _compared_batch(np.array([int(doc[rows[r]]) for r, _ in left], dtype=np.int64), at, at + least, digests)
            i = j

    return run


def _compared_batch(doc, start, end, digests=None):
    n = len(doc)
    one = pa.nulls(n, pa.int64()) if digests is None else pa.array(digests[:, 0])
    two = pa.nulls(n, pa.int64()) if digests is None else pa.array(digests[:, 1])
    return pa.RecordBatch.from_arrays([*[pa.array(np.asarray(x, dtype=np.int64)) for x in (doc, start, end)], one, two], names=["doc", "start", "end", "d1", "d2"])


def _finished(keep: list[str], with_text: bool):
    def run(batches):
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            sizes = np.diff(offsets)
            removed, spans, digests, texts = [], [], [], []
            for d, ranges in enumerate(batch.column("ranges").to_pylist()):
                own = raw[offsets[d] : offsets[d + 1]].tobytes()
                ranges = [(r["start"], min(r["end"], len(own))) for r in ranges or [] if r["start"] < len(own)]
                a = np.array(ranges, dtype=np.int64).reshape(-1, 2)
                _, s, e = _merged(np.zeros(len(a), dtype=np.int64), a[:, 0], a[:, 1])
                left, at = [], 0
                for x, y in zip(s.tolist(), e.tolist()):
                    left.append(own[at:x])
                    at = y
                rest = b"".join([*left, own[at:]])
                removed.append(len(own) - len(rest))
                spans.append([{"start": x, "end": y} for x, y in zip(s.tolist(), e.tolist())])
                digests.append(hashlib.sha256(rest).hexdigest())
                texts.append(rest)
            span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [*[batch.column(c) for c in keep], pa.array(sizes), pa.array(removed, pa.int64()), pa.array(spans, span_type), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(texts, pa.binary())] if with_text else []), names=[*keep, "n_bytes", "n_removed", "spans", "kept_sha256", *["kept_bytes"] * with_text])

    return run


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", least: int = LEAST, with_text: bool = False) -> DataFrame:
    """(key, n_bytes, n_removed, spans, kept_sha256[, kept_bytes]): one row per row of docs.

    spans are the maximal removed byte ranges; they may cut a character, so what is kept comes as bytes.  Null and empty
    texts have no bytes.  Rows that share a key are one document, whose ranges are taken from each of them; a null key
    stands before all others.  Other columns of docs are not read; an empty table gives an empty result.
    """
    k = max(8, K * least // LEAST)
    if least - k > 60:
        raise ValueError("least is at most 100")
    given = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("doc"), F.col(text).alias("text"))
    spans = "doc long, start long, end long"
    settled = given.mapInArrow(_settled(least, k), spans)
    dealt = given.mapInArrow(_dealt(least, k), "h long, c long, doc long, place long").repartition("h")
    judged = cut_lineage(dealt.mapInArrow(_judged(least), "h long, doc long, start long, end long, parts long"), "judged")
    suspects = judged.where("parts > 0").groupBy("doc").agg(F.collect_list(F.struct("h", "start", "end", "parts")).alias("places"))
    bodies = given.join(suspects, "doc").select("doc", "text", "places").mapInArrow(_cut_out, "h long, part long, parts long, doc long, start long, body binary")
    compared = cut_lineage(bodies.repartition("h", "part").mapInArrow(_compared(least), f"{spans}, d1 long, d2 long"), "compared")
    across = compared.where("d1 is not null")
    earliest = across.groupBy("d1", "d2").agg(F.min(F.struct("doc", "start")).alias("first"))
    later = across.join(earliest, ["d1", "d2"]).where(F.struct("doc", "start") > F.col("first")).select("doc", "start", "end")
    ranges = (
        judged.where("parts = 0").select("doc", "start", "end").union(compared.where("d1 is null").select("doc", "start", "end")).union(later).union(settled)
        .groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    )
    rows = given.join(ranges, "doc", "left").select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias(key), "text", "ranges")
    out = f"{key} long, n_bytes long, n_removed long, spans {_SPANS}, kept_sha256 string" + (", kept_bytes binary" if with_text else "")
    return rows.mapInArrow(_finished([key], with_text), out)
