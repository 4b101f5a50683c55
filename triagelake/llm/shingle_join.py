"""Jaccard join on word n-grams by vertical partitioning.

The global order of n-grams is the order of their 64-bit hashes, with very common ones last.  Any order gives the same
links; this one keeps common n-grams out of most prefixes.  Common is what at least one document in 500 of some Arrow batch
has; at most MOST_COMMON such n-grams (the commonest) are sent to the tasks.

* Equal sets are one class; only classes are joined.
* Candidates: two sets with a Jaccard similarity of t share one of the first n - ceil(t n) + 1 n-grams of either.  These
  prefixes are dealt by n-gram, one of n-grams that the same sets share; a bucket's sets are compared with three hubs of the bucket, and after the links so found
  only sets of different components are compared with each other, block by block inside a task, in the unions of the
  buckets that have the same first set.
* Sets that still have a possible partner in another component are looked at together: an n-gram that only one of them has
  adds to its difference from every other, which bounds pairs far more tightly in large groups of edited copies.  The
  member with fewest such n-grams is the next hub; only what it leaves unlinked is compared pair by pair.
  There the parities of finely dealt n-gram counts bound the difference almost exactly.
* A sketch (counts of n-grams in equal cuts of the order) bounds the difference of two sets from below, so most candidates
  end there.  Counts come from the whole sets and never drop a linked pair.
* Overlap: the order is cut into FRAGMENTS, each pair's overlap is counted in every fragment separately and summed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.llm.arrow_text import NOT_SPACE, Words, mix, pieces, signed, text_bytes, windows
from triagelake.llm.components import components
from triagelake.llm.names import unused
from triagelake.session import cut_lineage

N = 5
PERCENT = 80
FRAGMENTS = 4
HUBS = 3
#: Keys (about 16 bytes each) that are sent to every executor instead of dealing texts out.
MOST_SENT = 2_000_000
MOST_COMMON = 1 << 18
BLOCK = 1024
_SECOND = np.uint64(0xA0761D6478BD642F)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets) of each document's distinct n-grams in hash order."""
    parts, sizes = [], []
    for i, j in pieces(offsets):
        words = Words(raw, offsets[i : j + 1], NOT_SPACE, lower=True)
        h = words.hashes()
        hashes, docs = [], []
        full = windows(h, n)
        if len(full):
            inside = np.flatnonzero(words.doc[: len(full)] == words.doc[n - 1 :])
            hashes.append(full[inside])
            docs.append(words.doc[inside])
        for k in range(1, n):
            own = np.flatnonzero(words.per_doc == k)
            if len(own):
                hashes.append(windows(h, k)[words.first[own]])
                docs.append(own)
        if hashes:
            hashes, docs = np.concatenate(hashes), np.concatenate(docs)
            order = np.argsort(hashes, kind="stable")
            order = order[np.argsort(docs[order], kind="stable")]
            hashes, docs = hashes[order], docs[order]
            new = np.ones(len(hashes), dtype=bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
            parts.append(hashes[new])
            sizes.append(np.bincount(docs[new], minlength=j - i))
        else:
            sizes.append(np.zeros(j - i, dtype=np.int64))
    sizes = np.concatenate(sizes) if sizes else np.zeros(0, dtype=np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def set_keys(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each set."""
    run = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(hashes ^ _SECOND), dtype=np.uint64)])
    return mix(run[at[1:]] - run[at[:-1]] + np.diff(at).astype(np.uint64))


def _cuts(size: int) -> int:
    """Number of cuts of a set's sketch: a power of two, about one for every 4 to 8 n-grams."""
    return 1 << max(4, int(size).bit_length() - 3)


def sketch(hashes: np.ndarray) -> bytes:
    cuts = _cuts(len(hashes))
    at = np.bincount((hashes >> np.uint64(64 - cuts.bit_length() + 1)).astype(np.int64), minlength=cuts)
    return np.minimum(at, 255).astype(np.uint8).tobytes()


def parity(hashes: np.ndarray) -> bytes:
    """Parities of the counts of n-grams in 2 to 4 cells for each n-gram.  Two sets differ by at least the differing parities."""
    cells = 1 << max(6, 1 + len(hashes).bit_length())
    return np.packbits((np.bincount((hashes & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1).astype(np.uint8)).tobytes()


def _folded(sketches: np.ndarray, cuts: int) -> np.ndarray:
    """A sketch with fewer cuts; sums of capped counts stay lower bounds only where none is capped."""
    return sketches.reshape(len(sketches), cuts, -1).sum(axis=2)


def may_link(a: list[bytes], b: list[bytes], size_a: np.ndarray, size_b: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """False where the sketches show that two sets differ by too many n-grams."""
    keep = np.ones(len(a), dtype=bool)
    groups: dict[tuple[int, int], list[int]] = {}
    for k, (x, y) in enumerate(zip(a, b)):
        groups.setdefault((len(x), len(y)), []).append(k)
    for (p, q), rows in groups.items():
        x = np.frombuffer(b"".join(a[k] for k in rows), dtype=np.uint8).reshape(len(rows), p).astype(np.int32)
        y = np.frombuffer(b"".join(b[k] for k in rows), dtype=np.uint8).reshape(len(rows), q).astype(np.int32)
        keep[rows] = _near(x, y, size_a[rows], size_b[rows], percent)
    return keep


def _near(x, y, size_x, size_y, percent):
    """Row by row (or broadcast): the sketches allow a link."""
    cuts = min(x.shape[-1], y.shape[-1])
    free = (x.max(axis=-1) >= 255) | (y.max(axis=-1) >= 255)  # capped counts prove nothing
    if x.shape[-1] != cuts:
        x = _folded(x, cuts)
    if y.shape[-1] != cuts:
        y = _folded(y, cuts)
    apart = np.abs(x - y).sum(axis=-1)
    # percent% of the union: difference <= (sizes) * (100 - percent) / (100 + percent)
    return free | (apart * (100 + percent) <= (size_x + size_y) * (100 - percent))


def _sets(text: str, key: str, n: int):
    def run(batches):
        for batch in batches:
            hashes, at = shingle_sets(*text_bytes(batch.column(text)), n)
            values, counts = np.unique(hashes, return_counts=True)
            often = counts >= max(8, batch.num_rows // 500)
            common = [[] for _ in range(batch.num_rows)]
            if batch.num_rows:
                common[0] = [{"gram": g, "n": n} for g, n in zip(signed(values[often]).tolist(), counts[often].tolist())]
            sketches = [sketch(hashes[at[d] : at[d + 1]]) for d in range(len(at) - 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(np.diff(at)), pa.array(signed(set_keys(hashes, at))), pa.array(sketches, pa.binary()),
                 pa.array(common, pa.list_(pa.struct([("gram", pa.int64()), ("n", pa.int64())])))],
                names=["doc", "size", "sid", "sketch", "common"],
            )

    return run


def _first_of_each(one: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    _, first = np.unique(one, return_index=True)
    return np.sort(first[sizes[first] > 0])


def _common_last(hashes: np.ndarray, at: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The sets with their common n-grams moved behind the others."""
    if not len(common):
        return hashes
    where = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
    last = common[where] == hashes
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    return hashes[np.argsort(2 * doc + last, kind="stable")]


def _prefixes(text: str, n: int, percent: int, shared):
    def run(batches):
        common = shared.value
        for batch in batches:
            hashes, at = shingle_sets(*text_bytes(batch.column(text)), n)
            sizes = np.diff(at)
            one = set_keys(hashes, at)
            own = _first_of_each(one, sizes)  # copies inside a batch are dealt once
            hashes = _common_last(hashes, at, common)
            many = sizes[own] - (percent * sizes[own] + 99) // 100 + 1
            rows = np.repeat(at[own] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum()) if len(own) else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(hashes[rows])), pa.array(np.repeat(signed(one[own]), many)), pa.array(np.repeat(sizes[own], many).astype(np.int32))],
                names=["gram", "sid", "size"],
            )

    return run


def _whole(batches, *names):
    """A partition's columns as numpy arrays.  Its rows are narrow and its size is set by the shuffle partitions."""
    got = [[b.column(n) for n in names] for b in batches]
    return [np.concatenate([c[k].to_numpy(zero_copy_only=False) for c in got]) if got else np.zeros(0, dtype=np.int64) for k in range(len(names))]


def _shared(batches):
    """Keep the n-grams that several sets have in their prefixes; of n-grams with the same sets one, and a 128-bit name of its sets."""
    gram, sid, size = _whole(batches, "gram", "sid", "size")
    order = np.argsort(gram, kind="stable")
    gram, sid, size = gram[order], sid[order], size[order]
    starts = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.zeros(0, dtype=np.int64)
    counts = np.diff(np.concatenate([starts, [len(gram)]]))
    again = np.repeat(counts > 1, counts)
    gram, sid, size = gram[again], sid[again], size[again]
    order = np.lexsort((sid, gram))
    gram, sid, size = gram[order], sid[order], size[order]
    new = np.ones(len(gram), dtype=bool)
    new[1:] = (gram[1:] != gram[:-1]) | (sid[1:] != sid[:-1])
    gram, sid, size = gram[new], sid[new], size[new]
    starts = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]])) if len(gram) else np.zeros(0, dtype=np.int64)
    counts = np.diff(np.concatenate([starts, [len(gram)]]))
    sets = sid.view(np.uint64)
    none = np.zeros(0, dtype=np.uint64)
    one, two = (np.add.reduceat(mix(v), starts) if len(starts) else none for v in (sets, sets ^ _SECOND))
    keep = np.zeros(len(starts), dtype=bool)
    order = np.lexsort((two, one))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    keep[order[new]] = True
    keep &= counts > 1
    again = np.repeat(keep, counts)
    name = [signed(np.repeat(v[keep], counts[keep])) for v in (one, two)]
    yield pa.RecordBatch.from_arrays(
        [pa.array(gram[again]), pa.array(sid[again]), pa.array(size[again].astype(np.int32)), *map(pa.array, name)],
        names=["gram", "sid", "size", "one", "two"],
    )


def _hub_pairs(percent: int):
    def run(batches):
        gram, sid, size = _whole(batches, "gram", "sid", "size")
        found = []
        for k in range(HUBS):
            rank = mix(sid.view(np.uint64) + np.uint64(k * 7919))
            order = np.lexsort((rank, gram))
            g, s, z = gram[order], sid[order], size[order].astype(np.int64)
            starts = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, dtype=np.int64)
            counts = np.diff(np.concatenate([starts, [len(g)]]))
            hub, hub_size = np.repeat(s[starts], counts), np.repeat(z[starts], counts)
            fits = (hub != s) & (100 * np.minimum(z, hub_size) >= percent * np.maximum(z, hub_size))
            if k:
                fits &= np.repeat(counts > 4, counts)
            found.append(np.stack([np.minimum(s, hub)[fits], np.maximum(s, hub)[fits]], axis=1))
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return run


def _buckets(batches):
    """A partition's rows as columns, with the rows of each bucket that has several components, by size."""
    got = [pa.Table.from_batches([b]) for b in batches]
    if not got:
        return
    rows = pa.concat_tables(got).combine_chunks()
    gram, sid, size, label, alone = (rows.column(c).to_numpy() for c in ("gram", "sid", "size", "label", "alone"))
    sketches = rows.column("sketch")
    order = np.lexsort((sid, size, gram))
    bounds = np.flatnonzero(np.concatenate([[True], gram[order][1:] != gram[order][:-1]])) if len(gram) else np.zeros(0, dtype=np.int64)
    for s, e in zip(bounds.tolist(), [*bounds[1:].tolist(), len(gram)]):
        own = order[s:e]
        if e - s > 1 and not (label[own] == label[own[0]]).all():
            yield sid[own], size[own].astype(np.int64), label[own], alone[own].astype(np.int64), [np.frombuffer(sketches[int(k)].as_py(), dtype=np.uint8) for k in own]


def _possible(ids, z, label, alone, raw, percent, exact):
    """(row, later rows) of one bucket that sizes, sketches (exact: parities) and lone n-grams allow to link and that are of different components."""
    cuts = np.array([len(r) for r in raw])
    free = np.array([not exact and r.max() >= 255 for r in raw])  # capped counts prove nothing
    now, flat, head, wide = 0, None, 0, 1
    for i in range(len(ids)):
        if cuts[i] != now:  # cuts ascend with sizes; partners behind have as many or twice as many
            now, head = cuts[i], i
            tail = int(np.searchsorted(cuts, 2 * now, side="right"))
            if exact:  # the low bits of a hash choose the cell, so halves fold onto each other
                flat = np.stack([np.bitwise_xor.reduce(r.reshape(-1, now), axis=0) for r in raw[i:tail]]).view(np.uint64)
            else:
                flat = np.stack([r.reshape(now, -1).astype(np.int32).sum(axis=1) for r in raw[i:tail]])
            wide = max(1, BLOCK * 64 // now)
        last = int(np.searchsorted(z, 100 * z[i] // percent, side="right"))
        for at in range(i + 1, last, wide):
            to = min(last, at + wide)
            most = (z[at:to] + z[i]) * (100 - percent)
            other = np.flatnonzero((label[at:to] != label[i]) & ((alone[at:to] + alone[i]) * (100 + percent) <= most)) + at
            if len(other):
                if exact:
                    apart = np.bitwise_count(flat[other - head] ^ flat[i - head]).sum(axis=1, dtype=np.int64)
                else:
                    apart = np.abs(flat[other - head] - flat[i - head]).sum(axis=1)
                ok = other[free[other] | free[i] | (apart * (100 + percent) <= (z[other] + z[i]) * (100 - percent))]
                if len(ok):
                    yield i, ok


def _pair_batch(a, b):
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0) if len(a) else np.zeros((0, 2), dtype=np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _open_sets(percent: int):
    """Sets with a possible partner in another component."""
    def run(batches):
        found: set[int] = set()
        for ids, z, label, alone, raw in _buckets(batches):
            for i, ok in _possible(ids, z, label, alone, raw, percent, False):
                found.add(int(ids[i]))
                found.update(ids[ok].tolist())
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int64())], names=["sid"])

    return run


def _lone_hub_pairs(percent: int):
    """Each bucket's set with fewest lone n-grams, with the sets of other components."""
    def run(batches):
        a, b = [], []
        for ids, z, label, alone, _ in _buckets(batches):
            hub = np.lexsort((ids, alone))[0]
            most = (z + z[hub]) * (100 - percent)
            fits = (label != label[hub]) & (100 * np.minimum(z, z[hub]) >= percent * np.maximum(z, z[hub])) & ((alone + alone[hub]) * (100 + percent) <= most)
            a.append(np.full(int(fits.sum()), ids[hub]))
            b.append(ids[fits])
        none = np.zeros(0, dtype=np.int64)
        yield _pair_batch(np.concatenate([none, *a]), np.concatenate([none, *b]))

    return run


def _rest_pairs(percent: int):
    """Pairs of sets of different components that may link; blocks bound the work arrays."""
    def run(batches):
        a, b = [], []
        for ids, z, label, alone, raw in _buckets(batches):
            for i, ok in _possible(ids, z, label, alone, raw, percent, True):
                a.append(np.full(len(ok), ids[i]))
                b.append(ids[ok])
        none = np.zeros(0, dtype=np.int64)
        yield _pair_batch(np.concatenate([none, *a]), np.concatenate([none, *b]))

    return run


def _grams_of(text: str, n: int):
    def run(batches):
        for batch in batches:
            hashes, at = shingle_sets(*text_bytes(batch.column(text)), n)
            yield pa.RecordBatch.from_arrays([pa.array(signed(hashes)), pa.array(np.repeat(signed(set_keys(hashes, at)), np.diff(at)))], names=["gram", "sid"])

    return run


def _set_rows(text: str, n: int, fragments: int):
    """(sid, fragment, its hashes) of each set of a batch."""
    def run(batches):
        for batch in batches:
            hashes, at = shingle_sets(*text_bytes(batch.column(text)), n)
            one = set_keys(hashes, at)
            sid = signed(one)
            out = {"sid": [], "fragment": [], "grams": []}
            for d in range(len(at) - 1):
                own = hashes[at[d] : at[d + 1]]
                cuts = np.searchsorted(own >> np.uint64(62), np.arange(fragments + 1, dtype=np.uint64) * np.uint64(4 // fragments))
                for f in range(fragments):
                    if cuts[f + 1] > cuts[f]:
                        out["sid"].append(int(sid[d]))
                        out["fragment"].append(f)
                        out["grams"].append(own[cuts[f] : cuts[f + 1]].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out["sid"], pa.int64()), pa.array(out["fragment"], pa.int32()), pa.array(out["grams"], pa.binary())], names=list(out))

    return run


def _parities(text: str, n: int):
    def run(batches):
        for batch in batches:
            hashes, at = shingle_sets(*text_bytes(batch.column(text)), n)
            cells = [parity(hashes[at[d] : at[d + 1]]) for d in range(len(at) - 1)]
            yield pa.RecordBatch.from_arrays([pa.array(signed(set_keys(hashes, at))), pa.array(cells, pa.binary())], names=["sid", "sketch"])

    return run


def _pass_sketch(percent: int):
    def run(batches):
        for batch in batches:
            keep = may_link(batch.column("ka").to_pylist(), batch.column("kb").to_pylist(), batch.column("za").to_numpy().astype(np.int64), batch.column("zb").to_numpy().astype(np.int64), percent)
            yield batch.filter(pa.array(keep)).select(["a", "b", "za", "zb"])

    return run


def _overlap(batches):
    """Partial overlap of each (pair, fragment)."""
    for batch in batches:
        n = [
            len(np.intersect1d(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64), assume_unique=True))
            for x, y in zip(batch.column("ga").to_pylist(), batch.column("gb").to_pylist())
        ]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("a", "b", "za", "zb", "fragment")], pa.array(n, pa.int64())], names=["a", "b", "za", "zb", "fragment", "n"])


def _linked(pairs: DataFrame, members: DataFrame, given: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) that reach the similarity, counted fragment by fragment.  Only sets that pass their sketches are built again."""
    near = (
        pairs.join(members.select(F.col("sid").alias("a"), F.col("size").alias("za"), F.col("sketch").alias("ka")), "a")
        .join(members.select(F.col("sid").alias("b"), F.col("size").alias("zb"), F.col("sketch").alias("kb")), "b")
        .mapInArrow(_pass_sketch(percent), "a long, b long, za int, zb int")
    )
    near = cut_lineage(near, "near")
    wanted = near.select(F.col("a").alias("sid")).union(near.select("b")).distinct().join(members, "sid").select("doc")
    wanted = cut_lineage(wanted.distinct(), "wanted")
    # a key may be that of several rows: their sets are told apart again by their digests
    parts = cut_lineage(given.join(wanted, "doc", "left_semi").select("text").mapInArrow(_set_rows("text", n, FRAGMENTS), "sid long, fragment int, grams binary"), "grams")
    counted = (
        near.join(parts.select(F.col("sid").alias("a"), "fragment", F.col("grams").alias("ga")), "a")
        .join(parts.select(F.col("sid").alias("b"), "fragment", F.col("grams").alias("gb")), ["b", "fragment"])
        .select("a", "b", "za", "zb", "fragment", "ga", "gb")
        .mapInArrow(_overlap, "a long, b long, za int, zb int, fragment int, n long")
        .groupBy("a", "b", "za", "zb", "fragment").agg(F.max("n").alias("n"))  # a set may be there more than once
        .groupBy("a", "b", "za", "zb").agg(F.sum("n").alias("n"))
    )
    return cut_lineage(counted.where(F.col("n") * 100 >= percent * (F.col("za") + F.col("zb") - F.col("n"))).select("a", "b"), "links")


def _mixed(rows: DataFrame, labels: DataFrame, least: int = 2) -> DataFrame:
    """The bucket rows with their component and the bucket's first set, of buckets with several components and least sets."""
    labelled = rows.join(labels.toDF("sid", "label"), "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    of_bucket = F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("sid").alias("first"), F.count("*").alias("sets")
    several = labelled.groupBy("gram").agg(*of_bucket).where((F.col("lo") != F.col("hi")) & (F.col("sets") >= least))
    return labelled.join(several.select("gram", "first"), "gram")


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id, n_links): one row per row of docs, components over every link between different texts.

    component_id is the smallest key reachable by links.  n_links counts only the links of the row's class that were verified
    until its component was joined: at least 1 in a component of several classes, no degree.  Null and wordless texts have no n-grams and are linked with nothing.
    Repeated rows come back as often as they are there.  A null key is smaller than all others and is given back as null.
    An empty table gives an empty result; other columns of docs are not read.
    """
    given = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("doc"), F.col(text).alias("text"))
    sets = cut_lineage(given.mapInArrow(_sets("text", "doc", n), "doc long, size long, sid long, sketch binary, common array<struct<gram:long,n:long>>"), "sets")
    often = sets.select(F.explode("common").alias("c")).groupBy("c.gram").agg(F.sum("c.n").alias("n")).orderBy(F.desc("n"), "gram").limit(MOST_COMMON)
    common = np.sort(np.array([r["gram"] for r in often.select("gram").collect()], dtype=np.int64).view(np.uint64))
    shared_common = docs.sparkSession.sparkContext.broadcast(common)
    dealt = given.select("text").mapInArrow(_prefixes("text", n, percent, shared_common), "gram long, sid long, size int").repartition("gram")
    several = cut_lineage(dealt.mapInArrow(_shared, "gram long, sid long, size int, one long, two long"), "several")
    # n-grams with the same sets give the same pairs, also the same hubs: one of them is enough
    chosen = several.groupBy("one", "two").agg(F.min("gram").alias("gram")).select("gram")
    shared = cut_lineage(several.join(chosen, "gram", "left_semi").select("gram", "sid", "size"), "shared")
    first = cut_lineage(shared.repartition("gram").mapInArrow(_hub_pairs(percent), "a long, b long").distinct(), "pairs")
    members = cut_lineage(sets.where("size > 0").groupBy("sid").agg(F.min(F.struct("doc", "size", "sketch")).alias("m")).select("sid", "m.doc", F.col("m.size").cast("int").alias("size"), "m.sketch"), "members")
    links = _linked(first, members, given, n, percent)
    labels = components(links)
    dealt_rows = "gram", "sid", "size", "label", "alone", "sketch"
    # buckets with the same first set are mostly cuts of one passage's sets: their union holds every pair, and each sketch once
    # of two sets one was the hub, so their pair is decided
    unions = _mixed(shared, labels, 3).select(F.col("first").alias("gram"), "sid", "size", "label").repartition("sid").distinct()
    mixed = unions.join(members.select("sid", "sketch"), "sid").withColumn("alone", F.lit(0).cast("long")).select(*dealt_rows)
    opened = cut_lineage(mixed.repartition("gram").mapInArrow(_open_sets(percent), "sid long").distinct(), "open")
    open_docs = cut_lineage(opened.join(members, "sid").select("doc").distinct(), "wanted")
    open_texts = cut_lineage(given.join(open_docs, "doc", "left_semi").select("text"), "opentexts")
    grams = open_texts.mapInArrow(_grams_of("text", n), "gram long, sid long").join(opened, "sid", "left_semi")
    parities = open_texts.mapInArrow(_parities("text", n), "sid long, sketch binary").groupBy("sid").agg(F.min("sketch").alias("sketch"))
    lone = grams.groupBy("gram").agg(F.min("sid").alias("sid"), F.max("sid").alias("other")).where("sid = other").groupBy("sid").agg(F.count("*").alias("alone"))
    linkable = cut_lineage(
        members.drop("sketch").join(opened, "sid", "left_semi").join(parities, "sid").join(lone, "sid", "left").withColumn("alone", F.coalesce("alone", F.lit(0).cast("long")))
        .where(F.col("alone") * percent <= F.col("size") * (100 - percent)).select("sid", "sketch", "alone"),
        "linkable",
    )
    left = cut_lineage(shared.join(linkable.select("sid"), "sid", "left_semi"), "left")
    round2 = _mixed(left, labels).join(linkable, "sid").select(*dealt_rows)
    second = cut_lineage(round2.repartition("gram").mapInArrow(_lone_hub_pairs(percent), "a long, b long").distinct().join(first, ["a", "b"], "left_anti"), "second")
    links = links.unionByName(_linked(second, members, given, n, percent))
    labels = components(links)
    round3 = _mixed(left, labels).join(linkable, "sid").select(*dealt_rows)
    rest = round3.repartition("gram").mapInArrow(_rest_pairs(percent), "a long, b long").distinct()
    rest = cut_lineage(rest.join(first.unionByName(second), ["a", "b"], "left_anti"), "rest")
    every = links.unionByName(_linked(rest, members, given, n, percent))
    final = cut_lineage(components(every).toDF("sid", "label"), "labels")
    degree = every.select("a", "b").union(every.select("b", "a")).groupBy(F.col("a").alias("sid")).agg(F.count("*").alias("links"))
    named = members.select("sid", F.col("doc").alias("rep")).join(final, "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    smallest = named.groupBy("label").agg(F.min("rep").alias("component"))
    by_set = named.join(smallest, "label").join(degree, "sid", "left").select("sid", "component", F.coalesce("links", F.lit(0)).alias("links"))
    out = sets.join(by_set, "sid", "left")
    plain = lambda c: F.when(F.col(c) != -(2**63), F.col(c))
    component = F.when(F.col("size") > 0, F.col("component")).otherwise(F.col("doc"))
    return out.select(
        plain("doc").alias(key), F.col("size").alias("n_shingles"), F.when(component != -(2**63), component).alias("component_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
    )


def keep_representatives(docs: DataFrame, *, key: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """The rows of docs without near duplicates: of each component the one row with the smallest key.

    Rows without words are duplicates of nothing and stay.  Of repeated rows of the smallest key one stays.  Null keys
    count as one key before all others.
    """
    found = cut_lineage(near_duplicates(docs, key=key, text=text, n=n, percent=percent), "classes")
    own_key, has_words, own_row = unused(docs.columns, "dropped", "worded", "own")
    stays = F.max(F.col(key).eqNullSafe(F.col("component_id")))
    dropped = found.groupBy(F.col(key).alias(own_key), (F.col("n_shingles") > 0).alias(has_words)).agg(stays.alias("stays")).where(~F.col("stays")).drop("stays")
    dropped = cut_lineage(dropped, "dropped")
    if dropped.count() <= MOST_SENT:  # else the join deals texts and keys out
        dropped = F.broadcast(dropped)
    worded = F.coalesce(docs[text].rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = docs.join(dropped, docs[key].eqNullSafe(F.col(own_key)) & (F.col(has_words) == worded), "left_anti")
    if not found.where("n_shingles > 0").groupBy(key).count().where("count > 1").head(1):
        return rows  # texts need not be dealt again where no key is repeated
    own = F.when(F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False)), F.lit(0).cast("long")).otherwise(F.monotonically_increasing_id() + 1)
    return rows.withColumn(own_row, own).dropDuplicates([key, own_row]).select(*docs.columns)
