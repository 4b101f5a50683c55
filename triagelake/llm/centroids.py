"""Centroid clustering of integer vectors with a vantage-point tree over the centroids.

Each round the driver builds a tree over at most k centroids and broadcasts it; tasks find each vector's nearest centroid by
best-first branch and bound and return one row of exact sums per centroid.  Nothing but k centroids ever reaches the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triagelake.llm.names import unused
from triagelake.session import cut_lineage

LEAF = 4
BLOCK = 4096
#: Scaled components stay below this, so that a squared distance fits a long.
LIMIT = 1 << 27
NEW = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def squared(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows x points) of integer vectors."""
    d = max(1, rows.shape[1])
    most = max(int(np.abs(rows).max(initial=0)), int(np.abs(points).max(initial=0)))
    if 4 * d * most * most < 1 << 53:  # every partial sum is a whole number that a double holds
        a, b = rows.astype(np.float64), points.astype(np.float64)
        out = (a * a).sum(axis=1)[:, None] - 2.0 * (a @ b.T) + (b * b).sum(axis=1)[None, :]
        return out.astype(np.int64)
    out = np.empty((len(rows), len(points)), dtype=np.int64)
    for j, p in enumerate(points):
        off = rows - p
        out[:, j] = (off * off).sum(axis=1)
    return out


class VantageTree:
    """A binary tree of centroids: near and far halves around a vantage point, with the range of distances of each half.

    Of equal centroids only the one with the smallest number is kept: ties go to it anyway.
    """

    def __init__(self, centroids: np.ndarray, leaf: int = LEAF):
        self.centroids = np.ascontiguousarray(centroids, dtype=np.int64)
        _, first = np.unique(self.centroids, axis=0, return_index=True)
        self.vantage: list[int] = []
        self.members: list[np.ndarray | None] = []
        self.children: list[list[tuple[int, float, float]]] = []  # (node, nearest, farthest)
        waiting = [(self._node(), np.sort(first))]
        while waiting:
            node, own = waiting.pop()
            if len(own) <= leaf:
                self.members[node] = own
                continue
            point, rest = own[0], own[1:]
            far = np.sqrt(squared(self.centroids[rest], self.centroids[[point]])[:, 0].astype(np.float64))
            self.vantage[node] = int(point)
            middle = np.median(far)
            for half in (far <= middle, far > middle):
                if half.any():
                    child = self._node()
                    self.children[node].append((child, float(far[half].min()), float(far[half].max())))
                    waiting.append((child, rest[half]))

    def _node(self) -> int:
        self.vantage.append(-1)
        self.members.append(None)
        self.children.append([])
        return len(self.vantage) - 1

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of the nearest centroid of each row, ties to the smaller number."""
        number, distance = np.empty(len(rows), dtype=np.int64), np.empty(len(rows), dtype=np.int64)
        for at in range(0, len(rows), BLOCK):
            number[at : at + BLOCK], distance[at : at + BLOCK] = self._nearest(rows[at : at + BLOCK])
        return number, distance

    def _nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # every row has its own frontier of nodes and takes the one with the least bound; rows at the same node go together
        frontier = np.full((len(rows), len(self.vantage)), np.inf)
        frontier[:, 0] = 0.0
        best = np.full(len(rows), np.iinfo(np.int64).max)
        number = np.full(len(rows), len(self.centroids))
        active = np.arange(len(rows))
        while True:
            node = frontier[active].argmin(axis=1)
            bound = frontier[active, node]
            # inclusive: a node that may hold a centroid just as near is still looked at, for the smaller number
            open_ = np.isfinite(bound) & (bound <= np.sqrt(best[active].astype(np.float64)))
            active, node, bound = active[open_], node[open_], bound[open_]
            if not len(active):
                return number, best
            frontier[active, node] = np.inf
            order = np.argsort(node, kind="stable")
            edges = np.flatnonzero(np.diff(node[order])) + 1
            for own in np.split(order, edges):
                at = active[own]
                t = int(node[own[0]])
                points = self.members[t] if self.members[t] is not None else np.array([self.vantage[t]])
                far = squared(rows[at], self.centroids[points])
                pick = far.argmin(axis=1)  # members are in ascending order: the first least one has the smallest number
                least, which = far[np.arange(len(at)), pick], points[pick]
                better = (least < best[at]) | ((least == best[at]) & (which < number[at]))
                best[at] = np.where(better, least, best[at])
                number[at] = np.where(better, which, number[at])
                if self.members[t] is None:
                    length = np.sqrt(far[:, 0].astype(np.float64))
                    for child, low, high in self.children[t]:
                        # rounding may only make a bound smaller
                        own_bound = np.maximum(low - length, length - high) - 1e-12 * (length + high)
                        frontier[at, child] = np.maximum(bound[own], own_bound)


def _matrix(column, dim: int) -> np.ndarray:
    values = column.flatten() if not isinstance(column, pa.ChunkedArray) else column.combine_chunks().flatten()
    return values.to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _sums(vectors: DataFrame, tree, ints: str, k: int, dim: int) -> dict[int, tuple[int, list[int]]]:
    """cluster -> (count, component sums): at most k rows from a task, k * (dim + 1) on the driver."""

    def run(batches):
        total = np.zeros((k, dim + 1), dtype=np.int64)
        for batch in batches:
            rows = _matrix(batch.column(ints), dim)
            number, _ = tree.value.nearest(rows)
            order = np.argsort(number, kind="stable")
            found, first = np.unique(number[order], return_index=True)
            if len(found):
                total[found, :dim] += np.add.reduceat(rows[order], first, axis=0)
                total[found, dim] += np.diff([*first, len(order)])
        for c in np.flatnonzero(total[:, dim]).tolist():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(dim + 1, c, dtype=np.int32)), pa.array(np.arange(dim + 1, dtype=np.int32)), pa.array(total[c])], names=["cluster", "part", "total"]
            )

    parts = vectors.select(ints).mapInArrow(run, "cluster int, part int, total long").groupBy("cluster", "part").agg(F.sum("total").alias("total"))
    out: dict[int, list[int]] = {}
    for r in parts.collect():
        out.setdefault(r["cluster"], [0] * (dim + 1))[r["part"]] = r["total"]
    return {c: (v[dim], v[:dim]) for c, v in out.items()}


def usable(vector, dim: int, scale: int, limit: int):
    """Whether a vector has dim components, all finite and, scaled, below the limit."""
    return (F.size(vector) == dim) & F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(F.floor(scale * F.when(F.abs(x) < limit, x.cast("double")).otherwise(float(limit)))) < limit)), F.lit(False)
    )


def cluster_vectors(
    vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256,
    salt: str = "2", keep: list[str] | None = None,
) -> DataFrame:
    """keep (default: all columns) with cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Components become floor(scale * x).  Rows whose vector is null, has another length, or holds a null or non-finite
    component are left out, and so are those with a scaled component of 2^27 or more, whose distances no long holds.  The
    k rows with the smallest sha256 of ``salt:key`` (a null key counts as empty; equal keys by their components) are the
    first centroids, fewer if there are fewer rows; an empty table gives an empty result.  Repeated rows count each.  A sum
    of distances that no long holds is null.  Columns named like the new ones are replaced.
    """
    spark = vectors.sparkSession
    keep = [c for c in (vectors.columns if keep is None else keep) if c not in NEW]
    (ints, name) = unused([*keep, *NEW], "scaled", "digest")
    good = vectors.where(usable(F.col(vector), dim, scale, LIMIT))
    scaled = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("int"))
    kept = cut_lineage(
        good.select(*keep, scaled.alias(ints), F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256).alias(name)), "vectors"
    )
    first = kept.select(name, ints).orderBy(name, ints).limit(k).collect()
    centroids = np.array([r[ints] for r in first], dtype=np.int64).reshape(len(first), dim)
    n = len(first)
    for _ in range(rounds if n else 0):
        tree = spark.sparkContext.broadcast(VantageTree(centroids))
        for c, (count, total) in _sums(kept, tree, ints, n, dim).items():
            centroids[c] = [t // count for t in total]
        tree.unpersist()
    tree = spark.sparkContext.broadcast(VantageTree(centroids) if n else None)

    def run(batches):
        for batch in batches:
            number, distance = tree.value.nearest(_matrix(batch.column(ints), dim)) if batch.num_rows else (np.zeros(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(number.astype(np.int32)), pa.array(distance)], names=[*keep, "cluster", "distance"])

    schema = T.StructType([*kept.select(*keep).schema.fields, T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    assigned = cut_lineage(kept.select(*keep, ints).mapInArrow(run, schema), "assigned")
    sums = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}  # at most k rows
    fits = lambda s: s if s < 1 << 63 else None
    rows = [(c, fits(s), fits(sum(sums.values())), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in sorted(sums.items())]
    table = pa.table(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.string()))], names=["cluster", "cluster_inertia", "inertia", "centroid_sha256"]
    )
    return assigned.join(F.broadcast(spark.createDataFrame(table)), "cluster").select(*keep, *NEW)  # broadcast: at most k rows
