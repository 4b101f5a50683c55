"""Whitening of embeddings: exact covariance over all tasks, eigenvectors by mixed-precision refinement.

The covariance is summed in whole numbers.  The driver holds one dim x dim matrix: it takes eigenvectors in float32 and corrects
them by Ogita and Aishima's iterations, matrix products in extended precision that double the right digits each time; columns
whose eigenvalues lie too close together for that are turned by an eigenvalue problem of their own.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triagelake.llm.centroids import _matrix, usable
from triagelake.llm.names import unused
from triagelake.session import cut_lineage

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Scaled components stay below this: sums of products are exact.
LIMIT = 1 << 27
#: Variances up to this share of the trace are rounding: such a component has no whitened value.
NO_VARIANCE = 1e-14
_LOW = 30
STEPS = 40


def _products(rows: np.ndarray) -> np.ndarray:
    """rows' x rows in whole numbers (int64, few enough rows)."""
    most = int(np.abs(rows).max(initial=0))
    if most * most * max(1, len(rows)) < 1 << 53:
        a = rows.astype(np.float64)
        return (a.T @ a).astype(np.int64)
    return rows.T @ rows


def _summed(vectors: DataFrame, column: str, dim: int, middle: np.ndarray | None) -> list[int]:
    """Exact sums over all rows: of the components, or, given a middle, of the products of components less the middle.

    A task returns one row per sum, split into a high and a low part so that no long overflows.
    """
    upper = np.triu_indices(dim)

    def run(batches):
        total = np.zeros(dim if middle is None else len(upper[0]), dtype=object)
        for batch in batches:
            rows = _matrix(batch.column(column), dim)
            if middle is None:
                total = total + rows.sum(axis=0).astype(object)
                continue
            rows = rows - middle
            step = 64 if np.abs(rows).max(initial=0) >= 1 << 20 else 4096
            for at in range(0, len(rows), step):
                total = total + _products(rows[at : at + step])[upper].astype(object)
        names = ["part", "high", "low"]
        high, low = [int(v) >> _LOW for v in total], [int(v) & ((1 << _LOW) - 1) for v in total]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(high, pa.int64()), pa.array(low, pa.int64())], names=names)

    parts = vectors.select(column).mapInArrow(run, "part int, high long, low long").groupBy("part").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    return [(r["high"] << _LOW) + r["low"] for r in parts.orderBy("part").collect()]  # at most dim * (dim + 1) / 2 rows


def _extended(value: Fraction) -> np.longdouble:
    near = float(value)
    return np.longdouble(near) + np.longdouble(float(value - Fraction(near)))


def covariance(n: int, sums: list[int], middle: np.ndarray, products: list[int]) -> np.ndarray:
    """The covariance with divisor n in extended precision, rounded once per entry."""
    dim = len(sums)
    off = [s - n * int(m) for s, m in zip(sums, middle)]
    out = np.zeros((dim, dim), dtype=np.longdouble)
    for (i, j), p in zip(zip(*np.triu_indices(dim)), products):
        out[i, j] = out[j, i] = _extended(Fraction(n * p - off[i] * off[j], n * n))
    return out


def _close_groups(values: np.ndarray, gap) -> list[np.ndarray]:
    """Runs of eigenvalues with neighbours no further than gap apart, as positions; single ones are left out."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


def refined_eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(falling eigenvalues, unit eigenvectors as columns) of a symmetric matrix, in extended precision.

    With X from float32, R = I - X'X and S = X'AX give l_i = S_ii / (1 - R_ii) and the correction X + XE, where
    E_ij = (S_ij + l_j R_ij) / (l_j - l_i) if that gap is safe and R_ij / 2 inside a cluster.  A cluster is then resolved by
    the eigenvectors of its own small matrix less its mean, whose gaps stand out again once the mean is gone.
    """
    dim = len(matrix)
    size = np.abs(matrix).max(initial=0)
    if dim == 0 or size == 0:
        return np.zeros(dim, dtype=np.longdouble), np.eye(dim, dtype=np.longdouble)
    a = (matrix / size).astype(np.longdouble)
    norm = np.sqrt((a * a).sum())
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    one = np.eye(dim, dtype=np.longdouble)
    tiny = np.finfo(np.longdouble).eps * dim
    values, last = np.zeros(dim, dtype=np.longdouble), np.inf
    for _ in range(STEPS):
        r = one - x.T @ x
        s = x.T @ a @ x
        # symmetric to the last bit: E_ij + E_ji = R_ij must hold however small a gap is, or x loses its right angles
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values) + np.diag(values) @ r  # what keeps x from diagonalising a
        error = max(np.abs(off - np.diag(np.diag(off))).max(initial=0) / norm, np.abs(r).max())
        if error <= tiny or (error <= 1e-17 and error >= last):
            break
        last = error
        gap = 2 * (np.sqrt(((s - np.diag(values)) ** 2).sum()) + norm * np.sqrt((r * r).sum()))
        between = values[None, :] - values[:, None]
        safe = np.abs(between) > gap
        x = x + x @ np.where(safe, (s + values[None, :] * r) / np.where(safe, between, 1), r / 2)
        for own in _close_groups(values, gap):
            part = x[:, own]
            inner = part.T @ a @ part
            inner = inner - np.eye(len(own)) * (np.trace(inner) / len(own))
            scale = np.abs(inner).max()
            if scale > 0:
                turn = np.linalg.eigh(((inner + inner.T) / (2 * scale)).astype(np.float64))[1].astype(np.longdouble)
                turn = turn @ (1.5 * np.eye(len(own), dtype=np.longdouble) - 0.5 * (turn.T @ turn))  # orthogonal to all digits
                x[:, own] = part @ turn
    x = x / np.sqrt((x * x).sum(axis=0))
    order = np.argsort(-values, kind="stable")
    return values[order] * size, x[:, order]


def _deviations(off: np.ndarray) -> list[int | None]:
    """Sums of squares by row, null where no long holds one."""
    most = int(np.abs(off).max(initial=0))
    if most * most * max(1, off.shape[1]) < 1 << 63:
        return (off * off).sum(axis=1).tolist()
    sums = [sum(v * v for v in row) for row in off.tolist()]
    return [s if s < 1 << 63 else None for s in sums]


def whiten(vectors: DataFrame, *, vector: str = "embedding", components: int = COMPONENTS, keep: list[str] | None = None) -> DataFrame:
    """One row per remaining row and component: keep (default: all columns but the vector), component, n, deviation, whitened,
    explained, identity_error.

    Rows are left out whose vector is null, holds a null or non-finite entry or one of 131,072 or more (its products could
    not be summed exactly), or has not the most frequent length (of several, the greatest).  Repeated rows count each.
    Components without variance have a null whitened value and are left out of identity_error, which is measured on the
    whitened values themselves and 0 where there are none; explained is 0 where no dimension varies.  A deviation that no long
    holds is null.  Empty vectors and an empty table give an empty result.  Columns named like the new ones are replaced.
    """
    new = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    keep = [c for c in ([c for c in vectors.columns if c != vector] if keep is None else keep) if c not in new]
    (ints, white) = unused([*keep, *new], "scaled", "white")
    kinds = {"n": "long", "deviation": "long", "component": "int"}
    empty = vectors.limit(0).select(*keep, *[F.lit(None).cast(kinds.get(c, "double")).alias(c) for c in new])
    lengths = vectors.where(usable(F.col(vector), F.size(vector), SCALE, LIMIT)).groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not top or top[0]["d"] == 0:
        return empty
    dim, n = top[0]["d"], top[0]["n"]
    scaled = F.transform(vector, lambda x: (F.floor(F.lit(float(SCALE)) * x.cast("double")) + SHIFT).cast("int"))
    kept = cut_lineage(vectors.where(usable(F.col(vector), F.lit(dim), SCALE, LIMIT)).select(*keep, scaled.alias(ints)), "fit")

    sums = _summed(kept, ints, dim, None)
    middle = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    values, axes = refined_eigen(covariance(n, sums, middle, _summed(kept, ints, dim, middle)))
    p = min(components, dim)
    trace = values.sum()
    share = [float(v / trace) if trace > 0 else 0.0 for v in values[:p]]
    solid = np.array([s > NO_VARIANCE for s in share])
    signs = np.sign(axes[np.abs(axes[:, :p]).argmax(axis=0), np.arange(p)])
    turn = np.where(solid, (axes[:, :p] * signs / np.sqrt(np.where(solid, values[:p], 1))).astype(np.float64), 0.0)
    totals = np.array(sums, dtype=np.int64)

    def run(batches):
        for batch in batches:
            off = n * _matrix(batch.column(ints), dim) - totals
            values = (off / n) @ turn
            blank = np.broadcast_to(~solid, values.shape).ravel()
            listed = pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, p, dtype=np.int32)), pa.array(values.ravel(), mask=blank))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(_deviations(off), pa.int64()), listed], names=[*keep, "deviation", white])

    schema = T.StructType([*kept.select(*keep).schema.fields, T.StructField("deviation", T.LongType()), T.StructField(white, T.ArrayType(T.DoubleType()))])
    done = cut_lineage(kept.mapInArrow(run, schema), "whitened")
    pairs = [(i, j) for i in range(p) for j in range(i, p) if solid[i] and solid[j]]
    means = done.agg(*[F.avg(F.col(white)[i]).alias(f"m{i}") for i in range(p)]).head()
    spread = done.agg(F.count(F.lit(1)).alias("n"), *[F.avg((F.col(white)[i] - F.lit(means[i])) * (F.col(white)[j] - F.lit(means[j]))).alias(f"c{i}_{j}") for i, j in pairs]).head()
    error = max((abs(spread[f"c{i}_{j}"] - (i == j)) for i, j in pairs), default=0.0)
    explained = F.array(*[F.lit(s) for s in share])
    return done.select(*keep, "deviation", F.posexplode(white).alias("component", "whitened")).select(
        *keep, (F.col("component") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("component")).alias("explained"), F.lit(float(error)).alias("identity_error"),
    )
