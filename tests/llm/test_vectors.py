"""Centroid clustering and whitening against plain versions."""

import hashlib
import math

import numpy as np
import pytest

from tests.conftest import SF
from triagelake.llm import centroids, whitening
from triagelake.llm.queries import QUERIES

DDL = "vec_id long, embedding array<float>"


def plain_clusters(rows, k, rounds, dim, scale=256, salt="2"):
    good = [(i, [math.floor(scale * float(np.float32(c))) for c in v]) for i, v in rows if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    order = sorted(good, key=lambda r: (hashlib.sha256(f"{salt}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        own = [[] for _ in cents]
        for _, v in good:
            own[nearest(v)[1]].append(v)
        cents = [[sum(col) // len(g) for col in zip(*g)] if g else c for g, c in zip(own, cents)]
    out = [(i, nearest(v)[1], nearest(v)[0]) for i, v in good]
    inertia = {}
    for _, c, d in out:
        inertia[c] = inertia.get(c, 0) + d
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()) for i, c, d in out), key=repr)


def clustered(df, **kw):
    out = centroids.cluster_vectors(df, **kw)
    return sorted((tuple(r) for r in out.select("vec_id", *centroids.NEW).collect()), key=repr)


def test_tree_equals_all_pairs_with_ties():
    rng = np.random.default_rng(1)
    for dim, high in ((1, 3), (2, 4), (3, 50), (64, 300), (4, 1 << 26)):
        points = rng.integers(-high, high + 1, (60, dim))
        rows = np.concatenate([rng.integers(-high, high + 1, (500, dim)), points[:20]])
        number, distance = centroids.VantageTree(points).nearest(rows)
        for r, c, d in zip(rows.tolist(), number, distance):
            assert (d, c) == min((sum((a - b) ** 2 for a, b in zip(r, p)), j) for j, p in enumerate(points.tolist()))


def test_odd_vectors_equal_plain(frame):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 3) / 4]) for i in range(80)]
    rows += [(3, [0.1, 0.2, 0.3]), (None, [0.5, 0.5, 0.5]), (None, [0.25, 0.5, 0.5]), (81, None), (82, []), (83, [1.0, 2.0]), (84, [1.0, None, 2.0]), (85, [float("nan")] * 3), (86, [float("inf"), 0.0, 0.0])]
    df = frame(DDL, *rows)
    assert clustered(df, k=12, rounds=5, dim=3) == plain_clusters(rows, 12, 5, 3)
    assert clustered(df.where("vec_id < 5"), k=12, rounds=2, dim=3) == plain_clusters([r for r in rows if r[0] is not None and r[0] < 5], 12, 2, 3)
    assert clustered(df.limit(0), k=12, rounds=2, dim=3) == []
    assert clustered(frame(DDL, (1, [3e38, 0.0, 0.0]), (2, [0.0, 0.0, 0.0])), k=2, dim=3) == plain_clusters([(2, [0.0, 0.0, 0.0])], 2, 5, 3)


def test_many_equal_vectors(frame):
    rows = [(i, [0.5, 0.5]) for i in range(300)] + [(300 + i, [i / 8, -i / 8]) for i in range(30)]
    assert clustered(frame(DDL, *rows), k=9, dim=2) == plain_clusters(rows, 9, 5, 2)


def test_cluster_names_and_other_columns(frame):
    df = frame(DDL + ", scaled int, digest string, cluster string, part int, total int", (1, [0.5], 7, "x", "y", 8, 9), (2, [1.5], 7, "x", "y", 8, 9))
    out = centroids.cluster_vectors(df, dim=1)
    assert out.columns == ["vec_id", "embedding", "scaled", "digest", "part", "total", *centroids.NEW]
    assert [(r.scaled, r.digest, r.part, r.total) for r in out.collect()] == [(7, "x", 8, 9)] * 2 and dict(out.dtypes)["cluster"] == "int"


def test_given_table_equals_plain(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op11_centroids"](spark, SF).collect()), key=repr)
    assert got == plain_clusters(rows, 40, 5, 64)


# --- whitening ------------------------------------------------------------------------------------


def plain_whitening(rows, components=8):
    good = [(i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v]) for i, v in rows]
    n, dim = len(good), len(good[0][1])
    s = [sum(v[j] for _, v in good) for j in range(dim)]
    x = np.array([[n * c - t for c, t in zip(v, s)] for _, v in good], dtype=np.float64) / n
    values, axes = np.linalg.eigh(x.T @ x / n)
    values, axes = values[::-1], axes[:, ::-1]
    dev = {i: sum((n * c - t) ** 2 for c, t in zip(v, s)) for i, v in good}
    return n, dev, x @ axes[:, :components], values


def check(got, rows, p=8):
    n, dev, projected, values = plain_whitening(rows)
    by = {(r.vec_id, r.component): r for r in got}
    assert len(by) == len(got) == n * p
    for k in range(p):
        white = np.array([by[i, k + 1].whitened for i, _ in rows])
        want = projected[:, k] / np.sqrt(values[k])
        assert min(np.abs(white - want).max(), np.abs(white + want).max()) < 1e-6
        assert abs(white.mean()) < 1e-9 and abs((white * white).mean() - 1) < 1e-9
    assert all(r.n == n and r.deviation == dev[r.vec_id] and abs(r.explained - values[r.component - 1] / values.sum()) < 1e-10 for r in got)
    assert len({r.identity_error for r in got}) == 1 and 0 <= got[0].identity_error < 1e-9


def test_given_table_is_whitened(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(QUERIES["op12_whitening"](spark, SF).collect(), rows)


def test_whitening_leaves_bad_rows_out(frame):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=9) * np.arange(1, 10)]) for i in range(200)]
    bad = [(500, None), (501, [None] * 9), (502, [float("nan")] * 9), (503, [float("-inf")] * 9), (504, [1.0] * 8), (505, [1e30] * 9), (506, [])]
    df = frame(DDL + ", n string, scaled int, white int, part int", *[(*r, "x", 1, 2, 3) for r in rows + bad])
    out = whitening.whiten(df)
    assert out.columns == ["vec_id", "scaled", "white", "part", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(out.collect(), rows)
    assert whitening.whiten(df.limit(0)).count() == 0 and whitening.whiten(df.where("vec_id = 506 or vec_id = 500")).count() == 0


def test_whitening_without_variance_and_with_repeats(frame):
    one = whitening.whiten(frame(DDL, (1, [0.5, 0.25]))).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, 0.0, 0.0), (2, 1, 0, None, 0.0, 0.0)]
    rows = [(7, [1.0, 1.0, 5.0]), (7, [1.0, 1.0, 5.0]), (None, [3.0, 3.0, 5.0]), (8, [2.0, 2.0, 5.0])]  # rank 1
    got = whitening.whiten(frame(DDL, *rows)).collect()
    assert len(got) == 12 and all((r.whitened is None) == (r.component > 1) for r in got)
    first = [r for r in got if r.component == 1]
    assert abs(sum(r.whitened**2 for r in first) / 4 - 1) < 1e-12 and abs(sum(r.whitened for r in first)) < 1e-12 and got[0].identity_error < 1e-9


def test_sums_stay_exact(spark, frame, monkeypatch):
    rows = [(i, [float(100_000 + i % 7), -100_000.0 + i, 0.5]) for i in range(300)]
    got = {r.vec_id: r for r in whitening.whiten(frame(DDL, *rows)).where("component = 1").collect()}
    _, dev, _, _ = plain_whitening(rows, 3)
    assert {i: r.deviation for i, r in got.items()} == dev
    assert whitening._deviations(np.array([[1 << 40, 1], [3, 4]])) == [None, 25]


@pytest.mark.parametrize("gaps", [[0, 0, 0], [0, 1e-5, 1e-9], [0, 1e-13, 2e-13], [0, 0.3, 0.30001]])
def test_refinement_resolves_clusters(gaps):
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    q = q.astype(np.longdouble)
    for _ in range(3):
        q = q @ (1.5 * np.eye(12, dtype=np.longdouble) - 0.5 * (q.T @ q))  # orthogonal to all digits
    true = np.array([*[1 + np.longdouble(g) for g in gaps], *np.linspace(2, 40, 9)], dtype=np.longdouble)
    matrix = (q * true) @ q.T
    matrix = (matrix + matrix.T) / 2
    values, axes = whitening.refined_eigen(matrix)
    assert np.abs(values - np.sort(true)[::-1]).max() < 1e-16
    assert np.abs(axes.T @ axes - np.eye(12)).max() < 1e-17
    assert np.abs(matrix @ axes - axes * values).max() < 1e-16
    for j in range(12):
        if (np.abs(np.delete(true, j) - true[j]) > 1e-3).all():  # a simple eigenvalue: the vector itself, to double precision
            k = np.abs(values - true[j]).argmin()
            assert min(np.abs(axes[:, k] - q[:, j]).max(), np.abs(axes[:, k] + q[:, j]).max()) < 1e-15
