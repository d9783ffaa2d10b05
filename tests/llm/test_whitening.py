"""Whitening against exact fractions and numpy's symmetric eigenvalues."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tieproof.llm import whitening
from tieproof.llm.tables import QUERIES

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "label int, vec_id long, component string, embedding array<float>"


def frame(spark, rows):
    return spark.createDataFrame([(1, i, "x", v) for i, v in rows], SCHEMA)


def plain(vectors):
    """Eigenvalues and components of the grid values, and the exact deviations."""
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for v in vectors]
    n, total = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, total)) for row in x]
    centred = np.array([[float(n * c - s) / n for c, s in zip(row, total)] for row in x])
    values, components = np.linalg.eigh(centred.T @ centred / n)
    return deviation, centred, values[::-1], components[:, ::-1]


def same_up_to_sign(got, want, tolerance):
    flip = np.sign((got * want).sum(0))
    assert np.abs(got * flip - want).max() < tolerance


def check(spark, rows, used, most=8):
    """``rows`` with the query's columns against plain numbers of those at ``used``."""
    got = whitening.components_of(frame(spark, rows).repartition(3), most).collect()
    deviation, centred, values, components = plain([rows[i][1] for i in used])
    rank = int((values > values[0] * 1e-12).sum())
    k = min(most, rank)
    assert len(got) == k * len(used) and {r.n for r in got} == {len(used)}
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    want = centred @ components[:, :k] / np.sqrt(values[:k])
    table = np.array([[by_id[rows[i][0]][c + 1].whitened for c in range(k)] for i in used])
    same_up_to_sign(table, want, 1e-6)
    for j, i in enumerate(used):
        assert all(r.deviation == deviation[j] == int(r.deviation_exact) for r in by_id[rows[i][0]].values())
    for c in range(k):
        assert by_id[rows[used[0]][0]][c + 1].explained == pytest.approx(values[c] / values.sum(), rel=1e-9)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_vectors_of_the_tables(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    check(spark, rows, range(len(rows)))
    names = "vec_id component n deviation whitened explained identity_error".split()
    assert QUERIES["op11_embedding_whitening"](spark, FOLDER).columns[:7] == names


def test_rows_that_take_no_part(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(40)]
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0, 4.0]), (102, [float("nan")] * 5), (103, [float("inf"), 0.0, 0.0, 0.0, 0.0]),
           (104, [1.0, 2.0]), (105, []), (106, [1e30, 0.0, 0.0, 0.0, 0.0])]
    check(spark, rows + bad + [(107, [0.0] * 5)], [*range(40), 47])


def test_null_and_repeated_ids_stay(spark):
    rng = np.random.default_rng(2)
    rows = [(i % 7 if i % 3 else None, rng.normal(size=3).tolist()) for i in range(30)]
    got = whitening.components_of(frame(spark, rows)).groupBy("vec_id").count().collect()
    assert {r.vec_id: r["count"] for r in got} == {
        k: 3 * sum(1 for i, _ in rows if i == k) for k in {i for i, _ in rows}}


def test_little_variance_far_from_zero(spark):
    """Values near 10^6 that differ by units: centring in floats before sums would lose them."""
    rng = np.random.default_rng(3)
    rows = [(i, (1000 + rng.integers(0, 3, 4) / 1024).tolist()) for i in range(200)]
    check(spark, rows, range(200))


def test_directions_without_variance(spark):
    rng = np.random.default_rng(4)
    line = [(i, [float(a), 2.0 * float(a), 7.0]) for i, a in enumerate(rng.integers(0, 9, 50))]
    got = whitening.components_of(frame(spark, line)).collect()
    assert {r.component for r in got} == {1} and got[0].explained == pytest.approx(1)
    assert whitening.components_of(frame(spark, [(i, [1.0, 2.0]) for i in range(9)])).count() == 0
    assert whitening.components_of(frame(spark, [(1, [1.0, 2.0])])).count() == 0


def test_copies_of_one_vector(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [0.5, 0.25, -1.0, 0.0]) for i in range(100)] + [(100 + i, rng.normal(size=4).tolist()) for i in range(50)]
    check(spark, rows, range(150))


def test_empty_table(spark):
    got = whitening.components_of(frame(spark, []))
    assert got.count() == 0 and got.columns[:2] == ["vec_id", "component"]


def test_large_entries_are_exact(spark):
    rows = [(i, [float(2.0 ** 40 * (i - 3)), float(i * i), float(-i)]) for i in range(8)]
    fitted = whitening.fit(frame(spark, rows))
    x = [[int(c) * 1024 + 100_000 for c in v] for _, v in rows]
    total = [sum(c) for c in zip(*x)]
    assert list(fitted.sums) == total
    exact = whitening.scatter(frame(spark, rows), 8, total)
    centred = [[8 * c - s for c, s in zip(row, total)] for row in x]
    assert exact == [[sum(r[i] * r[j] for r in centred) // 8 for j in range(3)] for i in range(3)]
    deviation = {i: sum(c * c for c in row) for i, row in enumerate(centred)}
    got = whitening.whiten(frame(spark, rows), fitted).collect()
    assert {r.vec_id: int(r.deviation) for r in got} == deviation


def test_factor_and_rotation():
    rng = np.random.default_rng(6)
    for dim, rank in ((1, 1), (6, 6), (9, 4), (16, 16)):
        b = rng.normal(size=(dim, rank)) * 10.0 ** rng.integers(-3, 4, rank)
        a = b @ b.T
        g = whitening.pivoted_cholesky(a)
        assert np.abs(g @ g.T - a).max() <= 1e-9 * np.abs(a).max()
        values, components = whitening.jacobi(g)
        want = np.linalg.eigvalsh(a)[::-1][:len(values)]
        assert np.abs(values - want).max() <= 1e-10 * want[0] and (np.diff(values) <= 0).all()
        assert np.abs(components.T @ components - np.eye(len(values))).max() < 1e-9
    pairs = [tuple(p) for a, b in whitening._rounds(7) for p in zip(a.tolist(), b.tolist())]
    assert sorted(pairs) == [(i, j) for i in range(7) for j in range(i + 1, 7)]


def test_extra_components_are_orthogonal(spark):
    rng = np.random.default_rng(7)
    df = frame(spark, [(i, rng.normal(size=12).tolist()) for i in range(100)])
    fitted = whitening.fit(df, 12)
    w = np.array([r.whitened for r in whitening.whiten(df.where(F.col("vec_id") < 100), fitted).collect()])
    assert np.abs(w.T @ w / 100 - np.eye(12)).max() < 1e-9
