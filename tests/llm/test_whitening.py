"""Whitening against numpy's own eigenvectors, and the solver by itself."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenura.llm import feast, whitening

SCHEMA = "vec_id bigint, embedding array<float>"


def plainly(vectors, wanted):
    """(n, deviations, whitened, explained) of usable vectors."""
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    v = y.T @ y / n
    values, u = np.linalg.eigh(v)
    values, u = values[::-1][:wanted], u[:, ::-1][:, :wanted]
    deviation = [sum((n * int(c) - int(t)) ** 2 for c, t in zip(r, s)) for r in x]
    return n, deviation, y @ u / np.sqrt(values), values / np.trace(v)


def check(out, ids, vectors, wanted):
    rows = {r.vec_id: r for r in out.collect()}
    assert set(rows) == set(ids)
    n, deviation, white, explained = plainly(vectors, wanted)
    got = np.array([rows[i].whitened for i in ids])
    assert np.abs(np.abs(got) - np.abs(white)).max() < 1e-8
    # One sign for all rows of a component.
    assert (np.sign((got * white).sum(axis=0)) * got - white).__abs__().max() < 1e-8
    for i, d in zip(ids, deviation):
        assert rows[i].n == n and int(rows[i].deviation) == d and np.allclose(rows[i].explained, explained, rtol=1e-6)
        assert rows[i].identity_error < 1e-9


def test_table_with_rows_that_cannot_be_used(spark):
    rng = np.random.default_rng(1)
    good = (rng.standard_normal((400, 40)) * rng.uniform(0.1, 4, 40)).astype(np.float32)
    rows = [(i, r.tolist()) for i, r in enumerate(good)]
    bad = [(1000, None), (1001, [None] + [1.0] * 39), (1002, [float("nan")] + [1.0] * 39), (1003, [float("inf")] * 40), (1004, [])]
    df = spark.createDataFrame(rows + bad, SCHEMA).withColumn("n", F.lit("x")).withColumn("whitened", F.lit(1))
    check(whitening.whiten(df.repartition(5)), range(400), good, 32)


def test_few_dimensions_and_repeated_rows(spark):
    rows = [(1, [1.0, 0.0, 0.5]), (2, [0.0, 1.0, 0.25]), (3, [1.0, 1.0, -0.5]), (4, [0.0, 0.0, 2.0]), (5, [0.0, 0.0, 2.0]), (6, [-3.5, 1.25, 0.015])]
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    check(out, [i for i, _ in rows], np.array([v for _, v in rows], np.float32), 3)
    each = whitening.by_component(out)
    assert each.count() == 18 and each.dtypes[1] == ("component", "int") and each.dtypes[3] == ("deviation", "bigint")


def test_rows_without_variance(spark):
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.0])], SCHEMA)
    out = whitening.whiten(same).collect()
    assert len(out) == 3 and all(r.whitened == [] and int(r.deviation) == 0 and r.n == 3 for r in out)
    # On a line: one component.
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], SCHEMA)).collect()
    assert all(len(r.whitened) == 1 and abs(r.explained[0] - 1) < 1e-12 for r in line)


def test_no_usable_rows_and_ragged_ones(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], SCHEMA)).count() == 0
    with pytest.raises(Exception, match="all must have as many"):
        whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], SCHEMA).coalesce(1))


def test_deviations_beyond_64_bits(spark):
    rows = [(1, [1e9]), (2, [-1e9]), (3, [0.0])]
    far = np.array([[np.floor(64 * np.float64(np.float32(v[0])))] for _, v in rows])
    s = int(far.sum())
    got = {r.vec_id: int(r.deviation) for r in whitening.whiten(spark.createDataFrame([(i + 10 * k, v) for k in range(3) for i, v in rows], SCHEMA)).collect()}
    assert got[1] == (9 * int(far[0][0]) - 3 * s) ** 2 > 2**63


MATRICES = {
    "equal": np.eye(20) * 3,
    "clusters": np.diag([5.0] * 10 + [4.0] * 10 + [3.0] * 30),
    "scales": np.diag([1e8, 1e4, 1.0, 1e-3]),
    "zero": np.zeros((6, 6)),
    "one": np.array([[2.0]]),
    "line": np.outer(np.arange(6.0), np.arange(6.0)),
    "dense": np.cov(np.random.default_rng(3).standard_normal((300, 64)).T),
    "deficient": np.cov(np.random.default_rng(4).standard_normal((20, 64)).T),
}


@pytest.mark.parametrize("name", MATRICES)
def test_leading_pairs(spark, name):
    v = MATRICES[name]
    values, vectors = whitening.leading(spark, v, 32)
    want = np.linalg.eigvalsh(v)[::-1]
    want = want[want > feast.least_size(v)][:32]
    assert len(values) == len(want) and np.allclose(values, want, rtol=1e-9, atol=1e-12 * max(want, default=1))
    if len(values):
        assert np.abs(v @ vectors - vectors * values).max() < 1e-11 * want[0]
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12


def test_counts_agree_with_eigenvalues():
    rng = np.random.default_rng(6)
    for n in (1, 2, 3, 10, 33):
        a = rng.standard_normal((n, n))
        a = a + a.T
        inertia = feast.Inertia(a)
        values = np.linalg.eigvalsh(a)
        for shift in [*((values[1:] + values[:-1]) / 2), values[0] - 1, values[-1] + 1]:
            assert inertia.above(shift) == (values > shift).sum()
