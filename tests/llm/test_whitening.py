import numpy as np
import pytest
from pyspark.sql import functions as F

from stockwave.llm import whitening
from stockwave.llm.whitening import whiten

from samples import SF

SCHEMA = "vec_id long, embedding array<float>, x string, index int, place int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)


def whole(v, dim):
    return [int(np.floor(float(np.float32(c)) * 256)) for c in v] + [0] * (dim - len(v))


def compare(spark, rows, components=None):
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(np.float32(c)) for c in v)]
    dim = max(len(v) for _, v in kept)
    x = np.array([whole(v, dim) for _, v in kept])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    values, axes = np.linalg.eigh(np.cov(fit.T, bias=True).reshape(dim, dim))
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    used = values > values[0] * 1e-10
    want = (x - s / n) @ axes[:, used] / np.sqrt(values[used])
    got = whiten(frame(spark, rows), components=components).collect()
    assert len(got) == len(kept) and {r.n for r in got} == {n}
    assert all(r.identity_error < 1e-9 for r in got)
    assert np.allclose(got[0].explained, values[used] / np.trace(np.cov(fit.T, bias=True).reshape(dim, dim)), rtol=1e-9)
    deviation = ((n * x - s) ** 2).sum(1)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], *np.round(np.abs(r[2]), 6))
    a = sorted([(r.vec_id, r.deviation, np.array(r.whitened)) for r in got], key=key)
    b = sorted([(i, int(d), w) for (i, _), d, w in zip(kept, deviation, want)], key=key)
    assert [r[:2] for r in a] == [r[:2] for r in b]
    a, b = np.array([r[2] for r in a]), np.array([r[2] for r in b])
    assert np.allclose(a * np.sign((a * b).sum(0)), b, atol=1e-8)


def vectors(n, dim, seed):
    draw = np.random.default_rng(seed)
    turned = draw.normal(size=(n, dim)) * np.arange(1, dim + 1) @ np.linalg.qr(draw.normal(size=(dim, dim)))[0]
    return [(i, [float(c) for c in v]) for i, v in enumerate(turned.astype(np.float32))]


@pytest.mark.parametrize("n, dim, components", [(500, 6, 4), (300, 3, None), (700, 20, 4)])
def test_equals_brute_force(spark, n, dim, components, monkeypatch):
    """Several blocks of rows and columns, and a split middle dimension."""
    for name, value in (("BLOCK_ROWS", 64), ("BLOCK_COLUMNS", 7), ("BLOCKS_PER_TASK", 2)):
        monkeypatch.setattr(whitening, name, value)
    compare(spark, vectors(n, dim, n), components)


def test_copies_and_odd_vectors(spark):
    rows = vectors(40, 3, 1) + [(1, [0.5, 0.25, 1.0])] * 30 + [(None, [1.0, 2.0, -4.0]), (50, [3.0]), (51, [])]
    rows += [(60, None), (61, [None, 1.0, 2.0]), (62, [float("nan"), 1.0, 2.0]), (63, [float("inf"), 0.0, 0.0])]
    compare(spark, rows)


def test_axes_without_variance(spark):
    compare(spark, [(i, [float(i), 2.0 * i, 7.0]) for i in range(20)])
    rows = whiten(frame(spark, [(1, [1.0, 2.0])] * 3)).collect()
    assert [tuple(r) for r in rows] == [(1, 1, 0, [], [], None)] * 3
    assert whiten(frame(spark, [(1, []), (2, None)])).collect()[0].whitened == []


def test_empty_table(spark):
    assert whiten(frame(spark, [])).count() == 0


def test_deviation_beyond_long(spark):
    rows = whiten(frame(spark, [(i, [3.0e15 * i, 1.0]) for i in range(4)] + [(9, [1.0e30, 0.0])])).collect()
    assert all(r.deviation is None for r in rows)


def test_query(spark):
    found = whitening.op13_block_matrix(spark, SF)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    each = found.groupBy("component").agg(F.count("*").alias("rows"), F.max("identity_error").alias("error"), F.max("explained").alias("share")).orderBy("component").collect()
    assert [r.component for r in each] == [1, 2, 3, 4] and len({r.rows for r in each}) == 1
    assert each[0].error < 1e-4 and sorted((r.share for r in each), reverse=True) == [r.share for r in each]
