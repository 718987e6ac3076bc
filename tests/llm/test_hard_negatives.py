import numpy as np
import pytest
from pyspark.sql import functions as F

from stockwave.llm import hard_negatives
from stockwave.llm.hard_negatives import Packed, mine

SCHEMA = "vec_id long, label int, embedding array<float>, rank string, row int"


def usable(rows):
    seen = {}
    for vec_id, label, v in rows:
        if vec_id is not None and label is not None and v is not None and all(x is not None and np.isfinite(np.float32(x)) for x in v):
            seen[vec_id, label, tuple(int(np.floor(float(np.float32(x)) * 256)) for x in v)] = True
    return list(seen)


def brute(rows, step, positives=5, negatives=5):
    def score(u, v):
        return min(max(sum(a * b for a, b in zip(u, v)), -(1 << 63)), (1 << 63) - 1)

    rows, out = usable(rows), []
    for i, label, u in rows:
        if i % step == 0:
            near = sorted((-score(u, v), c) for c, other, v in rows if other == label and c != i)[:positives]
            far = sorted((-score(u, v), c) for c, other, v in rows if other != label)
            for p, positive in near:
                fitting = [(s, c) for s, c in far if 80 * -p <= 100 * -s <= 100 * -p][:negatives]
                out += [(i, positive, n + 1, c, -p, -s) for n, (s, c) in enumerate(fitting)]
    return sorted(out)


def compare(spark, rows, step=10):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    assert sorted(map(tuple, mine(frame, F.col("vec_id") % step == 0).collect())) == brute(rows, step)


def vectors(n, dim, seed, labels=4, spread=0.4):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(6, dim))
    found = middle[draw.integers(0, 6, n)] + spread * draw.normal(size=(n, dim))
    return [(i, int(draw.integers(0, labels)), [float(x) for x in v]) for i, v in enumerate(found.astype(np.float32))]


@pytest.mark.parametrize("size", [1, 300, 5 << 20, 1 << 35, 1 << 61])
def test_packed_products(size):
    draw = np.random.default_rng(2)
    rows, anchors = draw.integers(-size, size + 1, (50, 7)), draw.integers(-size, size + 1, (5, 7))
    packed = Packed(rows, int(np.abs(anchors).max()))
    for a in anchors:
        want = [min(max(sum(int(x) * int(y) for x, y in zip(a, r)), -(1 << 63)), (1 << 63) - 1) for r in rows]
        assert packed.scores(a).tolist() == want


@pytest.mark.parametrize("dim", [1, 3, 16])
def test_equals_brute_force(spark, dim, monkeypatch):
    """Several blocks, strips and groups of anchors."""
    for name, value in (("BLOCK_ROWS", 90), ("MIN_BLOCK_ROWS", 90), ("ANCHOR_ROWS", 20), ("STRIP", 16)):
        monkeypatch.setattr(hard_negatives, name, value)
    compare(spark, vectors(600, dim, dim))


def test_copies_ties_and_odd_rows(spark):
    rows = [(i, i % 3, [0.5, 0.25]) for i in range(90)] + [(100 + i, i % 2, [0.5, 0.25 + i % 3]) for i in range(50)]
    rows += [(200, 1, None), (210, 1, [None, 1.0]), (220, 1, [float("nan"), 1.0]), (230, 1, [float("inf"), 0.0]), (240, 1, []), (250, 1, [2.0])]
    rows += [(None, 1, [1.0, 1.0]), (260, None, [1.0, 1.0]), (-10, 0, [-0.001, -3.0]), (20, 2, [0.5, 0.25]), (20, 2, [0.5, 0.25])]
    compare(spark, rows)


def test_few_rows(spark):
    compare(spark, [(0, 1, [1.0]), (10, 1, [2.0]), (3, 2, [1.0])])
    compare(spark, [(0, 1, [1.0])])
    compare(spark, [])


def test_large_components(spark):
    compare(spark, [(i * 10, i % 2, [3.0e5 * (-1) ** i + i, 2.5e5 * i]) for i in range(30)])
    compare(spark, [(i * 10, i % 2, [3.0e25 + i, 2.5e5 * i]) for i in range(12)])
