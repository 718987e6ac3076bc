import numpy as np
import pytest
from pyspark.sql import functions as F

from stockwave.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score int, rank string"


def brute(rows, k, step):
    seen = {}
    for vec_id, v, *_ in rows:
        if vec_id is not None and v is not None and all(x is not None and np.isfinite(np.float32(x)) for x in v):
            seen[vec_id, tuple(int(np.floor(float(np.float32(x)) * 256)) for x in v)] = True
    out = []
    for q in {i for i, _ in seen if i % step == 0}:
        found = sorted((-sum(a * b for a, b in zip(u, v)), c) for i, u in seen if i == q for c, v in seen if c != q)
        out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(found[:k])]
    return sorted(out)


def compare(spark, rows, k=5, step=10):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    found = topk.top_k(df, F.col("vec_id") % step == 0, k)
    assert sorted(map(tuple, found.collect())) == brute(rows, k, step)


def vectors(n, dim, seed, centers=6):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(centers, dim))
    found = middle[draw.integers(0, centers, n)] + 0.2 * draw.normal(size=(n, dim))
    return [(i, [float(x) for x in v]) for i, v in enumerate(found.astype(np.float32))]


@pytest.mark.parametrize("dim", [1, 3, 16])
def test_equals_brute_force(spark, dim, monkeypatch):
    """Several cells, parts and query groups."""
    for name, value in (("BLOCK_ROWS", 60), ("QUERY_ROWS", 20), ("MAX_PIVOTS", 4)):
        monkeypatch.setattr(topk, name, value)
    compare(spark, vectors(700, dim, dim))


def test_ties_copies_and_odd_vectors(spark):
    rows = [(i, [0.5, 0.25]) for i in range(100)] + [(100 + i, [0.5, 0.25 + i % 3]) for i in range(50)]
    rows += [(200, None), (210, [None, 1.0]), (220, [float("nan"), 1.0]), (230, [float("inf"), 0.0]), (240, []), (250, [2.0]), (None, [1.0, 1.0])]
    rows += [(-10, [-0.001, -3.0]), (20, [0.5, 0.25])]
    compare(spark, rows)


def test_few_candidates(spark):
    compare(spark, [(0, [1.0]), (10, [2.0]), (3, [-1.0])])
    compare(spark, [(0, [1.0])])
    compare(spark, [])


def test_large_components(spark):
    rows = [(i * 10, [3.0e5 * (-1) ** i + i, 2.5e5 * i]) for i in range(30)]
    compare(spark, rows)


def test_tree_covers_its_points():
    draw = np.random.default_rng(0)
    points = np.concatenate([draw.normal(size=(500, 8)), np.ones((300, 8))])
    tree = topk.Tree(points)
    assert sorted(np.concatenate([m for m, c in zip(tree.members, tree.children) if not c])) == list(range(800))
    for center, radius, members in zip(tree.centers, tree.radii, tree.members):
        assert np.sqrt(((points[members] - center) ** 2).sum(1)).max() <= radius + 1e-12


def test_pruning_skips_pairs(monkeypatch):
    rows = np.array([v for _, v in vectors(3000, 8, 1)]) * 256
    done = []
    plain = topk.exact_scores
    monkeypatch.setattr(topk, "exact_scores", lambda a, b: done.append(len(a) * len(b)) or plain(a, b))
    topk.search(np.floor(rows[:300]), np.arange(300), np.full(300, -np.inf), np.floor(rows), np.arange(3000), 5)
    assert sum(done) < 0.7 * 300 * 3000


def test_far_blocks_are_not_repeated(spark, monkeypatch):
    """Of clusters in different directions a group of queries reaches few blocks, so few rows are shuffled."""
    for name, value in (("BLOCK_ROWS", 100), ("QUERY_ROWS", 20), ("MAX_PIVOTS", 8)):
        monkeypatch.setattr(topk, name, value)
    draw = np.random.default_rng(3)
    rows = [(i, (10 * np.eye(8)[i % 8] + 0.1 * draw.normal(size=8)).astype(np.float32).tolist()) for i in range(1600)]
    sent = {}
    plain = topk.stage
    monkeypatch.setattr(topk, "stage", lambda df, label: sent.setdefault(label, []).append(plain(df, label)) or sent[label][-1])
    compare(spark, rows, step=9)
    first, second = (df.select("cell", "part", "grp").distinct().count() for df in sent["asked"])
    groups = sent["asked"][0].select("grp").distinct().count()
    assert groups >= 8
    assert second <= 0.3 * groups * 16  # 16 blocks


def test_groups_of_queries(monkeypatch):
    monkeypatch.setattr(topk, "QUERY_ROWS", 10)
    centers = np.array([[0.0], [9.0], [1.0], [8.0], [4.0]])
    assert topk.chain(centers) == [0, 2, 4, 3, 1]
    first, split = topk.query_groups({0: 4, 1: 25, 2: 6, 3: 1}, centers)
    assert first.tolist() == [0, 2, 0, 1, 0] and split.tolist() == [1, 3, 1, 1, 1]
