import collections

import pytest
from pyspark.sql import functions as F

from stockwave.llm import mixing


def shares(spark, sizes, **options):
    rows = spark.createDataFrame(sizes, "source string, source_size long")
    return {r.source: r.target for r in mixing.target_shares(rows, **options).collect()}


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    limit = {s: most * n for s, n in order}
    budget, full = sum(n for _, n in order), {}
    while True:
        rest = [s for s in weight if s not in full]
        total = sum(weight[s] for s in rest)
        left = budget - sum(full.values())
        target = {s: left * weight[s] / total for s in rest} | full
        over = [s for s in rest if target[s] > limit[s]]
        if not over:
            return target
        full |= {s: limit[s] for s in over}


@pytest.mark.parametrize("sizes", [
    [("a", 10), ("b", 1000), ("c", 5), (None, 300)],
    [("a", 100), ("b", 100), ("c", 100)],
    [("a", 1), ("b", 1), ("c", 1), ("d", 1), ("e", 100_000)],
    [("z", 7)],
    [("a", 0), ("b", 50), ("c", 9)],
])
def test_targets_equal_repeated_resharing(spark, sizes):
    assert shares(spark, sizes) == pytest.approx(brute_targets(sizes))


def test_targets_of_empty_sources(spark):
    assert shares(spark, [("a", 0), (None, 0)]) == {"a": 0, None: 0}
    assert shares(spark, []) == {}


def test_sources_come_near_their_targets(spark):
    rows = [(i, "w " * (1 + i % 9), "hot" if i % 3 else f"s{i % 4}", "x") for i in range(6000)]
    plan = mixing.mix_plan(spark.createDataFrame(rows, "doc_id long, text string, source string, size string")).collect()
    taken, target = collections.Counter(), {}
    for r in plan:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
    assert all(abs(taken[s] - target[s]) <= 30 for s in target), (taken, target)
    assert sum(taken.values()) <= sum(r.size for r in plan)


def test_runs_agree(odd_docs):
    first, second = (sorted(map(str, mixing.mix_plan(odd_docs.repartition(n)).collect())) for n in (2, 5))
    assert first == second


def test_odd_rows(odd_docs, no_docs):
    plan = mixing.mix_plan(odd_docs).collect()
    assert len(plan) == odd_docs.count()
    assert all(r.taken == 0 for r in plan if r.size == 0)
    mixed = mixing.mix(odd_docs)
    assert mixed.columns == odd_docs.columns
    assert mixed.count() == sum(r.epochs for r in plan)
    assert mixing.mix_plan(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0


def test_mix_repeats_whole_rows(spark):
    docs = spark.createDataFrame([(1, "a b c", "few"), (2, "d e f g", "many"), (3, "h i " * 50, "many")], "doc_id long, text string, source string")
    plan = {r.doc_id: r.epochs for r in mixing.mix_plan(docs).collect()}
    counts = {r.doc_id: r["count"] for r in mixing.mix(docs).groupBy("doc_id").count().collect()}
    assert counts == {k: v for k, v in plan.items() if v}
    assert docs.join(mixing.mix(docs), "doc_id", "left_semi").where(F.col("source") == "few").count() == 1
