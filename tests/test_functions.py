from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockwave.functions.numeric import half_even, normal_quantile, normal_quantile_scalar, safe_corr
from stockwave.functions.skew import MAX_FOUND_KEYS, hot_keys, salted_join


def test_normal_quantile_matches_the_standard_library(spark):
    levels = [1e-12, 1e-6, 0.01, 0.07, 0.075, 0.2, 0.3, 0.5, 0.85, 0.95, 0.975, 0.99, 0.999999]
    rows = spark.createDataFrame([(p,) for p in levels], "p double").select("p", normal_quantile(F.col("p")).alias("z"))
    for p, z in rows.collect():
        assert z == pytest.approx(NormalDist().inv_cdf(p), rel=1e-12, abs=1e-12)


def test_normal_quantile_outside_the_open_interval(spark):
    rows = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (None,)], "p double")
    assert [r.z for r in rows.select(normal_quantile(F.col("p")).alias("z")).collect()] == [None] * 4
    for bad in (0.0, 1.0, -0.1):
        with pytest.raises(ValueError):
            normal_quantile_scalar(bad)


def test_half_even_rounds_like_numpy(spark):
    values = [0.5, 1.5, 2.5, -0.5, -1.5, 1.005, 2.675, 7.875, 12.345]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    got = rows.select("v", half_even(F.col("v")).alias("a"), half_even(F.col("v"), 2).alias("b")).collect()
    for v, a, b in got:
        assert a == np.round(v) and str(a) != "-0.0"
        assert b == np.round(v, 2)


def test_safe_corr_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.5, 5.0)], "a double, b double, k double")
    row = df.agg(safe_corr(F.col("a"), F.col("b")).alias("ab"), safe_corr(F.col("a"), F.col("k")).alias("ak")).first()
    assert row.ab == pytest.approx(np.corrcoef([1, 2, 3], [2, 4, 6.5])[0, 1])
    assert row.ak is None


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows hold one key, a tenth have none."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 500 + 1000)
    big = spark.range(30_000).select(key.cast("bigint").alias("k"), F.col("id").alias("v"))
    small = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    return big, small


def test_hot_keys_finds_only_the_hot_key(skewed):
    big, _ = skewed
    assert [r.k for r in hot_keys(big, "k", target_rows=1000).collect()] == [7]
    assert hot_keys(big, "k", target_rows=1).count() <= MAX_FOUND_KEYS


def test_keys_of_a_small_share_are_split_by_their_size(spark):
    key = F.when(F.col("id") % 300 == 0, -1).when(F.col("id") % 10 == 1, -2).otherwise(F.col("id"))
    found = hot_keys(spark.range(300_000).select(key.alias("k")), "k", target_rows=900).collect()
    assert {r.k: r["_hot"] for r in found if r.k < 0} == {-1: 2, -2: 34}


def test_sampled_keys_above_the_target_are_all_found(spark):
    """25 keys just above the target, each 1 % of the rows, beside a hot one and many rare ones; only a sample is counted."""
    key = F.when(F.col("id") % 4 == 0, -1).when(F.col("id") % 2 == 0, F.col("id") % 100).otherwise(F.col("id"))
    big = spark.range(4_000_000, numPartitions=8).select(key.alias("k"))
    found = {r.k: r["_hot"] for r in hot_keys(big, "k", target_rows=38_000).collect()}
    assert set(found) == {-1, *range(2, 100, 4)} and found[-1] in range(25, 29)
    assert found == {r.k: r["_hot"] for r in hot_keys(big, "k", target_rows=38_000).collect()}
    assert hot_keys(big, "k", target_rows=1_500_000).isEmpty()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(skewed, how):
    big, small = skewed
    got = salted_join(big, small, "k", how, target_rows=1000).select("k", "v", "w")
    want = big.join(small, "k", how).select("k", "v", "w")
    assert got.count() == want.count()
    assert got.exceptAll(want).isEmpty()


def test_salted_join_spreads_the_hot_key(spark, skewed):
    big, small = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = salted_join(big, small, "k", "inner", target_rows=200)
        spread = joined.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spread) >= 6 and max(r["count"] for r in spread) < 5000


def test_salted_join_refuses_other_kinds(skewed):
    with pytest.raises(ValueError):
        salted_join(*skewed, "k", "full")
