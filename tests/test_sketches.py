import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockwave.operators import features, sketches

KEYS = ["category", "days_ahead"]


def test_snapshot_predictions(panel):
    daily = features.densify(panel.where("category = 'toys'"))
    got = sketches.snapshot_predictions(daily, 5, 3).toPandas()
    values = daily.orderBy("date").toPandas().set_index("date").order_count
    assert len(got) == sum(min(5, len(values) - 1 - i) for i in range(len(values)))
    for r in got.itertuples():
        past = values[values.index <= r.origin].tail(3)
        assert r.date == r.origin + dt.timedelta(days=r.days_ahead) and r.y == values[r.date] and r.yhat == pytest.approx(past.mean())


def errors(spark, n, days=4):
    draw = np.random.default_rng(3)
    rows = [("a", h, float(h * draw.normal()), 0.0) for h in range(1, days + 1) for _ in range(n)]
    return spark.createDataFrame([*rows, ("a", 1, None, 0.0), ("b", 1, 1.0, 2.0)], "category string, days_ahead int, y double, yhat double").repartition(5)


def test_radius_is_the_stated_order_statistic(spark):
    rows = errors(spark, 99)
    stored = sketches.error_sketches(rows, KEYS)
    banded = sketches.with_band(rows, stored, KEYS, 0.8)
    data = rows.dropna().toPandas()
    for r in banded.select(*KEYS, "radius").distinct().collect():
        own = np.sort(np.abs(data[(data.category == r.category) & (data.days_ahead == r.days_ahead)].y - data[(data.category == r.category) & (data.days_ahead == r.days_ahead)].yhat))
        place = math.ceil((len(own) + 1) * 0.8)
        assert r.radius == (own[place - 1] if place <= len(own) else None)
    assert banded.where("lower < 0 or upper < yhat").isEmpty()


def test_merged_sketches_equal_those_of_all_rows(spark):
    rows = errors(spark, 150)
    merged = sketches.merge_error_sketches(sketches.error_sketches(rows, KEYS), ["category"])
    whole = sketches.error_sketches(rows, ["category"])
    radius = lambda s: {r[0]: r[1:] for r in s.select("category", "n", sketches.conformal_radius(s, 0.9)).collect()}
    assert radius(merged) == radius(whole) and radius(whole)["b"] == (1, None)


def test_coverage_on_new_errors(spark):
    stored = sketches.error_sketches(errors(spark, 400), KEYS)
    draw = np.random.default_rng(9)
    fresh = spark.createDataFrame([("a", h, float(h * draw.normal()), 0.0) for h in range(1, 5) for _ in range(500)], "category string, days_ahead int, y double, yhat double")
    wide = sketches.with_band(fresh, stored, KEYS).withColumn("lower", F.col("yhat") - F.col("radius"))
    for r in sketches.band_coverage(wide, KEYS).collect():
        assert r.n == 500 and 0.85 < r.coverage < 0.95


def test_distinct_orders_merge(spark):
    start = dt.date(2020, 1, 1)
    rows = [(f"o{i % 6000}", start + dt.timedelta(days=i % 40), "ab"[i % 2]) for i in range(18_000)]
    orders = spark.createDataFrame(rows, "order_id string, date date, category string")
    stored = sketches.order_sketches(orders).cache()
    assert stored.count() == 40
    for keys in ([], ["category"], ["date"]):
        exact = {tuple(r)[:-1]: r[-1] for r in orders.groupBy(*keys).agg(F.count_distinct("order_id")).collect()}
        got = {tuple(r)[:-1]: r[-1] for r in sketches.distinct_orders(stored, keys).collect()}
        assert set(got) == set(exact) and all(abs(got[k] - n) <= 0.02 * n for k, n in exact.items())
    assert sum(r.n_orders for r in sketches.distinct_orders(stored, ["category"]).collect()) >= 6000
