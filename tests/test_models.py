import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stockwave.operators import evaluate, features, forecast, models
from stockwave.params import STATIC_WEIGHTS, BoostingParams, SplitDates

SPLIT = SplitDates(train=("2020-01-01", "2020-02-20"), val=("2020-02-21", "2020-03-05"), test=("2020-03-06", "2020-03-30"))


def predictions(spark, rows):
    return spark.createDataFrame(rows, "category string, date string, model string, y double, yhat double").withColumn(
        "date", F.to_date("date")
    )


def test_absent_model_predicts_the_constant(panel):
    assert models.score_absent_model(panel, "none").select("yhat").distinct().collect()[0][0] == 100.0


def test_mean_baseline(panel):
    train, val, _ = features.train_val_test_split(panel, SPLIT)
    got = models.mean_baseline(train, val).where("category = 'toys'").select("yhat").distinct().collect()
    want = train.where("category = 'toys'").agg(F.avg("order_count")).first()[0]
    assert [r.yhat for r in got] == [want]


def test_weights_sum_to_one_and_zero_error_dominates(spark):
    metrics = spark.createDataFrame(
        [("a", "x", 0.0), ("a", "y", 2.0), ("b", "x", 4.0)], "category string, model string, rmse double"
    )
    got = {(r.category, r.model): r.weight for r in models.ensemble_weights(metrics).collect()}
    assert got["a", "x"] + got["a", "y"] == pytest.approx(1.0) and got["a", "x"] > 0.999
    assert got["b", "x"] == 1.0


def test_blend_renormalises_and_clamps(spark):
    rows = [("a", "2020-01-01", "x", 1.0, 10.0), ("a", "2020-01-01", "y", 1.0, 20.0), ("a", "2020-01-01", "z", 1.0, 99.0),
            ("a", "2020-01-02", "x", 2.0, -5.0), ("b", "2020-01-01", "z", 3.0, 7.0)]
    weights = spark.createDataFrame([("a", "x", 0.25), ("a", "y", 0.25)], "category string, model string, weight double")
    spine = spark.createDataFrame([("a", "2020-01-01"), ("a", "2020-01-02"), ("b", "2020-01-01"), ("c", "2020-01-01")],
                                  "category string, date string").withColumn("date", F.to_date("date"))
    got = {(r.category, str(r.date)): r.yhat for r in models.blend(predictions(spark, rows), weights, spine).collect()}
    assert got == {("a", "2020-01-01"): 15.0, ("a", "2020-01-02"): 0.0, ("b", "2020-01-01"): 0.0, ("c", "2020-01-01"): 0.0}


def test_static_weights(spark):
    got = models.static_weights(spark.createDataFrame([("a",)], "category string")).collect()
    assert len(got) == 3 and sum(r.weight for r in got) == pytest.approx(1.0)


def test_minmax_round_trip_and_constant_column(panel):
    columns = ["order_count", "avg_freight"]
    bounds = models.minmax_fit(panel, columns)
    scaled = models.minmax_transform(panel, bounds, columns)
    lo, hi, flat = scaled.agg(F.min("order_count"), F.max("order_count"), F.max("avg_freight")).first()
    assert (lo, hi, flat) == (0.0, 1.0, 0.0)
    back = models.minmax_inverse(scaled, bounds, {"order_count": "order_count"})
    want = panel.select("category", "date", F.col("order_count").cast("double").alias("w"))
    assert back.join(want, ["category", "date"]).where(F.abs(F.col("order_count") - F.col("w")) > 1e-9).isEmpty()


def test_sequence_windows_by_definition(panel):
    got = models.sequence_windows(panel, ["order_count", "total_revenue"], 10).orderBy("category", "date").toPandas()
    local = panel.toPandas().sort_values(["category", "date"])
    want = []
    for _, group in local.groupby("category"):
        data = group[["order_count", "total_revenue"]].to_numpy(float)
        want += [(data[i : i + 10].ravel(), data[i + 10, 0]) for i in range(len(data) - 10)]
    assert len(got) == len(want)
    for (window, target), row in zip(want, got.itertuples()):
        np.testing.assert_allclose(row.window, window)
        assert row.next_value == target


def test_sequence_future_pads_with_the_last_row(panel):
    got = models.sequence_future(panel, 3, ["order_count", "total_revenue"], 5).where("category = 'toys'").orderBy("date").toPandas()
    data = panel.where("category = 'toys'").orderBy("date").toPandas()[["order_count", "total_revenue"]].to_numpy(float)
    pad = np.array([[0.0, data[-1, 1]]] * 3)
    full = np.vstack([data, pad])
    for i, row in enumerate(got.itertuples()):
        start = len(full) - 3 - 5 + i
        np.testing.assert_allclose(row.window, full[start : start + 5].ravel())
    assert got.days_ahead.tolist() == [1, 2, 3]


def test_sequence_eligibility(panel):
    rows = {r.category: r for r in models.sequence_eligibility(features.label_split(panel, SPLIT), 30).collect()}
    assert rows["toys"].eligible and not rows["single"].eligible
    assert rows["single"].train_windows == 0


def test_pooled_trees_beat_the_mean(panel):
    matrix = features.feature_matrix(panel, ()).where("category <> 'single'").cache()
    train, val, _ = features.train_val_test_split(matrix, SPLIT)
    model, columns = models.fit_pooled(train, val, BoostingParams(trees=8, depth=4, learning_rate=0.3))
    assert len(columns) == 62 and model.rounds == 8 and 1 < model.trees <= 8
    mine = evaluate.forecast_metrics(models.score_boosted(model, train, train), ["model"]).first().rmse
    base = evaluate.forecast_metrics(models.mean_baseline(train, train), ["model"]).first().rmse
    assert mine < base


def test_best_round_with_patience():
    assert models.patient_best([5, 4, 3, 3, 3.5], 2) == (2, True)
    assert models.patient_best([5, 4, 4.5, 3, 4, 3.5], 3) == (3, False)
    assert models.patient_best([5, 6, 7, 1], 2) == (0, True)
    assert models.patient_best([], 2) == (0, False)


@pytest.mark.parametrize(("trees", "patience"), [(500, 20), (40, 2), (10, 20), (1000, 3), (61, 20)])
def test_boosting_runs_repeat_few_rounds(trees, patience):
    lengths = models.run_lengths(BoostingParams(trees=trees, patience=patience))
    assert lengths[-1] == trees and sum(lengths) <= 2 * trees
    assert all(2 * a <= b for a, b in zip(lengths, lengths[1:-1]))


def test_boosting_goes_on_to_its_best_round(panel):
    """Runs of 6, 12, ... rounds: the kept model is the start of the longest, cut where the held-out error is least."""
    rows = features.feature_matrix(panel, ()).where("category <> 'single'").withColumn("held", F.col("date") > "2020-02-20").cache()
    params = BoostingParams(trees=40, depth=3, learning_rate=0.1, patience=2)
    found = models.fit_boosted(rows, ["order_count_lag_1", "day_of_week", "total_revenue"], params, "held")
    best, settled = models.patient_best(found.errors, 2)
    assert found.trees == best + 1 and len(found.errors) == found.rounds and (settled or found.rounds == 40)
    held = rows.where("held")
    error = found.model.transform(held).agg(F.avg((F.col("order_count") - F.col("yhat")) ** 2)).first()[0]
    assert error == pytest.approx(found.errors[best])
    short = models.fit_boosted(rows.where("not held"), ["order_count_lag_1", "day_of_week", "total_revenue"], BoostingParams(trees=found.trees, depth=3, learning_rate=0.1))
    both = found.model.transform(held).select("category", "date", "yhat").join(short.model.transform(held).select("category", "date", F.col("yhat").alias("again")), ["category", "date"])
    assert short.errors == [] and both.where(F.abs(F.col("yhat") - F.col("again")) > 1e-9).isEmpty()


def test_per_category_training_reports_failures(spark, panel):
    matrix = features.feature_matrix(panel, ()).withColumn("avg_price", F.when(F.col("category") != "books", F.col("avg_price"))).cache()
    train, val, _ = features.train_val_test_split(matrix, SPLIT)
    fitted, report = models.fit_top_categories(train, val, 3, BoostingParams(trees=6, depth=2, learning_rate=0.3), at_once=2)
    rows = {r.category: r for r in report.collect()}
    assert {c: r.status for c, r in rows.items()} == {"toys": "trained", "books": "failed", "single": "trained"}
    assert set(fitted) == {"toys", "single"} and rows["books"].trees is None and rows["books"].detail
    assert rows["toys"].rmse > 0 and rows["toys"].trees <= rows["toys"].rounds and rows["single"].rmse is None
    assert models.fit_top_categories(train, val, 1, BoostingParams(trees=2, depth=2))[1].count() == 1


def test_sequence_regression_learns_a_linear_rule(spark):
    start = dt.date(2020, 1, 1)
    rows = [("a", start + dt.timedelta(days=i), float(3 * i)) for i in range(60)]
    df = spark.createDataFrame(rows, "category string, date date, order_count double")
    windows = models.sequence_windows(df, ["order_count"], 4)
    scored = models.score_sequences(models.fit_sequence_regression(windows, 0.0), windows)
    assert scored.where(F.abs(F.col("yhat") - F.col("next_value")) > 0.1).isEmpty()


def test_sequence_regression_is_least_squares(spark):
    rng = np.random.default_rng(3)
    start = dt.date(2020, 1, 1)
    rows = [("a", start + dt.timedelta(days=i), float(v), float(w)) for i, (v, w) in enumerate(rng.normal(size=(80, 2)))]
    df = spark.createDataFrame(rows, "category string, date date, order_count double, extra double")
    windows = models.sequence_windows(df, ["order_count", "extra"], 3)
    scored = models.score_sequences(models.fit_sequence_regression(windows, 0.0), windows).orderBy("date").toPandas()
    x = np.column_stack([np.vstack(scored.window), np.ones(len(scored))])
    fitted = x @ np.linalg.lstsq(x, scored.next_value, rcond=None)[0]
    np.testing.assert_allclose(scored.yhat, fitted, atol=1e-4)


def test_future_features(panel):
    holidays = (dt.date(2020, 3, 25),)
    got = forecast.future_features(panel, 10, holidays, ["order_count_lag_30", "avg_price"]).toPandas()
    toys = panel.where("category = 'toys'").orderBy("date").toPandas().order_count
    row = got[got.category == "toys"].sort_values("date")
    assert len(row) == 10 and (row.order_count_lag_30 == 0).all() and (row.avg_price == 0).all()
    first = row.iloc[0]
    assert [first[f"order_count_lag_{k}"] for k in (1, 2, 3, 7)] == [toys.iloc[-k] for k in (1, 2, 3, 7)]
    assert first.order_count_rolling_mean_30d == pytest.approx(toys.tail(30).mean())
    assert first.order_count_rolling_std_7d == pytest.approx(toys.tail(7).std())
    days = pd.to_datetime(row.date).dt.strftime("%m-%d")
    assert dict(zip(days, row.pre_holiday))["03-24"] == 1 and dict(zip(days, row.post_holiday))["03-26"] == 1
    short = got[got.category == "single"].iloc[0]
    assert short.order_count_lag_1 == 3 and short.order_count_lag_2 == 0 and short.order_count_rolling_mean_7d == 0


def test_forecast_band_and_summary(spark, panel):
    rows = [("toys", f"2020-04-0{i}", m, None, v) for i in range(1, 4) for m, v in (("x", 10.0), ("y", 11.0))]
    weights = spark.createDataFrame([("toys", "x", 0.5), ("toys", "y", 0.5)], "category string, model string, weight double")
    out = forecast.forecast_band(predictions(spark, rows), weights, ["x", "y"])
    row = out.first()
    assert (row.predicted_orders, row.predicted_lower, row.predicted_upper) == (10, 9, 12)  # 10.5 rounds to even
    assert (row.x_prediction, row.y_prediction) == (10, 11)
    info = forecast.forecast_summary(out, panel).first()
    recent = panel.where("category = 'toys'").toPandas()
    recent = recent[recent.date >= recent.date.max() - dt.timedelta(days=30)].order_count.mean()
    assert info.total_forecast_orders == 31 and info.avg_daily_forecast == 10.5
    assert info.avg_historical_daily == pytest.approx(round(recent, 1))
    line = forecast.forecast_series(panel.where("category = 'toys'"), out).orderBy("date").collect()
    assert len(line) == 4 and line[0].kind == "actual"


def test_unseen_categories_get_the_mean_of_all(spark, panel):
    train, rows = panel.where("category = 'toys'"), panel.where("category in ('toys', 'books')")
    got = models.mean_baseline(train, rows)
    assert got.count() == rows.count()
    assert got.select("yhat").distinct().count() == 1
    assert models.with_category_mean(rows, train).where("category_mean is null").isEmpty()


def test_static_weights_where_none_were_measured(spark):
    known = spark.createDataFrame([("a", "boosted", 2.0, 1.0)], "category string, model string, rmse double, weight double")
    categories = spark.createDataFrame([("a",), ("b",), ("b",)], "category string")
    got = {(r.category, r.model): r.weight for r in models.complete_weights(known, categories).collect()}
    assert got == {("a", "boosted"): 1.0} | {("b", m): w for m, w in STATIC_WEIGHTS.items()}
    rows = spark.createDataFrame([("b", "2020-01-01", "boosted", 1.0, 7.0)], "category string, date string, model string, y double, yhat double")
    assert models.blend(rows, models.complete_weights(known, categories)).first().yhat == 7.0


def test_training_report(spark):
    rows = [(c, "2020-01-01", s) for c, s, n in (("a", "train", 45), ("a", "val", 6), ("b", "train", 12), ("c", "val", 9)) for _ in range(n)]
    split = spark.createDataFrame(rows, "category string, date string, split string")
    metrics = spark.createDataFrame([("a", "boosted", 1.0), ("a", "sequence", 2.0), ("c", "boosted", 3.0)], "category string, model string, rmse double")
    got = {r.category: tuple(r)[1:5] for r in models.training_report(split, split.where("split = 'train'"), metrics).collect()}
    assert got == {"a": ("trained", 15, 6, {"boosted": 1.0, "sequence": 2.0}), "b": ("skipped", 0, 0, None), "c": ("unseen", 0, 9, {"boosted": 3.0})}
