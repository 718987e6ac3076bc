import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stockwave.operators import evaluate, explore, features


@pytest.fixture(scope="module")
def local(panel):
    out = panel.toPandas()
    out["date"] = pd.to_datetime(out["date"])
    return out.sort_values(["category", "date"], ignore_index=True)


def test_kpis_in_one_pass(panel, local):
    row = explore.kpi_panel(panel).first()
    totals = local.groupby("date").order_count.sum()
    assert row.n_categories == 3 and row.total_orders == totals.sum() and row.peak_daily_orders == totals.max()
    assert row.avg_daily_orders == pytest.approx(totals.mean())
    assert (pd.Timestamp(row.first_date), pd.Timestamp(row.last_date)) == (local.date.min(), local.date.max())


def test_top_n_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1)], "category string, order_count int")
    assert [r.category for r in explore.top_n(df, n=2).collect()] == ["a", "b"]
    assert explore.keep_top_n(df, 1).collect()[0].category == "a"


def test_weekday_spine_keeps_unseen_days(panel):
    rows = explore.weekday_profile(panel).where("category = 'single'").collect()
    assert len(rows) == 7 and sum(r.avg_orders is not None for r in rows) == 1


def test_pivot_matches_pandas(panel, local):
    got = explore.seasonality_pivot(panel).where("category = 'toys'").toPandas().set_index("day_of_week").sort_index()
    toys = local[local.category == "toys"]
    want = toys.pivot_table(values="order_count", index=toys.date.dt.dayofweek, columns=toys.date.dt.month, aggfunc="mean")
    np.testing.assert_allclose(got[["jan", "feb", "mar"]].astype(float), want)
    assert got["dec"].isna().all()


def test_outliers_match_the_quartile_rule(panel, local):
    def flag(s):
        q1, q3 = s.quantile(0.25), s.quantile(0.75)
        return (s < q1 - 1.5 * (q3 - q1)) | (s > q3 + 1.5 * (q3 - q1))

    spiked = panel.withColumn("order_count", F.when(F.dayofmonth("date") == 9, 99).otherwise(F.col("order_count")))
    base = local.assign(order_count=np.where(local.date.dt.day == 9, 99, local.order_count))
    want = base.groupby("category").order_count.transform(flag).sum()
    assert explore.flag_outliers(spiked).where("is_outlier").count() == want > 0
    assert explore.outlier_summary(spiked).agg(F.sum("n_outliers")).first()[0] == want


def test_null_profile(panel, local):
    want = {c: int(n) for c, n in local.isna().sum().items() if n}
    assert {r.column_name: r.n_null for r in explore.null_profile(panel).collect()} == want


def test_describe(panel, local):
    got = explore.describe_by_category(panel).toPandas().set_index("category").loc["toys"]
    want = local[local.category == "toys"].order_count.describe()
    np.testing.assert_allclose(got.astype(float).values, want[["count", "mean", "std", "min", "25%", "50%", "75%", "max"]].values)


def test_correlations(panel, local):
    columns = ["order_count", "total_revenue", "avg_freight"]
    got = {(r.column_a, r.column_b): r["corr"] for r in explore.corr_matrix(panel, columns).collect()}
    want = local[columns].corr()
    assert len(got) == 9
    for (a, b), value in got.items():
        assert value == pytest.approx(want.loc[a, b])


def test_target_corr_skips_constant_features(panel):
    matrix = features.feature_matrix(panel, ())
    rows = explore.target_corr(matrix, 5, 3).collect()
    assert [r.side for r in rows].count("top") == 5 and [r.side for r in rows].count("bottom") == 3
    assert all(r["corr"] is not None for r in rows)
    assert not {"is_holiday", "month_12"} & {r.feature for r in rows}


def test_recent_window_is_inclusive(panel, local):
    last = local.date.max()
    want = (local.date >= last - pd.Timedelta(days=30)).sum()
    assert explore.recent_window(panel).count() == want
    own = local.groupby("category").date.transform("max")
    assert explore.recent_window(panel, per_category=True).count() == (local.date >= own - pd.Timedelta(days=30)).sum()


def test_profile_of_one_day_has_no_deviation(panel):
    row = explore.demand_profile(panel.where("category = 'single'")).first()
    assert row.demand_std is None and row.monthly_forecast == 90.0


def test_latest_skips_nulls(spark, panel, local):
    got = explore.latest_per_category(panel).toPandas().set_index("category")
    want = local.sort_values("date").groupby("category").last()
    for c in ("order_count", "avg_price", "avg_review_score"):
        np.testing.assert_allclose(got[c].astype(float).sort_index(), want[c].astype(float).sort_index())


def test_moving_averages(panel, local):
    got = explore.moving_average(panel, (7,), ["category"]).toPandas().sort_values(["category", "date"])
    want = local.groupby("category").order_count.transform(lambda x: x.rolling(7, min_periods=1).mean())
    np.testing.assert_allclose(got.ma_7.values, want.values)
    strict = explore.moving_average(panel, (7,), ["category"], strict=True).toPandas().sort_values(["category", "date"])
    np.testing.assert_allclose(strict.ma_7.values, local.groupby("category").order_count.transform(lambda x: x.rolling(7).mean()).values)


def test_baseline_tail(panel, local):
    toys = local[local.category == "toys"].tail(60)
    base = toys.order_count.shift(1).rolling(7, min_periods=1).mean()
    want = (toys.order_count - base).abs().iloc[7:].mean()
    row = explore.baseline_tail(panel).where("category = 'toys'").first()
    assert row.baseline_mae == pytest.approx(want) and row.n_rows == len(toys) - 7


def test_head_transposed(panel, local):
    got = explore.head_transposed(panel, "toys", 3).toPandas().set_index("feature")
    want = local[local.category == "toys"].head(3)
    assert got.loc["order_count", ["row_1", "row_2", "row_3"]].tolist() == want.order_count.tolist()


def test_metrics_with_zero_actuals(spark):
    rows = [("a", "m", 0.0, 1.0), ("a", "m", 0.0, 3.0), ("b", "m", 0.0, 2.0), ("b", "m", 4.0, 3.0)]
    df = spark.createDataFrame(rows, "category string, model string, y double, yhat double")
    got = {r.category: r for r in evaluate.forecast_metrics(df).collect()}
    assert (got["a"].mape, got["a"].mae) == (0.0, 2.0) and got["a"].rmse == pytest.approx(2.24)
    assert (got["b"].mape, got["b"].mae, got["b"].rmse) == (25.0, 1.5, 1.58)
    macro = evaluate.metrics_macro(evaluate.forecast_metrics(df)).first()
    assert macro.n_categories == 2 and macro.avg_mape == 12.5
    flags = [r.meets_target for r in evaluate.leaderboard(evaluate.forecast_metrics(df)).collect()]
    assert flags == [True, False]


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(0)
    values = rng.integers(-40, 60, 500).astype(float)
    df = spark.createDataFrame([("g", float(v)) for v in values] + [("flat", 2.0)] * 4, "k string, v double")
    got = evaluate.histogram(df, "v", 20, ["k"]).orderBy("k", "bin").toPandas()
    counts, edges = np.histogram(values, bins=20)
    mine = got[got.k == "g"]
    assert mine.n.sum() == 500 and len(mine) == 20
    np.testing.assert_allclose(mine.lower, edges[:-1])
    np.testing.assert_allclose(mine.upper, edges[1:])
    assert np.abs(mine.n.values - counts).sum() <= 2  # a value on an edge may move by rounding
    assert got[got.k == "flat"].n.tolist() == np.histogram([2.0] * 4, bins=20)[0].tolist()


def test_residual_stats_use_population_deviation(spark):
    df = spark.createDataFrame([("a", "m", 3.0, 1.0), ("a", "m", 1.0, 1.0)], "category string, model string, y double, yhat double")
    row = evaluate.residual_stats(df).first()
    assert (row.residual_mean, row.residual_std) == (1.0, 1.0)


def test_improvement_over_a_baseline(spark):
    metrics = spark.createDataFrame(
        [("a", "lag1", 40.0), ("b", "lag1", 41.0), ("a", "tree", 14.0), ("b", "tree", 15.2)],
        "category string, model string, mape double",
    )
    got = {r.model: r.improvement_pct for r in evaluate.improvement_over(metrics).collect()}
    assert got == {"lag1": 0.0, "tree": 63.95}
