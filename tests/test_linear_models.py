import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockwave.functions.linear import linear_value, solve, squared_error, sums_of_products
from stockwave.operators import backtest, features, models, seasonal

START = dt.date(2020, 1, 1)
PLAN = backtest.Folds(START + dt.timedelta(days=100), 4, 30, 45)
COLUMNS = ("a", "b", "c")


def frame(spark, n=260, seed=1):
    """Two categories with three inputs, days missing, and one category that starts late."""
    draw = np.random.default_rng(seed)
    rows = []
    for category, first in (("x", 0), ("late", 120)):
        for i in range(first, n):
            a, b, c = draw.normal(size=3).tolist()
            if draw.random() < 0.9:
                rows.append((category, START + dt.timedelta(days=i), float(5 + 2 * a - b + draw.normal()), a, b, c))
    rows.append(("x", START + dt.timedelta(days=n), 1.0, None, 1.0, 1.0))
    return spark.createDataFrame(rows, "category string, date date, order_count double, a double, b double, c double").cache()


def ridge_fit(x, y, ridge):
    x = np.column_stack([np.ones(len(x)), x])
    penalty = np.diag([0.0] + [ridge] * (x.shape[1] - 1))
    return np.linalg.solve(x.T @ x + penalty, x.T @ y)


@pytest.mark.parametrize("ridge", [0.0, 3.0])
def test_solve_is_least_squares(spark, ridge):
    rows = frame(spark).na.drop()
    data = rows.toPandas()
    inputs = [F.col(c) for c in COLUMNS]
    sums = rows.agg(F.array(*sums_of_products(inputs, F.col("order_count"))).alias("s"))
    fitted = sums.select(solve(F.col("s"), 3, ridge).alias("w"), "s").select("w", squared_error(F.col("s"), F.col("w"), 3).alias("e")).first()
    want = ridge_fit(data[list(COLUMNS)].to_numpy(), data.order_count.to_numpy(), ridge)
    np.testing.assert_allclose(fitted.w, want, atol=1e-9)
    errors = data.order_count - np.column_stack([np.ones(len(data)), data[list(COLUMNS)]]) @ want
    assert fitted.e == pytest.approx((errors**2).sum())
    value = rows.select(linear_value(F.array(*[F.lit(float(w)) for w in want]), inputs).alias("v")).toPandas().v
    np.testing.assert_allclose(value, data.order_count - errors)


def test_dependent_and_unused_inputs_get_no_weight(spark):
    rows = frame(spark).na.drop().withColumn("d", F.col("a") * 2 + 1).withColumn("flat", F.lit(3.0))
    inputs = [F.col(c) for c in ("a", "d", "flat", "b")]
    sums = rows.agg(F.array(*sums_of_products(inputs, F.col("order_count"))).alias("s"))
    w = sums.select(solve(F.col("s"), 4)).first()[0]
    assert w[2] == w[3] == 0.0
    data = rows.toPandas()
    np.testing.assert_allclose([w[0], w[1], w[4]], ridge_fit(data[["a", "b"]].to_numpy(), data.order_count.to_numpy(), 0.0), atol=1e-8)
    only = sums.select(solve(F.col("s"), 4, 0.0, F.array(*[F.lit(x) for x in (False, False, False, True)]))).first()[0]
    np.testing.assert_allclose([only[0], only[4]], ridge_fit(data[["b"]].to_numpy(), data.order_count.to_numpy(), 0.0), atol=1e-9)
    assert only[1:4] == [0.0] * 3


def brute_folds(data, columns, ridge):
    """(category, fold) -> (n_train, mean, coefficients, validation rows)."""
    out = {}
    for category, group in data.dropna().groupby("category"):
        for k in range(PLAN.folds):
            cut = PLAN.first_cut + dt.timedelta(days=k * PLAN.step_days)
            train = group[group.date <= cut]
            val = group[(group.date > cut) & (group.date <= cut + dt.timedelta(days=PLAN.val_days))]
            if len(train):
                out[category, k] = len(train), train.order_count.mean(), ridge_fit(train[list(columns)].to_numpy(), train.order_count.to_numpy(), ridge), val
    return out


def test_all_folds_equal_separate_fits(spark):
    rows = frame(spark)
    want = brute_folds(rows.toPandas(), COLUMNS, 2.0)
    got = {(r.category, r.fold): r for r in backtest.fold_models(rows, COLUMNS, PLAN, 2.0).collect()}
    assert set(got) == set(want) and {k for c, k in got if c == "late"} == {1, 2, 3}
    for key, (n, mean, weights, _) in want.items():
        assert got[key].n_train == n and got[key].train_mean == pytest.approx(mean)
        np.testing.assert_allclose(got[key].coefficients, weights, atol=1e-8)
    scores = {(r.category, r.fold, r.model): r for r in backtest.walk_forward_scores(rows, COLUMNS, PLAN, 2.0).collect()}
    assert len(scores) == 2 * len(want)
    for (category, fold), (n, mean, weights, val) in want.items():
        yhat = np.maximum(np.column_stack([np.ones(len(val)), val[list(COLUMNS)]]) @ weights, 0)
        row = scores[category, fold, "linear"]
        assert (row.n_train, row.n_val) == (n, len(val)) and row.rmse == pytest.approx(np.sqrt(((val.order_count - yhat) ** 2).mean()), abs=0.00501)
        assert scores[category, fold, "mean_baseline"].rmse == pytest.approx(np.sqrt(((val.order_count - mean) ** 2).mean()), abs=0.00501)


def test_tuning_by_halving(spark):
    rows = frame(spark)
    data = rows.toPandas()
    trials = [backtest.Trial(f"{''.join(c)}{r:g}", c, r) for c in (("a",), ("a", "b"), ("c",)) for r in (0.0, 50.0)]

    def rmse(trial, folds):
        found = [(v.order_count - np.column_stack([np.ones(len(v)), v[list(trial.columns)]]) @ w) for (_, k), (_, _, w, v) in brute_folds(data, trial.columns, trial.ridge).items() if k < folds]
        return np.sqrt((np.concatenate(found) ** 2).mean())

    left, folds, rung, want = trials, 1, 0, {}
    while True:
        errors = {t.name: rmse(t, folds) for t in left}
        want.update({t.name: (rung, folds, errors[t.name]) for t in left})
        if len(left) == 1 or folds >= PLAN.folds:
            break
        left = sorted(left, key=lambda t: errors[t.name])[: (len(left) + 1) // 2]
        folds, rung = min(PLAN.folds, folds * 2), rung + 1
    table, refit = backtest.tune(rows, trials, PLAN)
    got = {r.trial: r for r in table.collect()}
    assert set(got) == {t.name for t in trials}
    for name, (rung, folds, error) in want.items():
        assert (got[name].rung, got[name].folds) == (rung, folds) and got[name].rmse == pytest.approx(error)
    best = min(left, key=lambda t: want[t.name][2])
    assert [n for n, r in got.items() if r.is_best] == [best.name] and best.name == "ab0"
    group = data.dropna().query("category == 'x'")
    np.testing.assert_allclose(refit.where("category = 'x'").first().coefficients[:3], ridge_fit(group[["a", "b"]].to_numpy(), group.order_count.to_numpy(), 0.0), atol=1e-8)


def test_empty_tables(spark):
    none = frame(spark).where("false")
    assert backtest.walk_forward_scores(none, COLUMNS, PLAN).count() == 0
    table, refit = backtest.tune(none, [backtest.Trial("only", ("a",), 0.0)], PLAN)
    assert table.first().rmse is None and refit.count() == 0
    assert seasonal.fit_seasonal(none, START).count() == 0


@pytest.mark.parametrize("multiplicative", [False, True])
def test_seasonal_model(spark, multiplicative):
    """Equal to a brute-force solve, and below the mean baseline on the days after the fit where there are seasons."""
    draw, rows = np.random.default_rng(4), []
    for i in range(1000):
        day = START + dt.timedelta(days=i)
        level = 30 + 0.01 * i + 8 * np.sin(2 * np.pi * i / 365.25) + 5 * (day.weekday() < 5)
        rows.append(("s", day, int(max(0, draw.poisson(level)))))
    panel = spark.createDataFrame(rows, "category string, date date, order_count int")
    cut = START + dt.timedelta(days=800)
    train, later = panel.where(F.col("date") <= cut), panel.where(F.col("date") > cut)
    fitted = seasonal.fit_seasonal(train, START, 2.0, multiplicative)
    data = train.toPandas()
    t = np.array([(d - START).days for d in data.date], float)
    waves = [f(t * 2 * np.pi * k / period) for period, n in ((365.25, 6), (7.0, 3)) for k in range(1, n + 1) for f in (np.sin, np.cos)]
    y = np.log1p(data.order_count) if multiplicative else data.order_count
    np.testing.assert_allclose(fitted.first().coefficients, ridge_fit(np.column_stack([t / 365.25, *waves]), y.to_numpy(float), 2.0), atol=1e-6)
    error = F.sqrt(F.avg((F.col("y") - F.col("yhat")) ** 2))
    mine = seasonal.score_seasonal(fitted, later, START, multiplicative).agg(error).first()[0]
    assert mine < 0.8 * models.mean_baseline(train, later).agg(error).first()[0]


def test_recursive_forecast(spark, panel):
    lags, means = (1, 2, 7), (3, 14)
    built = panel.select("category", "date", "order_count", *features.lag_columns(lags=lags), *features.rolling_columns(windows=means)).na.fill(0)
    model = seasonal.fit_lags(built, lags, means, 1.0)
    got = seasonal.recursive_forecast(panel, model, 12, lags, means).toPandas()
    weights = {r.category: r.coefficients for r in model.collect()}
    for category, group in panel.toPandas().sort_values("date").groupby("category"):
        past, mine = group.order_count.astype(float).tolist(), got[got.category == category].sort_values("days_ahead")
        assert mine.date.tolist() == [group.date.max() + dt.timedelta(days=k) for k in range(1, 13)]
        for value in mine.yhat:
            inputs = [past[-k] if len(past) >= k else 0.0 for k in lags] + [np.mean(past[-w:]) for w in means]
            past.append(max(weights[category][0] + float(np.dot(weights[category][1:], inputs)), 0.0))
            assert value == pytest.approx(past[-1])
