import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stockwave.operators import features
from stockwave.params import EXOGENOUS, LAGS, ROLLING_WINDOWS, SplitDates

HOLIDAYS = (dt.date(2020, 1, 1), dt.date(2020, 1, 14), dt.date(2020, 2, 10), dt.date(2020, 3, 20))


def by_key(df):
    out = df.toPandas()
    out["date"] = pd.to_datetime(out["date"])
    return out.sort_values(["date", "category"], ignore_index=True)


@pytest.fixture(scope="module")
def local(panel):
    return by_key(panel)


def test_feature_count_is_61(panel):
    matrix = features.feature_matrix(panel, HOLIDAYS)
    assert len(features.feature_columns(matrix)) == 61
    assert matrix.count() == panel.count()
    assert matrix.dropna().count() == panel.count()
    assert len(features.feature_columns(features.feature_matrix(panel, HOLIDAYS, leak_free=True))) == 56


def test_lags_are_previous_rows(panel, local):
    got = by_key(features.add_lag_features(panel))
    for k in LAGS:
        want = local.groupby("category")["order_count"].shift(k)
        np.testing.assert_allclose(got[f"order_count_lag_{k}"].astype(float), want)


def test_rolling_excludes_the_current_row(panel, local):
    got = by_key(features.add_rolling_features(panel))
    for w in ROLLING_WINDOWS:
        group = local.groupby("category")["order_count"]
        mean = group.transform(lambda x, w=w: x.shift(1).rolling(w, min_periods=1).mean())
        std = group.transform(lambda x, w=w: x.shift(1).rolling(w, min_periods=1).std().fillna(0))
        np.testing.assert_allclose(got[f"order_count_rolling_mean_{w}d"].astype(float), mean)
        np.testing.assert_allclose(got[f"order_count_rolling_std_{w}d"], std, atol=1e-9)


def test_calendar(panel, local):
    got = by_key(features.add_seasonal_features(panel))
    day = local["date"].dt
    assert (got.day_of_week == day.dayofweek).all() and (got.week_of_year == day.isocalendar().week).all()
    assert (got.is_month_end == day.is_month_end.astype(int)).all()
    assert (got[[f"dow_{k}" for k in range(1, 7)]].sum(axis=1) == (day.dayofweek > 0).astype(int)).all()
    assert (got.month_2 == (day.month == 2).astype(int)).all()


def test_exogenous_fill_and_lags(panel, local):
    got = by_key(features.add_exogenous_features(panel))
    for c in EXOGENOUS:
        want = local.groupby("category")[c].transform(lambda x: x.ffill().bfill())
        np.testing.assert_allclose(got[c].astype(float), want)
        np.testing.assert_allclose(got[f"{c}_lag_7"].astype(float), want.groupby(local["category"]).shift(7))


def test_row_holidays_equal_the_shifted_sorted_table(panel, local):
    got = by_key(features.add_holiday_feature(panel, HOLIDAYS))
    days = {pd.Timestamp(h) for h in HOLIDAYS}
    assert got.is_holiday.tolist() == local["date"].isin(days).astype(int).tolist()
    assert got.pre_holiday.tolist() == local["date"].shift(-1).isin(days).astype(int).tolist()
    assert got.post_holiday.tolist() == local["date"].shift(1).isin(days).astype(int).tolist()


def test_calendar_holidays(panel, local):
    got = by_key(features.add_holiday_feature(panel, HOLIDAYS, mode="calendar"))
    eve = (local["date"] + pd.Timedelta(days=1)).isin({pd.Timestamp(h) for h in HOLIDAYS}).astype(int)
    assert got.pre_holiday.tolist() == eve.tolist()
    with pytest.raises(ValueError):
        features.add_holiday_feature(panel, HOLIDAYS, mode="other")


def test_windows_share_one_shuffle_and_sort(panel):
    matrix = features.feature_matrix(panel, HOLIDAYS, holiday_mode="calendar")
    plan = matrix._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(category") == 1
    assert plan.count("Sort [category") == 1


def test_densify_adds_zero_days(panel):
    dense = features.densify(panel)
    spans = panel.groupBy("category").agg((F.datediff(F.max("date"), F.min("date")) + 1).alias("n"))
    assert dense.count() == spans.agg(F.sum("n")).first()[0]
    assert dense.agg(F.sum("order_count")).first()[0] == panel.agg(F.sum("order_count")).first()[0]


def test_splits_are_disjoint_and_inclusive(panel):
    dates = SplitDates(train=("2020-01-01", "2020-02-10"), val=("2020-02-11", "2020-02-29"), test=("2020-03-01", "2020-03-10"))
    parts = features.train_val_test_split(panel, dates)
    counts = [p.count() for p in parts]
    summary = {r.split: (r.n_rows, str(r.last_date)) for r in features.split_summary(panel, dates).collect()}
    assert [summary[s][0] for s in ("train", "val", "test")] == counts
    assert summary["train"][1] == "2020-02-10"
    labelled = features.label_split(panel, dates)
    assert labelled.where("split is null").count() == panel.count() - sum(counts)


def test_empty_split_is_empty(panel):
    empty = SplitDates(test=("2030-01-01", "2030-02-01"))
    assert features.train_val_test_split(panel, empty)[2].isEmpty()


def test_walk_forward_folds(panel):
    cut = dt.date(2020, 1, 31)
    got = features.walk_forward_folds(panel, cut, folds=3, step_days=10, val_days=7).toPandas()
    local = panel.toPandas()
    for k in range(3):
        edge = cut + dt.timedelta(days=10 * k)
        train = (local.date <= edge).sum()
        val = ((local.date > edge) & (local.date <= edge + dt.timedelta(days=7))).sum()
        assert ((got.fold == k) & (got.role == "train")).sum() == train
        assert ((got.fold == k) & (got.role == "val")).sum() == val
