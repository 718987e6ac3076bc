"""Forecasts for the days after the last known one, for all categories at once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockwave.functions.calendar import calendar_columns, is_holiday, onehot_columns
from stockwave.functions.numeric import half_even
from stockwave.operators.models import blend
from stockwave.params import FORECAST_DAYS, HOLIDAYS, ROLLING_WINDOWS, TARGET

SNAPSHOT_LAGS = (1, 2, 3, 7)


def future_spine(history: DataFrame, days: int = FORECAST_DAYS) -> DataFrame:
    """One row per category and future day, from the day after its last date."""
    last = history.groupBy("category").agg(F.max("date").alias("last_date"))
    return last.select(
        "category", F.explode(F.sequence(F.date_add("last_date", 1), F.date_add("last_date", days))).alias("date")
    )


def lag_snapshot(
    history: DataFrame, lags: Sequence[int] = SNAPSHOT_LAGS, windows: Sequence[int] = ROLLING_WINDOWS
) -> DataFrame:
    """Per category: the last values, and mean and deviation of the last w rows (0 if fewer)."""
    newest = Window.partitionBy("category").orderBy(F.desc("date"))
    depth = max(*lags, *windows)
    tail = (
        history.select("category", "date", TARGET, F.row_number().over(newest).alias("_row"))
        .where(F.col("_row") <= depth)
    )
    row = F.col("_row")

    def lagged(k: int) -> Column:
        return F.coalesce(F.max(F.when(row == k, F.col(TARGET))), F.lit(0)).alias(f"{TARGET}_lag_{k}")

    def rolled(w: int) -> list[Column]:
        value = F.when(row <= w, F.col(TARGET))
        enough = F.count(F.lit(1)) >= w
        return [
            F.when(enough, F.avg(value)).otherwise(0.0).alias(f"{TARGET}_rolling_mean_{w}d"),
            F.when(enough, F.stddev_samp(value)).otherwise(0.0).alias(f"{TARGET}_rolling_std_{w}d"),
        ]

    return tail.groupBy("category").agg(*[lagged(k) for k in lags], *[c for w in windows for c in rolled(w)])


def future_features(
    history: DataFrame,
    days: int = FORECAST_DAYS,
    holidays: Sequence[dt.date] = HOLIDAYS,
    columns: Sequence[str] = (),
) -> DataFrame:
    """Features of the future days: known calendar, one frozen lag snapshot, 0 for the rest.

    ``columns`` lists the features a model expects; those not built here are added as 0.
    """
    spine = future_spine(history, days)
    last = F.max("date").over(Window.partitionBy("category"))
    first = F.min("date").over(Window.partitionBy("category"))
    eve = F.when(F.col("date") < last, is_holiday(F.date_add("date", 1), holidays)).otherwise(0)
    after = F.when(F.col("date") > first, is_holiday(F.date_sub("date", 1), holidays)).otherwise(0)
    built = spine.select(
        "category",
        "date",
        F.lit(0).cast("bigint").alias(TARGET),
        *calendar_columns(),
        *onehot_columns(),
        is_holiday(F.col("date"), holidays).alias("is_holiday"),
        eve.alias("pre_holiday"),
        after.alias("post_holiday"),
    ).join(lag_snapshot(history), "category")
    absent = [F.lit(0.0).alias(c) for c in columns if c not in built.columns]
    return built.select("*", *absent)


def whole(x: Column) -> Column:
    return half_even(x).cast("bigint")


def forecast_band(
    predictions: DataFrame, weights: DataFrame, models: Sequence[str], reach: float = 0.15
) -> DataFrame:
    """Blended forecast in whole orders with a fixed band, and one column per model."""
    per_model = [
        F.max(F.when(F.col("model") == m, whole(F.greatest(F.col("yhat"), F.lit(0.0))))).alias(f"{m}_prediction")
        for m in models
    ]
    y = F.col("yhat")
    return blend(predictions, weights, also=per_model).select(
        "category",
        "date",
        y.alias("blended"),
        whole(y).alias("predicted_orders"),
        F.greatest(whole(y * (1 - reach)), F.lit(0)).alias("predicted_lower"),
        whole(y * (1 + reach)).alias("predicted_upper"),
        *[f"{m}_prediction" for m in models],
    )


def forecast_summary(forecast: DataFrame, history: DataFrame, recent_days: int = 30) -> DataFrame:
    """Per category: forecast total and daily mean, recent history mean, and their difference."""
    ahead = forecast.groupBy("category").agg(
        F.count(F.lit(1)).alias("forecast_days"),
        F.sum("blended").cast("bigint").alias("total_forecast_orders"),
        half_even(F.avg("blended"), 1).alias("avg_daily_forecast"),
    )
    last = F.max("date").over(Window.partitionBy("category"))
    past = (
        history.select("category", "date", TARGET, last.alias("_last"))
        .where(F.col("date") >= F.date_sub("_last", recent_days))
        .groupBy("category")
        .agg(half_even(F.avg(TARGET), 1).alias("avg_historical_daily"), F.max("date").alias("last_training_date"))
    )
    change = (F.col("avg_daily_forecast") - F.col("avg_historical_daily")) / F.greatest(
        F.col("avg_historical_daily"), F.lit(0.01)
    )
    return ahead.join(past, "category").withColumn("trend_pct", half_even(change * 100, 1))


def forecast_series(history: DataFrame, forecast: DataFrame) -> DataFrame:
    """The forecast with the last actual point in front, so that both lines meet."""
    last = history.groupBy("category").agg(
        F.max("date").alias("date"), F.max_by(F.col(TARGET), F.col("date")).cast("bigint").alias("_y")
    )
    point = last.select(
        "category", "date", *[F.col("_y").alias(c) for c in ("predicted_orders", "predicted_lower", "predicted_upper")],
        F.lit("actual").alias("kind"),
    )
    ahead = forecast.select(*[c for c in point.columns if c != "kind"], F.lit("forecast").alias("kind"))
    return point.unionByName(ahead)
