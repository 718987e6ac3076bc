"""Linear models of a daily series: trend with seasons, and a recursive forecast on lags.

Both are solved per category from sums of products, without a fit on the driver.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockwave.functions.linear import linear_value, solve, sums_of_products
from stockwave.operators.models import as_predictions
from stockwave.params import FORECAST_DAYS, TARGET

YEAR, WEEK = 365.25, 7.0
LAGS = (1, 7)
MEANS = (7,)


def season_inputs(origin: dt.date, yearly: int = 6, weekly: int = 3, date: Column | str = "date") -> list[Column]:
    """Years since ``origin`` as trend, and sine and cosine of the first multiples of a year's and a week's turn."""
    days = F.datediff(F.col(date) if isinstance(date, str) else date, F.lit(origin)).cast("double")
    turns = [(period, k) for period, n in ((YEAR, yearly), (WEEK, weekly)) for k in range(1, n + 1)]
    return [days / YEAR, *[f(days * (2 * math.pi * k / period)) for period, k in turns for f in (F.sin, F.cos)]]


def fit_seasonal(train: DataFrame, origin: dt.date, ridge: float = 1.0, multiplicative: bool = False, yearly: int = 6, weekly: int = 3) -> DataFrame:
    """(category, n_train, coefficients) of a trend with yearly and weekly seasons, by penalised least squares.

    ``multiplicative`` fits the logarithm of one plus the target, so that seasons scale with the level. Rows
    with a null target are left out.
    """
    inputs = season_inputs(origin, yearly, weekly)
    y = F.log1p(TARGET) if multiplicative else F.col(TARGET)
    sums = train.where(F.col(TARGET).isNotNull()).groupBy("category").agg(F.array(*sums_of_products(inputs, y)).alias("sums"))
    return sums.select("category", F.get("sums", F.lit(0)).cast("bigint").alias("n_train"), solve(F.col("sums"), len(inputs), ridge).alias("coefficients"))


def score_seasonal(model: DataFrame, rows: DataFrame, origin: dt.date, multiplicative: bool = False, yearly: int = 6, weekly: int = 3) -> DataFrame:
    """Predictions, never below 0, of rows whose category was fitted; settings as in the fit."""
    value = linear_value(F.col("coefficients"), season_inputs(origin, yearly, weekly))
    value = F.expm1(value) if multiplicative else value
    return as_predictions(rows.join(model.select("category", "coefficients"), "category"), "seasonal", F.greatest(value, F.lit(0.0)))


def recursive_inputs(past: Column, lags: Sequence[int], means: Sequence[int]) -> list[Column]:
    """Lags and means of the last values of an array, oldest first; 0 beyond its start, as in the feature matrix."""
    lagged = [F.coalesce(F.try_element_at(past, F.lit(-k)), F.lit(0.0)) for k in lags]

    def mean(w: int) -> Column:
        tail = F.slice(past, -F.least(F.lit(w), F.greatest(F.size(past), F.lit(1))), F.lit(w))
        return F.coalesce(F.try_divide(F.aggregate(tail, F.lit(0.0), lambda a, x: a + x), F.size(tail)), F.lit(0.0))

    return [*lagged, *[mean(w) for w in means]]


def lag_inputs(lags: Sequence[int] = LAGS, means: Sequence[int] = MEANS) -> list[str]:
    """The feature columns behind ``recursive_inputs``, in the same order."""
    return [*[f"{TARGET}_lag_{k}" for k in lags], *[f"{TARGET}_rolling_mean_{w}d" for w in means]]


def fit_lags(features: DataFrame, lags: Sequence[int] = LAGS, means: Sequence[int] = MEANS, ridge: float = 0.0) -> DataFrame:
    """(category, n_train, coefficients) of a linear model on lags and rolling means."""
    columns = lag_inputs(lags, means)
    sums = sums_of_products([F.col(c) for c in columns], F.col(TARGET))
    summed = features.select("category", TARGET, *columns).na.drop().groupBy("category").agg(F.array(*sums).alias("sums"))
    return summed.select("category", F.get("sums", F.lit(0)).cast("bigint").alias("n_train"), solve(F.col("sums"), len(columns), ridge).alias("coefficients"))


def recursive_forecast(
    history: DataFrame, model: DataFrame, days: int = FORECAST_DAYS, lags: Sequence[int] = LAGS, means: Sequence[int] = MEANS
) -> DataFrame:
    """(category, date, days_ahead, yhat): every day's prediction is an input of the next days'.

    The state of a category, its last values, is folded over the horizon inside one row, so a category's days need no
    join or window among each other. Predictions are never below 0. Categories without a model have none. Lags and means count
    present rows, as the features do.
    """
    depth = max([*lags, *means, 1])
    newest = Window.partitionBy("category").orderBy(F.desc("date"))
    tail = history.select("category", "date", F.col(TARGET).cast("double").alias("y"), F.row_number().over(newest).alias("nth")).where(F.col("nth") <= depth)
    states = tail.groupBy("category").agg(  # at most ``depth`` values
        F.max("date").alias("last_date"), F.transform(F.array_sort(F.collect_list(F.struct("date", "y"))), lambda r: r["y"]).alias("past")
    )

    def step(past: Column, _: Column) -> Column:
        value = F.greatest(linear_value(F.col("coefficients"), recursive_inputs(past, lags, means)), F.lit(0.0))
        return F.concat(past, F.array(value))

    path = F.aggregate(F.sequence(F.lit(1), F.lit(days)), F.col("past"), step)
    ahead = states.join(model.select("category", "coefficients"), "category").select(
        "category", "last_date", F.posexplode(F.slice(path, F.size("past") + 1, days)).alias("place", "yhat")
    )
    return ahead.select("category", F.date_add("last_date", F.col("place") + 1).alias("date"), (F.col("place") + 1).alias("days_ahead"), "yhat")
