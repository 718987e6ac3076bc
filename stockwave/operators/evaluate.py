"""Scores of predictions. Input is long: (category, date, model, y, yhat)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockwave.functions.numeric import half_even


def forecast_metrics(predictions: DataFrame, keys: Sequence[str] = ("category", "model")) -> DataFrame:
    """MAPE over non-zero actuals (0 when there is none), RMSE and MAE, to two digits."""
    error = F.col("y") - F.col("yhat")
    share = F.abs(F.try_divide(error, F.nullif(F.col("y").cast("double"), F.lit(0.0))))
    return predictions.groupBy(*keys).agg(
        half_even(F.coalesce(F.avg(share) * 100, F.lit(0.0)), 2).alias("mape"),
        half_even(F.sqrt(F.avg(error * error)), 2).alias("rmse"),
        half_even(F.avg(F.abs(error)), 2).alias("mae"),
    )


def metrics_macro(metrics: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Unweighted means over categories."""
    return metrics.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_categories"),
        F.avg("mape").alias("avg_mape"),
        F.avg("rmse").alias("avg_rmse"),
        F.avg("mae").alias("avg_mae"),
    )


def improvement_over(metrics: DataFrame, baseline: str = "lag1") -> DataFrame:
    """Mean MAPE of each model and how far, in percent, it is below that of a baseline model."""
    macro = metrics.groupBy("model").agg(F.avg("mape").alias("avg_mape"))  # one row per model
    base = F.max(F.when(F.col("model") == baseline, F.col("avg_mape"))).over(Window.partitionBy())
    gain = F.try_divide(base - F.col("avg_mape"), base) * 100
    return macro.select("model", "avg_mape", half_even(gain, 2).alias("improvement_pct"))


def leaderboard(metrics: DataFrame, target: float = 15.0) -> DataFrame:
    """Metrics by ascending MAPE, with a flag for rows below the target."""
    ties = [c for c in ("category", "model") if c in metrics.columns]
    return metrics.withColumn("meets_target", F.col("mape") < target).orderBy("mape", *ties)


def residuals(predictions: DataFrame) -> DataFrame:
    """Forecast against actual with the residual."""
    return predictions.withColumn("residual", F.col("y") - F.col("yhat"))


def residual_stats(predictions: DataFrame, keys: Sequence[str] = ("category", "model")) -> DataFrame:
    """Mean and population deviation of the residuals."""
    return residuals(predictions).groupBy(*keys).agg(
        F.avg("residual").alias("residual_mean"), F.stddev_pop("residual").alias("residual_std")
    )


def histogram(df: DataFrame, column: str, bins: int, keys: Sequence[str]) -> DataFrame:
    """Equal-width histogram between the extremes of each group; empty bins are kept.

    The maximum belongs to the last bin, and a group with one distinct value is widened by half a
    unit on both sides. The extremes come from a first aggregation, so the values are read twice;
    the counts are then combined before the shuffle.
    """
    bounds = df.groupBy(*keys).agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    flat = F.col("_lo") == F.col("_hi")
    bounds = bounds.select(
        *keys,
        F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).cast("double").alias("lo"),
        F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).cast("double").alias("hi"),
    )
    slot = F.least(
        F.width_bucket(F.col(column).cast("double"), F.col("lo"), F.col("hi"), F.lit(bins)), F.lit(bins)
    ).cast("int")
    counts = df.join(bounds, list(keys)).groupBy(*keys, slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (F.col("hi") - F.col("lo")) / bins
    spine = bounds.select("*", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    return spine.join(counts, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * width).alias("lower"),
        (F.col("lo") + F.col("bin") * width).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
