"""Summaries that are stored once and merge: quantiles of forecast errors, distinct orders.

A sketch has a bounded size however many rows it saw, and sketches of parts give that of the whole. So
bands over any span of days ahead, and distinct counts over any roll-up, come from the stored sketches
without reading predictions or order items again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockwave.functions.skew import salted_join
from stockwave.operators import ingest
from stockwave.operators.features import series
from stockwave.params import TARGET

ERRORS_KEPT = 4096  # of a quantile sketch; up to so many errors its quantiles are exact
BEYOND = 1e308  # larger than any error
REGISTERS = 14  # binary logarithm of a distinct sketch's registers: a standard error of 0.8 percent

# --- bands from errors -----------------------------------------------------------------------


def snapshot_predictions(daily: DataFrame, days: int, window: int = 7) -> DataFrame:
    """(category, origin, date, days_ahead, y, yhat) from every day of a panel without gaps.

    As in the forecast, one frozen snapshot, the mean of the last ``window`` days, speaks for all days ahead.
    Days beyond the end of the panel have no actual and are left out.
    """
    mean = F.avg(TARGET).over(series().rowsBetween(1 - window, 0))
    later = [F.struct(F.lit(h).alias("days_ahead"), F.lead(TARGET, h).over(series()).cast("double").alias("y")) for h in range(1, days + 1)]
    rows = daily.select("category", F.col("date").alias("origin"), mean.alias("yhat"), F.array(*later).alias("later"))
    each = rows.select("category", "origin", "yhat", F.explode("later").alias("l")).where(F.col("l.y").isNotNull())
    return each.select("category", "origin", F.date_add("origin", F.col("l.days_ahead")).alias("date"), "l.days_ahead", "l.y", "yhat")


def error_sketches(predictions: DataFrame, keys: Sequence[str] = ("category", "days_ahead"), kept: int = ERRORS_KEPT) -> DataFrame:
    """Per key: number of absolute errors and a mergeable sketch of them. Rows without actual or prediction are left out."""
    error = F.abs(F.col("y") - F.col("yhat"))
    return predictions.where(error.isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(error, kept).alias("errors"))


def merge_error_sketches(sketches: DataFrame, keys: Sequence[str], kept: int = ERRORS_KEPT) -> DataFrame:
    """The sketches of coarser keys, from stored ones."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("errors", kept).alias("errors"))


def conformal_radius(sketches: DataFrame, level: float) -> Column:
    """The error that a new one stays below with at least the chance ``level``, if errors are exchangeable.

    Of n errors it is number ceil((n + 1) level) by size: the quantile of the errors and one beyond them all. It is
    null where n is too small for that.
    """
    beyond = sketches.sparkSession.range(1).agg(F.kll_sketch_agg_double(F.lit(BEYOND), ERRORS_KEPT)).scalar()
    radius = F.kll_sketch_get_quantile_double(F.kll_sketch_merge_double("errors", beyond), F.lit(level))
    return F.nullif(radius, F.lit(BEYOND))


def with_band(predictions: DataFrame, sketches: DataFrame, keys: Sequence[str], level: float = 0.9) -> DataFrame:
    """Predictions with ``radius``, ``lower`` (never below 0) and ``upper``; null where errors are too few."""
    radii = sketches.select(*keys, conformal_radius(sketches, level).alias("radius"))
    found = predictions.join(radii, list(keys), "left")
    return found.select("*", F.greatest(F.col("yhat") - F.col("radius"), F.lit(0.0)).alias("lower"), (F.col("yhat") + F.col("radius")).alias("upper"))


def band_coverage(banded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with an actual and a band, the share of actuals within it, and its mean radius."""
    inside = F.col("y").between(F.col("lower"), F.col("upper"))
    rows = banded.where(F.col("y").isNotNull() & F.col("radius").isNotNull())
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(inside.cast("double")).alias("coverage"), F.avg("radius").alias("radius"))


# --- distinct orders -------------------------------------------------------------------------


def order_days(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(order_id, date, category) per item of a cleaned order."""
    orders = ingest.clean_orders(tables["orders"].select("order_id", "order_status", ingest.PURCHASED))
    lines = salted_join(tables["order_items"].select("order_id", "product_id"), orders.select("order_id", F.to_date(ingest.PURCHASED).alias("date")), "order_id")
    return ingest.with_category(lines, tables).select("order_id", "date", F.coalesce(F.col(ingest.ENGLISH).cast("string"), F.lit(ingest.UNKNOWN)).alias("category"))


def order_sketches(orders: DataFrame, keys: Sequence[str] = ("date", "category")) -> DataFrame:
    """Per key a mergeable sketch of its distinct orders: one small row, whatever the number of items."""
    return orders.groupBy(*keys).agg(F.hll_sketch_agg(F.col("order_id").cast("string"), REGISTERS).alias("orders"))


def distinct_orders(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Estimated distinct orders of a roll-up: an order in several days or categories counts once."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("orders")).alias("n_orders"))
