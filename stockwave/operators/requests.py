"""Validation and batch answering of forecast and plan requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockwave.functions.numeric import half_even
from stockwave.functions.skew import hot_keys, row_slots, salted_join
from stockwave.operators.replenish import items_from_forecast, solve_plan, with_request_limits
from stockwave.session import stage

# Request defaults and bounds.
DEFAULT_DAYS, MIN_DAYS, MAX_DAYS = 30, 1, 365
DEFAULT_SERVICE_LEVEL = 0.95


def _report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add the list of broken rules and a valid flag; a null value breaks no rule."""
    broken = F.concat_ws(",", *[F.when(~F.coalesce(ok, F.lit(True)), F.lit(name)) for name, ok in rules.items()])
    return df.withColumn("errors", broken).withColumn("valid", F.col("errors") == "")


def validate_forecast_requests(requests: DataFrame) -> DataFrame:
    """(category, days) requests: days default to 30 and must lie between 1 and 365."""
    filled = requests.withColumn("days", F.coalesce("days", F.lit(DEFAULT_DAYS)))
    return _report(
        filled,
        {"category": F.col("category").isNotNull(), "days": F.col("days").between(MIN_DAYS, MAX_DAYS)},
    )


def validate_plan_requests(requests: DataFrame) -> DataFrame:
    """Limits must not be negative; the service level must lie in [0, 1)."""
    level = F.coalesce("service_level", F.lit(DEFAULT_SERVICE_LEVEL))
    return _report(
        requests.withColumn("service_level", level),
        {
            "storage_capacity": F.col("storage_capacity") >= 0,
            "budget": F.col("budget") >= 0,
            "service_level": (F.col("service_level") >= 0) & (F.col("service_level") < 1),
        },
    )


def validate_items(items: DataFrame) -> DataFrame:
    """Stock, cost, price and storage must not be negative."""
    names = [c for c in ("current_stock", "unit_cost", "selling_price", "storage_per_unit") if c in items.columns]
    return _report(items, {c: F.col(c) >= 0 for c in names})


def answer_forecast_requests(requests: DataFrame, forecast: DataFrame) -> DataFrame:
    """Rows of a precomputed forecast (days_ahead, category, ...) asked for by valid requests.

    A request is answered for all the days it asks, so the forecast should reach ``MAX_DAYS`` ahead.
    ``unanswered_days`` tells whether it did.
    """
    wanted = validate_forecast_requests(requests).where("valid").select("request_id", "category", "days")
    return wanted.join(forecast, "category").where(F.col("days_ahead") <= F.col("days"))


def unanswered_days(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """Answered requests with fewer rows than days asked; none where the forecast reaches far enough."""
    got = answers.groupBy("request_id").agg(F.count(F.lit(1)).alias("n"))
    asked = validate_forecast_requests(requests).where("valid").select("request_id", "category", "days")
    return asked.join(got, "request_id").where(F.col("n") < F.col("days"))


def summarise_answers(answers: DataFrame) -> DataFrame:
    """Whole orders and daily mean per answered request, from the unrounded forecast."""
    return answers.groupBy("request_id", "category").agg(
        F.count(F.lit(1)).alias("forecast_days"),
        F.sum("blended").cast("bigint").alias("total_forecast_orders"),
        half_even(F.avg("blended"), 1).alias("avg_daily_forecast"),
    )


def rejected_forecast_requests(requests: DataFrame, categories: DataFrame) -> DataFrame:
    """Requests that break a rule or name a category without a forecast, with the reason."""
    checked = validate_forecast_requests(requests)
    known = categories.select("category").distinct().withColumn("_known", F.lit(True))
    reason = F.when(F.col("valid"), F.lit("unknown category")).otherwise(F.col("errors"))
    return (
        checked.join(known, "category", "left")
        .where(~F.col("valid") | F.col("_known").isNull())
        .select("request_id", "category", "days", reason.alias("errors"))
    )


def reorder_batch(requests: DataFrame, items: DataFrame) -> DataFrame:
    """Plans for all valid requests in one job; ``items`` holds the items of each request.

    Both tables carry ``request_id``. Items without a demand or other fields get the defaults.
    Rejected requests and items take no part; ``rejected_plan_requests`` lists them. ``items`` is a stored
    table: its items meet their limits, and then the sums of their request, in salted joins, so a request with most
    items is many tasks, and sums per request are combined before they are shuffled.
    """
    limits = with_request_limits(validate_plan_requests(requests).where("valid").drop("valid", "errors"))
    sound = validate_items(items).where("valid").drop("valid", "errors")
    hot = stage(hot_keys(items, "request_id"), "hot-requests")
    full = items_from_forecast(sound, keep=("request_id",)).withColumn("_slot", row_slots())
    limited = salted_join(full, limits, "request_id", hot=hot, slot="_slot")
    return solve_plan(limited, "request_id", low_service=True, hot=hot, slot="_slot").drop("_slot")


def rejected_plan_requests(requests: DataFrame, items: DataFrame) -> DataFrame:
    """What ``reorder_batch`` leaves out: (request_id, category, errors), category null for a whole request.

    Requests that break a rule, requests without a sound item, items that break a rule, and items
    of a request that is not there.
    """
    asked = validate_plan_requests(requests).select("request_id", F.col("valid").alias("_asked"), "errors")
    checked = validate_items(items)
    whole = F.lit(None).cast("string").alias("category")
    broken = asked.where(~F.col("_asked")).select("request_id", whole, "errors")
    sound = checked.where("valid").select("request_id").distinct()
    empty = asked.where("_asked").join(sound, "request_id", "left_anti").select("request_id", whole, F.lit("no items").alias("errors"))
    wrong = checked.where(~F.col("valid")).select("request_id", "category", "errors")
    known = asked.select("request_id").distinct()
    stray = checked.where("valid").join(known, "request_id", "left_anti").select("request_id", "category", F.lit("unknown request").alias("errors"))
    return broken.unionByName(empty).unionByName(wrong).unionByName(stray)
