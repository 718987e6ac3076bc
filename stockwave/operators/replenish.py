"""Cost-minimising reorder plans under storage, budget and service-level limits.

The plan minimises  sum h*c*(I/2 + Q) + s*c*S  with S >= D - I - Q, sum w*Q <= storage,
sum c*Q <= budget and I + Q >= D + z*sigma*sqrt(L/30). Its solution needs no solver:

* every item needs at least  need = max(0, D + safety - I);  if the needs alone break a limit the
  plan is infeasible, and the needs are reported;
* with z >= 0 the needs leave no shortage and more stock only costs, so Q = need;
* with z < 0 and s > h each further unit of money spent on an item that is still short saves
  (s - h), so the remaining money goes to the items with most money per unit of storage first.

So a plan is a projection plus one sum per scenario; only the last case ranks items.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockwave.functions.numeric import half_even, normal_quantile, normal_quantile_scalar
from stockwave.functions.skew import salted_join
from stockwave.params import (
    DEMAND_VARIATION,
    ITEM_DEFAULTS,
    PLAN_DEFAULTS,
    PRICE_MARKUP,
    TARGET,
    Scenario,
)

BUCKETS_PER_OCTAVE = 64
SLICES_PER_BUCKET = 4096
UNLIMITED_BUCKET = 1 << 20
BROADCAST_KEYS = 10_000  # sums of so many scenarios are small


# --- items -----------------------------------------------------------------------------------


def first_present(df: DataFrame, names: Sequence[str], default: Column) -> Column:
    """First non-null of the columns that exist, else the default."""
    return F.coalesce(*[F.col(n) for n in names if n in df.columns], default)


def items_from_forecast(forecast: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Planning items from rows with a category and a demand; absent or null fields get defaults.

    ``keep`` names further columns to carry along, such as a request id.
    """

    def field(name: str, kind: str) -> Column:
        return first_present(forecast, (name,), F.lit(ITEM_DEFAULTS[name])).cast(kind).alias(name)

    demand = first_present(
        forecast, ("forecast_demand", "predicted_orders", TARGET), F.lit(ITEM_DEFAULTS["forecast_demand"])
    ).cast("double")
    return forecast.select(
        *keep,
        first_present(forecast, ("category", "product_category_name_english"), F.lit("unknown")).alias("category"),
        demand.alias("forecast_demand"),
        first_present(forecast, ("forecast_std",), demand * DEMAND_VARIATION).cast("double").alias("forecast_std"),
        field("current_stock", "double"),
        field("unit_cost", "double"),
        field("selling_price", "double"),
        field("lead_time_days", "int"),
        field("storage_per_unit", "double"),
    )


def cost_config(categories: DataFrame, panel: DataFrame) -> DataFrame:
    """Cost and price per category from its mean daily price; defaults where it was never sold."""
    prices = panel.groupBy(F.col("category").alias("_priced")).agg(F.avg("avg_price").alias("_price"))
    cost = half_even(F.coalesce("_price", F.lit(ITEM_DEFAULTS["unit_cost"])), 2)
    return (
        categories.select("category")
        .join(prices, F.col("category") == F.col("_priced"), "left")
        .select("category", cost.alias("unit_cost"))
        .select(
            "category",
            "unit_cost",
            half_even(F.col("unit_cost") * PRICE_MARKUP, 2).alias("selling_price"),
            F.lit(ITEM_DEFAULTS["current_stock"]).alias("current_stock"),
            F.lit(ITEM_DEFAULTS["storage_per_unit"]).alias("storage_per_unit"),
        )
    )


def items_from_profile(
    config: DataFrame, profile: DataFrame, lead_time_days: int = ITEM_DEFAULTS["lead_time_days"], default_demand: float = 100.0
) -> DataFrame:
    """Planning items from costs and a monthly demand profile; the deviation is at least 1."""
    demand = F.coalesce("monthly_forecast", F.lit(default_demand)).cast("double")
    known = F.col("monthly_forecast").isNotNull()
    std = F.when(known, F.coalesce("demand_std", F.lit(1.0))).otherwise(demand * DEMAND_VARIATION)
    return config.join(profile.select("category", "monthly_forecast", "demand_std"), "category", "left").select(
        "category",
        demand.alias("forecast_demand"),
        F.greatest(std, F.lit(1.0)).alias("forecast_std"),
        "current_stock",
        "unit_cost",
        "selling_price",
        F.lit(lead_time_days).alias("lead_time_days"),
        "storage_per_unit",
    )


# --- limits ----------------------------------------------------------------------------------


def with_scenarios(items: DataFrame, scenarios: Sequence[Scenario]) -> DataFrame:
    """Repeat every item once per scenario of a short list; the limits travel as literals."""
    rows = []
    for s in scenarios:
        limits = {k: float(getattr(s, k) or default) for k, default in PLAN_DEFAULTS.items()}
        z = normal_quantile_scalar(limits["service_level"])
        rows.append(
            F.struct(
                F.lit(s.name).alias("scenario"), *[F.lit(v).alias(k) for k, v in limits.items()], F.lit(z).alias("z")
            )
        )
    return items.select("*", F.explode(F.array(*rows)).alias("_s")).select(*items.columns, "_s.*")


def with_request_limits(requests: DataFrame) -> DataFrame:
    """Effective limits of a request table: null and 0 mean the default; z per row."""
    limits = []
    for name, default in PLAN_DEFAULTS.items():
        given = F.nullif(F.col(name).cast("double"), F.lit(0.0)) if name in requests.columns else F.lit(None).cast("double")
        limits.append(F.coalesce(given, F.lit(default)).alias(name))
    others = [c for c in requests.columns if c not in PLAN_DEFAULTS]
    full = requests.select(*others, *limits)
    return full.select("*", normal_quantile(F.col("service_level")).alias("z"))


# --- plan ------------------------------------------------------------------------------------


def safety_stock() -> Column:
    """z * sigma * sqrt(lead time in months)."""
    return F.col("z") * F.col("forecast_std") * F.sqrt(F.col("lead_time_days") / F.lit(30.0))


def _before(total: str, *partition: str, order: str) -> Column:
    """Sum of ``total`` over the rows ranked ahead."""
    ahead = Window.partitionBy(*partition).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(total).over(ahead), F.lit(0.0))


def _fill_shares(candidates: DataFrame, key: str) -> DataFrame:
    """Share of the fillable room each storage density gets, per scenario.

    Items with equal money per unit of storage are interchangeable and share alike, so they are
    summed first and a density held by most items is one row. No running sum goes over all items:
    densities fall into logarithmic buckets (at most 64 for each of the 2,098 binary orders of
    magnitude of a double), each bucket into 4,096 slices, and the sums run over the buckets, over
    the slices of a bucket, and over the densities of one slice.
    """
    groups = candidates.groupBy(key, "_density").agg(
        F.sum(F.col("unit_cost") * F.col("_room")).alias("_money"),
        F.sum(F.col("storage_per_unit") * F.col("_room")).alias("_volume"),
        F.max("_money_left").alias("_money_left"),
        F.max("_volume_left").alias("_volume_left"),
    )
    limited = F.col("_density") < F.lit(float("inf"))
    scale = F.when(limited, F.log2("_density") * BUCKETS_PER_OCTAVE)
    groups = groups.withColumn("_bucket", F.coalesce(F.floor(scale).cast("int"), F.lit(UNLIMITED_BUCKET))).withColumn(
        "_slice", F.coalesce(F.floor((scale - F.floor(scale)) * SLICES_PER_BUCKET).cast("int"), F.lit(0))
    )
    sums = (F.sum("_money").alias("_money"), F.sum("_volume").alias("_volume"))
    slices = groups.groupBy(key, "_bucket", "_slice").agg(*sums)
    buckets = slices.groupBy(key, "_bucket").agg(*sums).select(
        key,
        "_bucket",
        _before("_money", key, order="_bucket").alias("_bucket_money"),
        _before("_volume", key, order="_bucket").alias("_bucket_volume"),
    )
    offsets = slices.join(buckets, [key, "_bucket"]).select(
        key,
        "_bucket",
        "_slice",
        (F.col("_bucket_money") + _before("_money", key, "_bucket", order="_slice")).alias("_slice_money"),
        (F.col("_bucket_volume") + _before("_volume", key, "_bucket", order="_slice")).alias("_slice_volume"),
    )
    place = (key, "_bucket", "_slice")
    placed = groups.join(offsets, list(place)).select(
        "*",
        (F.col("_slice_money") + _before("_money", *place, order="_density")).alias("_money_used"),
        (F.col("_slice_volume") + _before("_volume", *place, order="_density")).alias("_volume_used"),
    )
    by_money = (F.col("_money_left") - F.col("_money_used")) / F.col("_money")
    by_volume = F.when(F.col("_volume") > 0.0, (F.col("_volume_left") - F.col("_volume_used")) / F.col("_volume"))
    share = F.greatest(F.least(by_money, F.coalesce(by_volume, F.lit(1.0)), F.lit(1.0)), F.lit(0.0))
    return placed.select(key, "_density", share.alias("_share"))


def solve_plan(
    items: DataFrame, key: str = "scenario", low_service: bool = False, n_keys: int | None = None,
    hot: DataFrame | None = None, slot: str | None = None,
) -> DataFrame:
    """Exact optimal order quantities, unrounded, for items that carry their limits.

    ``items`` is read by a sum per scenario and by the projection; pass a stored table when it is
    costly. The sums of a list of scenarios, whose length ``n_keys`` the caller knows, are broadcast up to
    ``BROADCAST_KEYS`` of them, so items are not shuffled by one of a few names. Otherwise they meet their items in a join
    that is salted by the ``hot`` keys and the ``slot`` column of the items, where these are given. ``low_service`` adds the filling step that scenarios with a service level under one
    half need; it changes nothing for the others.
    """
    demand, stock, cost = F.col("forecast_demand"), F.col("current_stock"), F.col("unit_cost")
    needed = items.withColumn("safety_stock", safety_stock()).withColumn(
        "_need", F.greatest(F.lit(0.0), demand + F.col("safety_stock") - stock)
    )
    loads = needed.groupBy(key).agg(
        F.sum(F.col("storage_per_unit") * F.col("_need")).alias("_volume_need"),
        F.sum(cost * F.col("_need")).alias("_money_need"),
    )
    fits = (F.col("_volume_need") <= F.col("storage_capacity")) & (F.col("_money_need") <= F.col("budget"))
    if n_keys is not None and n_keys <= BROADCAST_KEYS:
        joined = needed.join(F.broadcast(loads), key)
    else:
        joined = needed.join(loads, key) if hot is None else salted_join(needed, loads, key, hot=hot, slot=slot)
    base = joined.withColumn("status", F.when(fits, "Optimal").otherwise("Infeasible"))
    quantity = F.col("_need")
    if low_service:
        short = F.greatest(F.lit(0.0), demand - stock)
        fillable = (
            (F.col("z") < 0.0)
            & (F.col("stockout_rate") > F.col("holding_rate"))
            & (cost > 0.0)
            & (F.col("status") == "Optimal")
        )
        density = F.when(F.col("storage_per_unit") > 0.0, cost / F.col("storage_per_unit")).otherwise(
            F.lit(float("inf"))
        )
        base = base.select(
            "*",
            F.when(fillable, F.greatest(F.lit(0.0), short - F.col("_need"))).otherwise(0.0).alias("_room"),
            density.alias("_density"),
            (F.col("budget") - F.col("_money_need")).alias("_money_left"),
            (F.col("storage_capacity") - F.col("_volume_need")).alias("_volume_left"),
        )
        shares = _fill_shares(base.where(F.col("_room") > 0.0), key)
        base = base.join(shares, [key, "_density"], "left")
        quantity = quantity + F.col("_room") * F.coalesce("_share", F.lit(0.0))
    solved = base.withColumn("reorder_quantity", quantity)
    ordered = F.col("reorder_quantity")
    return solved.select(
        *items.columns,
        "status",
        "safety_stock",
        (demand + F.col("safety_stock")).alias("reorder_point"),
        "reorder_quantity",
        F.greatest(F.lit(0.0), demand - stock - ordered).alias("shortage"),
        (F.col("holding_rate") * cost * (stock / 2.0 + ordered)).alias("holding_cost"),
        (F.col("stockout_rate") * cost * F.greatest(F.lit(0.0), demand - stock - ordered)).alias("stockout_cost"),
    )


def plan_report(plan: DataFrame, key: str = "scenario") -> DataFrame:
    """The plan rounded for reading: whole units, money to two digits."""
    units = ("current_stock", "forecast_demand", "reorder_quantity", "reorder_point", "safety_stock")
    return plan.select(
        key,
        "category",
        "status",
        *[half_even(F.col(c)).alias(c) for c in units],
        half_even(F.col("forecast_std"), 1).alias("forecast_std"),
        half_even(F.col("current_stock") + F.col("reorder_quantity")).alias("total_inventory_after_order"),
        half_even(F.col("unit_cost"), 2).alias("unit_cost"),
        half_even(F.col("holding_cost"), 2).alias("holding_cost"),
    )


def plan_totals(plan: DataFrame, key: str = "scenario") -> DataFrame:
    """Totals per scenario; cost comes from the unrounded quantities, units from the report."""
    rounded = half_even(F.col("reorder_quantity"))
    after = half_even(F.col("current_stock") + F.col("reorder_quantity"))
    return plan.groupBy(key).agg(
        F.max("status").alias("status"),
        F.count(F.lit(1)).alias("n_items"),
        F.sum(rounded).alias("total_reorder"),
        F.sum(after).alias("total_inventory_after_order"),
        half_even(F.sum("holding_cost"), 2).alias("total_holding_cost"),
        half_even(F.sum("stockout_cost"), 2).alias("total_stockout_cost"),
        half_even(F.sum(F.col("holding_cost") + F.col("stockout_cost")), 2).alias("total_cost"),
    )


def naive_comparison(plan: DataFrame, key: str = "scenario") -> DataFrame:
    """Cost of ordering the full demand on top of the stock, against the plan."""
    naive = F.sum(F.col("holding_rate") * F.col("unit_cost") * (F.col("current_stock") + F.col("forecast_demand")))
    optimal = F.sum(F.col("holding_cost") + F.col("stockout_cost"))
    return plan.groupBy(key).agg(
        half_even(naive, 2).alias("naive_cost"),
        half_even(optimal, 2).alias("optimal_cost"),
        half_even(F.try_divide(naive - optimal, naive) * 100, 1).alias("saving_pct"),
    )
