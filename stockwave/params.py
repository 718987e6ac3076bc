"""Parameters of the pipeline. Every operator takes these as arguments; nothing is hard-wired."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# --- fixed values: column names ------------------------------------------------------------
TARGET = "order_count"
KEYS = ("date", "category")
EXOGENOUS = ("avg_price", "total_revenue", "avg_freight", "avg_review_score", "avg_installments")

# --- fixed values: feature settings --------------------------------------------------------
LAGS = (1, 2, 3, 7, 14, 21, 30)
ROLLING_WINDOWS = (7, 14, 30)
EXOGENOUS_LAGS = (1, 7, 14)
SEQUENCE_LENGTH = 30
FORECAST_DAYS = 90
RANDOM_SEED = 42

# --- fixed values: public holidays of the studied market -----------------------------------
HOLIDAYS = tuple(
    dt.date.fromisoformat(day)
    for day in (
        "2016-11-15", "2016-12-25",
        "2017-01-01", "2017-02-25", "2017-04-14", "2017-05-01", "2017-06-15", "2017-09-07",
        "2017-10-12", "2017-11-02", "2017-11-15", "2017-12-25",
        "2018-01-01", "2018-02-10", "2018-03-30", "2018-05-01", "2018-05-31", "2018-09-07",
        "2018-10-12",
    )
)

# --- fixed values: columns of the order-item fact that forecasting never reads --------------
UNUSED_COLUMNS = (
    "order_status", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
    "customer_id", "customer_unique_id", "customer_zip_code_prefix", "seller_zip_code_prefix",
    "product_description_length", "product_photos_qty", "product_weight_g",
    "product_length_cm", "product_height_cm", "product_width_cm",
)

# --- fixed values: blend weights used when no validation error is known ----------------------
STATIC_WEIGHTS = {"mean_baseline": 0.25, "boosted": 0.40, "sequence": 0.35}


def yearly_holidays(first_year: int, last_year: int) -> tuple[dt.date, ...]:
    """The holidays that fall on the same month and day every year, for a span of years."""
    month_days = ((1, 1), (5, 1), (9, 7), (10, 12), (11, 2), (11, 15), (12, 25))
    return tuple(dt.date(y, m, d) for y in range(first_year, last_year + 1) for m, d in month_days)


# --- fixed values: split dates and boosting settings -----------------------------------------
@dataclass(frozen=True)
class SplitDates:
    """Inclusive bounds of the chronological train / validation / test split."""

    train: tuple[str, str] = ("2016-09-01", "2018-06-30")
    val: tuple[str, str] = ("2018-07-01", "2018-08-31")
    test: tuple[str, str] = ("2018-09-01", "2018-10-31")

    def items(self) -> tuple[tuple[str, tuple[str, str]], ...]:
        return (("train", self.train), ("val", self.val), ("test", self.test))


@dataclass(frozen=True)
class BoostingParams:
    """Settings of the gradient-boosted regressor."""

    trees: int = 500
    learning_rate: float = 0.05
    depth: int = 6
    row_share: float = 0.8
    column_share: float = 0.8
    patience: int = 20
    seed: int = RANDOM_SEED


@dataclass(frozen=True)
class Scenario:
    """Limits and cost rates of one replenishment plan. Zero or None means "use the default"."""

    name: str = "base"
    storage_capacity: float | None = None
    budget: float | None = None
    service_level: float | None = None
    holding_rate: float | None = None
    stockout_rate: float | None = None


# --- fixed values: plan defaults ------------------------------------------------------------
PLAN_DEFAULTS = {
    "storage_capacity": 10_000.0,
    "budget": 500_000.0,
    "service_level": 0.95,
    "holding_rate": 0.25,
    "stockout_rate": 0.40,
}
ITEM_DEFAULTS = {
    "forecast_demand": 0.0,
    "current_stock": 100.0,
    "unit_cost": 50.0,
    "selling_price": 80.0,
    "lead_time_days": 7,
    "storage_per_unit": 1.0,
}

# --- fixed values: demand variation and price markup assumed where none is known --------------
DEMAND_VARIATION = 0.3
PRICE_MARKUP = 1.6
