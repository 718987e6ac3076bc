"""Features of the daily panel (one row per date and category).

All per-category windows share one specification, so they run on a single shuffle and sort. A
category partition holds at most one row per day, which bounds every window whatever the number
of orders behind it. Lags and rolling windows count present rows, not calendar days; ``densify``
adds the missing days when calendar semantics are wanted.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from stockwave.functions.calendar import calendar_columns, is_holiday, onehot_columns
from stockwave.params import (
    EXOGENOUS,
    EXOGENOUS_LAGS,
    HOLIDAYS,
    LAGS,
    ROLLING_WINDOWS,
    TARGET,
    SplitDates,
)

NOT_FEATURES = (TARGET, "date", "category", "product_category_name")


def series() -> WindowSpec:
    """The rows of one category in date order."""
    return Window.partitionBy("category").orderBy("date")


def lag_columns(columns: Sequence[str] = (TARGET,), lags: Sequence[int] = LAGS) -> list[Column]:
    """Values of the k-th previous row of the category."""
    rows = series()
    return [F.lag(c, k).over(rows).alias(f"{c}_lag_{k}") for c in columns for k in lags]


def rolling_columns(columns: Sequence[str] = (TARGET,), windows: Sequence[int] = ROLLING_WINDOWS) -> list[Column]:
    """Mean and sample deviation of the previous rows, the current one excluded.

    The deviation of a single previous row, and of none, is 0.
    """
    out = []
    for w in windows:
        previous = series().rowsBetween(-w, -1)
        for c in columns:
            out.append(F.avg(c).over(previous).alias(f"{c}_rolling_mean_{w}d"))
            out.append(F.coalesce(F.stddev_samp(c).over(previous), F.lit(0.0)).alias(f"{c}_rolling_std_{w}d"))
    return out


def filled_columns(columns: Sequence[str]) -> list[Column]:
    """Last known values; rows before the first known value take that first value.

    The second frame spans the whole partition so that it is evaluated once per category.
    """
    past = series().rowsBetween(Window.unboundedPreceding, 0)
    whole = series().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return [
        F.coalesce(F.last(c, ignorenulls=True).over(past), F.first(c, ignorenulls=True).over(whole)).alias(c)
        for c in columns
    ]


def add_lag_features(panel: DataFrame, columns: Sequence[str] = (TARGET,), lags: Sequence[int] = LAGS) -> DataFrame:
    return panel.select("*", *lag_columns(columns, lags))


def add_rolling_features(
    panel: DataFrame, columns: Sequence[str] = (TARGET,), windows: Sequence[int] = ROLLING_WINDOWS
) -> DataFrame:
    return panel.select("*", *rolling_columns(columns, windows))


def add_seasonal_features(panel: DataFrame) -> DataFrame:
    return panel.select("*", *calendar_columns(), *onehot_columns())


def add_exogenous_features(
    panel: DataFrame, columns: Sequence[str] = EXOGENOUS, lags: Sequence[int] = EXOGENOUS_LAGS
) -> DataFrame:
    """Fill the gaps of the exogenous columns, then add their lags."""
    present = [c for c in columns if c in panel.columns]
    kept = [c for c in panel.columns if c not in present]
    filled = panel.select(*kept, *filled_columns(present))
    return filled.select("*", *lag_columns(present, lags))


def holiday_calendar(panel: DataFrame, holidays: Sequence[dt.date] = HOLIDAYS) -> DataFrame:
    """Per present date: holiday flags of the previous, this and the next present date.

    One row per calendar day, so the window without partitions and the broadcast by the caller
    are bounded by the length of the calendar (365 rows a year).
    """
    dates = panel.groupBy("date").agg(F.min("category").alias("_first"), F.max("category").alias("_last"))
    order = Window.orderBy("date")
    return dates.select(
        "date",
        "_first",
        "_last",
        is_holiday(F.lead("date").over(order), holidays).alias("_next"),
        is_holiday(F.lag("date").over(order), holidays).alias("_previous"),
    )


def add_holiday_feature(panel: DataFrame, holidays: Sequence[dt.date] = HOLIDAYS, mode: str = "row") -> DataFrame:
    """0/1 flags for a holiday, the eve of one and the day after one.

    ``row`` looks at the neighbouring row of the table sorted by date and category: inside a date
    the neighbour shares the date, and only the last (first) category of a date sees the next
    (previous) present date. ``calendar`` looks one calendar day ahead and back for every row.
    In row mode the panel is read twice; pass a stored one.
    """
    today = is_holiday(F.col("date"), holidays)
    if mode == "calendar":
        return panel.select(
            "*",
            today.alias("is_holiday"),
            is_holiday(F.date_add("date", 1), holidays).alias("pre_holiday"),
            is_holiday(F.date_sub("date", 1), holidays).alias("post_holiday"),
        )
    if mode != "row":
        raise ValueError(f"mode must be 'row' or 'calendar', got {mode!r}")
    days = F.broadcast(holiday_calendar(panel, holidays))  # one row per calendar day
    return panel.join(days, "date").select(
        *panel.columns,
        today.alias("is_holiday"),
        F.when(F.col("category") == F.col("_last"), F.col("_next")).otherwise(today).alias("pre_holiday"),
        F.when(F.col("category") == F.col("_first"), F.col("_previous")).otherwise(today).alias("post_holiday"),
    )


def densify(panel: DataFrame) -> DataFrame:
    """Add the missing days of every category, between its first and last day, with zero orders."""
    spans = panel.groupBy("category").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    spine = spans.select("category", F.explode(F.sequence("lo", "hi")).alias("date"))
    return spine.join(panel, ["date", "category"], "left").fillna(0, [TARGET]).select(*panel.columns)


def feature_matrix(
    panel: DataFrame,
    holidays: Sequence[dt.date] = HOLIDAYS,
    holiday_mode: str = "row",
    fill: bool = True,
    leak_free: bool = False,
) -> DataFrame:
    """The panel with its 61 features; ``leak_free`` leaves out same-day exogenous values."""
    exogenous = [c for c in EXOGENOUS if c in panel.columns]
    kept = [c for c in panel.columns if c not in exogenous]
    flagged = add_holiday_feature(panel, holidays, holiday_mode)
    windowed = flagged.select(
        *kept,
        *filled_columns(exogenous),
        *lag_columns(),
        *rolling_columns(),
        *calendar_columns(),
        *onehot_columns(),
        "is_holiday",
        "pre_holiday",
        "post_holiday",
    )
    full = windowed.select("*", *lag_columns(exogenous, EXOGENOUS_LAGS))
    if leak_free:
        full = full.drop(*exogenous)
    if not fill:
        return full
    return full.na.drop(subset=[TARGET]).na.fill(0, feature_columns(full))


def feature_columns(df: DataFrame) -> list[str]:
    """All columns but the target, the keys and the untranslated category."""
    return [c for c in df.columns if c not in NOT_FEATURES]


def label_split(df: DataFrame, dates: SplitDates = SplitDates()) -> DataFrame:
    """Add the split a row falls into; rows outside all three are null."""
    label = F.lit(None).cast("string")
    for name, (lo, hi) in reversed(dates.items()):
        label = F.when(F.col("date").between(F.lit(lo).cast("date"), F.lit(hi).cast("date")), name).otherwise(label)
    return df.withColumn("split", label)


def train_val_test_split(df: DataFrame, dates: SplitDates = SplitDates()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three filters with inclusive bounds; they reach the scan of a stored table."""
    return tuple(
        df.where(F.col("date").between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))) for _, (lo, hi) in dates.items()
    )


def split_summary(df: DataFrame, dates: SplitDates = SplitDates()) -> DataFrame:
    """Rows and date span of each split."""
    return (
        label_split(df, dates)
        .where(F.col("split").isNotNull())
        .groupBy("split")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    )


def walk_forward_folds(
    panel: DataFrame, first_cut: dt.date, folds: int, step_days: int, val_days: int
) -> DataFrame:
    """Rows of an expanding-window validation: fold k trains up to its cut and validates after it.

    A row's fold membership is computed from its date as an array of (fold, role), so no join with
    a fold table is needed; a row appears once per fold that uses it.
    """
    offset = F.datediff("date", F.lit(first_cut))
    members = F.transform(
        F.sequence(F.lit(0), F.lit(folds - 1)),
        lambda k: F.when(offset <= k * step_days, F.struct(k.alias("fold"), F.lit("train").alias("role")))
        .when(offset <= k * step_days + val_days, F.struct(k.alias("fold"), F.lit("val").alias("role"))),
    )
    return panel.select("*", F.explode(F.filter(members, lambda m: m.isNotNull())).alias("_m")).select(
        *panel.columns, "_m.fold", "_m.role"
    )
