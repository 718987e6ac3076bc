"""Exploratory questions on the daily panel and on the order-item fact."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockwave.functions.calendar import MONTH_LABELS, weekday_name
from stockwave.functions.numeric import half_even, safe_corr
from stockwave.operators.features import feature_columns
from stockwave.params import TARGET


def daily_total(panel: DataFrame) -> DataFrame:
    """Orders of each day over all categories; one row per day."""
    return panel.groupBy("date").agg(F.sum(TARGET).alias(TARGET))


def top_n(panel: DataFrame, measure: str = TARGET, n: int = 15, keys: Sequence[str] = ("category",)) -> DataFrame:
    """The n largest sums of a measure; ties go to the smaller key. Runs as TakeOrderedAndProject."""
    return (
        panel.groupBy(*keys)
        .agg(F.sum(measure).alias(measure))
        .orderBy(F.desc(measure), *keys)
        .limit(n)
    )


def keep_top_n(panel: DataFrame, n: int, measure: str = TARGET) -> DataFrame:
    """All rows of the n categories with the largest sums. Reads the panel twice."""
    top = top_n(panel, measure, n).select("category")
    return panel.join(F.broadcast(top), "category", "left_semi")  # n rows


def kpi_panel(panel: DataFrame) -> DataFrame:
    """Categories, orders, mean and peak of the daily totals, and the date range, in one row.

    Grouping sets by date and by category give both totals in one pass over the panel.
    """
    by_day, by_category = F.grouping("date") == 0, F.grouping("category") == 0
    totals = panel.groupingSets([[F.col("date")], [F.col("category")]], "date", "category").agg(
        F.sum(TARGET).alias("orders"), by_day.alias("is_day"), by_category.alias("is_category")
    )
    day = F.when(F.col("is_day"), F.col("orders"))
    return totals.agg(
        F.count_if("is_category").alias("n_categories"),
        F.sum(day).alias("total_orders"),
        F.avg(day).alias("avg_daily_orders"),
        F.max(day).alias("peak_daily_orders"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def weekday_profile(panel: DataFrame) -> DataFrame:
    """Mean orders per category and weekday; all seven weekdays appear, null where never seen."""
    spine = panel.select("category").distinct().select(
        "category", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("day_of_week")
    )
    means = panel.groupBy("category", F.weekday("date").alias("day_of_week")).agg(F.avg(TARGET).alias("avg_orders"))
    return spine.join(means, ["category", "day_of_week"], "left").select(
        "category", "day_of_week", weekday_name(F.col("day_of_week")).alias("day_name"), "avg_orders"
    )


def month_profile(panel: DataFrame) -> DataFrame:
    """Mean orders per month of the year."""
    return panel.groupBy(F.month("date").alias("month")).agg(F.avg(TARGET).alias("avg_orders"))


def seasonality_pivot(panel: DataFrame) -> DataFrame:
    """Mean orders per category: weekdays down, the twelve months across."""
    labels = F.array(*[F.lit(m) for m in MONTH_LABELS])
    return (
        panel.select(
            "category",
            F.weekday("date").alias("day_of_week"),
            F.element_at(labels, F.month("date")).alias("_month"),
            TARGET,
        )
        .groupBy("category", "day_of_week")
        .pivot("_month", list(MONTH_LABELS))
        .agg(F.avg(TARGET))
    )


def monthly_volume(panel: DataFrame) -> DataFrame:
    """Orders per category and calendar month."""
    return panel.groupBy("category", F.date_format("date", "yyyy-MM").alias("year_month")).agg(
        F.sum(TARGET).alias(TARGET)
    )


def category_scatter(panel: DataFrame) -> DataFrame:
    """Orders, mean review score and revenue per category."""
    return panel.groupBy("category").agg(
        F.sum(TARGET).alias(TARGET),
        F.avg("avg_review_score").alias("avg_review_score"),
        F.sum("total_revenue").alias("total_revenue"),
    )


def flag_outliers(panel: DataFrame, reach: float = 1.5) -> DataFrame:
    """Mark rows outside the quartile fences of their category."""
    whole = Window.partitionBy("category")  # at most one row per day
    q1 = F.percentile(TARGET, F.lit(0.25)).over(whole)
    q3 = F.percentile(TARGET, F.lit(0.75)).over(whole)
    fenced = panel.select("*", q1.alias("_q1"), q3.alias("_q3"))
    spread = (F.col("_q3") - F.col("_q1")) * reach
    outside = (F.col(TARGET) < F.col("_q1") - spread) | (F.col(TARGET) > F.col("_q3") + spread)
    return fenced.select(*panel.columns, outside.alias("is_outlier"))


def outlier_summary(panel: DataFrame, n: int = 10) -> DataFrame:
    """Outliers and their share per category, largest counts first."""
    return (
        flag_outliers(panel)
        .groupBy("category")
        .agg(F.count_if("is_outlier").alias("n_outliers"), F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_outliers") > 0)
        .withColumn("outlier_pct", F.col("n_outliers") * 100.0 / F.col("n_rows"))
        .orderBy(F.desc("n_outliers"), "category")
        .limit(n)
    )


def null_profile(df: DataFrame, n: int = 20) -> DataFrame:
    """Columns with nulls, most first; one pass over the data for all columns."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return (
        counts.unpivot([], list(df.columns), "column_name", "n_null")
        .where(F.col("n_null") > 0)
        .orderBy(F.desc("n_null"), "column_name")
        .limit(n)
    )


def describe_by_category(panel: DataFrame, column: str = TARGET) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per category."""
    quartiles = F.percentile(column, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return (
        panel.groupBy("category")
        .agg(
            F.count(column).alias("n"),
            F.avg(column).alias("mean"),
            F.stddev_samp(column).alias("std"),
            F.min(column).alias("min"),
            quartiles.alias("_q"),
            F.max(column).alias("max"),
        )
        .select(
            "category", "n", "mean", "std", "min",
            F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("q50"), F.col("_q")[2].alias("q75"), "max",
        )
    )


def lag_like(features: DataFrame, n: int = 10) -> list[str]:
    """The first n feature names that hold a lag or a rolling value."""
    return [c for c in feature_columns(features) if "lag" in c or "rolling" in c][:n]


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form: all pairs, each once, are summed in one pass over the rows."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    found = one_pass_corr(df, pairs)
    cells = [F.struct(F.lit(x).alias("column_a"), F.lit(y).alias("column_b"), F.col(f"c{i}").alias("corr"))
             for i, (a, b) in enumerate(pairs) for x, y in {(a, b), (b, a)}]
    return found.select(F.explode(F.array(*cells)).alias("p")).select("p.*")


def one_pass_corr(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """One row with the correlation of each pair as ``c0``, ``c1``, ...; null where a column is constant."""
    names = sorted({c for pair in pairs for c in pair})
    values = df.select(*[F.col(c).cast("double").alias(c) for c in names])
    return values.agg(*[safe_corr(F.col(a), F.col(b)).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])


def target_corr(features: DataFrame, top: int = 10, bottom: int = 5) -> DataFrame:
    """Features most and least correlated with the target; features without variance are left out.

    All features are summed in one pass; the rankings run on one row per feature.
    """
    names = feature_columns(features)
    found = one_pass_corr(features, [(TARGET, c) for c in names])
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"c{i}").alias("corr")) for i, c in enumerate(names)])
    long = found.select(F.explode(cells).alias("p")).select("p.feature", half_even(F.col("p.corr"), 6).alias("corr"))
    ranked = long.where(F.col("corr").isNotNull())
    up, down = Window.orderBy(F.asc("corr"), "feature"), Window.orderBy(F.desc("corr"), "feature")
    placed = ranked.select(
        "feature", "corr", F.row_number().over(down).alias("_down"), F.row_number().over(up).alias("_up")
    )  # one row per feature
    sides = F.filter(
        F.array(F.when(F.col("_down") <= top, F.lit("top")), F.when(F.col("_up") <= bottom, F.lit("bottom"))),
        lambda s: s.isNotNull(),
    )
    return placed.select("feature", "corr", F.explode(sides).alias("side"))


def modal_category(panel: DataFrame) -> DataFrame:
    """The category with most rows; ties go to the smaller name."""
    return panel.groupBy("category").agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"), "category").limit(1)


def head_transposed(df: DataFrame, category: str | Column, n: int = 5) -> DataFrame:
    """First n rows of a category by date, one output row per column."""
    head = df.where(F.col("category") == category).orderBy("date").limit(n)
    order = Window.orderBy("date")  # n rows
    numbered = head.withColumn("_row", F.concat(F.lit("row_"), F.row_number().over(order)))
    names = [c for c in df.columns if c not in ("date", "category")]
    long = numbered.select("_row", *[F.col(c).cast("double").alias(c) for c in names]).unpivot(
        ["_row"], names, "feature", "value"
    )
    return long.groupBy("feature").pivot("_row", [f"row_{i}" for i in range(1, n + 1)]).agg(F.first("value"))


def recent_window(panel: DataFrame, days: int = 30, per_category: bool = False) -> DataFrame:
    """Rows within ``days`` of the last date, of the whole panel or of their category.

    The bounds are inclusive, so 30 days keep 31 dates. The panel-wide bound is a scalar subquery,
    which reads the panel once more.
    """
    if per_category:
        last = F.max("date").over(Window.partitionBy("category"))
        return panel.select("*", last.alias("_last")).where(F.col("date") >= F.date_sub("_last", days)).drop("_last")
    last_day = panel.agg(F.max("date")).scalar()
    return panel.where(F.col("date") >= F.date_sub(last_day, days))


def demand_profile(panel: DataFrame, days: int = 30, n: int = 10) -> DataFrame:
    """Mean, deviation and monthly demand of the n largest categories of the recent window."""
    return (
        recent_window(panel, days)
        .groupBy("category")
        .agg(F.sum(TARGET).alias("_total"), F.avg(TARGET).alias("_mean"), F.stddev_samp(TARGET).alias("_std"))
        .orderBy(F.desc("_total"), "category")
        .limit(n)
        .select(
            "category",
            half_even(F.col("_mean"), 1).alias("avg_daily_demand"),
            half_even(F.col("_std"), 1).alias("demand_std"),
            half_even(F.col("_mean") * 30).alias("monthly_forecast"),
        )
    )


def latest_per_category(df: DataFrame) -> DataFrame:
    """The last known value of every column per category."""
    values = [c for c in df.columns if c not in ("date", "category")]
    return df.groupBy("category").agg(
        F.max("date").alias("date"),
        *[F.expr(f"max_by(`{c}`, date) FILTER (WHERE `{c}` IS NOT NULL)").alias(c) for c in values],
    )


def tail_rows(panel: DataFrame, n: int) -> DataFrame:
    """The last n rows of each category, numbered from the newest."""
    newest = Window.partitionBy("category").orderBy(F.desc("date"))
    return panel.withColumn("row_from_end", F.row_number().over(newest)).where(F.col("row_from_end") <= n)


def moving_average(df: DataFrame, windows: Sequence[int], keys: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """Means of the last w rows including the current one; ``strict`` waits for w rows.

    Without keys the input must be the daily totals, one row per day.
    """
    order = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("date")
    out = []
    for w in windows:
        frame = order.rowsBetween(-(w - 1), 0)
        mean = F.avg(TARGET).over(frame)
        if strict:
            mean = F.when(F.count(TARGET).over(frame) == w, mean)
        out.append(mean.alias(f"ma_{w}"))
    return df.select("*", *out)


def baseline_tail(panel: DataFrame, tail: int = 60, window: int = 7, skip: int = 7) -> DataFrame:
    """Per category: mean absolute error of a trailing mean on the last rows, first rows skipped."""
    order = Window.partitionBy("category").orderBy("date")
    recent = tail_rows(panel, tail).select("category", "date", TARGET)
    scored = recent.select(
        "category",
        TARGET,
        F.row_number().over(order).alias("_row"),
        F.avg(TARGET).over(order.rowsBetween(-window, -1)).alias("_baseline"),
    )
    return (
        scored.where(F.col("_row") > skip)
        .groupBy("category")
        .agg(F.avg(F.abs(F.col(TARGET) - F.col("_baseline"))).alias("baseline_mae"), F.count(F.lit(1)).alias("n_rows"))
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
