"""Registered queries: every operator run over the whole given tables.

Each takes (spark, folder) and returns a DataFrame. ``tidy`` fixes the output types: dates and times
as ISO text, money as double, doubles at six digits. Queries that read the daily panel in several
branches store it first, so the order items are scanned once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwave.functions.numeric import half_even
from stockwave.operators import (
    backtest, evaluate, explore, features, forecast, ingest, models, replenish, requests, seasonal, sketches,
)
from stockwave.params import EXOGENOUS, TARGET, Scenario, SplitDates, yearly_holidays
from stockwave.plans import pipeline, refresh
from stockwave.session import scratch_path, stage
from stockwave.sources import files
from stockwave.sources.schemas import PANEL_SCHEMA
from stockwave.sources.star import read, retail_tables

Query = Callable[[SparkSession, str], DataFrame]

HOLIDAYS = yearly_holidays(1995, 2001)
SPLITS = SplitDates(
    train=("1995-01-01", "1999-12-31"), val=("2000-01-01", "2000-12-31"), test=("2001-01-01", "2001-07-31")
)
MODELS = ("lag1", "ma7", "mean_baseline")
HORIZON = 30
FIRST_CUT = dt.date(1999, 12, 31)
ONE_DAY = dt.date(2000, 2, 1)
SEASON_ORIGIN = dt.date(1995, 1, 1)
FALLBACK = {"mean_baseline": 0.25, "lag1": 0.4, "ma7": 0.35}

_REGISTRY: dict[str, Query] = {}


def query(run: Query) -> Query:
    _REGISTRY[run.__name__] = run
    return run


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def tidy(df: DataFrame, as_double: Sequence[str] = ()) -> DataFrame:
    def column(f: T.StructField) -> str:
        name = f"`{f.name}`"
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) or f.name in as_double:
            return f"rint(CAST({name} AS double) * 1e6D) / 1e6D + 0D AS {name}"
        if isinstance(f.dataType, T.DecimalType):
            return f"CAST({name} AS double) AS {name}"
        if isinstance(f.dataType, T.DateType):
            return f"CAST({name} AS string) AS {name}"
        if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            return f"date_format({name}, 'yyyy-MM-dd HH:mm:ss') AS {name}"
        return name

    return df.selectExpr(*[column(f) for f in df.schema.fields])


def panel_of(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.daily_category_demand(retail_tables(spark, folder))


def stored_panel(spark: SparkSession, folder: str) -> DataFrame:
    return stage(panel_of(spark, folder), "panel")


def lag_names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "_lag_" in c]


def naive_predictions(panel: DataFrame, split: str) -> DataFrame:
    """Long predictions of the three baselines for one split; ``panel`` must be stored."""
    rows = panel.select(
        "date", "category", TARGET, *features.lag_columns(lags=(1,)), *features.rolling_columns(windows=(7,))
    ).na.fill(0)
    parts = dict(zip(("train", "val", "test"), features.train_val_test_split(rows, SPLITS)))
    train, _, _ = features.train_val_test_split(panel, SPLITS)
    return models.naive_models(train, parts[split])


def validation_weights(panel: DataFrame) -> DataFrame:
    return models.ensemble_weights(evaluate.forecast_metrics(naive_predictions(panel, "val")))


def future_predictions(panel: DataFrame, days: int = HORIZON) -> DataFrame:
    train, _, _ = features.train_val_test_split(panel, SPLITS)
    return models.naive_models(train, forecast.future_features(panel, days, HOLIDAYS))


def forecast_of(panel: DataFrame, days: int = HORIZON) -> DataFrame:
    return forecast.forecast_band(future_predictions(panel, days), validation_weights(panel), MODELS)


def sku_items(spark: SparkSession, folder: str) -> DataFrame:
    """One planning item per part: demand from all its line items, cost and size from the part."""
    demand = read(spark, folder, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("forecast_demand"))
    rows = read(spark, folder, "part").join(demand, F.col("p_partkey") == F.col("l_partkey"), "left")
    size = F.col("p_size")
    return replenish.items_from_forecast(
        rows.select(
            F.concat(F.lit("sku-"), F.col("p_partkey")).alias("category"),
            "forecast_demand",
            (size * 10.0).alias("current_stock"),
            F.col("p_retailprice").alias("unit_cost"),
            (F.col("p_retailprice") * 1.6).alias("selling_price"),
            (size % 14 + 1).alias("lead_time_days"),
            F.when(size % 10 == 0, 0.0).otherwise(size / 10.0).alias("storage_per_unit"),
        )
    )


PLAN_SCENARIOS = (
    Scenario("roomy", storage_capacity=1e12, budget=1e13),
    Scenario("default"),
    Scenario("costly", storage_capacity=1e12, budget=1e13, service_level=0.99, holding_rate=0.4, stockout_rate=0.6),
)
LOW_SERVICE_SCENARIOS = (
    Scenario("budget_bound", storage_capacity=1e12, budget=9.0e8, service_level=0.3),
    Scenario("storage_bound", storage_capacity=1.8e6, budget=1e13, service_level=0.3),
    Scenario("unbound", storage_capacity=1e12, budget=1e13, service_level=0.2),
    Scenario("no_gain", storage_capacity=1e12, budget=1e13, service_level=0.3, holding_rate=0.5),
    Scenario("normal", storage_capacity=1e12, budget=1e13, service_level=0.9),
)
SWEEP = tuple(
    Scenario(f"sl_{int(level * 100)}", storage_capacity=1e12, budget=1e13, service_level=level)
    for level in (0.85, 0.90, 0.95, 0.99)
)


# --- sources and sinks -----------------------------------------------------------------------


@query
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "orders-csv")
    files.export_csv(retail_tables(spark, folder)["orders"], path)
    schema = "order_id bigint, customer_id bigint, order_status string, order_purchase_timestamp timestamp_ntz"
    return tidy(files.load_csv(spark, path, schema))


@query
def csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Prices of a CSV written with words and with amounts beyond the declared type."""
    path = scratch_path(spark, "items-csv")
    price, key = F.col("l_extendedprice").cast("string"), F.col("l_orderkey")
    odd = F.when(key % 7 == 0, "n/a").when(key % 11 == 0, F.concat(F.lit("99999999"), price)).otherwise(price)
    lines = read(spark, folder, "lineitem").select(key.alias("order_id"), odd.alias("price"), F.col("l_quantity").alias("freight_value"))
    files.export_csv(lines, path)
    return files.csv_rejects(spark, path, "order_id bigint, price decimal(12,2), freight_value decimal(12,2)")


@query
def catalog_from_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and columns of every table written as a folder of CSV files and read through the catalog."""
    path = scratch_path(spark, "catalog-csv")
    source = retail_tables(spark, folder)
    for name, df in source.items():
        files.export_csv(df, f"{path}/{name}")
    return files.table_profile(files.load_catalog(spark, path, {name: name for name in source}))


@query
def absent_table(spark: SparkSession, folder: str) -> DataFrame:
    """A table that was never written reads as empty: the panel and its union with that."""
    never = files.load_table_or_empty(spark, scratch_path(spark, "never"), PANEL_SCHEMA)
    return tidy(never.unionByName(panel_of(spark, folder)))


@query
def catalog_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return files.table_profile(retail_tables(spark, folder))


@query
def parquet_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "panel-by-category")
    files.save_table(panel_of(spark, folder), path, partition_by="category")
    return tidy(files.load_table(spark, path, PANEL_SCHEMA))


@query
def metrics_json_explode(spark: SparkSession, folder: str) -> DataFrame:
    metrics = stage(evaluate.forecast_metrics(naive_predictions(stored_panel(spark, folder), "test")), "metrics")
    loaded = []
    for model in MODELS:
        path = scratch_path(spark, "metrics-json")
        files.save_metrics(metrics.where(F.col("model") == model).drop("model"), path)
        loaded.append(files.load_metrics(spark, path).withColumn("model", F.lit(model)))
    return tidy(explore.union_all(loaded))


@query
def forecast_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "forecast-csv")
    columns = ["date", "category", "predicted_orders", "predicted_lower", "predicted_upper"]
    files.export_csv(forecast_of(stored_panel(spark, folder)).select(*columns), path)
    schema = "date date, category string, predicted_orders bigint, predicted_lower bigint, predicted_upper bigint"
    return tidy(files.load_csv(spark, path, schema))


@query
def trained_categories(spark: SparkSession, folder: str) -> DataFrame:
    train, _, _ = features.train_val_test_split(panel_of(spark, folder), SPLITS)
    return files.trained_categories(models.category_means(train))


# --- ingest ----------------------------------------------------------------------------------


@query
def clean_orders(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(ingest.clean_orders(retail_tables(spark, folder)["orders"]))


@query
def payments_per_order(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(ingest.payments_per_order(retail_tables(spark, folder)["payments"]))


@query
def reviews_per_order(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(ingest.reviews_per_order(retail_tables(spark, folder)["reviews"]))


@query
def unified_orders(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(ingest.unified_orders(retail_tables(spark, folder)), ["review_score_count"])


@query
def daily_category_demand(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(panel_of(spark, folder))


@query
def daily_from_unified(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(ingest.aggregate_daily_category(ingest.unified_orders(retail_tables(spark, folder))))


@query
def null_profile(spark: SparkSession, folder: str) -> DataFrame:
    return explore.null_profile(ingest.unified_orders(retail_tables(spark, folder)))


# --- features --------------------------------------------------------------------------------


@query
def lag_features(spark: SparkSession, folder: str) -> DataFrame:
    out = features.add_lag_features(panel_of(spark, folder).select("date", "category", TARGET))
    return tidy(out, lag_names(out))


@query
def rolling_features(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(features.add_rolling_features(panel_of(spark, folder).select("date", "category", TARGET)))


@query
def calendar_features(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(panel_of(spark, folder).select("date", "category", *features.calendar_columns()))


@query
def onehot_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(panel_of(spark, folder).select("date", "category", *features.onehot_columns()))


@query
def holiday_flags(spark: SparkSession, folder: str) -> DataFrame:
    panel = stored_panel(spark, folder).select("date", "category")
    return tidy(features.add_holiday_feature(panel, HOLIDAYS))


@query
def holiday_flags_calendar(spark: SparkSession, folder: str) -> DataFrame:
    panel = panel_of(spark, folder).select("date", "category")
    return tidy(features.add_holiday_feature(panel, HOLIDAYS, "calendar"))


@query
def exogenous_features(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(features.add_exogenous_features(panel_of(spark, folder).select("date", "category", *EXOGENOUS)))


@query
def feature_matrix(spark: SparkSession, folder: str) -> DataFrame:
    out = features.feature_matrix(stored_panel(spark, folder), HOLIDAYS)
    return tidy(out, lag_names(out))


@query
def chrono_split(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(features.split_summary(panel_of(spark, folder), SPLITS))


@query
def train_val_union(spark: SparkSession, folder: str) -> DataFrame:
    train, val, _ = features.train_val_test_split(stored_panel(spark, folder), SPLITS)
    return tidy(train.unionByName(val).select("date", "category", TARGET))


@query
def walk_forward_folds(spark: SparkSession, folder: str) -> DataFrame:
    folds = features.walk_forward_folds(panel_of(spark, folder).select("date", "category", TARGET), FIRST_CUT, 5, 90, 60)
    return tidy(
        folds.groupBy("fold", "role").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("date").alias("first_date"),
            F.max("date").alias("last_date"),
            F.sum(TARGET).alias("orders"),
        )
    )


@query
def late_days_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The daily panel from files that arrive in three loads, each with rows of all days; one load finds nothing new."""
    facts = stage(ingest.unified_orders(retail_tables(spark, folder)), "facts")
    out = scratch_path(spark, "refresh")
    for part in (0, 1, 1, 2):
        load = f"{out}/inbox/load-{part}"
        if not files.path_exists(spark, load):
            facts.where(F.pmod(F.xxhash64("order_id", "product_id"), F.lit(3)) == part).write.parquet(load)
        panel = refresh.refresh(spark, f"{out}/inbox", f"{out}/stored")
    return tidy(panel)


FOLDS = backtest.Folds(FIRST_CUT, 5, 90, 60)
LAG_INPUTS = seasonal.lag_inputs()
TRIALS = tuple(
    backtest.Trial(f"{name}-{ridge:g}", columns, ridge)
    for name, columns in (("previous", LAG_INPUTS[:1]), ("week", LAG_INPUTS[1:]), ("all", LAG_INPUTS))
    for ridge in (0.0, 10.0, 1000.0)
)


def lag_rows(panel: DataFrame) -> DataFrame:
    """The stored inputs of the linear models."""
    columns = [*features.lag_columns(lags=seasonal.LAGS), *features.rolling_columns(windows=seasonal.MEANS)]
    return stage(panel.select("date", "category", TARGET, *columns).na.fill(0), "lag-rows")


@query
def walk_forward_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Errors per category and fold of a line through the previous row, and of the training mean."""
    return tidy(backtest.walk_forward_scores(lag_rows(stored_panel(spark, folder)), LAG_INPUTS[:1], FOLDS))


@query
def walk_forward_models(spark: SparkSession, folder: str) -> DataFrame:
    """Coefficients per category and fold on two lags, all folds solved from one pass."""
    found = backtest.fold_models(lag_rows(stored_panel(spark, folder)), LAG_INPUTS[:2], FOLDS)
    names = ("constant", "first", "second")
    return tidy(found.select("category", "fold", "n_train", *[F.get("coefficients", F.lit(i)).alias(n) for i, n in enumerate(names)]))


@query
def tuning_trials(spark: SparkSession, folder: str) -> DataFrame:
    """Trials of linear models by successive halving over the folds; each parameter set once."""
    trials, _ = backtest.tune(lag_rows(stored_panel(spark, folder)), TRIALS, FOLDS)
    return tidy(trials.withColumn("columns", F.array_join("columns", ",")))


@query
def tuning_checked(spark: SparkSession, folder: str) -> DataFrame:
    """Rung and folds that each trial reached, one best among the last, and the rows that it was fitted on again."""
    rows = lag_rows(stored_panel(spark, folder))
    trials, refit = backtest.tune(rows, TRIALS, FOLDS)
    per_rung = trials.groupBy("rung", "folds").agg(F.count(F.lit(1)).alias("n_trials"), F.count_if("is_best").alias("n_best"), F.count_if(F.col("rmse") > 0).alias("n_scored"))
    return per_rung.select("*", refit.agg(F.sum("n_train")).scalar().alias("n_refit"))


# --- exploration -----------------------------------------------------------------------------


@query
def distinct_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct orders of roll-ups, exact, and whether stored sketches give them within 2 percent."""
    orders = stage(sketches.order_days(retail_tables(spark, folder)), "order-days")
    stored = stage(sketches.order_sketches(orders), "order-sketches")
    levels = {"all": F.lit("all"), "category": F.col("category"), "year": F.year("date").cast("string"), "month": F.date_format("date", "yyyy-MM")}
    found = []
    for level, key in levels.items():
        exact = orders.groupBy(key.alias("key")).agg(F.count_distinct("order_id").alias("n_orders"))
        estimate = sketches.distinct_orders(stored.withColumn("key", key), ["key"]).withColumnRenamed("n_orders", "estimate")
        near = F.abs(F.col("estimate") - F.col("n_orders")) <= 0.02 * F.col("n_orders")
        found.append(exact.join(estimate, "key").select(F.lit(level).alias("level"), "key", "n_orders", near.alias("sketch_is_near")))
    return explore.union_all(found)


@query
def daily_total(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(explore.daily_total(panel_of(spark, folder)))


@query
def top_categories(spark: SparkSession, folder: str) -> DataFrame:
    return explore.top_n(panel_of(spark, folder), TARGET, 4)


@query
def top_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(explore.top_n(panel_of(spark, folder), "total_revenue", 4))


@query
def topn_semijoin(spark: SparkSession, folder: str) -> DataFrame:
    panel = stored_panel(spark, folder)
    return tidy(explore.keep_top_n(panel, 3).select("date", "category", TARGET))


@query
def kpi_panel(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(explore.kpi_panel(panel_of(spark, folder)))


@query
def dow_profile(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(explore.weekday_profile(stored_panel(spark, folder)))


@query
def month_profile(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(explore.month_profile(panel_of(spark, folder)))


@query
def seasonality_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(explore.seasonality_pivot(panel_of(spark, folder)))


@query
def monthly_volume(spark: SparkSession, folder: str) -> DataFrame:
    return explore.monthly_volume(panel_of(spark, folder))


@query
def category_scatter(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(explore.category_scatter(panel_of(spark, folder)))


@query
def outlier_rows(spark: SparkSession, folder: str) -> DataFrame:
    flagged = explore.flag_outliers(panel_of(spark, folder).select("date", "category", TARGET))
    return tidy(flagged.where("is_outlier").drop("is_outlier"))


@query
def outlier_summary(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(explore.outlier_summary(panel_of(spark, folder)))


@query
def category_describe(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(explore.describe_by_category(panel_of(spark, folder)))


@query
def corr_matrix(spark: SparkSession, folder: str) -> DataFrame:
    train, _, _ = features.train_val_test_split(features.feature_matrix(stored_panel(spark, folder), HOLIDAYS), SPLITS)
    return tidy(explore.corr_matrix(train, [TARGET, *explore.lag_like(train)]))


@query
def target_corr(spark: SparkSession, folder: str) -> DataFrame:
    train, _, _ = features.train_val_test_split(features.feature_matrix(stored_panel(spark, folder), HOLIDAYS), SPLITS)
    return tidy(explore.target_corr(train))


@query
def modal_category(spark: SparkSession, folder: str) -> DataFrame:
    return explore.modal_category(panel_of(spark, folder))


@query
def modal_head_transposed(spark: SparkSession, folder: str) -> DataFrame:
    panel = stored_panel(spark, folder)
    modal = explore.modal_category(panel).select("category").scalar()
    return tidy(explore.head_transposed(panel, modal))


@query
def recent_window(spark: SparkSession, folder: str) -> DataFrame:
    panel = stored_panel(spark, folder).select("date", "category", TARGET)
    overall = explore.recent_window(panel).withColumn("scope", F.lit("panel"))
    own = explore.recent_window(panel, per_category=True).withColumn("scope", F.lit("category"))
    return tidy(overall.unionByName(own))


@query
def demand_profile_30d(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(explore.demand_profile(stored_panel(spark, folder), 30, 4))


@query
def latest_per_category(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(explore.latest_per_category(panel_of(spark, folder)))


@query
def moving_average(spark: SparkSession, folder: str) -> DataFrame:
    panel = stored_panel(spark, folder).select("date", "category", TARGET)
    total = explore.daily_total(panel).withColumn("category", F.lit("*"))
    both = explore.moving_average(panel, (7, 14), ["category"]).unionByName(explore.moving_average(total, (7, 14)))
    return tidy(both)


@query
def moving_average_strict(spark: SparkSession, folder: str) -> DataFrame:
    panel = stored_panel(spark, folder).select("date", "category", TARGET)
    total = explore.daily_total(panel).withColumn("category", F.lit("*"))
    both = explore.moving_average(panel, (7, 14), ["category"], True).unionByName(
        explore.moving_average(total, (7, 14), strict=True)
    )
    return tidy(both)


@query
def ma_baseline_mae(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(explore.baseline_tail(panel_of(spark, folder)))


@query
def tail_history(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(explore.tail_rows(panel_of(spark, folder).select("date", "category", TARGET), 90))


# --- models and scores -----------------------------------------------------------------------


@query
def mean_baseline(spark: SparkSession, folder: str) -> DataFrame:
    train, val, _ = features.train_val_test_split(stored_panel(spark, folder), SPLITS)
    return tidy(models.mean_baseline(train, val))


@query
def forecast_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(evaluate.forecast_metrics(naive_predictions(stored_panel(spark, folder), "val")))


@query
def metrics_macro(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(evaluate.metrics_macro(evaluate.forecast_metrics(naive_predictions(stored_panel(spark, folder), "val"))))


@query
def metrics_leaderboard(spark: SparkSession, folder: str) -> DataFrame:
    metrics = evaluate.forecast_metrics(naive_predictions(stored_panel(spark, folder), "test"))
    return tidy(evaluate.leaderboard(metrics, 45.0))


@query
def naive_lag1_mape(spark: SparkSession, folder: str) -> DataFrame:
    rows = features.add_lag_features(panel_of(spark, folder).select("date", "category", TARGET), lags=(1,))
    _, val, _ = features.train_val_test_split(rows, SPLITS)
    return tidy(evaluate.forecast_metrics(models.naive_lag1(val)))


@query
def improvement_over_naive(spark: SparkSession, folder: str) -> DataFrame:
    metrics = evaluate.forecast_metrics(naive_predictions(stored_panel(spark, folder), "val"))
    return tidy(evaluate.improvement_over(metrics, "lag1"))


@query
def residuals(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(evaluate.residuals(naive_predictions(stored_panel(spark, folder), "test")))


@query
def residual_stats(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(evaluate.residual_stats(naive_predictions(stored_panel(spark, folder), "test")))


@query
def residual_histogram(spark: SparkSession, folder: str) -> DataFrame:
    errors = evaluate.residuals(naive_predictions(stored_panel(spark, folder), "test"))
    return tidy(evaluate.histogram(errors, "residual", 30, ["category", "model"]))


@query
def mape_histogram(spark: SparkSession, folder: str) -> DataFrame:
    metrics = evaluate.forecast_metrics(naive_predictions(stored_panel(spark, folder), "val"))
    return tidy(evaluate.histogram(metrics, "mape", 20, ["model"]))


@query
def ensemble_weights(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(validation_weights(stored_panel(spark, folder)))


@query
def ensemble_blend(spark: SparkSession, folder: str) -> DataFrame:
    panel = stored_panel(spark, folder)
    return tidy(models.blend(naive_predictions(panel, "test"), validation_weights(panel)))


@query
def minmax_scale(spark: SparkSession, folder: str) -> DataFrame:
    panel = stored_panel(spark, folder).select("date", "category", TARGET, "avg_price")
    train, val, _ = features.train_val_test_split(panel, SPLITS)
    bounds = models.minmax_fit(train, [TARGET, "avg_price"])
    scaled = models.minmax_transform(train.unionByName(val), bounds, [TARGET, "avg_price"])
    both = scaled.withColumn("restored", F.col(TARGET))
    return tidy(models.minmax_inverse(both, bounds, {"restored": TARGET}))


def _windows_text(df: DataFrame) -> DataFrame:
    return df.withColumn("window", F.array_join(F.transform("window", lambda x: x.cast("bigint").cast("string")), ","))


@query
def sequence_windows(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(_windows_text(models.sequence_windows(panel_of(spark, folder))))


@query
def sequence_future(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(_windows_text(models.sequence_future(stored_panel(spark, folder), 7)))


@query
def sequence_eligibility(spark: SparkSession, folder: str) -> DataFrame:
    return models.sequence_eligibility(features.label_split(panel_of(spark, folder), SPLITS))


@query
def sequence_regression(spark: SparkSession, folder: str) -> DataFrame:
    columns = pipeline.SEQUENCE_COLUMNS
    filled = features.add_exogenous_features(stored_panel(spark, folder), lags=()).select("date", "category", *columns)
    train, _, _ = features.train_val_test_split(filled, SPLITS)
    bounds = stage(models.minmax_fit(train, columns), "bounds")
    windows = stage(pipeline.sequence_inputs(filled, bounds), "windows")
    fit_on, val, _ = features.train_val_test_split(windows, SPLITS)
    return tidy(pipeline.sequence_predictions(models.fit_sequence_regression(fit_on), val, bounds))


@query
def gbt_forecast(spark: SparkSession, folder: str) -> DataFrame:
    matrix = stage(features.feature_matrix(stored_panel(spark, folder), HOLIDAYS), "features")
    train, val, test = features.train_val_test_split(matrix, SPLITS)
    model, _ = models.fit_pooled(train, val)
    return tidy(models.score_boosted(model, test, train))


def trained_pipeline(spark: SparkSession, folder: str, splits: SplitDates = SPLITS) -> str:
    """A pipeline folder with the default models trained on the whole panel."""
    out = scratch_path(spark, "pipeline")
    files.save_table(panel_of(spark, folder), f"{out}/daily_category_demand")
    pipeline.run_features(spark, out, HOLIDAYS)
    pipeline.run_training(spark, out, splits)
    return out


@query
def train_report(spark: SparkSession, folder: str) -> DataFrame:
    """One row per category of the pooled run, whether each model has a finite validation error, and whether boosting went beyond one round to its best."""
    report = files.load_table(spark, f"{trained_pipeline(spark, folder)}/training_report")
    scored = F.coalesce(F.array_join(F.array_sort(F.map_keys(F.map_filter("scores", lambda _, v: (v >= 0) & (v < 1e300)))), ","), F.lit(""))
    several, kept = F.col("best_round") > 1, F.col("best_round") <= F.col("rounds")
    return report.select("category", "status", "train_windows", "val_windows", scored.alias("scored"), (several & kept).alias("best_of_several_rounds"))


def finite(x: str):
    return F.coalesce((F.col(x) > -1e300) & (F.col(x) < 1e300), F.lit(False))


@query
def gbt_forecast_checked(spark: SparkSession, folder: str) -> DataFrame:
    """Keys and actuals scored by the boosted model with the default settings, and whether scores are finite."""
    matrix = stage(features.feature_matrix(stored_panel(spark, folder), HOLIDAYS), "features")
    train, val, test = features.train_val_test_split(matrix, SPLITS)
    model, _ = models.fit_pooled(train, val)
    return tidy(models.score_boosted(model, test, train).select("category", "date", "model", "y", finite("yhat").alias("is_finite")))


@query
def boosted_model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """A stored and reloaded boosted model scores every test row as the fitted one does."""
    matrix = stage(features.feature_matrix(stored_panel(spark, folder), HOLIDAYS), "features")
    train, val, test = features.train_val_test_split(matrix, SPLITS)
    model, _ = models.fit_pooled(train, val)
    path = scratch_path(spark, "boosted")
    files.save_model(model.model, path)
    first, second = (models.score_boosted(m, test, train) for m in (model, files.load_model(path)))
    both = first.join(second.select("category", "date", F.col("yhat").alias("_again")), ["category", "date"])
    return tidy(both.select("category", "date", (F.col("yhat") == F.col("_again")).alias("same")))


@query
def boosted_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Per split: errors of the previous row and the training mean, and whether the boosted model, of more than one tree, is below both."""
    panel = stored_panel(spark, folder)
    matrix = stage(features.feature_matrix(panel, HOLIDAYS), "features")
    train, val, test = features.train_val_test_split(matrix, SPLITS)
    model, _ = models.fit_pooled(train, val)
    found = []
    for split, rows in (("val", val), ("test", test)):
        scored = naive_predictions(panel, split).where("model <> 'ma7'").unionByName(models.score_boosted(model, rows, train))
        errors = scored.groupBy(F.lit(split).alias("split")).pivot("model", ["lag1", "mean_baseline", "boosted"]).agg(F.sqrt(F.avg((F.col("y") - F.col("yhat")) ** 2)))
        found.append(errors)
    below = (F.col("boosted") < F.col("lag1")) & (F.col("boosted") < F.col("mean_baseline"))
    return tidy(explore.union_all(found).select("split", "lag1", "mean_baseline", below.alias("boosted_is_below"), F.lit(model.trees > 1).alias("several_trees")))


@query
def models_per_category(spark: SparkSession, folder: str) -> DataFrame:
    """A boosted model for each category, one of them without any value of a feature, which is reported and stops no other."""
    matrix = stage(features.feature_matrix(stored_panel(spark, folder), HOLIDAYS), "features")
    broken = matrix.withColumn("avg_price", F.when(F.col("category") != "economy", F.col("avg_price")))
    train, val, _ = features.train_val_test_split(broken, SPLITS)
    fitted, report = models.fit_top_categories(train, val, n=None)
    has_detail = F.length("detail") > 0
    stored = F.col("category").isin(*fitted) if fitted else F.lit(False)
    return report.select("category", "status", (F.col("trees") > 1).alias("several_trees"), (F.col("rmse") > 0).alias("has_error"), has_detail.alias("has_detail"), stored.alias("has_model"))


def category_pipeline(spark: SparkSession, folder: str) -> str:
    """A pipeline folder with a registered model for each category of the whole panel."""
    out = scratch_path(spark, "categories")
    files.save_table(panel_of(spark, folder), f"{out}/daily_category_demand")
    pipeline.run_features(spark, out, HOLIDAYS)
    pipeline.run_category_training(spark, out, SPLITS)
    return out


@query
def category_registry(spark: SparkSession, folder: str) -> DataFrame:
    """Every category with a registered model, its test rows, and whether the reloaded model's error on them is the registered run's."""
    out = category_pipeline(spark, folder)
    registered = files.load_table(spark, f"{out}/registry")
    names = [r.category for r in files.trained_categories(registered).collect()]  # one per model
    reloaded = {name: files.load_category_model(registered, name) for name in names}
    _, _, test = features.train_val_test_split(pipeline.load_features(spark, out), SPLITS)
    scored = models.score_categories(reloaded, test).groupBy("category").agg(F.count("yhat").alias("n_test"), F.sqrt(F.avg((F.col("y") - F.col("yhat")) ** 2)).alias("_again"))
    first = files.load_table(spark, f"{out}/category_metrics").select("category", "rmse")
    listed = registered.where(F.col("status") == "trained").select("category", (F.col("trees") <= F.col("rounds")).alias("best_of_rounds"))
    both = listed.join(scored, "category", "left").join(first, "category", "left")
    return both.select("category", F.coalesce("n_test", F.lit(0)).alias("n_test"), "best_of_rounds", (F.abs(F.col("_again") - F.col("rmse")) < 0.01).alias("same_error"))


@query
def category_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Days ahead of every category by its own registered model, and whether orders and band fit the prediction."""
    out = category_pipeline(spark, folder)
    names = [r.category for r in files.trained_categories(files.load_table(spark, f"{out}/registry")).collect()]  # one per model
    ahead = explore.union_all([pipeline.run_category_forecast(spark, out, name, HORIZON, HOLIDAYS) for name in names])
    y = F.col("blended")
    band = (F.col("predicted_lower") == F.greatest(forecast.whole(y * 0.85), F.lit(0))) & (F.col("predicted_upper") == forecast.whole(y * 1.15))
    return tidy(ahead.select("category", "date", ((F.col("predicted_orders") == forecast.whole(y)) & band & finite("blended")).alias("band_fits")))


@query
def sequence_regression_checked(spark: SparkSession, folder: str) -> DataFrame:
    """Keys and actuals scored by the window model, and whether scores are finite and not negative."""
    scored = sequence_regression(spark, folder)
    return scored.select("category", "date", "model", "y", (finite("yhat") & (F.col("yhat") >= 0)).alias("sound"))


@query
def ensemble_forecast_checked(spark: SparkSession, folder: str) -> DataFrame:
    """Days of the model forecast, whether both models predicted, and whether blend and band fit their predictions."""
    out = trained_pipeline(spark, folder)
    stored, _ = pipeline.run_forecast(spark, out, HORIZON, HOLIDAYS)
    low, high = F.least("boosted_prediction", "sequence_prediction"), F.greatest("boosted_prediction", "sequence_prediction")
    between = (F.col("predicted_orders") >= low) & (F.col("predicted_orders") <= high)
    band = (F.col("predicted_lower") == forecast.whole(F.col("blended") * 0.85)) & (F.col("predicted_upper") == forecast.whole(F.col("blended") * 1.15))
    return tidy(stored.select("category", "date", (between & (F.col("predicted_orders") == forecast.whole(F.col("blended")))).alias("blended_between"), band.alias("band_fits")))


@query
def ensemble_weights_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """Weights when one day validates: categories without a row that day get the static ones."""
    panel = stored_panel(spark, folder)
    rows = naive_predictions(panel, "val").where(F.col("date") == ONE_DAY)
    known = models.ensemble_weights(evaluate.forecast_metrics(rows))
    return tidy(models.complete_weights(known, panel, FALLBACK).select("category", "model", "weight"))


@query
def mean_baseline_unseen(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions for all categories by a mean fitted without one of them: that one gets the mean of all."""
    panel = stored_panel(spark, folder)
    train, _, test = features.train_val_test_split(panel, SPLITS)
    return tidy(models.mean_baseline(train.where("category <> 'economy'"), test))


@query
def absent_model(spark: SparkSession, folder: str) -> DataFrame:
    """Every row scored by the stand-in for a model that was never fitted."""
    return tidy(models.score_absent_model(panel_of(spark, folder), "sequence"))


@query
def densified_panel(spark: SparkSession, folder: str) -> DataFrame:
    """The panel with a zero row for every day without demand between a category's first and last."""
    return tidy(features.densify(stored_panel(spark, folder)).select("date", "category", TARGET))


@query
def feature_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and features a model gets, with and without same-day price and revenue."""
    panel = stored_panel(spark, folder)
    found = []
    for leak_free in (False, True):
        matrix = features.feature_matrix(panel, HOLIDAYS, leak_free=leak_free)
        n = len(features.feature_columns(matrix))
        found.append(matrix.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(leak_free).alias("leak_free"), F.lit(n).alias("n_features"), "n_rows"))
    return explore.union_all(found)

@query
def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    rows = stored_panel(spark, folder).select("date", "category", TARGET, F.month("date").alias("month"))
    assembler = VectorAssembler(inputCols=["month"], outputCol="inputs")
    line = LinearRegression(featuresCol="inputs", labelCol=TARGET, predictionCol="yhat", solver="normal")
    path = scratch_path(spark, "model")
    files.save_model(Pipeline(stages=[assembler, line]).fit(rows), path)
    return tidy(files.load_model(path).transform(rows).select("date", "category", "yhat"))


@query
def ensemble_forecast(spark: SparkSession, folder: str) -> DataFrame:
    out = trained_pipeline(spark, folder)
    stored, _ = pipeline.run_forecast(spark, out, HORIZON, HOLIDAYS)
    return tidy(stored)


# --- forecasts -------------------------------------------------------------------------------


@query
def recursive_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Each day's prediction feeds the lags of the days after; a line on the last value and the one a week before."""
    panel = stored_panel(spark, folder)
    model = seasonal.fit_lags(lag_rows(panel), means=())
    return tidy(seasonal.recursive_forecast(panel, model, HORIZON, means=()))


@query
def seasonal_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Trend with yearly and weekly seasons, fitted on the training rows and scored on the test rows."""
    train, _, test = features.train_val_test_split(stored_panel(spark, folder), SPLITS)
    return tidy(seasonal.score_seasonal(seasonal.fit_seasonal(train, SEASON_ORIGIN), test, SEASON_ORIGIN))


@query
def seasonal_fit_checked(spark: SparkSession, folder: str) -> DataFrame:
    """Per category: training rows, error of the training mean, and whether the seasonal model's is below it."""
    train, _, _ = features.train_val_test_split(stored_panel(spark, folder), SPLITS)
    scored = seasonal.score_seasonal(seasonal.fit_seasonal(train, SEASON_ORIGIN), train, SEASON_ORIGIN).unionByName(models.mean_baseline(train, train))
    error = F.sqrt(F.avg((F.col("y") - F.col("yhat")) ** 2))
    found = scored.groupBy("category").pivot("model", ["mean_baseline", "seasonal"]).agg(error.alias("rmse"), F.count(F.lit(1)).alias("n"))
    return tidy(found.select("category", F.col("seasonal_n").alias("n_train"), F.col("mean_baseline_rmse").alias("mean_rmse"), (F.col("seasonal_rmse") < F.col("mean_baseline_rmse")).alias("seasonal_is_below")))


@query
def conformal_band(spark: SparkSession, folder: str) -> DataFrame:
    """Bands from validation errors, per category and days ahead, and the share of test actuals within them."""
    daily = stage(features.densify(stored_panel(spark, folder)), "daily")
    predictions = stage(sketches.snapshot_predictions(daily, 14), "snapshots")
    _, val, test = features.train_val_test_split(predictions, SPLITS)
    keys = ["category", "days_ahead"]
    stored = stage(sketches.error_sketches(val, keys), "error-sketches")
    weeks = sketches.merge_error_sketches(stored.withColumn("week", F.ceil(F.col("days_ahead") / 7).cast("int")), ["category", "week"])
    by_day = sketches.band_coverage(sketches.with_band(test, stored, keys), keys).select("category", F.lit("day").alias("span"), F.col("days_ahead").alias("ahead"), "n", "coverage", "radius")
    in_weeks = test.withColumn("week", F.ceil(F.col("days_ahead") / 7).cast("int"))
    by_week = sketches.band_coverage(sketches.with_band(in_weeks, weeks, ["category", "week"]), ["category", "week"]).select("category", F.lit("week").alias("span"), F.col("week").alias("ahead"), "n", "coverage", "radius")
    return tidy(by_day.unionByName(by_week))


@query
def future_spine(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(forecast.future_spine(panel_of(spark, folder), 90))


@query
def future_features(spark: SparkSession, folder: str) -> DataFrame:
    names = [f"{TARGET}_lag_{k}" for k in (14, 21, 30)] + list(EXOGENOUS)
    out = forecast.future_features(stored_panel(spark, folder), HORIZON, HOLIDAYS, names)
    return tidy(out, lag_names(out))


@query
def forecast_band(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(forecast_of(stored_panel(spark, folder)))


@query
def forecast_summary(spark: SparkSession, folder: str) -> DataFrame:
    panel = stored_panel(spark, folder)
    return tidy(forecast.forecast_summary(forecast_of(panel), panel))


@query
def forecast_series(spark: SparkSession, folder: str) -> DataFrame:
    panel = stored_panel(spark, folder)
    return tidy(forecast.forecast_series(panel, forecast_of(panel)))


@query
def request_validation(spark: SparkSession, folder: str) -> DataFrame:
    customers = read(spark, folder, "customer").withColumn("request_id", F.col("c_custkey"))
    asked = customers.select(
        "request_id",
        F.nullif(F.col("c_mktsegment"), F.lit("FURNITURE")).alias("category"),
        F.when(F.col("c_custkey") % 5 != 0, (F.col("c_custkey") % 400 - 10).cast("int")).alias("days"),
    )
    planned = customers.select(
        "request_id",
        F.col("c_acctbal").alias("storage_capacity"),
        (F.col("c_acctbal") + 500.0).alias("budget"),
        F.when(F.col("c_custkey") % 3 != 0, (F.col("c_custkey") % 110) / 100.0).alias("service_level"),
    )
    first = requests.validate_forecast_requests(asked).select("request_id", F.lit("forecast").alias("kind"), "errors", "valid")
    second = requests.validate_plan_requests(planned).select("request_id", F.lit("plan").alias("kind"), "errors", "valid")
    return first.unionByName(second)


def forecast_requests_of(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    return read(spark, folder, "supplier").select(
        key.alias("request_id"),
        F.when(key % 3 == 0, "economy").when(key % 3 == 1, "small").otherwise("toys").alias("category"),
        (key * 37 % 380 - 2).cast("int").alias("days"),
    )


def answers_of(spark: SparkSession, folder: str) -> DataFrame:
    panel = stored_panel(spark, folder)
    spans = panel.groupBy("category").agg(F.max("date").alias("_last"))
    numbered = forecast_of(panel, requests.MAX_DAYS).join(spans, "category").select(
        "category", "date", "blended", "predicted_orders", F.datediff("date", "_last").alias("days_ahead")
    )
    return requests.answer_forecast_requests(forecast_requests_of(spark, folder), numbered)


@query
def forecast_requests(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(answers_of(spark, folder).drop("blended"))


@query
def forecast_request_summary(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(requests.summarise_answers(answers_of(spark, folder)))


@query
def forecast_requests_short(spark: SparkSession, folder: str) -> DataFrame:
    """Answered requests with fewer days than asked, of all; none are expected."""
    return requests.unanswered_days(forecast_requests_of(spark, folder), answers_of(spark, folder))


@query
def forecast_requests_rejected(spark: SparkSession, folder: str) -> DataFrame:
    return requests.rejected_forecast_requests(forecast_requests_of(spark, folder), panel_of(spark, folder))


# --- replenishment ---------------------------------------------------------------------------


@query
def inventory_items_defaulted(spark: SparkSession, folder: str) -> DataFrame:
    panel = stored_panel(spark, folder)
    categories = panel.select("category").distinct()
    profile = explore.demand_profile(panel, 30, 4)
    from_profile = replenish.items_from_profile(replenish.cost_config(categories, panel), profile)
    from_forecast = replenish.items_from_forecast(explore.latest_per_category(panel).select("category", TARGET))
    both = from_profile.withColumn("origin", F.lit("profile")).unionByName(
        from_forecast.withColumn("origin", F.lit("forecast"))
    )
    return tidy(both)


@query
def cost_config(spark: SparkSession, folder: str) -> DataFrame:
    panel = stored_panel(spark, folder)
    return tidy(replenish.cost_config(panel.select("category").distinct(), panel))


@query
def safety_stock(spark: SparkSession, folder: str) -> DataFrame:
    items = replenish.with_scenarios(sku_items(spark, folder), PLAN_SCENARIOS)
    return tidy(
        items.select(
            "scenario",
            "category",
            replenish.safety_stock().alias("safety_stock"),
            (F.col("forecast_demand") + replenish.safety_stock()).alias("reorder_point"),
        )
    )


def sku_plan(spark: SparkSession, folder: str, scenarios: Sequence[Scenario], low_service: bool = False) -> DataFrame:
    items = stage(sku_items(spark, folder), "items")
    return replenish.solve_plan(replenish.with_scenarios(items, scenarios), low_service=low_service, n_keys=len(scenarios))


@query
def reorder_plan(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(replenish.plan_report(sku_plan(spark, folder, PLAN_SCENARIOS)))


@query
def reorder_plan_low_service(spark: SparkSession, folder: str) -> DataFrame:
    plan = sku_plan(spark, folder, LOW_SERVICE_SCENARIOS, low_service=True)
    return tidy(
        plan.select(
            "scenario", "category", "status",
            *[half_even(F.col(c), 3).alias(c) for c in ("reorder_quantity", "shortage", "holding_cost", "stockout_cost")],
        )
    )


@query
def reorder_totals(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(replenish.plan_totals(sku_plan(spark, folder, PLAN_SCENARIOS)))


@query
def service_level_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(replenish.plan_totals(sku_plan(spark, folder, SWEEP)))


@query
def naive_vs_optimal_cost(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(replenish.naive_comparison(sku_plan(spark, folder, PLAN_SCENARIOS)))


@query
def reorder_from_latest(spark: SparkSession, folder: str) -> DataFrame:
    items = stage(replenish.items_from_forecast(explore.latest_per_category(panel_of(spark, folder))), "items")
    plan = replenish.solve_plan(replenish.with_scenarios(items, (Scenario("latest"),)), n_keys=1)
    return tidy(replenish.plan_report(plan))


@query
def reorder_from_profile(spark: SparkSession, folder: str) -> DataFrame:
    panel = stored_panel(spark, folder)
    profile = stage(explore.demand_profile(panel, 30, 10), "profile")
    items = stage(replenish.items_from_profile(replenish.cost_config(profile, panel), profile), "items")
    scenario = Scenario("profile", storage_capacity=1e12, budget=1e13)
    return tidy(replenish.plan_report(replenish.solve_plan(replenish.with_scenarios(items, (scenario,)), n_keys=1)))


def plan_requests_of(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Requests, some with a limit below 0 or without items, and their items, some with a stock below 0."""
    key = F.col("s_suppkey")
    asked = read(spark, folder, "supplier").select(
        key.alias("request_id"),
        F.when(key % 4 != 0, 200.0 * (key % 50)).alias("storage_capacity"),
        F.when(key % 13 == 0, -1.0).otherwise(F.abs("s_acctbal") * 100).alias("budget"),
        F.when(key % 7 == 0, 0.3).when(key % 7 != 1, 0.8 + (key % 21) / 100.0).alias("service_level"),
    )
    lines, parts = read(spark, folder, "lineitem"), read(spark, folder, "part")
    items = (
        lines.where(F.col("l_suppkey") % 9 != 0).join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("l_suppkey").alias("request_id"), F.col("p_brand").alias("category"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("forecast_demand"),
            F.max("p_size").cast("double").alias("unit_cost"),
            (F.min("p_size") % 9 - 1).cast("double").alias("current_stock"),
            (F.count(F.lit(1)) % 5).cast("double").alias("storage_per_unit"),
        )
    )
    return asked, stage(items, "request-items")


@query
def plan_requests_rejected(spark: SparkSession, folder: str) -> DataFrame:
    return requests.rejected_plan_requests(*plan_requests_of(spark, folder))


@query
def reorder_batch(spark: SparkSession, folder: str) -> DataFrame:
    solved = requests.reorder_batch(*plan_requests_of(spark, folder))
    return tidy(
        solved.select(
            "request_id", "category", "status",
            *[half_even(F.col(c), 3).alias(c) for c in ("safety_stock", "reorder_quantity", "holding_cost", "stockout_cost")],
        )
    )
