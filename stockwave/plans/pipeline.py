"""End-to-end jobs over stored tables: ingest, train, forecast, replenish.

Each job writes its result below one folder, and the next reads it from there, so every stage is
computed once and can be run again on its own:

    unified_orders/  daily_category_demand/  features/           ingest and features
    models/boosted  models/sequence  bounds/  weights/  metrics/  training_report/  training
    models/by_category  registry/  category_metrics/              a model per category
    forecast/  forecast_csv/  plan/  plan_csv/                    forecast and replenishment
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwave.operators import evaluate, explore, features, forecast, ingest, models, replenish
from stockwave.params import (
    EXOGENOUS,
    FORECAST_DAYS,
    HOLIDAYS,
    SEQUENCE_LENGTH,
    TARGET,
    BoostingParams,
    Scenario,
    SplitDates,
)
from stockwave.session import stage
from stockwave.sources import files
from stockwave.sources.schemas import PANEL_SCHEMA

SEQUENCE_COLUMNS = (TARGET, *EXOGENOUS)


def run_ingest(spark: SparkSession, tables: Mapping[str, DataFrame], out: str) -> tuple[DataFrame, DataFrame]:
    """Store the order-item fact and the daily panel; the panel comes from the raw tables, without the wide fact."""
    files.save_table(ingest.unified_orders(tables), f"{out}/unified_orders")
    unified = files.load_table(spark, f"{out}/unified_orders")
    files.save_table(ingest.daily_category_demand(tables), f"{out}/daily_category_demand")
    return unified, load_panel(spark, out)


def load_panel(spark: SparkSession, out: str) -> DataFrame:
    return files.load_table(spark, f"{out}/daily_category_demand", PANEL_SCHEMA)


def load_features(spark: SparkSession, out: str) -> DataFrame:
    """The stored features; a category stays text, whatever its folder is called."""
    stored = files.load_table(spark, f"{out}/features").schema
    fields = [T.StructField("category", T.StringType()) if f.name == "category" else f for f in stored.fields]
    return spark.read.schema(T.StructType(fields)).parquet(f"{out}/features")


def run_features(spark: SparkSession, out: str, holidays: Sequence[dt.date] = HOLIDAYS) -> DataFrame:
    """Store the feature matrix by category, so later reads of one category skip the others."""
    panel = load_panel(spark, out)
    files.save_table(features.feature_matrix(panel, holidays), f"{out}/features", partition_by="category")
    return load_features(spark, out)


def sequence_inputs(matrix: DataFrame, bounds: DataFrame, length: int = SEQUENCE_LENGTH) -> DataFrame:
    """Scaled windows of the target and the exogenous columns."""
    rows = matrix.select("date", "category", *SEQUENCE_COLUMNS)
    scaled = models.minmax_transform(rows, bounds, SEQUENCE_COLUMNS)
    return models.sequence_windows(scaled, SEQUENCE_COLUMNS, length)


def sequence_predictions(model: PipelineModel, windows: DataFrame, bounds: DataFrame) -> DataFrame:
    """Scored windows on the original scale, in the long form."""
    scored = models.score_sequences(model, windows)
    restored = models.minmax_inverse(scored, bounds, {"next_value": TARGET, "yhat": TARGET})
    return restored.select(
        "category",
        "date",
        F.lit("sequence").alias("model"),
        F.col("next_value").alias("y"),
        F.greatest(F.col("yhat"), F.lit(0.0)).alias("yhat"),
    )


def run_training(
    spark: SparkSession,
    out: str,
    splits: SplitDates = SplitDates(),
    top_n: int | None = None,
    params: BoostingParams = BoostingParams(),
) -> DataFrame:
    """Fit the pooled models, weigh them by validation error, store them; returns test metrics.

    The mean baseline is scored and reported, but as in the blend of the original study it gets a
    weight without contributing predictions; the weights of the other models are renormalised.
    Categories without enough windows simply have no sequence predictions; ``training_report`` lists
    them. Categories without validation rows get the static weights, those without training rows
    the training mean of all. An empty test split gives empty metrics. Test windows are made of the
    rows before each test day (one step ahead), while a forecast pads its windows, so errors grow
    with the days ahead beyond what the test shows.
    """
    matrix = load_features(spark, out)
    if top_n:
        train_rows, _, _ = features.train_val_test_split(matrix, splits)
        top = explore.top_n(train_rows, TARGET, top_n).select("category")
        matrix = matrix.join(F.broadcast(top), "category", "left_semi")  # top_n rows
    train, val, test = features.train_val_test_split(matrix, splits)

    files.save_table(models.minmax_fit(train, SEQUENCE_COLUMNS), f"{out}/bounds")
    bounds = files.load_table(spark, f"{out}/bounds")
    windows = stage(sequence_inputs(matrix, bounds), "windows")
    eligible = models.sequence_eligibility(features.label_split(matrix, splits)).where("eligible").select("category")
    usable = windows.join(eligible, "category", "left_semi")
    window_train, window_val, window_test = features.train_val_test_split(usable, splits)

    boosted, columns = models.fit_pooled(train, val, params)
    sequence = models.fit_sequence_regression(window_train)
    files.save_model(boosted.model, f"{out}/models/boosted")
    files.save_model(sequence, f"{out}/models/sequence")
    categories = matrix.select("category").distinct()
    files.save_table(models.with_train_mean(categories, train), f"{out}/category_means")

    on_val = explore.union_all(
        [
            models.mean_baseline(train, val),
            models.score_boosted(boosted, val, train),
            sequence_predictions(sequence, window_val, bounds),
        ]
    )
    val_metrics = stage(evaluate.forecast_metrics(on_val), "validation-metrics")
    files.save_table(models.complete_weights(models.ensemble_weights(val_metrics), categories), f"{out}/weights")
    weights = files.load_table(spark, f"{out}/weights")
    report = models.training_report(features.label_split(matrix, splits), train, val_metrics, boosted=boosted)
    files.save_table(report, f"{out}/training_report")

    on_test = stage(
        models.score_boosted(boosted, test, train).unionByName(sequence_predictions(sequence, window_test, bounds)),
        "test-predictions",
    )
    blended = models.blend(on_test, weights)
    metrics = evaluate.forecast_metrics(on_test.unionByName(blended))
    files.save_table(metrics, f"{out}/metrics")
    scored = files.load_table(spark, f"{out}/metrics")
    files.save_metrics(scored.where(F.col("model") == "blend").drop("model"), f"{out}/metrics_json")
    return scored


def run_category_training(
    spark: SparkSession,
    out: str,
    splits: SplitDates = SplitDates(),
    top_n: int | None = None,
    params: BoostingParams = BoostingParams(),
    at_once: int = 4,
) -> tuple[DataFrame, DataFrame]:
    """Fit, store and register a boosted model for each category, or the ``top_n`` largest; returns registry and test metrics.

    The registry has one row per category: status, trees, rounds, rmse on the validation rows, detail of a
    failure, and the path of the model (null where it failed). Each run stores its models in a folder of its own and
    writes the registry last, so a run that broke off leaves the earlier registry and its models as they were.
    """
    train, val, test = features.train_val_test_split(load_features(spark, out), splits)
    folder = f"{out}/models/by_category/{uuid.uuid4().hex}"

    def store(category: str, model: PipelineModel) -> None:
        files.save_model(model, f"{folder}/{hashlib.md5(category.encode()).hexdigest()}")

    fitted, report = models.fit_top_categories(train, val, top_n, params, at_once, store)
    path = F.when(F.col("status") == "trained", F.concat(F.lit(f"{folder}/"), F.md5("category")))
    files.save_table(report.withColumn("path", path), f"{out}/registry")
    scores = evaluate.forecast_metrics(models.score_categories(fitted, test))
    files.save_table(scores, f"{out}/category_metrics")
    return files.load_table(spark, f"{out}/registry"), files.load_table(spark, f"{out}/category_metrics")


def run_category_forecast(
    spark: SparkSession, out: str, category: str, days: int = FORECAST_DAYS, holidays: Sequence[dt.date] = HOLIDAYS
) -> DataFrame:
    """Forecast of one category by its registered model; LookupError where none was trained. Only its folder of the features is read."""
    model = files.load_category_model(files.load_table(spark, f"{out}/registry"), category)
    history = load_features(spark, out).where(F.col("category") == category)
    ahead = forecast.future_features(history, days, holidays, features.feature_columns(history))
    weights = spark.createDataFrame([(category, "boosted", 1.0)], "category string, model string, weight double")
    return forecast.forecast_band(models.as_predictions(model.transform(ahead), "boosted", F.col("yhat")), weights, ("boosted",))


def run_forecast(
    spark: SparkSession, out: str, days: int = FORECAST_DAYS, holidays: Sequence[dt.date] = HOLIDAYS
) -> tuple[DataFrame, DataFrame]:
    """Forecast all trained categories at once; returns the stored forecast and its summary."""
    means = files.load_table(spark, f"{out}/category_means")
    matrix = load_features(spark, out).join(means.select("category"), "category", "left_semi")
    bounds = files.load_table(spark, f"{out}/bounds")
    wanted = features.feature_columns(matrix)
    ahead = forecast.future_features(matrix, days, holidays, wanted).join(
        means.withColumnRenamed("train_mean", "category_mean"), "category"
    )
    boosted = files.load_model(f"{out}/models/boosted").transform(ahead)
    rows = matrix.select("date", "category", *SEQUENCE_COLUMNS)
    windows = models.sequence_future(rows, days, SEQUENCE_COLUMNS)
    scaled = scale_windows(windows, bounds).withColumn("next_value", F.lit(0.0))
    sequence = sequence_predictions(files.load_model(f"{out}/models/sequence"), scaled, bounds)
    predictions = stage(
        models.as_predictions(boosted, "boosted", F.col("yhat")).unionByName(sequence), "future-predictions"
    )
    weights = files.load_table(spark, f"{out}/weights")
    result = forecast.forecast_band(predictions, weights, ("boosted", "sequence"))
    files.save_table(result, f"{out}/forecast")
    stored = files.load_table(spark, f"{out}/forecast")
    files.export_csv(stored.drop("blended"), f"{out}/forecast_csv")
    return stored, forecast.forecast_summary(stored, matrix)


def scale_windows(windows: DataFrame, bounds: DataFrame) -> DataFrame:
    """Scale flat windows of the sequence columns by the bounds of their category."""
    lows = F.array(*[F.col(f"{c}__lo") for c in SEQUENCE_COLUMNS])
    highs = F.array(*[F.col(f"{c}__hi") for c in SEQUENCE_COLUMNS])
    width = len(SEQUENCE_COLUMNS)

    def scaled(x, i):
        lo, hi = F.get(F.col("_lows"), i % width), F.get(F.col("_highs"), i % width)
        return (x - lo) / F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo)

    joined = windows.join(bounds, "category").select(*windows.columns, lows.alias("_lows"), highs.alias("_highs"))
    return joined.withColumn("window", F.transform("window", scaled)).drop("_lows", "_highs")


def run_replenishment(
    spark: SparkSession, out: str, scenarios: Sequence[Scenario] = (Scenario(),), days: int = 30
) -> tuple[DataFrame, DataFrame]:
    """Plan orders for the demand forecast over ``days``, with cost from the panel's prices."""
    ahead = files.load_table(spark, f"{out}/forecast")
    first = ahead.groupBy(F.col("category").alias("_c")).agg(F.min("date").alias("_first"))
    month = ahead.join(first, F.col("category") == F.col("_c")).where(F.col("date") < F.date_add("_first", days))
    demand = month.groupBy("category").agg(F.sum("blended").alias("forecast_demand"))
    panel = load_panel(spark, out)
    config = replenish.cost_config(demand, panel)
    items = stage(replenish.items_from_forecast(demand.join(config, "category")), "items")
    limited = replenish.with_scenarios(items, scenarios)
    low = any((s.service_level or 0.95) < 0.5 for s in scenarios)
    plan = replenish.solve_plan(limited, low_service=low, n_keys=len(scenarios))
    files.save_table(plan, f"{out}/plan")
    stored = files.load_table(spark, f"{out}/plan")
    report = replenish.plan_report(stored)
    files.export_csv(report, f"{out}/plan_csv")
    return report, replenish.plan_totals(stored)
