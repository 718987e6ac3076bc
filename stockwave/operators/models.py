"""Forecast models: set-based baselines, boosted trees, a window regression, and their blend.

Predictions are long, (category, date, model, y, yhat), and are matched by key, never by position.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockwave.operators.explore import union_all
from stockwave.operators.features import feature_columns, series
from stockwave.params import SEQUENCE_LENGTH, STATIC_WEIGHTS, TARGET, BoostingParams
from stockwave.session import stage

ABSENT_MODEL_VALUE = 100.0
PREDICTION = ("category", "date", "model", "y", "yhat")


def as_predictions(df: DataFrame, model: str, yhat: Column) -> DataFrame:
    """Bring scored rows into the long form."""
    return df.select(
        "category", "date", F.lit(model).alias("model"), F.col(TARGET).cast("double").alias("y"), yhat.cast("double").alias("yhat")
    )


def stack_predictions(df: DataFrame, models: Mapping[str, Column]) -> DataFrame:
    """Several models of the same rows in the long form, in one pass over the rows."""
    each = F.array(
        *[F.struct(F.lit(m).alias("model"), yhat.cast("double").alias("yhat")) for m, yhat in models.items()]
    )
    y = F.col(TARGET).cast("double").alias("y")
    return df.select("category", "date", y, F.explode(each).alias("_m")).select(
        "category", "date", "_m.model", "y", "_m.yhat"
    )


def score_absent_model(df: DataFrame, model: str) -> DataFrame:
    """The constant that stands in for a model that was never fitted."""
    return as_predictions(df, model, F.lit(ABSENT_MODEL_VALUE))


def category_means(train: DataFrame) -> DataFrame:
    return train.groupBy("category").agg(F.avg(TARGET).alias("train_mean"))


def with_train_mean(rows: DataFrame, train: DataFrame, name: str = "train_mean") -> DataFrame:
    """Add the training mean of the category; a category without training rows gets the mean of all."""
    known = category_means(train).withColumnRenamed("train_mean", "_mean")
    overall = train.agg(F.avg(TARGET)).scalar()
    return rows.join(known, "category", "left").withColumn(name, F.coalesce("_mean", overall)).drop("_mean")


def mean_baseline(train: DataFrame, rows: DataFrame) -> DataFrame:
    """Predict the training mean of the category."""
    return as_predictions(with_train_mean(rows, train), "mean_baseline", F.col("train_mean"))


def naive_lag1(features: DataFrame) -> DataFrame:
    """Predict the previous row."""
    return as_predictions(features, "lag1", F.col(f"{TARGET}_lag_1"))


def naive_models(train: DataFrame, rows: DataFrame) -> DataFrame:
    """Training mean, previous row and mean of the previous seven rows, in one pass."""
    return stack_predictions(
        with_train_mean(rows, train),
        {
            "mean_baseline": F.col("train_mean"),
            "lag1": F.col(f"{TARGET}_lag_1"),
            "ma7": F.col(f"{TARGET}_rolling_mean_7d"),
        },
    )


def ensemble_weights(metrics: DataFrame, floor: float = 0.001) -> DataFrame:
    """Per category: weights in proportion to the inverse RMSE. A partition holds one row per model."""
    inverse = F.lit(1.0) / F.greatest(F.col("rmse"), F.lit(floor))
    share = inverse / F.sum(inverse).over(Window.partitionBy("category"))
    return metrics.select("category", "model", "rmse", share.alias("weight"))


def static_weights(categories: DataFrame, weights: Mapping[str, float] = STATIC_WEIGHTS) -> DataFrame:
    """Fixed weights for categories without any validation error."""
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(w).alias("weight")) for m, w in weights.items()])
    return categories.select("category", F.explode(pairs).alias("_w")).select("category", "_w.model", "_w.weight")


def complete_weights(
    weights: DataFrame, categories: DataFrame, static: Mapping[str, float] = STATIC_WEIGHTS
) -> DataFrame:
    """``weights`` (category, model, rmse, weight) and the static ones for categories that have none."""
    absent = categories.select("category").distinct().join(weights, "category", "left_anti")
    return weights.unionByName(static_weights(absent, static), allowMissingColumns=True)


def blend(
    predictions: DataFrame, weights: DataFrame, rows: DataFrame | None = None, also: Sequence[Column] = ()
) -> DataFrame:
    """Weighted mean over the models present for a row, never below 0.

    Weights are renormalised over the models that predicted; a model without a weight counts 0.
    With ``rows`` (category, date) every such row appears, 0 where no model predicted. ``also`` adds
    aggregates over the models of a row to the same pass.
    """
    weighted = predictions.join(weights.select("category", "model", "weight"), ["category", "model"], "left")
    w = F.coalesce("weight", F.lit(0.0))
    total = F.try_divide(F.sum(w * F.col("yhat")), F.sum(w))
    blended = weighted.groupBy("category", "date").agg(
        F.greatest(F.coalesce(total, F.lit(0.0)), F.lit(0.0)).alias("yhat"), F.max("y").alias("y"), *also
    )
    extra = [c for c in blended.columns if c not in PREDICTION]
    if rows is not None:
        blended = rows.select("category", "date").join(blended, ["category", "date"], "left").fillna(0.0, ["yhat"])
    return blended.select("category", "date", F.lit("blend").alias("model"), "y", "yhat", *extra)


# --- scaling and windows ---------------------------------------------------------------------


def minmax_fit(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Extremes of each column per category, from the training rows only."""
    return train.groupBy("category").agg(
        *[F.min(c).cast("double").alias(f"{c}__lo") for c in columns],
        *[F.max(c).cast("double").alias(f"{c}__hi") for c in columns],
    )


def _range(column: str) -> Column:
    """Span of a column; a constant column counts as span 1."""
    span = F.col(f"{column}__hi") - F.col(f"{column}__lo")
    return F.when(span == 0.0, F.lit(1.0)).otherwise(span)


def minmax_transform(df: DataFrame, bounds: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale columns to the training range of their category."""
    scaled = {c: ((F.col(c) - F.col(f"{c}__lo")) / _range(c)).alias(c) for c in columns}
    return df.join(bounds, "category").select(*[scaled.get(c, F.col(c)) for c in df.columns])


def minmax_inverse(df: DataFrame, bounds: DataFrame, values: Mapping[str, str]) -> DataFrame:
    """Undo the scaling; ``values`` maps a column to the original column whose range it has."""
    original = {v: (F.col(v) * _range(c) + F.col(f"{c}__lo")).alias(v) for v, c in values.items()}
    return df.join(bounds, "category").select(*[original.get(c, F.col(c)) for c in df.columns])


def sequence_windows(panel: DataFrame, columns: Sequence[str] = (TARGET,), length: int = SEQUENCE_LENGTH) -> DataFrame:
    """Per row: the values of the ``length`` previous rows, oldest first, and the row's own target.

    Rows with a shorter past are left out. ``window`` is flat: all columns of the oldest row first.
    """
    past = series().rowsBetween(-length, -1)
    row = F.array(*[F.col(c).cast("double") for c in columns])
    return (
        panel.select("category", "date", F.col(TARGET).alias("next_value"), F.collect_list(row).over(past).alias("_rows"))
        .where(F.size("_rows") == length)
        .select("category", "date", F.flatten("_rows").alias("window"), "next_value")
    )


def sequence_eligibility(
    split_rows: DataFrame, length: int = SEQUENCE_LENGTH, min_train: int = 10, min_val: int = 5
) -> DataFrame:
    """Windows per category in train and validation, and whether there are enough to fit."""
    counts = split_rows.groupBy("category").agg(
        F.count_if(F.col("split") == "train").alias("_train"), F.count_if(F.col("split") == "val").alias("val_windows")
    )
    train_windows = F.greatest(F.col("_train") - length, F.lit(0))
    return counts.select(
        "category",
        train_windows.alias("train_windows"),
        "val_windows",
        ((train_windows >= min_train) & (F.col("val_windows") >= min_val)).alias("eligible"),
    )


def sequence_future(
    history: DataFrame, days: int, columns: Sequence[str] = (TARGET,), length: int = SEQUENCE_LENGTH
) -> DataFrame:
    """Windows for future days: the last row is repeated once per day with target 0."""
    last = history.groupBy("category").agg(F.max_by(F.struct(*history.columns), "date").alias("_last"))
    padded = last.select(
        "category", F.col("_last"), F.explode(F.sequence(F.lit(1), F.lit(days))).alias("_ahead")
    ).select(
        *[
            F.date_add("_last.date", F.col("_ahead")).alias(c)
            if c == "date"
            else F.lit(0).cast(history.schema[c].dataType).alias(c)
            if c == TARGET
            else F.col(f"_last.{c}").alias(c)
            for c in history.columns
        ],
        F.col("_ahead"),
    )
    newest = Window.partitionBy("category").orderBy(F.desc("date"))
    recent = history.withColumn("_row", F.row_number().over(newest)).where(F.col("_row") <= length).drop("_row")
    both = recent.withColumn("_ahead", F.lit(0)).unionByName(padded)
    past = series().rowsBetween(-length, -1)
    row = F.array(*[F.col(c).cast("double") for c in columns])
    return (
        both.select("category", "date", "_ahead", F.collect_list(row).over(past).alias("_rows"))
        .where((F.col("_ahead") > 0) & (F.size("_rows") == length))
        .select("category", "date", F.col("_ahead").alias("days_ahead"), F.flatten("_rows").alias("window"))
    )


def fit_sequence_regression(windows: DataFrame, reg: float = 0.01) -> PipelineModel:
    """Linear model from a flat window to the next value, pooled over the scaled categories."""
    train = windows.select(array_to_vector("window").alias("inputs"), F.col("next_value").cast("double").alias("label"))
    estimator = LinearRegression(featuresCol="inputs", labelCol="label", predictionCol="yhat", regParam=reg, maxIter=50)
    return Pipeline(stages=[estimator]).fit(train)


def score_sequences(model: PipelineModel, windows: DataFrame) -> DataFrame:
    return model.transform(windows.withColumn("inputs", array_to_vector("window"))).drop("inputs")


# --- boosted trees ---------------------------------------------------------------------------


class BoostedFit(NamedTuple):
    """A boosted model cut at its best round, the rounds fitted to find it, and the error of each on the held-out rows."""

    model: PipelineModel
    rounds: int
    errors: list[float]

    @property
    def trees(self) -> int:
        return self.model.stages[-1].getNumTrees


def patient_best(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """The best place before ``patience`` places bring no gain, and whether that has ended the search."""
    best = 0
    for place, error in enumerate(errors):
        if error < errors[best]:
            best = place
        elif place - best >= patience:
            return best, True
    return best, False


def run_lengths(params: BoostingParams) -> list[int]:
    """Rounds of the runs in which the best round is looked for: each twice as long, the last ``params.trees``.

    A run starts anew, so one that would come next to the limit is left out: all together have at most about twice
    ``params.trees`` rounds.
    """
    lengths = [min(params.trees, max(1, 3 * params.patience))]
    while lengths[-1] < params.trees:
        longer = 2 * lengths[-1]
        lengths.append(longer if 2 * longer <= params.trees else params.trees)
    return lengths


def first_trees(model: GBTRegressionModel, n: int) -> GBTRegressionModel:
    """The model of the first ``n`` rounds."""
    context = SparkContext._active_spark_context
    regression = context._jvm.org.apache.spark.ml.regression
    trees = context._gateway.new_array(regression.DecisionTreeRegressionModel, n)
    weights = context._gateway.new_array(context._jvm.double, n)
    for i, (tree, weight) in enumerate(zip(model._java_obj.trees()[:n], model.treeWeights[:n])):
        trees[i], weights[i] = tree, weight
    cut = GBTRegressionModel(regression.GBTRegressionModel(model.uid, trees, weights, model.numFeatures))
    return cut.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())


def fit_boosted(
    features: DataFrame, columns: Sequence[str] | None = None, params: BoostingParams = BoostingParams(),
    validation: str | None = None,
) -> BoostedFit:
    """Gradient-boosted trees on the feature columns.

    ``validation`` names a boolean column. The error on its rows is measured after every round, and the
    best round is kept once ``params.patience`` more bring no gain. Rounds are fitted in the runs of
    ``run_lengths``; a seed gives the same trees in each, so a longer run only adds to a shorter one. Without such
    rows all ``params.trees`` rounds are kept.
    """
    columns = list(columns or feature_columns(features))
    assembler = VectorAssembler(inputCols=columns, outputCol="inputs")
    held_out = F.col(validation) if validation else F.lit(False)
    rows = assembler.transform(features).select("inputs", F.col(TARGET).cast("double").alias(TARGET), held_out.alias("_held_out"))
    rows = stage(rows, "boosting-inputs")
    train, val = rows.where(~F.col("_held_out")), rows.where("_held_out")
    measured = bool(validation) and not val.isEmpty()
    for rounds in run_lengths(params) if measured else [params.trees]:
        trees = GBTRegressor(
            featuresCol="inputs",
            labelCol=TARGET,
            predictionCol="yhat",
            maxIter=rounds,
            stepSize=params.learning_rate,
            maxDepth=params.depth,
            subsamplingRate=params.row_share,
            featureSubsetStrategy=str(params.column_share),
            seed=params.seed,
        ).fit(train)
        if not measured:
            return BoostedFit(PipelineModel([assembler, trees]), rounds, [])
        errors = trees.evaluateEachIteration(val, "squared")
        best, settled = patient_best(errors, params.patience)
        if settled:
            break
    return BoostedFit(PipelineModel([assembler, first_trees(trees, best + 1)]), rounds, errors)


def with_category_mean(df: DataFrame, train: DataFrame) -> DataFrame:
    """Encode the category as its training mean, so one pooled model serves any number of them."""
    return with_train_mean(df, train, "category_mean")


def fit_pooled(
    train: DataFrame, val: DataFrame, params: BoostingParams = BoostingParams()
) -> tuple[BoostedFit, list[str]]:
    """One boosted model for all categories: cost grows with rows, not with categories."""
    columns = [*feature_columns(train), "category_mean"]
    rows = train.withColumn("_held_out", F.lit(False)).unionByName(val.withColumn("_held_out", F.lit(True)))
    return fit_boosted(with_category_mean(rows, train), columns, params, "_held_out"), columns


def score_boosted(model: PipelineModel | BoostedFit, rows: DataFrame, train: DataFrame) -> DataFrame:
    model = model.model if isinstance(model, BoostedFit) else model
    return as_predictions(model.transform(with_category_mean(rows, train)), "boosted", F.col("yhat"))


def training_report(
    split_rows: DataFrame, train: DataFrame, metrics: DataFrame, length: int = SEQUENCE_LENGTH,
    boosted: BoostedFit | None = None,
) -> DataFrame:
    """One row per category of a pooled run: status, window counts, validation errors per model, and boosting rounds.

    ``trained``: by both models; ``skipped``: too few windows for the window model; ``unseen``: no
    training row, so scored with the mean of all. ``metrics`` has (category, model, rmse) on the
    validation rows; ``scores`` is null where a category has none. ``rounds`` were boosted, and the first
    ``best_round`` kept; both are null without ``boosted``.
    """
    seen = train.select("category").distinct().withColumn("_seen", F.lit(True))
    by_model = metrics.groupBy("category").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("model", "rmse")))).alias("scores")  # one per model
    )
    status = F.when(F.col("_seen").isNull(), "unseen").when(F.col("eligible"), "trained").otherwise("skipped")
    rows = sequence_eligibility(split_rows, length).join(seen, "category", "left").join(by_model, "category", "left")
    rounds, best = (boosted.rounds, boosted.trees) if boosted else (None, None)
    return rows.select(
        "category", status.alias("status"), "train_windows", "val_windows", "scores",
        F.lit(rounds).cast("int").alias("rounds"), F.lit(best).cast("int").alias("best_round"),
    )


def fit_top_categories(
    train: DataFrame, val: DataFrame, n: int | None = 5, params: BoostingParams = BoostingParams(), at_once: int = 4,
    store: Callable[[str, PipelineModel], None] | None = None,
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """One boosted model for each of the ``n`` largest categories; a failure does not stop the rest.

    ``at_once`` categories are fitted at a time: each runs its jobs from a thread of its own that inherits the
    caller's job properties, so Spark fills cores that one category leaves idle (under fair scheduling
    each thread has a pool of its own). The driver holds at most ``n`` names and models; ``fit_pooled`` suits
    very many categories better. Without ``n`` all categories are fitted. ``store`` is called with each name and model
    as soon as it is fitted, in its thread; a category that cannot be stored counts as failed. Returns the models and
    a report: category, status, trees, rounds, rmse on the validation rows (null without), detail of a failure.
    """
    spark = train.sparkSession
    ranked = train.groupBy("category").agg(F.sum(TARGET).alias("_total")).orderBy(F.desc("_total"), "category")
    names = [r["category"] for r in (ranked if n is None else ranked.limit(n)).collect()]
    rows = stage(train.withColumn("_held_out", F.lit(False)).unionByName(val.withColumn("_held_out", F.lit(True))), "category-rows")
    columns = feature_columns(train)

    def fit_one(name: str) -> tuple[str, BoostedFit | None, str]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"category-{name}")
        try:
            fit = fit_boosted(rows.where(F.col("category") == name), columns, params, "_held_out")
            if store:
                store(name, fit.model)
            return name, fit, ""
        except Exception as error:  # noqa: BLE001 - reported per category
            return name, None, f"{type(error).__name__}: {error}"

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        done = list(pool.map(inheritable_thread_target(spark)(fit_one), names))
    report = [
        (name, "trained", fit.trees, fit.rounds, min(fit.errors[: fit.trees]) ** 0.5 if fit.errors else None, "") if fit else (name, "failed", None, None, None, detail)
        for name, fit, detail in done
    ]
    schema = "category string, status string, trees int, rounds int, rmse double, detail string"
    return {name: fit.model for name, fit, _ in done if fit}, spark.createDataFrame(report, schema)


def score_categories(registered: Mapping[str, PipelineModel], rows: DataFrame, name: str = "boosted_own") -> DataFrame:
    """Rows of each category by the category's own model, in the long form; categories without a model get no row.

    One branch per model over the rows of its category: ``rows`` should be stored by category.
    """
    scored = [as_predictions(model.transform(rows.where(F.col("category") == c)), name, F.col("yhat")) for c, model in registered.items()]
    return union_all(scored) if scored else as_predictions(rows.limit(0), name, F.lit(None))
