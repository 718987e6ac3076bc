"""Walk-forward validation and tuning of linear models from sums that merge.

Rows are read once: each (category, block of days) gives the sums of products of its rows, and a fold's
training sums are the running sum over its blocks. All folds are then solved from a few numbers per
category, so cost grows with the rows and not with rows times folds.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockwave.functions.linear import linear_value, solve, squared_error, sums_of_products
from stockwave.operators.evaluate import forecast_metrics
from stockwave.operators.features import walk_forward_folds
from stockwave.params import TARGET
from stockwave.session import stage


class Folds(NamedTuple):
    """Expanding windows: fold k trains on days up to ``first_cut + k * step_days`` and validates on the ``val_days`` after."""

    first_cut: dt.date
    folds: int
    step_days: int
    val_days: int


def complete_rows(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key, target and inputs; rows with a null among them cannot be used."""
    return rows.select("category", "date", TARGET, *columns).na.drop()


def fold_sums(rows: DataFrame, columns: Sequence[str], plan: Folds) -> DataFrame:
    """(category, fold, sums) of the training rows of every fold that has any for the category.

    The window runs over one row per block of a category.
    """
    blocks_ahead = F.ceil(F.datediff("date", F.lit(plan.first_cut)) / plan.step_days)
    block = F.greatest(blocks_ahead, F.lit(0)).cast("int").alias("fold")
    sums = sums_of_products([F.col(c) for c in columns], F.col(TARGET))
    names = [f"s{i}" for i in range(len(sums))]
    parts = rows.select("*", block).where(F.col("fold") < plan.folds).groupBy("category", "fold").agg(*[s.alias(n) for s, n in zip(sums, names)])
    order = Window.partitionBy("category").orderBy("fold")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    last = F.coalesce(F.lead("fold").over(order) - 1, F.lit(plan.folds - 1))
    running = parts.select("category", F.sequence("fold", last).alias("folds"), F.array(*[F.sum(n).over(so_far) for n in names]).alias("sums"))
    return running.select("category", F.explode("folds").alias("fold"), "sums")


def fold_models(rows: DataFrame, columns: Sequence[str], plan: Folds, ridge: float = 0.0) -> DataFrame:
    """(category, fold, n_train, train_mean, coefficients) for every fold, in one pass over the rows."""
    sums = fold_sums(complete_rows(rows, columns), columns, plan)
    n, total = F.get("sums", F.lit(0)), F.get("sums", F.lit(len(columns) + 1))
    return sums.select(
        "category", "fold", n.cast("bigint").alias("n_train"), (total / n).alias("train_mean"),
        solve(F.col("sums"), len(columns), ridge).alias("coefficients"),
    )


def walk_forward_predictions(rows: DataFrame, columns: Sequence[str], plan: Folds, ridge: float = 0.0) -> DataFrame:
    """(category, fold, date, model, y, yhat, n_train) on the validation rows of every fold.

    Models: ``linear`` on the columns, never below 0, and ``mean_baseline``. A row is there once per fold that validates on
    it; folds without training rows of a category have no predictions for it. ``rows`` is read twice, so it should be stored.
    """
    models = fold_models(rows, columns, plan, ridge)
    val = walk_forward_folds(complete_rows(rows, columns), *plan).where("role = 'val'")
    yhat = F.greatest(linear_value(F.col("coefficients"), [F.col(c) for c in columns]), F.lit(0.0))
    each = F.array(*[F.struct(F.lit(m).alias("model"), v.alias("yhat")) for m, v in (("linear", yhat), ("mean_baseline", F.col("train_mean")))])
    scored = val.join(models, ["category", "fold"]).select("category", "fold", "date", F.col(TARGET).cast("double").alias("y"), "n_train", F.explode(each).alias("m"))
    return scored.select("category", "fold", "date", "m.model", "y", "m.yhat", "n_train")


def walk_forward_scores(rows: DataFrame, columns: Sequence[str], plan: Folds, ridge: float = 0.0) -> DataFrame:
    """Errors per category, fold and model on the days after each cut."""
    predictions = walk_forward_predictions(rows, columns, plan, ridge)
    keys = ("category", "fold", "model", "n_train")
    counts = predictions.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_val"))
    return forecast_metrics(predictions, keys).join(counts, list(keys))


class Trial(NamedTuple):
    """One set of parameters: which columns a linear model uses, and its penalty."""

    name: str
    columns: tuple[str, ...]
    ridge: float


def tune(rows: DataFrame, trials: Sequence[Trial], plan: Folds) -> tuple[DataFrame, DataFrame]:
    """Successive halving over the folds: trials, and the best one fitted again on all rows.

    The first rung scores all trials on the first fold, each further one the better half on twice as many
    folds, until one trial is left or a rung has used all folds. Training and validation sums are made once, from one pass over the
    rows each; a rung only solves small systems. The driver holds the list of trials and their errors.

    Returns (trial, ridge, columns, rung, folds, rmse, is_best), each trial once, with the last rung it
    reached, and (category, n_train, coefficients) of the best, whose coefficients follow the sorted columns of all trials.
    Ties go to the trial named first.
    """
    columns = sorted({c for t in trials for c in t.columns})
    usable = complete_rows(rows, columns)
    train = stage(fold_sums(usable, columns, plan), "fold-sums")
    held_out = walk_forward_folds(usable, *plan).where("role = 'val'")
    sums = sums_of_products([F.col(c) for c in columns], F.col(TARGET))
    val = stage(held_out.groupBy("category", "fold").agg(F.array(*sums).alias("val_sums")), "validation-sums")
    both = train.join(val, ["category", "fold"])

    def literal(chosen: Sequence[Trial]):
        return F.array(*[F.struct(F.lit(t.name).alias("trial"), F.lit(t.ridge).alias("ridge"), F.array(*[F.lit(c in t.columns) for c in columns]).alias("used")) for t in chosen])

    def fitted(frame: DataFrame, chosen: Sequence[Trial]) -> DataFrame:
        each = frame.select("*", F.explode(literal(chosen)).alias("t")).select(*frame.columns, "t.*")
        return each.withColumn("coefficients", solve(F.col("sums"), len(columns), F.col("ridge"), F.col("used")))

    left, used, results, rung = list(trials), 1, {}, 0
    while True:
        scored = fitted(both.where(F.col("fold") < used), left)
        error, n = squared_error(F.col("val_sums"), F.col("coefficients"), len(columns)), F.get("val_sums", F.lit(0))
        found = {r.trial: r.rmse for r in scored.groupBy("trial").agg(F.sqrt(F.sum(error) / F.sum(n)).alias("rmse")).collect()}  # a row per trial
        for t in left:
            results[t.name] = (rung, used, found.get(t.name))
        if len(left) == 1 or used >= plan.folds or not found:
            break
        left = sorted(left, key=lambda t: found[t.name])[: (len(left) + 1) // 2]
        used, rung = min(plan.folds, used * 2), rung + 1
    best = min(left, key=lambda t: (results[t.name][2] is None, results[t.name][2] or 0.0))
    table = [(t.name, t.ridge, list(t.columns), *results[t.name], t.name == best.name) for t in trials]
    schema = "trial string, ridge double, columns array<string>, rung int, folds int, rmse double, is_best boolean"
    whole = usable.groupBy("category").agg(F.array(*sums).alias("sums"))
    refit = fitted(whole, [best]).select("category", F.get("sums", F.lit(0)).cast("bigint").alias("n_train"), "coefficients")
    return rows.sparkSession.createDataFrame(table, schema), refit
