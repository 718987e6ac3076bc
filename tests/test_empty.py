"""Operators on tables without rows return tables without rows."""

from stockwave.operators import evaluate, explore, features, forecast, ingest, models, replenish
from stockwave.params import Scenario
from stockwave.sources.star import retail_tables


def test_ingest_without_items(spark):
    tables = dict(retail_tables(spark, "/root/testdata/sf0.001"))
    tables["order_items"] = tables["order_items"].where("false")
    assert ingest.daily_category_demand(tables).isEmpty()
    assert ingest.unified_orders(tables).isEmpty()


def test_features_and_forecasts_without_rows(panel):
    none = panel.where("false")
    assert features.feature_matrix(none, ()).isEmpty()
    assert features.densify(none).isEmpty()
    assert forecast.future_features(none, 5).isEmpty()
    assert models.sequence_windows(none).isEmpty()
    assert explore.target_corr(features.feature_matrix(none, ())).isEmpty()
    assert explore.flag_outliers(none).isEmpty() and explore.recent_window(none).isEmpty()
    assert explore.kpi_panel(none).first().n_categories == 0


def test_scores_and_plans_without_rows(spark, panel):
    none = models.score_absent_model(panel.where("false"), "none")
    assert evaluate.forecast_metrics(none).isEmpty()
    assert evaluate.histogram(evaluate.residuals(none), "residual", 5, ["model"]).isEmpty()
    items = replenish.items_from_forecast(panel.where("false"))
    plan = replenish.solve_plan(replenish.with_scenarios(items, (Scenario("x", service_level=0.2),)), low_service=True)
    assert replenish.plan_report(plan).isEmpty()
