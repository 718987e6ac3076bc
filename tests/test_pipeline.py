import pytest

from stockwave.params import BoostingParams, Scenario, SplitDates, yearly_holidays
from stockwave.plans import pipeline
from stockwave.session import scratch_path
from stockwave.sources import files
from stockwave.sources.star import retail_tables

SPLITS = SplitDates(
    train=("1995-01-01", "1999-12-31"), val=("2000-01-01", "2000-12-31"), test=("2001-01-01", "2001-07-31")
)
HOLIDAYS = yearly_holidays(1995, 2001)


@pytest.fixture(scope="module")
def out(spark):
    return scratch_path(spark, "pipeline")


def test_whole_pipeline_from_csv(spark, out):
    source = retail_tables(spark, "/root/testdata/sf0.001")
    for name, df in source.items():
        files.export_csv(df, f"{out}/raw/{name}")
    catalog = files.load_catalog(spark, f"{out}/raw", {name: name for name in source})
    unified, panel = pipeline.run_ingest(spark, catalog, out)
    assert unified.count() > 0
    assert panel.select("category").distinct().count() == 6
    matrix = pipeline.run_features(spark, out, HOLIDAYS)
    assert matrix.count() == panel.count()

    metrics = pipeline.run_training(spark, out, SPLITS, top_n=4, params=BoostingParams(trees=4, depth=3, learning_rate=0.3))
    rows = metrics.collect()
    assert {r.model for r in rows} == {"boosted", "sequence", "blend"}
    assert len({r.category for r in rows}) == 4
    assert files.load_metrics(spark, f"{out}/metrics_json").count() == 4

    ahead, summary = pipeline.run_forecast(spark, out, 40, HOLIDAYS)
    assert ahead.count() == 4 * 40
    assert ahead.where("predicted_lower > predicted_orders or predicted_orders > predicted_upper").isEmpty()
    assert ahead.where("boosted_prediction is null or sequence_prediction is null").isEmpty()
    assert {r.forecast_days for r in summary.collect()} == {40}

    report, totals = pipeline.run_replenishment(spark, out, (Scenario("base"), Scenario("low", service_level=0.3)))
    assert report.count() == 8 and {r.status for r in totals.collect()} == {"Optimal"}
    assert files.load_csv(spark, f"{out}/plan_csv", "category string, holding_cost double").count() == 8


def test_a_registered_model_per_category(spark, out):
    """Follows the test above, whose features it reads."""
    few = BoostingParams(trees=4, depth=3, learning_rate=0.3)
    registry, metrics = pipeline.run_category_training(spark, out, SPLITS, top_n=3, params=few)
    rows = registry.collect()
    names = [r.category for r in files.trained_categories(registry).collect()]
    assert names == sorted(r.category for r in rows if r.status == "trained") and len(names) == 3
    assert {r.category for r in metrics.collect()} <= set(names)
    again, _ = pipeline.run_category_training(spark, out, SPLITS, top_n=2, params=few)
    assert again.count() == 2
    for row in rows:  # an earlier run's models stay where its registry says
        assert files.load_model(row.path).stages[-1].getNumTrees == row.trees
    known = files.trained_categories(again).head().category
    ahead = pipeline.run_category_forecast(spark, out, known, 10, HOLIDAYS).collect()
    assert len(ahead) == 10 and {r.category for r in ahead} == {known}
    assert all(r.predicted_lower <= r.predicted_orders <= r.predicted_upper for r in ahead)
    with pytest.raises(LookupError, match="no trained model"):
        pipeline.run_category_forecast(spark, out, "nothing", 10, HOLIDAYS)


def test_failed_categories_are_registered_without_a_model(spark):
    rows = [("a", "trained", "p"), ("b", "failed", None)]
    registry = spark.createDataFrame(rows, "category string, status string, path string")
    assert [r.category for r in files.trained_categories(registry).collect()] == ["a"]
    with pytest.raises(LookupError):
        files.load_category_model(registry, "b")
