import json

import pytest
from pyspark.errors import AnalysisException

from stockwave import session
from stockwave.session import scratch_path, stage
from stockwave.sources import files
from stockwave.sources.schemas import METRICS_SCHEMA, PANEL_SCHEMA, RAW_SCHEMAS


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return f"file://{path}"


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    path = write(tmp_path, "payments.csv", "payment_value,order_id,payment_installments,extra\n10.50,a,3,x\nbad,b,,y\n")
    df = files.load_csv(spark, path, RAW_SCHEMAS["payments"])
    assert df.columns == ["order_id", "payment_installments", "payment_value", "extra"]
    a, b = df.orderBy("order_id").collect()
    assert (float(a.payment_value), a.payment_installments) == (10.5, 3)
    assert (b.payment_value, b.payment_installments) == (None, None)


def test_csv_dates_and_multiline_text(spark, tmp_path):
    text = 'review_id,order_id,review_score,review_comment_message,review_creation_date\n1,a,5,"two\nlines, ""quoted""",2018-01-02 03:04:05\n'
    df = files.load_csv(spark, write(tmp_path, "r.csv", text), RAW_SCHEMAS["reviews"], multiline=True)
    row = df.first()
    assert row.review_comment_message == 'two\nlines, "quoted"' and str(row.review_creation_date) == "2018-01-02 03:04:05"


def test_missing_sources_raise(spark, tmp_path):
    with pytest.raises(AnalysisException):
        files.load_csv(spark, str(tmp_path / "none.csv"), RAW_SCHEMAS["orders"])
    with pytest.raises(AnalysisException):
        files.load_table(spark, str(tmp_path / "none"))
    with pytest.raises(Exception):
        files.load_model(str(tmp_path / "none"))


def test_missing_table_as_empty(spark, tmp_path, panel):
    path = f"file://{tmp_path}/panel"
    empty = files.load_table_or_empty(spark, path, PANEL_SCHEMA)
    assert empty.isEmpty() and empty.columns == panel.columns
    files.save_table(panel, path)
    assert files.load_table_or_empty(spark, path, PANEL_SCHEMA).count() == panel.count()


def test_partitioned_table_prunes_by_category(spark, panel):
    path = scratch_path(spark, "panel")
    files.save_table(panel, path, partition_by="category")
    files.save_table(panel, path, partition_by="category")  # overwrites
    back = files.load_table(spark, path)
    assert back.count() == panel.count()
    plan = back.where("category = 'toys'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(category" in plan


def test_catalog_views_and_profile(spark, tmp_path):
    for name in RAW_SCHEMAS:
        columns = [part.strip().split(" ")[0] for part in RAW_SCHEMAS[name].replace("decimal(12,2)", "d").split(",")]
        write(tmp_path, f"{name}.csv", ",".join(columns) + "\n" + ",".join([""] * len(columns)) + "\n")
    catalog = files.load_catalog(spark, f"file://{tmp_path}")
    assert len(catalog) == 9 and spark.table("reviews").count() == 1
    profile = {r.table_name: (r.n_rows, r.n_columns) for r in files.table_profile(catalog).collect()}
    assert profile["orders"] == (1, 8) and profile["category_translation"] == (1, 2)


def test_metrics_documents(spark, tmp_path):
    rows = spark.createDataFrame([("a", 12.5, 3.25, 2.0), ("b", 0.0, 1.0, 1.0)], METRICS_SCHEMA)
    path = scratch_path(spark, "metrics")
    files.save_metrics(rows, path)
    assert sorted(files.load_metrics(spark, path).collect()) == sorted(rows.collect())
    one = write(tmp_path, "m.json", json.dumps({"a": {"mape": 1, "rmse": 2, "mae": 3}, "b": {"mape": 4, "rmse": 5, "mae": 6}}))
    assert sorted(tuple(r) for r in files.load_metrics(spark, one).collect()) == [("a", 1, 2, 3), ("b", 4, 5, 6)]


def test_csv_export(spark, panel):
    path = scratch_path(spark, "export")
    files.export_csv(panel, path)
    back = files.load_csv(spark, path, PANEL_SCHEMA)
    assert back.count() == panel.count() and back.exceptAll(panel.select(*back.columns)).isEmpty()


def test_staged_tables_keep_rows_and_schema(panel):
    kept = stage(panel, "test")
    assert kept.schema.simpleString() == panel.schema.simpleString()
    assert kept.exceptAll(panel).isEmpty() and kept.count() == panel.count()


def test_trained_categories_in_order(panel):
    assert [r.category for r in files.trained_categories(panel).collect()] == ["books", "single", "toys"]


def test_shared_folder_comes_from_the_session():
    class Conf(dict):
        def get(self, key, default=None):
            return super().get(key, default)

    class Session:
        def __init__(self, **settings):
            self.conf = Conf({key.replace("_", "."): value for key, value in settings.items()})

    warehouse = "s3a://bucket/warehouse/"
    assert session.shared_dir(Session(spark_checkpoint_dir="s3a://bucket/tmp", spark_sql_warehouse_dir=warehouse)) == "s3a://bucket/tmp"
    assert session.shared_dir(Session(spark_sql_warehouse_dir=warehouse)) == "s3a://bucket/warehouse/_staged"


def test_drop_staged_removes_only_its_folder(spark, panel, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "session_folder", lambda _: f"file://{tmp_path}/app")
    stage(panel, "gone")
    (tmp_path / "kept").mkdir()
    assert (tmp_path / "app").exists()
    session.drop_staged(spark)
    assert not (tmp_path / "app").exists() and (tmp_path / "kept").exists()


def test_a_category_named_like_a_number_stays_text(spark, tmp_path):
    rows = [("2020-01-01", "001", 1), ("2020-01-02", "002", 2)]
    df = spark.createDataFrame(rows, "date string, category string, order_count bigint").selectExpr("cast(date as date) as date", "category", "order_count")
    path = str(tmp_path / "panel")
    files.save_table(df, path, partition_by="category")
    assert {r.category for r in files.load_table(spark, path, PANEL_SCHEMA).collect()} == {"001", "002"}


def test_values_that_do_not_fit_are_counted(spark, tmp_path):
    path = write(tmp_path, "items.csv", "order_id,price\n1,2.50\n2,abc\n3,99999999999999.00\n4,\n")
    got = {r.column_name: r.n_rejected for r in files.csv_rejects(spark, path, "order_id bigint, price decimal(12,2)").collect()}
    assert got == {"order_id": 0, "price": 2}


def test_staged_tables_go_to_the_named_folder_and_are_dropped(spark, tmp_path):
    df = stage(spark.range(3).toDF("x"), "named")
    assert df.count() == 3 and "/stockwave/" in df.inputFiles()[0]
    if not spark.conf.get("spark.checkpoint.dir", None):
        assert spark.conf.get("spark.sql.warehouse.dir").split(":", 1)[-1].lstrip("/") in df.inputFiles()[0]
