"""CSV, Parquet, JSON and model files."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwave.sources.schemas import RAW_SCHEMAS


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is present on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


def load_csv(spark: SparkSession, path: str, schema: str, multiline: bool = False) -> DataFrame:
    """CSV with a header and a declared schema. A missing path raises AnalysisException.

    Columns are matched to the header by name, so a file may hold fewer columns or another order;
    a value that does not fit its type becomes null. ``multiline`` is for free text that contains
    line breaks; it makes a file unsplittable, so it is off unless a table needs it.
    """
    raw = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline).csv(path)
    fields = T.StructType.fromDDL(schema).fields
    declared = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields if f.name in raw.columns]
    return raw.select(*declared, *[c for c in raw.columns if c not in {f.name for f in fields}])


def csv_rejects(spark: SparkSession, path: str, schema: str, multiline: bool = False) -> DataFrame:
    """Per declared column of a CSV: values present in the text that do not fit the type (column_name, n_rejected)."""
    raw = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline).csv(path)
    fields = [f for f in T.StructType.fromDDL(schema).fields if f.name in raw.columns]
    lost = [F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name) for f in fields]
    return raw.agg(*lost).unpivot([], [f.name for f in fields], "column_name", "n_rejected")


def load_catalog(
    spark: SparkSession, folder: str, file_names: Mapping[str, str] | None = None
) -> dict[str, DataFrame]:
    """The raw tables by name, each also registered as a temporary view.

    A name may be a file or a folder of files. Reviews hold free text with line breaks, so each of
    their files is one task: a large table should come as a folder of many.
    """
    names = file_names or {table: f"{table}.csv" for table in RAW_SCHEMAS}
    catalog = {
        table: load_csv(spark, f"{folder.rstrip('/')}/{name}", RAW_SCHEMAS[table], table == "reviews")
        for table, name in names.items()
    }
    for table, df in catalog.items():
        df.createOrReplaceTempView(table)
    return catalog


def table_profile(catalog: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of every table of a catalog."""
    profiles = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(table).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for table, df in catalog.items()
    ]
    return reduce(DataFrame.unionByName, profiles)


def save_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Write a processed table as Parquet, replacing what is there.

    With ``partition_by`` the rows are brought together by that column first, so each folder gets
    few files. Meant for the panel and feature tables, whose rows per category are bounded by days.
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = df.repartition(partition_by).write.mode("overwrite").partitionBy(partition_by)
    writer.parquet(path)


def load_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Read a processed table; a missing path raises AnalysisException.

    A table stored by folders needs its ``schema``: without one, Spark takes a folder name such as
    ``001`` for a number.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def load_table_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read a processed table, or an empty one when it has not been written yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return load_table(spark, path, schema)


def export_csv(df: DataFrame, path: str) -> None:
    """Write a report as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def save_metrics(metrics: DataFrame, path: str) -> None:
    """Write (category, mape, rmse, mae) as JSON lines, each a map category -> scores."""
    scores = F.struct("mape", "rmse", "mae")
    metrics.select(
        F.to_json(F.create_map(F.col("category"), scores)).alias("value")
    ).write.mode("overwrite").text(path)


def load_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Read JSON documents keyed by category (one or many keys per document) as rows."""
    shape = "map<string, struct<mape: double, rmse: double, mae: double>>"
    documents = spark.read.option("wholetext", False).text(path)
    return documents.select(F.explode(F.from_json("value", shape)).alias("category", "scores")).select(
        "category", "scores.*"
    )


def save_model(model: PipelineModel, path: str) -> None:
    """Write a fitted pipeline, replacing what is there."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Read a fitted pipeline; a missing path raises."""
    return PipelineModel.load(path)


def trained_categories(registry: DataFrame) -> DataFrame:
    """Distinct categories of a table of trained models, in order; rows of failed fits do not count."""
    if "status" in registry.columns:
        registry = registry.where(F.col("status") == "trained")
    return registry.select("category").distinct().orderBy("category")


def load_category_model(registry: DataFrame, category: str) -> PipelineModel:
    """The registered model of a category; LookupError where none was trained."""
    found = registry.where((F.col("status") == "trained") & (F.col("category") == category)).select("path").head()
    if found is None:
        raise LookupError(f"no trained model for category {category!r}")
    return load_model(found["path"])
