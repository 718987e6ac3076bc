"""Incremental loads: new files of the order-item fact, late days included, update the stored panel.

    facts/month=.../file=...   rows of each loaded file by month
    panel/month=...            daily demand per category
    ledger/                    files whose rows are in both

Only new files are read, and only the months they touch are summed again. Each write replaces whole
partitions, so a load that broke off is simply repeated: it writes the same partitions again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockwave.operators import ingest
from stockwave.session import stage
from stockwave.sources import files
from stockwave.sources.schemas import PANEL_SCHEMA

NO_MONTH = "none"
LEDGER_SCHEMA = "path string, bytes bigint, modified timestamp"


def replace_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Write ``df`` by the given columns, replacing the partitions it has rows for and no other."""
    rows = df.repartition(*by)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def ledger(spark: SparkSession, out: str) -> DataFrame:
    """The files whose rows are in the facts and the panel."""
    return files.load_table_or_empty(spark, f"{out}/ledger", LEDGER_SCHEMA)


def new_files(spark: SparkSession, inbox: str, out: str) -> DataFrame:
    """Parquet files below the inbox that are not in the ledger; their content is not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(inbox)
    listed = found.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    return listed.join(ledger(spark, out).select("path"), "path", "left_anti")


def refresh(spark: SparkSession, inbox: str, out: str) -> DataFrame:
    """Load the inbox's new files and bring the panel up to date; returns the stored panel.

    The inbox holds Parquet files of the order-item fact, which do not change once they are there. Rows without a
    purchase time have no day: they are kept among the facts and are in no day of the panel. The driver holds the
    list of new files and of the months they touch.
    """
    arrived = stage(new_files(spark, inbox, out), "arrived")  # the listing as it is now
    paths = [r.path for r in arrived.select("path").collect()]
    if paths:
        month = F.date_format(ingest.PURCHASED, "yyyy-MM")
        rows = spark.read.parquet(*paths).withColumns({"file": F.sha2("_metadata.file_path", 256), "month": F.coalesce(month, F.lit(NO_MONTH))})
        replace_partitions(rows, f"{out}/facts", "month", "file")
        months = [r.month for r in rows.select("month").where(F.col("month") != NO_MONTH).distinct().collect()]
        facts = spark.read.parquet(f"{out}/facts").where(F.col("month").isin(months))  # reads only these folders
        panel = ingest.aggregate_daily_category(facts.drop("month", "file"))
        replace_partitions(panel.withColumn("month", F.date_format("date", "yyyy-MM")), f"{out}/panel", "month")
        arrived.write.mode("append").parquet(f"{out}/ledger")
    return files.load_table_or_empty(spark, f"{out}/panel", f"{PANEL_SCHEMA}, month string").drop("month")
