from pyspark.sql import functions as F

from stockwave.operators import ingest
from stockwave.plans.refresh import ledger, new_files, refresh
from stockwave.session import scratch_path, stage
from stockwave.sources.star import retail_tables

ORDER = ["date", "category"]


def same(a, b):
    return sorted(map(repr, a.select(*sorted(b.columns)).collect())) == sorted(map(repr, b.select(*sorted(b.columns)).collect()))


def test_loads_in_parts_give_the_same_panel(spark):
    facts = stage(ingest.unified_orders(retail_tables(spark, "/root/testdata/sf0.001")), "facts")
    out = scratch_path(spark, "refresh")
    early, late = F.col(ingest.PURCHASED) < "1996-03-10", F.col(ingest.PURCHASED) >= "1996-03-10"
    slot = F.pmod(F.xxhash64("order_id", "product_id"), F.lit(3))
    assert refresh(spark, scratch_inbox(spark, out), out).count() == 0
    facts.where(early & (slot < 2)).write.parquet(f"{out}/inbox/a")
    first = refresh(spark, f"{out}/inbox", out)
    assert same(first, ingest.aggregate_daily_category(facts.where(early & (slot < 2))))
    untouched = stage(first.where("date < '1996-02-01'"), "untouched")
    facts.where((late & (F.col(ingest.PURCHASED) < "1997-01-01")) | (early & (slot == 2) & (F.col(ingest.PURCHASED) >= "1996-02-01"))).write.parquet(f"{out}/inbox/b")
    second = refresh(spark, f"{out}/inbox", out)
    assert same(second.where("date < '1996-02-01'"), untouched)
    wanted = facts.where((F.col(ingest.PURCHASED) < "1997-01-01") & ((slot < 2) | (F.col(ingest.PURCHASED) >= "1996-02-01")))
    assert same(second, ingest.aggregate_daily_category(wanted))
    loaded = ledger(spark, out).count()
    assert same(refresh(spark, f"{out}/inbox", out), second) and ledger(spark, out).count() == loaded and new_files(spark, f"{out}/inbox", out).isEmpty()


def scratch_inbox(spark, out):
    """An inbox without any Parquet file."""
    spark.range(1).selectExpr("'x' as value").write.text(f"{out}/inbox/notes")
    return f"{out}/inbox"


def test_a_load_that_broke_off_is_repeated(spark):
    """Facts and panel are written, the ledger is not: loading the files again changes nothing."""
    facts = stage(ingest.unified_orders(retail_tables(spark, "/root/testdata/sf0.001")), "facts")
    out = scratch_path(spark, "refresh")
    facts.where(F.col(ingest.PURCHASED) < "1996-01-01").write.parquet(f"{out}/inbox/a")
    first = stage(refresh(spark, f"{out}/inbox", out), "first")
    spark.createDataFrame([], ledger(spark, out).schema).write.mode("overwrite").parquet(f"{out}/ledger")
    assert not new_files(spark, f"{out}/inbox", out).isEmpty()
    assert same(refresh(spark, f"{out}/inbox", out), first)
    nowhen = facts.limit(3).withColumn(ingest.PURCHASED, F.lit(None).cast(facts.schema[ingest.PURCHASED].dataType))
    nowhen.write.parquet(f"{out}/inbox/b")
    assert same(refresh(spark, f"{out}/inbox", out), first)
