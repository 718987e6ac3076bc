"""Raw tables to the order-item fact and to daily demand per category.

Order items are the only data that grows without bound; everything after the daily roll-up has at
most days x categories rows. The steps here therefore decide the cost at scale.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockwave.functions.numeric import mean_of_sum, minor_units
from stockwave.functions.skew import TARGET_ROWS, hot_keys, row_slots, salted_join
from stockwave.params import UNUSED_COLUMNS
from stockwave.session import stage

PURCHASED = "order_purchase_timestamp"
ENGLISH = "product_category_name_english"
UNKNOWN = "unknown"


def clean_orders(orders: DataFrame) -> DataFrame:
    """Delivered orders with a purchase time, one row per order id.

    Of several rows with one id the earliest purchase wins (ties: the smallest remaining columns).
    Spark keeps one row per id in every map task before the shuffle (WindowGroupLimit), so an id
    repeated millions of times does not reach a single task.
    """
    ties = [c for c in orders.columns if c not in ("order_id", PURCHASED)]
    first = Window.partitionBy("order_id").orderBy(PURCHASED, *ties)
    return (
        orders.where((F.col("order_status") == "delivered") & F.col(PURCHASED).isNotNull())
        .withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def payments_per_order(payments: DataFrame) -> DataFrame:
    """One row per order: last sequence, most installments, value, methods, card payments."""
    return payments.groupBy("order_id").agg(
        F.max("payment_sequential").alias("payment_sequential_max"),
        F.max("payment_installments").alias("payment_installments_max"),
        F.sum("payment_value").alias("payment_value_sum"),
        F.size(F.collect_set("payment_type")).cast("bigint").alias("payment_method_count"),  # a handful of methods
        F.count_if(F.col("payment_type") == "credit_card").alias("payment_type_credit_card"),
    )


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    """One row per order: mean review score and number of scores."""
    return reviews.groupBy("order_id").agg(
        F.avg("review_score").alias("review_score_mean"),
        F.count("review_score").alias("review_score_count"),
    )


def with_category(lines: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Attach product columns and the translated category name.

    Products meet the translation first, at product grain, so items are never shuffled by one of a
    few category names. The result is stored, which shows Spark its size: it is broadcast while it is
    under the limit, and otherwise both sides are shuffled by product, where the skew join splits a
    product that holds a large share of the lines.
    """
    products = tables["products"].join(tables["category_translation"], "product_category_name", "left")
    return lines.join(stage(products, "products"), "product_id", "left")


def unified_orders(tables: Mapping[str, DataFrame], drop: Sequence[str] = UNUSED_COLUMNS) -> DataFrame:
    """One row per item of a delivered order, with product, customer, seller, payment and review.

    Everything known per order is joined at order grain first, where order ids are unique and one
    hash partitioning serves three joins; items are then joined once. That join is salted, since
    a single order may hold a large share of the items.
    """
    per_order = (
        clean_orders(tables["orders"])
        .join(payments_per_order(tables["payments"]), "order_id", "left")
        .join(reviews_per_order(tables["reviews"]), "order_id", "left")
        .join(tables["customers"], "customer_id", "left")
    )
    lines = salted_join(tables["order_items"], per_order, "order_id", "inner")
    return (
        with_category(lines, tables)
        .join(tables["sellers"], "seller_id", "left")
        .drop(*drop)
    )


def aggregate_daily_category(unified: DataFrame) -> DataFrame:
    """Daily demand per category from the order-item fact."""
    return (
        unified.groupBy(
            F.to_date(PURCHASED).alias("date"),
            F.coalesce(F.col(ENGLISH).cast("string"), F.lit(UNKNOWN)).alias("category"),
        )
        .agg(
            F.count_distinct("order_id").alias("order_count"),
            mean_of_sum(F.sum("price"), F.count("price")).alias("avg_price"),
            F.sum("price").cast("double").alias("total_revenue"),
            mean_of_sum(F.sum("freight_value"), F.count("freight_value")).alias("avg_freight"),
            F.avg("review_score_mean").alias("avg_review_score"),
            mean_of_sum(
                F.sum("payment_installments_max"), F.count("payment_installments_max")
            ).alias("avg_installments"),
        )
    )


def daily_category_demand(tables: Mapping[str, DataFrame], target_rows: int = TARGET_ROWS) -> DataFrame:
    """Daily demand per category straight from the raw tables.

    Same result as ``aggregate_daily_category(unified_orders(tables))`` for unique customer and
    seller keys, without building the wide fact: customers and sellers, which add no column, are
    not read. Items are shuffled once, for the salted join with their order (and once by product
    where products are too large to broadcast). As the result is partitioned by order and salt,
    the items of an (order, category) are summed where they are, distinct orders become a count of
    those sums, and only orders split over several salts are counted as distinct ids. What is left
    for the last shuffle is days x categories.
    """
    items = tables["order_items"]
    price, price_factor = minor_units(items, "price")
    freight, freight_factor = minor_units(items, "freight_value")
    lines = with_category(
        items.select(
            "order_id", "product_id", price.alias("price"), freight.alias("freight"), row_slots().alias("_slot")
        ),
        tables,
    ).select(
        "order_id", "price", "freight", "_slot", F.coalesce(F.col(ENGLISH).cast("string"), F.lit(UNKNOWN)).alias("category")
    )
    orders = clean_orders(tables["orders"].select("order_id", "order_status", PURCHASED))
    per_order = (
        orders.select("order_id", F.to_date(PURCHASED).alias("date"))
        .join(payments_per_order(tables["payments"]).select("order_id", "payment_installments_max"), "order_id", "left")
        .join(reviews_per_order(tables["reviews"]).select("order_id", "review_score_mean"), "order_id", "left")
    )
    joined = salted_join(
        lines, per_order, "order_id", hot=hot_keys(items, "order_id", target_rows), slot="_slot", keep=True
    )
    baskets = joined.groupBy(
        "order_id", "_salt", "_hot", "category", "date", "payment_installments_max", "review_score_mean"
    ).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum("price").alias("price_sum"),
        F.count("price").alias("price_n"),
        F.sum("freight").alias("freight_sum"),
        F.count("freight").alias("freight_n"),
    )
    n, score, installments = (F.col(c) for c in ("n_items", "review_score_mean", "payment_installments_max"))
    split_order = F.when(F.col("_hot").isNotNull(), F.col("order_id"))
    revenue = F.sum("price_sum").cast("double") / price_factor
    freight_total = F.sum("freight_sum").cast("double") / freight_factor
    return baskets.groupBy("date", "category").agg(
        (F.count_if(F.col("_hot").isNull()) + F.count_distinct(split_order)).alias("order_count"),
        mean_of_sum(revenue, F.sum("price_n")).alias("avg_price"),
        revenue.alias("total_revenue"),
        mean_of_sum(freight_total, F.sum("freight_n")).alias("avg_freight"),
        mean_of_sum(F.sum(score * n), F.sum(F.when(score.isNotNull(), n))).alias("avg_review_score"),
        mean_of_sum(F.sum(installments * n), F.sum(F.when(installments.isNotNull(), n))).alias("avg_installments"),
    )
