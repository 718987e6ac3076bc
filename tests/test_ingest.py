import datetime as dt
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stockwave.operators import ingest
from stockwave.sources.schemas import RAW_SCHEMAS

T = dt.datetime


@pytest.fixture(scope="module")
def tables(spark):
    def make(name, columns, rows):
        types = dict(part.strip().split(" ", 1) for part in RAW_SCHEMAS[name].replace("decimal(12,2)", "decimal(12;2)").split(","))
        return spark.createDataFrame(rows, ", ".join(f"{c} {types[c].replace(';', ',')}" for c in columns))

    orders = [
        ("a", "c1", "delivered", T(2020, 1, 1, 23, 59)),
        ("a", "c1", "delivered", T(2020, 1, 3)),  # repeated id, later
        ("b", "c2", "delivered", T(2020, 1, 1, 8)),
        ("c", "c1", "delivered", None),
        ("d", "c3", "shipped", T(2020, 1, 1)),
        ("e", "c9", "delivered", T(2020, 1, 2)),  # unknown customer, no payment, no review
        ("f", "c2", "delivered", T(2020, 1, 2)),  # no items
    ]
    m = Decimal
    items = [("a", "p1", "s1", m("10.10"), m("1.00")), ("a", "p1", "s1", m("10.10"), m("1.00")),
             ("a", "p2", "s9", m("5.05"), None), ("b", "p1", "s2", m("7.00"), m("0.50")),
             ("c", "p1", "s1", m("99.00"), m("9.00")), ("d", "p1", "s1", m("99.00"), m("9.00")),
             ("e", "p3", "s1", m("3.00"), m("0.10")), ("e", "p8", "s1", None, m("0.20"))]
    items += [("b", "p2", "s1", m("1.01"), m("0.02"))] * 300  # one order with most items
    return {
        "orders": make("orders", ["order_id", "customer_id", "order_status", "order_purchase_timestamp"], orders),
        "order_items": make("order_items", ["order_id", "product_id", "seller_id", "price", "freight_value"], items),
        "products": make("products", ["product_id", "product_category_name", "product_photos_qty"],
                         [("p1", "brinquedos", 1), ("p2", "livros", 2), ("p3", "sem_nome", 3)]),
        "category_translation": make("category_translation", ["product_category_name", "product_category_name_english"],
                                     [("brinquedos", "toys"), ("livros", "books")]),
        "customers": make("customers", ["customer_id", "customer_unique_id"], [("c1", "u1"), ("c2", "u2"), ("c3", "u3")]),
        "sellers": make("sellers", ["seller_id", "seller_zip_code_prefix"], [("s1", "1"), ("s2", "2")]),
        "payments": make("payments", ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
                         [("a", 1, "credit_card", 3, m("20.00")), ("a", 2, "voucher", 1, m("5.25")),
                          ("a", 3, "credit_card", 2, m("1.00")), ("b", 1, "boleto", 1, m("7.00"))]),
        "reviews": make("reviews", ["order_id", "review_score"], [("a", 5), ("a", 4), ("a", None), ("b", None)]),
    }


def test_clean_orders(tables):
    rows = {r.order_id: r.order_purchase_timestamp for r in ingest.clean_orders(tables["orders"]).collect()}
    assert rows == {"a": T(2020, 1, 1, 23, 59), "b": T(2020, 1, 1, 8), "e": T(2020, 1, 2), "f": T(2020, 1, 2)}


def test_clean_orders_reduces_copies_before_the_shuffle(tables):
    plan = ingest.clean_orders(tables["orders"])._jdf.queryExecution().executedPlan().toString()
    before, after = plan.split("Exchange hashpartitioning", 1)
    assert "row_number(), 1, Partial" in after and "row_number(), 1, Final" in before


def test_payments_and_reviews(tables):
    pay = {r.order_id: r for r in ingest.payments_per_order(tables["payments"]).collect()}
    assert pay["a"][1:] == (3, 3, Decimal("26.25"), 2, 2)
    assert pay["b"][1:] == (1, 1, Decimal("7.00"), 1, 0)
    rev = {r.order_id: r[1:] for r in ingest.reviews_per_order(tables["reviews"]).collect()}
    assert rev == {"a": (4.5, 2), "b": (None, 0)}


def test_unified_has_one_row_per_item_of_a_kept_order(tables):
    unified = ingest.unified_orders(tables)
    counts = {r.order_id: r["count"] for r in unified.groupBy("order_id").count().collect()}
    assert counts == {"a": 3, "b": 301, "e": 2}
    assert "order_status" not in unified.columns and "product_photos_qty" not in unified.columns
    first = unified.where("order_id = 'e' and product_id = 'p8'").first()
    assert first.product_category_name is None and first.payment_value_sum is None


def test_daily_demand_by_definition(tables):
    rows = {(str(r.date), r.category): r for r in ingest.daily_category_demand(tables).collect()}
    toys = rows[("2020-01-01", "toys")]
    assert toys.order_count == 2
    assert toys.total_revenue == pytest.approx(27.20)
    assert toys.avg_price == pytest.approx(27.20 / 3)
    assert toys.avg_review_score == pytest.approx(4.5)  # order b has no score
    assert toys.avg_installments == pytest.approx((3 + 3 + 1) / 3)
    books = rows[("2020-01-01", "books")]
    assert books.order_count == 2 and books.avg_freight == pytest.approx(0.02)
    unknown = rows[("2020-01-02", "unknown")]
    assert unknown.order_count == 1 and unknown.avg_price == pytest.approx(3.0) and unknown.avg_installments is None
    assert len(rows) == 3


@pytest.mark.parametrize("target_rows", [10, 1_000_000])
def test_both_ways_to_the_panel_agree(tables, target_rows):
    a = ingest.daily_category_demand(tables, target_rows).toPandas().sort_values(["date", "category"], ignore_index=True)
    b = ingest.aggregate_daily_category(ingest.unified_orders(tables)).toPandas()
    b = b.sort_values(["date", "category"], ignore_index=True)
    pd.testing.assert_frame_equal(a, b[a.columns])


def test_daily_path_reads_neither_customers_nor_sellers(tables):
    needed = {k: v for k, v in tables.items() if k not in ("customers", "sellers")}
    assert ingest.daily_category_demand(needed).agg(F.sum("order_count")).first()[0] == 5


def test_items_are_shuffled_once(spark, tables):
    """Without broadcasts: one exchange of the items for the join, none for the basket sums."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = {k: v for k, v in tables.items()}
        plan = ingest.daily_category_demand(small)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above_join = plan.split("SortMergeJoin [order_id")[0]
    assert above_join.count("Exchange hashpartitioning(date") == 2  # distinct split orders, then the result
    assert "Exchange hashpartitioning(order_id" not in above_join
