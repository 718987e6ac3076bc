"""The nine logical retail tables, taken from a star schema of orders and line items on Parquet."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

# Declared schemas: reading needs no job to look into the files.
STAR_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
}

MONEY = "CAST(l_extendedprice AS decimal(12,2))"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(STAR_SCHEMAS[table]).parquet(f"{folder.rstrip('/')}/{table}.parquet")


class TableCatalog(Mapping[str, DataFrame]):
    """Tables by name, each opened when it is first asked for."""

    def __init__(self, openers: Mapping[str, Callable[[], DataFrame]]):
        self._openers = dict(openers)
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self._openers[name]()
        return self._opened[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._openers)

    def __len__(self) -> int:
        return len(self._openers)


def retail_tables(spark: SparkSession, folder: str, category: str = "p_type") -> TableCatalog:
    """Lazy projections of the Parquet tables; ``category`` is the part column to plan by."""

    def table(name: str) -> DataFrame:
        return read(spark, folder, name)

    return TableCatalog(
        {
            "orders": lambda: table("orders").selectExpr(
                "o_orderkey AS order_id",
                "o_custkey AS customer_id",
                "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END AS order_status",
                "o_orderdate AS order_purchase_timestamp",
            ),
            "order_items": lambda: table("lineitem").selectExpr(
                "l_orderkey AS order_id",
                "l_partkey AS product_id",
                "l_suppkey AS seller_id",
                f"{MONEY} AS price",
                f"{MONEY} * CAST(l_tax AS decimal(4,2)) AS freight_value",
            ),
            "products": lambda: table("part").selectExpr("p_partkey AS product_id", f"{category} AS product_category_name"),
            "category_translation": lambda: table("part")
            .where(f"{category} <> 'PROMO'")
            .selectExpr(f"{category} AS product_category_name", f"lower({category}) AS product_category_name_english")
            .distinct(),
            "customers": lambda: table("customer").selectExpr(
                "c_custkey AS customer_id",
                "c_name AS customer_unique_id",
                "CAST(c_nationkey AS string) AS customer_zip_code_prefix",
            ),
            "sellers": lambda: table("supplier").selectExpr(
                "s_suppkey AS seller_id", "CAST(s_nationkey AS string) AS seller_zip_code_prefix"
            ),
            "payments": lambda: table("lineitem").selectExpr(
                "l_orderkey AS order_id",
                "l_linenumber AS payment_sequential",
                "CAST(l_quantity AS int) AS payment_installments",
                f"{MONEY} AS payment_value",
                "CASE l_returnflag WHEN 'R' THEN 'credit_card' WHEN 'A' THEN 'boleto' ELSE 'voucher' END AS payment_type",
            ),
            "reviews": lambda: table("lineitem")
            .where("l_linestatus = 'F'")
            .selectExpr("l_orderkey AS order_id", "CAST(l_suppkey % 5 + 1 AS int) AS review_score"),
            "geolocation": lambda: table("nation"),
        }
    )
