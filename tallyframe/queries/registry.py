"""Named queries over the test tables, each next to the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe.functions.numbers import cents, from_cents, money


@dataclass(frozen=True)
class Query:
    run: Callable[["Tables"], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables` under a name, with its SQL twin."""

    def keep(run: Callable[["Tables"], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(run, sql)
        return run

    return keep


class Tables:
    """The test tables in one folder, and the job inputs derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.read(name)

    @cached_property
    def part_sales(self) -> DataFrame:
        """Sold lines with product, category, price and revenue in cents."""
        sold = self.lineitem.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
        )
        parts = self.part.select(
            F.col("p_partkey").alias("product"),
            F.col("p_type").alias("category"),
            money(F.col("p_retailprice")).alias("price"),
            cents(F.col("p_retailprice")).alias("price_cents"),
        )
        joined = sold.join(parts, "product")
        return joined.withColumn("cents", F.col("price_cents") * F.col("quantity"))

    @cached_property
    def order_heads(self) -> DataFrame:
        return self.orders.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
        )

    @cached_property
    def sales(self) -> DataFrame:
        """Sold lines with revenue, their order's customer and date."""
        lines = self.part_sales.withColumn("revenue", money(from_cents(F.col("cents"))))
        return lines.join(self.order_heads, "order_id")

    @cached_property
    def order_sales(self) -> DataFrame:
        """As ``sales`` with one row per order.

        Lines are summed per order before the join to orders. Both shuffle on
        the order key, so the sum costs no extra exchange and the join, and the
        shuffle on the customer after it, carry a fraction of the rows.
        """
        per_order = self.part_sales.groupBy("order_id").agg(
            from_cents(F.sum("cents")).alias("revenue"),
            F.count(F.lit(1)).alias("line_count"),
        )
        return per_order.join(self.order_heads, "order_id")

    @cached_property
    def customers(self) -> DataFrame:
        """Customers with their nation's key as country; see :meth:`name_countries`."""
        return self.customer.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.col("c_nationkey").alias("country"),
        )

    def name_countries(self, report: DataFrame) -> DataFrame:
        """A finished report with nation names for keys: few rows to look up, short group keys."""
        names = self.nation.select(F.col("n_nationkey").alias("country"), "n_name")
        named = report.join(names, "country")
        return named.select(
            *[F.col("n_name").alias(c) if c == "country" else F.col(c) for c in report.columns]
        )

    @cached_property
    def staff(self) -> DataFrame:
        """Suppliers as staff; the department is the key's last base-five digit."""
        return self.supplier.select(
            F.col("s_suppkey").alias("employee_id"),
            F.col("s_name").alias("name"),
            money(F.col("s_acctbal")).alias("salary"),
            (F.col("s_suppkey") % 5).cast("bigint").alias("department"),
            F.col("s_nationkey").alias("location_id"),
        )

    @cached_property
    def staff_sold(self) -> DataFrame:
        return self.lineitem.select(
            F.col("l_suppkey").alias("employee_id"),
            F.col("l_partkey").alias("product"),
            F.col("l_extendedprice").alias("amount"),
        )

    @cached_property
    def labelled(self) -> DataFrame:
        """Documents with their label row."""
        return self.documents.select("doc_id", "lang", "source", "n_chars").join(
            self.labels, "doc_id"
        )


# SQL fragments shared by the twins.

LINES = """lines AS (
    SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, n.n_name AS country,
           l.l_partkey AS product, p.p_type AS category,
           CAST(o.o_orderdate AS DATE) AS order_date,
           CAST(l.l_quantity AS DECIMAL(10,0)) AS quantity,
           CAST(CAST(p.p_retailprice AS DECIMAL(18,2)) * CAST(l.l_quantity AS DECIMAL(10,0))
                AS DECIMAL(18,2)) AS revenue
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN part p ON l.l_partkey = p.p_partkey
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

CUST = """cust AS (
    SELECT country, customer_id, CAST(SUM(revenue) AS DECIMAL(38,2)) AS total
    FROM lines GROUP BY country, customer_id)"""
