"""Sales reports.

A *sales* frame has one row per order line with ``revenue``; ``add_revenue``
makes one. Reports that need a customer's country first roll the lines up to
one row per customer and join after that: the join then moves as many rows as
there are customers, and a customer holding most of the lines is one row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyframe.functions.dates import year_month
from tallyframe.functions.numbers import exact, rounded, total
from tallyframe.operators.joins import LOOKUP_ROWS, join_lookup
from tallyframe.operators.ranking import rank_within


def add_revenue(lines: DataFrame) -> DataFrame:
    """``revenue`` = price x quantity, exact and not rounded; totals round it once."""
    price = exact(F.col("price"), dict(lines.dtypes)["price"])
    return lines.withColumn("revenue", price * F.col("quantity"))


def rows_per(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def revenue_by(sales: DataFrame, *keys: str) -> DataFrame:
    return sales.groupBy(*keys).agg(total(F.col("revenue")).alias("total_revenue"))


def customer_sums(sales: DataFrame) -> DataFrame:
    """One row per customer: revenue at its own scale and number of lines.

    Takes raw lines, or lines already rolled up with a ``line_count``. What is
    summed or ranked further is not rounded here.
    """
    count = F.sum("line_count") if "line_count" in sales.columns else F.count(F.lit(1))
    return sales.groupBy("customer_id").agg(
        F.sum("revenue").alias("total"), count.cast("bigint").alias("line_count")
    )


def customer_totals(sales: DataFrame) -> DataFrame:
    """One row per customer: total revenue in cents and number of lines."""
    return customer_sums(sales).withColumn("total", rounded(F.col("total")))


def customer_country_sums(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Customer sums with the customer's country; the base of the country reports."""
    home = customers.select("customer_id", "country")
    return customer_sums(sales).join(home, "customer_id")


def revenue_by_country(sales: DataFrame, customers: DataFrame) -> DataFrame:
    totals = customer_country_sums(sales, customers)
    return totals.groupBy("country").agg(total(F.col("total")).alias("total_revenue"))


def revenue_by_country_broadcast(sales: DataFrame, customers: DataFrame, most_rows: int = LOOKUP_ROWS) -> DataFrame:
    """Customers joined to every line, then summed by country.

    The customers are counted first. Up to ``most_rows`` they are sent to all
    tasks and lines are not shuffled for the join; beyond it they are shuffled.
    """
    home = customers.select("customer_id", "country")
    return revenue_by(join_lookup(sales, home, "customer_id", most_rows=most_rows), "country")


def average_order_value(sales: DataFrame, customers: DataFrame, places: int = 4) -> DataFrame:
    """Mean revenue per line and country, from per-customer sums and counts."""
    totals = customer_country_sums(sales, customers)
    mean = F.sum("total").cast("double") / F.sum("line_count")
    return totals.groupBy("country").agg(F.round(mean, places).alias("avg_order_value"))


def average_customer_revenue(
    sales: DataFrame, customers: DataFrame, places: int = 4
) -> DataFrame:
    """Mean over a country's customers of their total revenue."""
    totals = customer_country_sums(sales, customers)
    return totals.groupBy("country").agg(
        F.round(F.avg(F.col("total").cast("double")), places).alias("avg_rev")
    )


def best_customers(sales: DataFrame, customers: DataFrame, places: int = 1) -> DataFrame:
    """Customers ranked within their country up to ``places``; ties share a rank.

    Ranks go by exact totals, shown in cents.
    """
    totals = customer_country_sums(sales, customers).select("country", "customer_id", "total")
    ranked = rank_within(totals, ["country"], [F.col("total").desc()], places, into="rk")
    return ranked.withColumn("total", rounded(F.col("total")))


def top_customers(sales: DataFrame, k: int = 10) -> DataFrame:
    return (
        customer_sums(sales)
        .select("customer_id", "total")
        .orderBy(F.col("total").desc(), "customer_id")
        .limit(k)
        .withColumn("total", rounded(F.col("total")))
    )


def top_products(sales: DataFrame, k: int = 1) -> DataFrame:
    """Products by quantity sold."""
    return (
        sales.groupBy("product")
        .agg(F.sum("quantity").cast("bigint").alias("total_quantity"))
        .orderBy(F.col("total_quantity").desc(), "product")
        .limit(k)
    )


def wide_baskets(sales: DataFrame, more_than: int = 5) -> DataFrame:
    """Customers who bought more than so many different products.

    The two group steps each combine before their shuffle, so repeated lines of
    one customer and product travel once.
    """
    pairs = sales.select("customer_id", "product").distinct()
    counted = pairs.groupBy("customer_id").agg(F.count("product").alias("n"))
    return counted.filter(F.col("n") > more_than)


def customers_without_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Anti join against the distinct buyers, so a frequent buyer's orders travel once."""
    buyers = orders.select("customer_id").distinct()
    return customers.join(buyers, "customer_id", "left_anti")


def monthly_revenue(sales: DataFrame, day: str = "order_date") -> DataFrame:
    """Revenue per calendar month with sales.

    Grouped on the first day of the month, a four-byte key; the month is turned
    into text once per month, not once per line.
    """
    months = sales.groupBy(F.trunc(F.col(day), "month").alias("first_day")).agg(
        total(F.col("revenue")).alias("rev")
    )
    return months.select(year_month(F.col("first_day")).alias("month"), "rev")


def month_change(monthly: DataFrame, fill_months: bool = False) -> DataFrame:
    """Each month against the month before it in the table.

    With ``fill_months`` absent months count as zero, so the change is against
    the calendar month before. The window has no partition: its input is one
    row per month.
    """
    if fill_months:
        monthly = _every_month(monthly)
    ordered = Window.orderBy("month")
    prev = F.lag("rev", 1).over(ordered)
    return monthly.select(
        "month", "rev", prev.alias("prev"), (F.col("rev") - prev).alias("change")
    ).withColumn("change", F.col("change").cast("decimal(38,2)"))


def _every_month(monthly: DataFrame) -> DataFrame:
    first_day = F.to_date(F.concat("month", F.lit("-01")))
    bounds = monthly.agg(F.min(first_day).alias("a"), F.max(first_day).alias("z"))
    months = bounds.select(
        F.explode(F.expr("sequence(a, z, interval 1 month)")).alias("day")
    ).select(year_month(F.col("day")).alias("month"))
    return months.join(monthly, "month", "left").withColumn(
        "rev", F.coalesce("rev", F.lit(0).cast("decimal(38,2)"))
    )


def median_order_value(sales: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Approximate (lower) median of revenue; the sketch merges map-side.

    For the exact figure use ``plans.ordered.exact_median``.
    """
    return sales.agg(
        F.percentile_approx("revenue", 0.5, accuracy).alias("median_order_value")
    )


# The same reports as SQL text over views of cleaned frames.

CATEGORY_SQL = """
    SELECT category,
           CAST(SUM(quantity) AS BIGINT) AS total_quantity,
           CAST(SUM(revenue) AS DECIMAL(38,2)) AS total_revenue
    FROM {sales}
    GROUP BY category
"""

BEST_SPENDER_SQL = """
    SELECT customer_id, CAST(SUM(revenue) AS DECIMAL(38,2)) AS total_spent
    FROM {sales}
    GROUP BY customer_id
    ORDER BY total_spent DESC, customer_id
    LIMIT 1
"""

MONTH_SQL = """
    SELECT date_format(order_date, 'yyyy-MM') AS month,
           CAST(SUM(revenue) AS DECIMAL(38,2)) AS rev
    FROM {sales}
    GROUP BY 1
    ORDER BY month
"""

BASKET_SQL = """
    SELECT customer_id, COUNT(DISTINCT product) AS n
    FROM {sales}
    GROUP BY customer_id
    HAVING COUNT(DISTINCT product) > 5
"""


def run_sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """Run SQL text over frames named in it, without leaving views behind."""
    return spark.sql(text, **frames)


def sales_between(sales: DataFrame, begin: dt.date, end: dt.date, day: str) -> DataFrame:
    """Lines of ``begin`` <= day < ``end``; a plain range, so it reaches the scan."""
    return sales.filter((F.col(day) >= F.lit(begin)) & (F.col(day) < F.lit(end)))


def display_order(df: DataFrame, *order: str | Column, k: int | None = None) -> DataFrame:
    """Sorted for display; with ``k`` only the top rows are kept by each task."""
    ordered = df.orderBy(*order)
    return ordered if k is None else ordered.limit(k)
