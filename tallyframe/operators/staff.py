"""Staff pay and sales reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.functions.numbers import exact_sum, money, rounded


def paid_more_than(staff: DataFrame, salary: float) -> DataFrame:
    return staff.filter(F.col("salary") > salary)


def in_department(staff: DataFrame, department: str) -> DataFrame:
    return staff.filter(F.col("department") == department)


def paid_between(staff: DataFrame, low: float, high: float) -> DataFrame:
    """Both ends included."""
    return staff.filter(F.col("salary").between(low, high))


def best_paid(staff: DataFrame, k: int = 5) -> DataFrame:
    return staff.orderBy(F.col("salary").desc(), "employee_id").limit(k)


def average_salary(staff: DataFrame, *keys: str, places: int = 2) -> DataFrame:
    return staff.groupBy(*keys).agg(F.round(F.avg("salary"), places).alias("avg_salary"))


def add_compensation(staff: DataFrame, rate: str = "0.10") -> DataFrame:
    """``bonus`` as a share of salary, and ``total_comp``; missing salaries read as 0."""
    salary = money(F.coalesce(F.col("salary"), F.lit(0)))
    share = F.lit(rate).cast("decimal(5,2)")
    return staff.withColumns(
        {
            "bonus": money(F.round(salary * share, 2)),
            "total_comp": money(salary + F.round(salary * share, 2)),
        }
    )


def staff_sales(staff: DataFrame, sales: DataFrame) -> DataFrame:
    """Each sale with its seller, one ``employee_id`` column left."""
    s = staff.alias("s")
    t = sales.alias("t")
    matched = s.join(t, F.col("s.employee_id") == F.col("t.employee_id"), "inner")
    return matched.drop(F.col("t.employee_id"))


def _sold(sales: DataFrame) -> Column:
    """Sum of all amounts at their own scale."""
    return exact_sum(F.col("amount"), dict(sales.dtypes)["amount"])


def seller_sums(sales: DataFrame) -> DataFrame:
    """Sales per seller, not rounded; joined to staff afterwards, one row per seller."""
    return sales.groupBy("employee_id").agg(_sold(sales).alias("total_sales"))


def sales_by(staff: DataFrame, sales: DataFrame, *keys: str) -> DataFrame:
    """Total sales per staff attribute, rolled up per seller before the join."""
    per_seller = staff_sales(staff.select("employee_id", *keys), seller_sums(sales))
    return per_seller.groupBy(*keys).agg(rounded(F.sum("total_sales")).alias("total_sales"))


def top_seller(staff: DataFrame, sales: DataFrame, k: int = 1) -> DataFrame:
    per_seller = staff_sales(staff.select("employee_id", "name"), seller_sums(sales))
    best = per_seller.orderBy(F.col("total_sales").desc(), "employee_id").limit(k)
    return best.withColumn("total_sales", rounded(F.col("total_sales")))


def product_totals(sales: DataFrame, products: Sequence[str] | None = None) -> DataFrame:
    """Amount and rows per product, optionally only of listed products."""
    rows = sales if products is None else sales.filter(F.col("product").isin(list(products)))
    return rows.groupBy("product").agg(
        rounded(_sold(sales)).alias("total"), F.count(F.lit(1)).alias("n")
    )


def product_totals_listed(sales: DataFrame, products: DataFrame) -> DataFrame:
    """As above with the list held in a table: a semi join instead of an IN list."""
    return product_totals(sales.join(products.select("product"), "product", "left_semi"))
