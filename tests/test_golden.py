"""Known answers on small CSV files, worked out row by row in plain Python."""

import csv
import datetime as dt
import os
import statistics
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal as D

import pytest
from pyspark.sql import functions as F

from tallyframe import schemas
from tallyframe.functions.bands import band
from tallyframe.functions.numbers import money
from tallyframe.operators import insights, staff
from tallyframe.operators.cleaning import clean_customers, clean_orders
from tallyframe.plans.ordered import exact_median
from tallyframe.sources.files import read_csv

FOLDER = os.path.join(os.path.dirname(os.path.abspath(__file__)), "csv")
FILES = {
    "customers": (schemas.CUSTOMERS, "yyyy-MM-dd"),
    "orders": (schemas.ORDERS, "yyyy-MM-dd"),
    "employees": (schemas.EMPLOYEES, "yyyy-MM-dd"),
    "employee_sales": (schemas.EMPLOYEE_SALES, "yyyy-MM-dd"),
    "sales": (schemas.SALES, "dd-MM-yyyy"),
}


def path(name):
    return os.path.join(FOLDER, f"{name}.csv")


def plain(name):
    with open(path(name), encoding="utf-8") as f:
        return list(csv.DictReader(f))


@pytest.fixture(scope="module")
def data(spark):
    out = {name: read_csv(spark, path(name), schema, pattern) for name, (schema, pattern) in FILES.items()}
    out["customers"] = clean_customers(out["customers"])
    out["orders"] = insights.add_revenue(clean_orders(out["orders"]))
    return out


@pytest.fixture(scope="module")
def lines():
    """Order lines with exact revenue and the customer's country."""
    homes = {c["customer_id"]: c["country"] for c in plain("customers")}
    return [{**o, "revenue": D(o["price"]) * int(o["quantity"]), "country": homes.get(o["customer_id"])} for o in plain("orders")]


def summed(rows, key, value):
    out = defaultdict(D)
    for row in rows:
        out[row[key]] += D(row[value])
    return dict(out)


def pairs(df):
    return {row[0]: row[1] for row in df.collect()}


def cents(value):
    return value.quantize(D("0.01"), ROUND_HALF_UP)


def test_inferred_types(spark):
    inferred = dict(read_csv(spark, path("orders")).dtypes)
    assert inferred["price"] == "double" and inferred["order_date"] == "date"


def test_category(spark, data, lines):
    rows = insights.run_sql(spark, insights.CATEGORY_SQL, sales=data["orders"]).collect()
    revenue, quantity = summed(lines, "category", "revenue"), summed(lines, "category", "quantity")
    assert {tuple(r) for r in rows} == {(k, int(quantity[k]), cents(v)) for k, v in revenue.items()}


def test_country(data, lines):
    want = {k: cents(v) for k, v in summed([r for r in lines if r["country"]], "country", "revenue").items()}
    assert len(want) == 3
    assert pairs(insights.revenue_by_country(data["orders"], data["customers"])) == want
    assert pairs(insights.revenue_by_country_broadcast(data["orders"], data["customers"])) == want


def test_country_means(data, lines):
    known = [r for r in lines if r["country"]]
    total, count, people = summed(known, "country", "revenue"), defaultdict(int), defaultdict(set)
    for row in known:
        count[row["country"]] += 1
        people[row["country"]].add(row["customer_id"])
    got = pairs(insights.average_order_value(data["orders"], data["customers"], 2))
    assert got == {k: pytest.approx(float(v) / count[k], abs=0.0051) for k, v in total.items()}
    got = pairs(insights.average_customer_revenue(data["orders"], data["customers"], 2))
    assert got == {k: pytest.approx(float(v) / len(people[k]), abs=0.0051) for k, v in total.items()}


def test_best_customers(data, lines):
    totals = summed([r for r in lines if r["country"]], "customer_id", "revenue")
    homes = {r["customer_id"]: r["country"] for r in lines}
    best = insights.best_customers(data["orders"], data["customers"], 1).collect()
    for row in best:
        rivals = [v for k, v in totals.items() if homes[k] == row.country]
        assert cents(max(rivals)) == row.total and totals[str(row.customer_id)] == max(rivals)
    assert len(best) == 3
    order = sorted(totals, key=lambda k: (-totals[k], int(k)))[:3]
    assert [str(r.customer_id) for r in insights.top_customers(data["orders"], 3).collect()] == order


def test_customers_products_months(data, lines):
    buyers = {r["customer_id"] for r in lines}
    idle = insights.customers_without_orders(data["customers"], data["orders"])
    assert {str(r.customer_id) for r in idle.collect()} == {c["customer_id"] for c in plain("customers")} - buyers
    quantity = summed(lines, "product", "quantity")
    top = insights.top_products(data["orders"], 2).collect()
    assert [r["product"] for r in top] == sorted(quantity, key=lambda k: (-quantity[k], k))[:2]
    bought = defaultdict(set)
    for row in lines:
        bought[row["customer_id"]].add(row["product"])
    assert {str(r.customer_id) for r in insights.wide_baskets(data["orders"], 2).collect()} == {k for k, v in bought.items() if len(v) > 2}
    months = summed([{**r, "month": r["order_date"][:7]} for r in lines], "month", "revenue")
    names = sorted(months)
    got = [(r.month, r.rev, r.change) for r in insights.month_change(insights.monthly_revenue(data["orders"])).orderBy("month").collect()]
    assert got == [(m, cents(months[m]), cents(months[m]) - cents(months[names[i - 1]]) if i else None) for i, m in enumerate(names)]


def test_medians(data, lines):
    values = sorted(r["revenue"] for r in lines)
    assert insights.median_order_value(data["orders"]).first()[0] == values[(len(values) - 1) // 2]
    assert exact_median(data["orders"], "revenue").first()[0] == pytest.approx(float(statistics.median(values)))


def test_sales(data):
    totals, count = summed(plain("sales"), "product", "amount"), defaultdict(int)
    for row in plain("sales"):
        count[row["product"]] += 1
    assert pairs(staff.product_totals(data["sales"])) == {k: cents(v) for k, v in totals.items()}
    listed = staff.product_totals(data["sales"], ["Kettle", "Lamp"]).collect()
    assert {r["product"]: r.n for r in listed} == {k: count[k] for k in ("Kettle", "Lamp")}
    assert data["sales"].agg(F.min("order_date")).first()[0] == dt.date(2024, 1, 31)


def test_staff(data):
    people, sold = data["employees"], data["employee_sales"].withColumn("amount", money(F.col("amount")))
    rows = plain("employees")
    groups = defaultdict(list)
    for row in rows:
        groups[row["department"]].append(int(row["salary"]))
    assert pairs(insights.rows_per(people, "department")) == {k: len(v) for k, v in groups.items()}
    assert pairs(staff.average_salary(people, "department")) == {k: pytest.approx(sum(v) / len(v), abs=0.0051) for k, v in groups.items()}
    pay = sorted((int(r["salary"]) for r in rows), reverse=True)
    assert staff.paid_more_than(people, 50000).count() == sum(p > 50000 for p in pay)
    assert staff.paid_between(people, 40000, 60000).count() == sum(40000 <= p <= 60000 for p in pay)
    assert [r.salary for r in staff.best_paid(people, 3).collect()] == pay[:3]
    assert staff.in_department(people, "IT").count() == len(groups["IT"])
    bands = people.withColumn("band", band(F.col("salary"), (30000, 60000)))
    assert pairs(insights.rows_per(bands, "band")) == {
        "Low": sum(p < 30000 for p in pay), "Medium": sum(30000 <= p < 60000 for p in pay), "High": sum(p >= 60000 for p in pay),
    }
    by_seller = summed(plain("employee_sales"), "employee_id", "amount")
    for key in ("department", "location"):
        want = defaultdict(D)
        for row in rows:
            want[row[key]] += by_seller.get(row["employee_id"], D(0))
        sellers = {r[key] for r in rows if r["employee_id"] in by_seller}
        assert pairs(staff.sales_by(people, sold, key)) == {k: cents(v) for k, v in want.items() if k in sellers}
    best = max(by_seller, key=lambda k: (by_seller[k], -int(k)))
    top = staff.top_seller(people, sold).first()
    assert (str(top.employee_id), top.total_sales) == (best, cents(by_seller[best]))
