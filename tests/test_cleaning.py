"""Messy rows in, clean rows out."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallyframe import schemas
from tallyframe.functions.bands import band, band_in_pandas, member_class
from tallyframe.functions.dates import add_months_eom, parse_date, within_months_before
from tallyframe.functions.numbers import as_flag, cents, exact, exact_sum, half_even
from tallyframe.functions.text import fill_placeholders, first_number, flag_or_no, joined, strip, yes_or_unset
from tallyframe.operators import cleaning, insights, profiling, staff


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def listed(df):
    return [r[0] for r in df.collect()]


def test_customers(spark):
    raw = spark.createDataFrame(
        [(1, "Ann", "USA", "42.0", "F"), (1, "Ann", "USA", "42.0", "F"),
         (1, " Ann\t", "USA", "42", "F"), (2, "Bo", None, "30", "M"), (3, "Cy", "  ", "30", "M"),
         (4, "Di", "UK", "old", "F")],
        "customer_id int, name string, country string, age string, gender string",
    )
    got = cleaning.clean_customers(raw)
    assert dict(got.dtypes)["age"] == "int"
    # Age "old" is no number: the row stays, its age is missing, and it is listed.
    assert sorted(map(tuple, got.collect())) == [(1, "Ann", "USA", 42, "F"), (4, "Di", "UK", None, "F")]
    listed_rows = cleaning.unfit_values(raw, {"age": "int"}).collect()
    assert [(r.customer_id, r.age, r.unfit) for r in listed_rows] == [(4, "old", ["age"])]
    part = raw.limit(1).withColumn("age", F.lit("42.7"))
    assert cleaning.unfit_values(part, {"age": "int"}).count() == 1


def test_orders(spark):
    raw = spark.createDataFrame(
        [(1, 1, "Pen ", "Office", 2, "1.50", "2023-01-12"), (2, 1, "Pen", "Office", 2, "abc", "2023-01-12"),
         (3, 1, "Pen", "Office", 2, "1.50", "2023-13-01")],
        "order_id int, customer_id int, product string, category string, quantity int, "
        "price string, order_date string",
    )
    got = cleaning.clean_orders(raw).collect()
    assert sorted(((r.order_id, r.product, r.price, r.order_date) for r in got)) == [
        (1, "Pen", 1.5, dt.date(2023, 1, 12)), (2, "Pen", None, dt.date(2023, 1, 12)), (3, "Pen", 1.5, None)]
    unfit = cleaning.unfit_values(raw, {"price": "double", "order_date": "date"}).collect()
    assert {r.order_id: (r.price, r.order_date, r.unfit) for r in unfit} == {
        2: ("abc", "2023-01-12", ["price"]), 3: ("1.50", "2023-13-01", ["order_date"])}


def test_amounts_are_rounded_once(spark):
    lines = spark.createDataFrame([(0.125, 1000)], "price double, quantity int")
    assert insights.revenue_by(insights.add_revenue(lines).withColumn("k", F.lit(1)), "k").first().total_revenue == D("125.00")
    sales = spark.createDataFrame([(1, 0.004)] * 1000, "employee_id int, amount double")
    assert staff.seller_sums(sales).first().total_sales == D("4.00000000")
    people = spark.createDataFrame([(i, "n", "IT") for i in range(10)], "employee_id int, name string, department string")
    few = spark.createDataFrame([(i, "p", 0.004) for i in range(10)], "employee_id int, product string, amount double")
    # Ten amounts below half a cent each: 0.04, however they are grouped first.
    assert staff.sales_by(people, few, "department").first().total_sales == D("0.04")
    assert staff.product_totals(few).first().total == D("0.04")
    homes = spark.createDataFrame([(i, "DE") for i in range(10)], "customer_id int, country string")
    orders = insights.add_revenue(spark.createDataFrame([(i, 0.004, 1) for i in range(10)], "customer_id int, price double, quantity int"))
    for report in (insights.revenue_by_country, insights.revenue_by_country_broadcast):
        assert report(orders, homes).first().total_revenue == D("0.04")
    assert insights.average_customer_revenue(orders, homes).first().avg_rev == 0.004
    assert {r.total for r in insights.best_customers(orders, homes, 1).collect()} == {D("0.00")}
    with pytest.raises(Exception, match="parts of a cent"):
        sales.select(cents(F.col("amount"))).collect()
    assert sales.limit(1).select(cents(F.lit(1234.57))).first()[0] == 123457


def test_exact_sums_of_binary_fractions(spark):
    """Eight places, far amounts, negative ones and nulls; as decimals give them."""
    groups = {
        "small": [0.1, 0.2, 0.30000001, -7.99999999], "far": [9.0e9 + 0.25, -9.0e9, 123456789.5], "both": [1e12, 0.01, -0.02],
        "null": [None, 1.5], "none": [None], "great": [8.9e7] * 300, "cents": [-0.005] * 400,
    }
    rows = [(k, v) for k, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.a, r.b) for r in df.groupBy("k").agg(
        exact_sum(F.col("v"), "double").alias("a"), F.sum(exact(F.col("v"), "double")).alias("b")).collect()}
    assert len(got) == len(groups) and all(a == b for a, b in got.values())
    kept = spark.createDataFrame([(D("0.0001"),)] * 3, "v decimal(20,4)").agg(exact_sum(F.col("v"), "decimal(20,4)").alias("s"))
    assert kept.first().s == D("0.0003")


def test_filled_values_are_not_filled_again(spark):
    df = spark.createDataFrame([("[DUE]", "soon", "Hi [NAME], [DUE]! [OTHER] [NAME]"), (None, "x", "[NAME][DUE]"), ("a", "b", "none"), ("a", "b", None)], "n string, d string, t string")
    filled = fill_placeholders(F.col("t"), {"NAME": F.col("n"), "DUE": F.col("d")})
    assert listed(df.select(filled)) == ["Hi [DUE], soon! [OTHER] [DUE]", "x", "none", None]


def test_lookback_from_a_month_end(spark):
    days = column(spark, [dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2025, 2, 28)], "date")
    got = listed(days.filter(within_months_before(F.col("x"), dt.date(2025, 2, 28), 12)))
    assert got == [dt.date(2024, 2, 29), dt.date(2025, 2, 28)]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="country"):
        cleaning.clean_customers(spark.createDataFrame([("a",)], "name string"))


def test_names_and_selection(spark):
    df = spark.createDataFrame([("a", 1, 2.0)], "` Policy ID` string, Age int, `is_x y` double")
    tidy = cleaning.tidy_names(df)
    assert tidy.columns == ["policy_id", "age", "is_x_y"]
    assert cleaning.text_columns(tidy) == ["policy_id"]
    assert cleaning.number_columns(tidy) == ["age", "is_x_y"]
    assert cleaning.prefixed_columns(tidy, "is_") == ["is_x_y"]
    assert cleaning.present_columns(tidy, ["nope", "age"]) == ["age"]


def test_first_number(spark):
    df = column(spark, ["113Nm@4400rpm", "n/a", None, "-5.5", ".75", "88.50bhp@6000rpm"])
    assert listed(df.select(first_number(F.col("x")))) == [113.0, None, None, -5.5, 0.75, 88.5]


def test_flags(spark):
    df = column(spark, ["Yes", "No", "True", "False", "1", "0", "maybe", None, "2.5"])
    assert listed(df.select(as_flag(F.col("x")))) == [1.0, 0.0, 1.0, 0.0, 1.0, 0.0, None, None, 2.5]
    numbers = column(spark, [1, 0, 7], "int")
    assert listed(numbers.select(as_flag(F.col("x")))) == [1.0, 0.0, 7.0]


def test_blank_tolerant_flags(spark):
    df = column(spark, ["Y", None, "", " ", "N", " y "])
    assert listed(df.select(yes_or_unset(F.col("x")))) == [True, True, True, True, False, False]
    assert listed(df.select(flag_or_no(F.col("x")))) == ["Y", "N", "N", "N", "N", "Y"]


def test_text_helpers(spark):
    df = column(spark, ["\t a b \n", None])
    assert listed(df.select(strip(F.col("x")))) == ["a b", None]
    assert listed(df.select(joined(F.lit("p"), F.col("x"), sep="|"))) == ["p|\t a b \n", "p|"]


def test_bands(spark):
    df = column(spark, [29999, 30000, 69999, 70000, None], "int")
    want = ["Low", "Medium", "Medium", "High", None]
    assert listed(df.select(band(F.col("x")))) == want
    assert listed(df.select(band_in_pandas(F.col("x")))) == want


def test_classes(spark):
    df = column(spark, ["A", "B", "C", None])
    classes = {"one": ["A"], "two": ["B"]}
    assert listed(df.select(member_class(F.col("x"), classes))) == ["one", "two", "Other", "Other"]


def test_months_and_dates(spark):
    df = column(spark, [dt.date(2026, 2, 28), dt.date(2026, 1, 31), dt.date(2026, 1, 15)], "date")
    assert listed(df.select(F.add_months("x", 1))) == [
        dt.date(2026, 3, 28), dt.date(2026, 2, 28), dt.date(2026, 2, 15)]
    assert listed(df.select(add_months_eom(F.col("x"), 1))) == [
        dt.date(2026, 3, 31), dt.date(2026, 2, 28), dt.date(2026, 2, 15)]
    text = column(spark, ["10/01/2026", "none"])
    assert listed(text.select(parse_date(F.col("x"), "MM/dd/yyyy"))) == [dt.date(2026, 10, 1), None]
    with pytest.raises(Exception):
        text.select(parse_date(F.col("x"), "MM/dd/yyyy", strict=True)).collect()
    assert listed(column(spark, ["31-DEC-2999"]).select(
        parse_date(F.initcap(F.col("x")), "dd-MMM-yyyy"))) == [dt.date(2999, 12, 31)]


def test_rounding(spark):
    df = column(spark, [0.5, 1.5, 2.5], "double")
    assert listed(df.select(F.round("x"))) == [1.0, 2.0, 3.0]
    assert listed(df.select(half_even(F.col("x")))) == [0.0, 2.0, 2.0]


def claims(spark):
    policy = spark.createDataFrame(
        [("p1", 0.5, "Yes"), ("p1", 0.5, "Yes"), ("p2", 1.5, "No"), ("p3", None, "maybe")],
        "`Policy ID` string, `policy tenure` double, is_new string",
    )
    car = spark.createDataFrame(
        [("p1", "113Nm@4400rpm", " A "), ("p2", "n/a", "B"), ("p3", None, "")],
        "policy_id string, max_torque string, segment string",
    )
    claim = spark.createDataFrame(
        [("p1", 1), ("p2", 0), ("p3", 0), ("p9", 1)], "policy_id string, is_claim int"
    )
    return cleaning.clean_claims(policy, car, claim)


def test_claims(spark):
    got = {r.policy_id: r for r in claims(spark).collect()}
    assert set(got) == {"p1", "p2", "p3"}
    assert (got["p1"].max_torque_num, got["p1"].segment, got["p1"].is_new) == (113.0, "A", 1.0)
    assert (got["p3"].max_torque_num, got["p3"].segment, got["p3"].is_new) == (None, None, None)
    assert "max_power_num" not in got["p1"].asDict()


def test_claim_profile(spark):
    rows = claims(spark)
    missing = profiling.missing_shares(rows, top=2).collect()
    assert [r.missing for r in missing] == [pytest.approx(2 / 3), pytest.approx(1 / 3)]
    rates = profiling.rate_by(rows, "segment", "is_claim").collect()
    assert [(r.segment, r.rate) for r in rates] == [("A", 1.0), ("B", 0.0)]
    each = profiling.rates_by_each(rows, ["segment", "is_new"], "is_claim").collect()
    assert {(r.attribute, r.value): r.rate for r in each} == {
        ("segment", "A"): 1.0, ("segment", "B"): 0.0, ("is_new", "1.0"): 1.0, ("is_new", "0.0"): 0.0}


def test_value_shares_count_nulls(spark):
    df = column(spark, ["a", "a", None])
    got = {r.x: (r.n, r.pct) for r in profiling.value_shares(df, "x").collect()}
    assert got == {"a": (2, 66.67), None: (1, 33.33)}


def test_duplicates_over_all_columns_and_empty(spark):
    df = column(spark, ["a", "a", None, None, "b"])
    assert tuple(profiling.duplicate_report(df).first()) == (5, 3, 2)
    assert tuple(profiling.duplicate_report(df.limit(0)).first()) == (0, 0, 0)


def test_correlation_skips_nan_and_null(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (float("nan"), 1.0), (None, 9.0)],
        "a double, b double",
    )
    assert profiling.correlation_with(df, "b", ["a"]).first().r == 1.0
    cells = {(r.a, r.b): r.r for r in profiling.correlation_matrix(df, ["a", "b"]).collect()}
    assert cells == {("a", "a"): 1.0, ("a", "b"): 1.0, ("b", "a"): 1.0, ("b", "b"): 1.0}


def test_schema_names():
    assert schemas.ORDERS.names[0] == "order_id"
