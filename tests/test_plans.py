"""Plans: what reaches the scan, what is broadcast, what is cut before a shuffle."""

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import alerts, insights, joins
from tallyframe.plans.inspect import plan_text
from tallyframe.queries import REGISTRY


def plan(tables, name):
    return plan_text(REGISTRY[name].run(tables))


@pytest.mark.parametrize("name", ["q_top3_customers", "q_latest_per_key", "q_last20", "q_best_customer"])
def test_ranks_are_cut_before_the_shuffle(tables, name):
    text = plan(tables, name)
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


@pytest.mark.parametrize("name,kind", [
    ("q_semi_verified", "LeftSemi"), ("q_in_subquery", "LeftSemi"), ("q_premium_listed", "LeftSemi"),
    ("q_anti_excluded", "LeftAnti"), ("q_customers_without_orders", "LeftAnti"),
    ("q_idempotent_append", "LeftAnti"),
])
def test_semi_and_anti_joins(tables, name, kind):
    assert kind in plan(tables, name)


def test_filters_and_columns_reach_the_scan(tables):
    text = plan(tables, "q_filter_eq")
    assert "EqualTo(c_mktsegment,BUILDING)" in text
    text = plan(tables, "q_customers_without_orders")
    assert "o_totalprice" not in text
    text = plan(tables, "q_revenue_by_category")
    assert "l_comment" not in text and "l_extendedprice" not in text


def test_lookups_are_measured_before_they_are_broadcast(spark, tables, monkeypatch):
    """Compressible and exploded tables look small to the planner; what counts is what they hold."""
    lines, homes = tables.order_sales, tables.customers
    wide = homes.withColumn("country", F.expr("repeat('x', 1000)"))
    monkeypatch.setattr(joins, "LOOKUP_BYTES", 50_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        used = lambda *a, **b: "BroadcastHashJoin" in plan_text(insights.revenue_by_country_broadcast(lines, *a, **b))
        assert used(homes) and not used(homes, most_rows=homes.count() - 1) and not used(wide)
        want = sorted(insights.revenue_by_country(lines, homes).collect())
        for most in (10**6, 1):
            assert sorted(insights.revenue_by_country_broadcast(lines, homes, most).collect()) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_status_rows_are_cut_to_the_wanted_people(tables):
    text = plan(tables, "q_population")
    assert text.count("LeftSemi") >= 2


def test_country_report_without_broadcast_agrees(spark, tables):
    want = sorted(insights.revenue_by_country(tables.order_sales, tables.customers).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = sorted(insights.revenue_by_country(tables.order_sales, tables.customers).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == want


def test_two_ways_to_the_same_total(tables):
    by_country = insights.revenue_by_country(tables.order_sales, tables.customers)
    by_line = insights.revenue_by(tables.sales, "category")
    totals = [df.agg(F.sum("total_revenue")).first()[0] for df in (by_country, by_line)]
    assert totals[0] == totals[1]


def test_months_filled(tables):
    monthly = insights.monthly_revenue(tables.order_sales)
    gaps = monthly.filter(F.substring("month", 6, 2) != "03")
    filled = insights.month_change(gaps, fill_months=True)
    march = filled.filter(F.substring("month", 6, 2) == "03").first()
    assert march.rev == 0 and march.change == -march.prev
    assert "SinglePartition" in plan_text(filled)


def test_alert_rules_work_on_plain_frames(tables):
    every = alerts.every_crossing(tables.events).count()
    first = alerts.first_crossing(tables.events, "event_type").count()
    kept = alerts.cool_down(tables.events, "event_type").count()
    assert first <= kept <= every
