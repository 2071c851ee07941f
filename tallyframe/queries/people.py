"""Staff, sales and joins over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions.bands import band, member_class
from tallyframe.functions.numbers import cents, from_cents, money
from tallyframe.operators import staff
from tallyframe.operators.joins import left_join_many
from tallyframe.queries.registry import Tables, query

_SALARY = "CAST(s_acctbal AS DECIMAL(18,2))"


@query("q_bonus", f"""
    SELECT s_suppkey AS employee_id,
           CAST(ROUND({_SALARY} * CAST(0.10 AS DECIMAL(5,2)), 2) AS DECIMAL(18,2)) AS bonus,
           CAST({_SALARY} + ROUND({_SALARY} * CAST(0.10 AS DECIMAL(5,2)), 2)
                AS DECIMAL(18,2)) AS total_comp
    FROM supplier""")
def bonus(t: Tables):
    return staff.add_compensation(t.staff).select("employee_id", "bonus", "total_comp")


@query("q_avg_salary", """
    SELECT s_nationkey AS location_id, ROUND(AVG(s_acctbal), 2) AS avg_salary
    FROM supplier GROUP BY s_nationkey""")
def avg_salary(t: Tables):
    paid = t.supplier.select(
        F.col("s_nationkey").alias("location_id"), F.col("s_acctbal").alias("salary")
    )
    return staff.average_salary(paid, "location_id")


@query("q_top5_paid", f"""
    SELECT s_suppkey AS employee_id, s_name AS name, {_SALARY} AS salary
    FROM supplier ORDER BY salary DESC, employee_id LIMIT 5""")
def top5_paid(t: Tables):
    return staff.best_paid(t.staff, 5).select("employee_id", "name", "salary")


@query("q_paid_more", f"""
    SELECT s_suppkey AS employee_id, {_SALARY} AS salary FROM supplier WHERE {_SALARY} > 5000""")
def paid_more(t: Tables):
    return staff.paid_more_than(t.staff, 5000).select("employee_id", "salary")


@query("q_sales_by_department", """
    SELECT s.s_suppkey % 5 AS department,
           CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_sales
    FROM supplier s JOIN lineitem l ON s.s_suppkey = l.l_suppkey GROUP BY s.s_suppkey % 5""")
def sales_by_department(t: Tables):
    return staff.sales_by(t.staff, t.staff_sold, "department")


@query("q_sales_by_location", """
    SELECT n.n_name AS location,
           CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_sales
    FROM supplier s JOIN lineitem l ON s.s_suppkey = l.l_suppkey
    JOIN nation n ON n.n_nationkey = s.s_nationkey GROUP BY n.n_name""")
def sales_by_location(t: Tables):
    named = t.staff.join(
        t.nation.select(F.col("n_nationkey").alias("location_id"),
                        F.col("n_name").alias("location")),
        "location_id",
    )
    return staff.sales_by(named, t.staff_sold, "location")


@query("q_top_seller", """
    SELECT s.s_suppkey AS employee_id, s.s_name AS name,
           CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_sales
    FROM supplier s JOIN lineitem l ON s.s_suppkey = l.l_suppkey
    GROUP BY s.s_suppkey, s.s_name ORDER BY total_sales DESC, employee_id LIMIT 1""")
def top_seller(t: Tables):
    return staff.top_seller(t.staff, t.staff_sold)


@query("q_join_drop_key", """
    SELECT s.s_suppkey AS employee_id, s.s_name AS name, l.l_partkey AS product,
           CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount
    FROM supplier s JOIN lineitem l ON s.s_suppkey = l.l_suppkey""")
def join_drop_key(t: Tables):
    sold = t.staff_sold.withColumn("amount", money(F.col("amount")))
    return staff.staff_sales(t.staff.select("employee_id", "name"), sold)


@query("q_product_totals", """
    SELECT l_partkey AS product,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total,
           COUNT(*) AS n
    FROM lineitem GROUP BY l_partkey""")
def product_totals(t: Tables):
    return staff.product_totals(t.staff_sold)


# The part types treated as premium products.
PREMIUM_TYPES = ("ECONOMY", "PROMO", "STANDARD")


@query("q_premium_products", f"""
    SELECT p.p_type AS product,
           CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total,
           COUNT(*) AS n
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
    WHERE p.p_type IN {PREMIUM_TYPES} GROUP BY p.p_type""")
def premium_products(t: Tables):
    """The list cuts the part table before the join; lines are summed per part first."""
    per_part = t.lineitem.groupBy("l_partkey").agg(
        F.sum(cents(F.col("l_extendedprice"))).alias("cents"), F.count(F.lit(1)).alias("n")
    )
    listed = t.part.filter(F.col("p_type").isin(*PREMIUM_TYPES)).select("p_partkey", "p_type")
    return (
        per_part.join(listed, per_part.l_partkey == listed.p_partkey)
        .groupBy(F.col("p_type").alias("product"))
        .agg(
            from_cents(F.sum("cents")).alias("total"),
            F.sum("n").cast("bigint").alias("n"),
        )
    )


@query("q_premium_listed", """
    SELECT l_partkey AS product,
           CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total,
           COUNT(*) AS n
    FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_retailprice > 950)
    GROUP BY l_partkey""")
def premium_listed(t: Tables):
    listed = t.part.filter(F.col("p_retailprice") > 950).select(
        F.col("p_partkey").alias("product")
    )
    return staff.product_totals_listed(t.staff_sold, listed)


@query("q_case_bands", f"""
    SELECT s_suppkey, CASE WHEN pay IS NULL THEN NULL WHEN pay < 3000 THEN 'Low'
                           WHEN pay < 7000 THEN 'Medium' ELSE 'High' END AS band
    FROM (SELECT s_suppkey, CASE WHEN s_acctbal >= 0 THEN {_SALARY} END AS pay FROM supplier) t""")
def case_bands(t: Tables):
    """Pay bands; a negative balance stands for unknown pay and keeps a NULL band."""
    pay = F.when(F.col("s_acctbal") >= 0, money(F.col("s_acctbal")))
    return t.supplier.select("s_suppkey", band(pay, (3000, 7000)).alias("band"))


# Nations by invented location class.
LOCATION_CLASSES = {
    "Urban": ("NATION_0", "NATION_3", "NATION_6", "NATION_9"),
    "Rural": ("NATION_1", "NATION_4", "NATION_7"),
}


@query("q_location_class", f"""
    SELECT s.s_suppkey,
           CASE WHEN n.n_name IN {LOCATION_CLASSES['Urban']} THEN 'Urban'
                WHEN n.n_name IN {LOCATION_CLASSES['Rural']} THEN 'Rural'
                ELSE 'Other' END AS location_class
    FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey""")
def location_class(t: Tables):
    placed = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return placed.select(
        "s_suppkey", member_class(F.col("n_name"), LOCATION_CLASSES).alias("location_class")
    )


# --- joins -----------------------------------------------------------------


@query("q_three_way_join", """
    SELECT d.doc_id, d.lang, d.source, e.n_chars, l.quality, l.toxic
    FROM documents d JOIN documents e ON e.doc_id = d.doc_id JOIN labels l ON l.doc_id = d.doc_id""")
def three_way_join(t: Tables):
    policy = t.documents.select("doc_id", "lang", "source")
    car = t.documents.select("doc_id", "n_chars")
    return policy.join(car, "doc_id").join(t.labels, "doc_id")


@query("q_multi_key_join", """
    SELECT l.l_orderkey, l.l_suppkey, COUNT(*) AS n
    FROM lineitem l JOIN (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem
                          WHERE l_returnflag = 'R') r
      ON r.l_orderkey = l.l_orderkey AND r.l_suppkey = l.l_suppkey
    GROUP BY l.l_orderkey, l.l_suppkey""")
def multi_key_join(t: Tables):
    """Lines per (order, seller) that had a return; both sides are grouped on the join keys."""
    keys = ["l_orderkey", "l_suppkey"]
    per_pair = t.lineitem.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    returned = t.lineitem.filter(F.col("l_returnflag") == "R").select(*keys).distinct()
    return per_pair.join(returned, keys)


@query("q_left_lookup", """
    SELECT c.c_custkey, COALESCE(n.n_name, 'NA') AS country
    FROM customer c LEFT JOIN nation n
      ON n.n_nationkey = CASE WHEN c.c_custkey % 4 = 0 THEN -1 - c.c_nationkey ELSE c.c_nationkey END""")
def left_lookup(t: Tables):
    """Every nation is looked up; every fourth customer has a key that no nation has."""
    key = F.col("c_nationkey")
    key = F.when(F.col("c_custkey") % 4 == 0, -1 - key).otherwise(key)
    found = t.customer.select("c_custkey", key.alias("n_nationkey")).join(t.nation, "n_nationkey", "left")
    return found.select("c_custkey", F.coalesce("n_name", F.lit("NA")).alias("country"))


@query("q_left_on_filter", """
    SELECT c.c_custkey, o.o_orderkey
    FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P'""")
def left_on_filter(t: Tables):
    """Every customer stays; orders are filtered before the join, and many may share a customer."""
    pending = t.orders.filter(F.col("o_orderstatus") == "P").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey"
    )
    return left_join_many(t.customer.select("c_custkey"), pending, "c_custkey")


@query("q_semi_verified", """
    SELECT c_custkey FROM customer c WHERE EXISTS (
        SELECT 1 FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
        WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT'
          AND l.l_returnflag = 'R')""")
def semi_verified(t: Tables):
    returned = t.lineitem.filter(F.col("l_returnflag") == "R").select("l_orderkey").distinct()
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
    buyers = (
        urgent.join(returned, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
        .select("o_custkey").distinct()
    )
    return t.customer.join(
        buyers, F.col("c_custkey") == F.col("o_custkey"), "left_semi"
    ).select("c_custkey")


@query("q_in_subquery", """
    SELECT c_custkey FROM customer WHERE c_custkey IN (
        SELECT DISTINCT TRY_CAST(k AS BIGINT) FROM (
            SELECT CASE WHEN o_orderstatus = 'O' THEN 'none'
                        ELSE CAST(o_orderkey AS VARCHAR) END AS k FROM orders) t
        WHERE TRY_CAST(k AS BIGINT) IS NOT NULL)""")
def in_subquery(t: Tables):
    """Keys held as text, some of it no number."""
    text = F.when(F.col("o_orderstatus") == "O", F.lit("none")).otherwise(
        F.col("o_orderkey").cast("string")
    )
    listed = t.orders.select(text.try_cast("bigint").alias("k")).na.drop().distinct()
    return t.customer.join(listed, F.col("c_custkey") == F.col("k"), "left_semi").select(
        "c_custkey"
    )
