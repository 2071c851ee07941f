"""Retail reports over the test tables."""

from __future__ import annotations


from pyspark.sql import functions as F

from tallyframe.functions.numbers import money
from tallyframe.operators import insights
from tallyframe.operators.cleaning import clean_rows, fill_nulls
from tallyframe.operators.profiling import duplicate_report
from tallyframe.operators.ranking import rank_with_ties
from tallyframe.plans.ordered import exact_median, number_rows
from tallyframe.queries.registry import CUST, LINES, Tables, query

# --- projection, filter, null handling -------------------------------------


@query("q_project", "SELECT s_name, s_acctbal FROM supplier")
def project(t: Tables):
    return t.supplier.select("s_name", "s_acctbal")


@query("q_revenue_lines", """
    SELECT l.l_orderkey AS order_id, l.l_partkey AS product,
           CAST(l.l_quantity AS DECIMAL(10,0)) AS quantity,
           CAST(CAST(p.p_retailprice AS DECIMAL(18,2)) * CAST(l.l_quantity AS DECIMAL(10,0))
                AS DECIMAL(18,2)) AS revenue
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""")
def revenue_lines(t: Tables):
    lines = insights.add_revenue(t.part_sales)
    return lines.select(
        "order_id", "product", F.col("quantity").cast("decimal(10,0)").alias("quantity"),
        money(F.col("revenue")).alias("revenue"),
    )


@query("q_filter_gt", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 5000")
def filter_gt(t: Tables):
    return t.customer.filter(F.col("c_acctbal") > 5000).select("c_custkey", "c_acctbal")


@query("q_filter_eq", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_eq(t: Tables):
    return t.customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")


@query("q_between",
       "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal BETWEEN 4000 AND 6000")
def between(t: Tables):
    return t.customer.filter(F.col("c_acctbal").between(4000, 6000)).select(
        "c_custkey", "c_acctbal"
    )


@query("q_not_in_null", """
    SELECT o_orderkey FROM (
        SELECT o_orderkey, NULLIF(o_orderpriority, '5-LOW') AS pr FROM orders) t
    WHERE pr NOT IN ('1-URGENT', '2-HIGH') OR pr IS NULL""")
def not_in_null(t: Tables):
    priority = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    listed = priority.isin("1-URGENT", "2-HIGH")
    return t.orders.filter(~listed | priority.isNull()).select("o_orderkey")


def _orders_with_gaps(t: Tables):
    return t.orders.select(
        "o_orderkey", "o_orderstatus",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
    )


_GAPS = """(SELECT o_orderkey, o_orderstatus, NULLIF(o_orderpriority, '5-LOW') AS priority
            FROM orders) t"""


@query("q_null_filter", f"""
    SELECT o_orderstatus, COUNT(*) AS n FROM {_GAPS}
    WHERE priority IS NULL GROUP BY o_orderstatus""")
def null_filter(t: Tables):
    return insights.rows_per(
        _orders_with_gaps(t).filter(F.col("priority").isNull()), "o_orderstatus"
    )


@query("q_drop_null", f"SELECT * FROM {_GAPS} WHERE priority IS NOT NULL")
def drop_null(t: Tables):
    return _orders_with_gaps(t).na.drop()


@query("q_fill",
       f"SELECT o_orderkey, o_orderstatus, COALESCE(priority, 'NONE') AS priority FROM {_GAPS}")
def fill(t: Tables):
    return fill_nulls(_orders_with_gaps(t), {"priority": "NONE"})


@query("q_clean_orders", """
    SELECT DISTINCT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date,
           o_orderpriority AS priority
    FROM orders WHERE o_orderpriority <> '5-LOW'""")
def clean_orders(t: Tables):
    """Every order as text, pending ones a second time padded with blanks; '5-LOW' left blank."""
    raw = t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
        .otherwise("  ").alias("priority"),
    )
    again = raw.filter(F.col("o_orderstatus") == "P").withColumn(
        "priority", F.concat(F.lit(" "), "priority", F.lit("\t "))
    )
    messy = raw.union(again).drop("o_orderstatus")
    return clean_rows(messy, {"order_date": "date"})


@query("q_dup_report", """
    SELECT CAST(SUM(n) AS BIGINT) AS total, COUNT(*) AS distinct_rows,
           CAST(SUM(n) - COUNT(*) AS BIGINT) AS duplicates
    FROM (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2) t""")
def dup_report(t: Tables):
    return duplicate_report(t.lineitem, "l_orderkey", "l_linenumber")


@query("q_dup_rows", """
    SELECT CAST(SUM(n) AS BIGINT) AS total, COUNT(*) AS distinct_rows, CAST(SUM(n) - COUNT(*) AS BIGINT) AS duplicates
    FROM (SELECT COUNT(*) AS n FROM (SELECT text, lang, source, n_chars, doc_id % 3 AS part FROM documents
                                     UNION ALL SELECT text, lang, source, n_chars, doc_id % 3 FROM documents WHERE lang = 'en') d
          GROUP BY text, lang, source, n_chars, part) t""")
def dup_rows(t: Tables):
    """Whole documents, English ones a second time."""
    rows = t.documents.select("text", "lang", "source", "n_chars", (F.col("doc_id") % 3).alias("part"))
    return duplicate_report(rows.union(rows.filter("lang = 'en'")))


# --- counts ----------------------------------------------------------------


@query("q_count_by_country", """
    SELECT n.n_name AS country, COUNT(*) AS n
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name""")
def count_by_country(t: Tables):
    return t.name_countries(insights.rows_per(t.customers, "country"))


@query("q_count_by_size", "SELECT p_size, COUNT(*) AS n FROM part GROUP BY p_size ORDER BY p_size")
def count_by_size(t: Tables):
    return insights.display_order(insights.rows_per(t.part, "p_size"), "p_size")


@query("q_counts", """
    SELECT COUNT(*) AS n, COUNT(DISTINCT p_type) AS types, COUNT(DISTINCT p_brand) AS brands
    FROM part""")
def counts(t: Tables):
    return t.part.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("p_type").alias("types"),
        F.count_distinct("p_brand").alias("brands"),
    )


@query("q_distinct_products_list", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_products_list(t: Tables):
    return t.part.select("p_brand", "p_type").distinct()


# --- revenue ---------------------------------------------------------------


def _category_base(t: Tables):
    """Quantity per product first, then price and category: one joined row per product."""
    sold = t.lineitem.groupBy(F.col("l_partkey").alias("product")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )
    parts = t.part.select(
        F.col("p_partkey").alias("product"),
        F.col("p_type").alias("category"),
        money(F.col("p_retailprice")).alias("price"),
    )
    return sold.join(parts, "product").withColumn(
        "revenue", (F.col("price") * F.col("quantity")).cast("decimal(38,2)")
    )


_PRICED = """lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""
_REVENUE = """CAST(p.p_retailprice AS DECIMAL(18,2)) * CAST(l.l_quantity AS DECIMAL(10,0))"""


@query("q_revenue_by_category", f"""
    SELECT p.p_type AS category, CAST(SUM({_REVENUE}) AS DECIMAL(38,2)) AS total_revenue
    FROM {_PRICED} GROUP BY p.p_type""")
def revenue_by_category(t: Tables):
    return insights.revenue_by(_category_base(t), "category")


@query("q_sql_category", f"""
    SELECT p.p_type AS category,
           CAST(SUM(CAST(l.l_quantity AS DECIMAL(10,0))) AS BIGINT) AS total_quantity,
           CAST(SUM({_REVENUE}) AS DECIMAL(38,2)) AS total_revenue
    FROM {_PRICED} GROUP BY p.p_type""")
def sql_category(t: Tables):
    return insights.run_sql(t.spark, insights.CATEGORY_SQL, sales=_category_base(t))


@query("q_revenue_by_country", f"""
    WITH {LINES}
    SELECT country, CAST(SUM(revenue) AS DECIMAL(38,2)) AS total_revenue
    FROM lines GROUP BY country""")
def revenue_by_country(t: Tables):
    return t.name_countries(insights.revenue_by_country(t.order_sales, t.customers))


@query("q_broadcast_revenue", f"""
    WITH {LINES}
    SELECT country, CAST(SUM(revenue) AS DECIMAL(38,2)) AS total_revenue
    FROM lines GROUP BY country""")
def broadcast_revenue(t: Tables):
    return t.name_countries(insights.revenue_by_country_broadcast(t.order_sales, t.customers))


@query("q_avg_order_value", f"""
    WITH {LINES}
    SELECT country, ROUND(AVG(CAST(revenue AS DOUBLE)), 4) AS avg_order_value
    FROM lines GROUP BY country""")
def avg_order_value(t: Tables):
    return t.name_countries(insights.average_order_value(t.order_sales, t.customers))


@query("q_avg_rev_per_customer", f"""
    WITH {LINES}, {CUST}
    SELECT country, ROUND(AVG(CAST(total AS DOUBLE)), 4) AS avg_rev FROM cust GROUP BY country""")
def avg_rev_per_customer(t: Tables):
    return t.name_countries(insights.average_customer_revenue(t.order_sales, t.customers))


@query("q_best_customer", f"""
    WITH {LINES}, {CUST}
    SELECT country, customer_id, total, rk FROM (
        SELECT *, CAST(RANK() OVER (PARTITION BY country ORDER BY total DESC) AS BIGINT) AS rk
        FROM cust) t
    WHERE rk = 1""")
def best_customer(t: Tables):
    return t.name_countries(insights.best_customers(t.order_sales, t.customers, 1))


@query("q_top3_customers", f"""
    WITH {LINES}, {CUST}
    SELECT country, customer_id, total, rk FROM (
        SELECT *, CAST(RANK() OVER (PARTITION BY country ORDER BY total DESC) AS BIGINT) AS rk
        FROM cust) t
    WHERE rk <= 3""")
def top3_customers(t: Tables):
    return t.name_countries(insights.best_customers(t.order_sales, t.customers, 3))


@query("q_top10_customers", f"""
    WITH {LINES}
    SELECT customer_id, CAST(SUM(revenue) AS DECIMAL(38,2)) AS total
    FROM lines GROUP BY customer_id ORDER BY total DESC, customer_id LIMIT 10""")
def top10_customers(t: Tables):
    return insights.top_customers(t.order_sales, 10)


@query("q_sql_best_spender", f"""
    WITH {LINES}
    SELECT customer_id, CAST(SUM(revenue) AS DECIMAL(38,2)) AS total_spent
    FROM lines GROUP BY customer_id ORDER BY total_spent DESC, customer_id LIMIT 1""")
def sql_best_spender(t: Tables):
    return insights.run_sql(t.spark, insights.BEST_SPENDER_SQL, sales=t.order_sales)


@query("q_top_product", """
    SELECT l_partkey AS product,
           CAST(SUM(CAST(l_quantity AS DECIMAL(10,0))) AS BIGINT) AS total_quantity
    FROM lineitem GROUP BY l_partkey ORDER BY total_quantity DESC, product LIMIT 1""")
def top_product(t: Tables):
    sold = t.lineitem.select(
        F.col("l_partkey").alias("product"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )
    return insights.top_products(sold, 1)


@query("q_distinct_products", f"""
    WITH {LINES}
    SELECT customer_id, COUNT(DISTINCT product) AS n
    FROM lines GROUP BY customer_id HAVING COUNT(DISTINCT product) > 5""")
def distinct_products(t: Tables):
    bought = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product")
    )
    return insights.wide_baskets(bought.join(t.order_heads, "order_id"), 5)


@query("q_sql_distinct_products", f"""
    WITH {LINES}
    SELECT customer_id, COUNT(DISTINCT product) AS n
    FROM lines GROUP BY customer_id HAVING COUNT(DISTINCT product) > 5""")
def sql_distinct_products(t: Tables):
    bought = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product")
    )
    return insights.run_sql(
        t.spark, insights.BASKET_SQL, sales=bought.join(t.order_heads, "order_id")
    )


@query("q_customers_without_orders", """
    SELECT c_custkey, c_name FROM customer c
    WHERE NOT EXISTS (
        SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_custkey % 3 <> 0)""")
def customers_without_orders(t: Tables):
    """Customers that never ordered, over all orders; those of every third customer name nobody."""
    buyer = F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey"))
    placed = t.orders.select(buyer.alias("customer_id"))
    people = t.customer.select(F.col("c_custkey").alias("customer_id"), "c_name")
    idle = insights.customers_without_orders(people, placed)
    return idle.select(F.col("customer_id").alias("c_custkey"), "c_name")


# --- months and medians ----------------------------------------------------

_MONTHS = """m AS (
    SELECT SUBSTRING(CAST(order_date AS VARCHAR(10)), 1, 7) AS month,
           CAST(SUM(revenue) AS DECIMAL(38,2)) AS rev
    FROM lines GROUP BY SUBSTRING(CAST(order_date AS VARCHAR(10)), 1, 7))"""


@query("q_monthly_revenue", f"WITH {LINES}, {_MONTHS} SELECT month, rev FROM m ORDER BY month")
def monthly_revenue(t: Tables):
    return insights.monthly_revenue(t.order_sales).orderBy("month")


@query("q_sql_monthly_revenue", f"WITH {LINES}, {_MONTHS} SELECT month, rev FROM m ORDER BY month")
def sql_monthly_revenue(t: Tables):
    return insights.run_sql(t.spark, insights.MONTH_SQL, sales=t.order_sales)


@query("q_month_change", f"""
    WITH {LINES}, {_MONTHS}
    SELECT month, rev, LAG(rev, 1) OVER (ORDER BY month) AS prev,
           CAST(rev - LAG(rev, 1) OVER (ORDER BY month) AS DECIMAL(38,2)) AS change
    FROM m""")
def month_change(t: Tables):
    return insights.month_change(insights.monthly_revenue(t.order_sales))


@query("q_median_exact", """
    SELECT l_returnflag, ROUND(MEDIAN(l_extendedprice), 4) AS median
    FROM lineitem GROUP BY l_returnflag""")
def median_exact(t: Tables):
    prices = t.lineitem.select("l_returnflag", money(F.col("l_extendedprice")).alias("price"))
    medians = exact_median(prices, "price", "l_returnflag")
    return medians.withColumn("median", F.round("median", 4))


@query("q_median_approx", """
    SELECT QUANTILE_DISC(CAST(l_extendedprice AS DECIMAL(18,2)), 0.5) AS median_order_value FROM lineitem""")
def median_approx(t: Tables):
    """The sketched lower median, with as much room as it takes to be sure of the rank."""
    prices = t.lineitem.select(money(F.col("l_extendedprice")).alias("revenue"))
    return insights.median_order_value(prices, accuracy=10_000_000)


@query("q_ranked_ties", """
    SELECT l_returnflag, l_orderkey, l_linenumber, l_quantity, rk FROM (
        SELECT *, RANK() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS rk FROM lineitem) t
    WHERE rk <= 3""")
def ranked_ties(t: Tables):
    """The lines of the greatest quantity: a fiftieth of all lines ties in each group."""
    lines = t.lineitem.select("l_returnflag", "l_orderkey", "l_linenumber", "l_quantity")
    return rank_with_ties(lines, ["l_returnflag"], "l_quantity", 3)


# --- lists -----------------------------------------------------------------

LIST_LENGTH = 1000


@query("q_case_list", f"""
    SELECT list_no, STRING_AGG(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS case_list
    FROM (SELECT o_orderkey,
                 CAST(FLOOR((ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1) / {LIST_LENGTH}.0)
                      AS BIGINT) AS list_no
          FROM orders) t
    GROUP BY list_no""")
def case_list(t: Tables):
    """All order keys as comma lists of a fixed length, so no list holds the whole table."""
    numbered = number_rows(t.orders.select("o_orderkey"), "o_orderkey", into="rn")
    lists = numbered.withColumn(
        "list_no", F.floor((F.col("rn") - 1) / F.lit(LIST_LENGTH)).cast("bigint")
    )
    return lists.groupBy("list_no").agg(
        F.expr("listagg(cast(o_orderkey as string), ',') within group (order by o_orderkey)")
        .alias("case_list")
    )
