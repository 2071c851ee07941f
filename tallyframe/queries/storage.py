"""Sinks, catalog tables, views, CSV intake and tables with a log: written, read back, compared."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, functions as F

from tallyframe.operators import campaign, insights
from tallyframe.plans.lineage import materialize, scratch_dir
from tallyframe.queries.registry import CUST, LINES, Tables, query
from tallyframe.schemas import _table
from tallyframe.sources import catalog, files, ledger

MARKED_ON = dt.date(2026, 10, 1)


def _place(t: Tables, name: str) -> str:
    return f"{scratch_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


def _name(prefix: str) -> str:
    """A catalog name of this run's own."""
    return f"{prefix}_{uuid.uuid4().hex}"


def _heads(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"), "o_orderpriority")


_HEADS = "SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderpriority FROM orders"


@query("q_parquet_sink", f"SELECT *, STRFTIME(day, '%Y-%m') AS month FROM ({_HEADS}) t")
def parquet_sink(t: Tables):
    """Orders by month, written a second time over the first."""
    place = _place(t, "parquet")
    months = _heads(t).withColumn("month", F.date_format("day", "yyyy-MM"))
    for rows in (months.limit(10), months):
        files.write_parquet(rows, place, partition_by=("month",))
    return files.read_parquet(t.spark, place).withColumn("month", F.col("month").cast("string"))


@query("q_csv_sink", _HEADS)
def csv_sink(t: Tables):
    place = _place(t, "csv")
    files.write_csv(_heads(t), place)
    return files.read_csv(t.spark, place, _heads(t).schema)


@query("q_text_pairs", "SELECT '(' || p_brand || ', ' || COUNT(*) || ')' AS value FROM part GROUP BY p_brand")
def text_pairs(t: Tables):
    place = _place(t, "pairs")
    files.write_pairs(insights.rows_per(t.part, "p_brand"), place, "p_brand", "n")
    return t.spark.read.text(place)


@query("q_table_as_select", f"SELECT * FROM ({_HEADS}) t WHERE o_orderpriority = '1-URGENT'")
def table_as_select(t: Tables):
    """A managed table from a select, bucketed by customer, and a scan of it."""
    name = _name("urgent")
    catalog.save_table(_heads(t).filter("o_orderpriority = '1-URGENT'"), name, bucket_by=(4, ["o_custkey"]))
    rows = materialize(t.spark.table(name))
    catalog.drop_if_present(t.spark, name)
    return rows


@query("q_append_select", """
    SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN c_mktsegment END AS c_mktsegment FROM customer""")
def append_select(t: Tables):
    """An empty clone, created once, that two selects are appended to; the second has a column less."""
    name, people = _name("people"), t.customer.select("c_custkey", "c_name", "c_mktsegment")
    clone = catalog.empty_clone(people)
    made = [catalog.create_if_absent(t.spark, name, clone.schema) for _ in range(2)]
    if made != [True, False]:
        raise ValueError("the table was there before, or was made twice")
    catalog.append_by_name(people.filter("c_mktsegment = 'BUILDING'"), name)
    catalog.append_by_name(people.filter("c_mktsegment <> 'BUILDING'").select("c_name", "c_custkey"), name)
    rows = materialize(t.spark.table(name))
    catalog.drop_if_present(t.spark, name)
    return rows


@query("q_catalog_steps", """
    SELECT 'clone' AS step, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'first', COUNT(*) FROM supplier
    UNION ALL SELECT 'again', CAST(2 * COUNT(*) AS BIGINT) FROM supplier UNION ALL SELECT 'dropped', CAST(0 AS BIGINT)""")
def catalog_steps(t: Tables):
    """Rows of a table after each step; a table that is gone has none."""
    name, seen = _name("steps"), []
    catalog.create_if_absent(t.spark, name, catalog.empty_clone(t.supplier).schema)
    seen.append(("clone", t.spark.table(name).count()))
    for step in ("first", "again"):
        catalog.append_by_name(t.supplier, name)
        seen.append((step, t.spark.table(name).count()))
    for _ in range(2):
        catalog.drop_if_present(t.spark, name)
    seen.append(("dropped", t.spark.table(name).count() if t.spark.catalog.tableExists(name) else 0))
    return files.from_rows(t.spark, seen, _table("step string, n bigint"))


@query("q_views", f"""
    WITH {LINES}, {CUST}
    SELECT customer_id, country, total FROM cust WHERE total > 100000""")
def views(t: Tables):
    """SQL text over registered views of cleaned frames."""
    orders, people = _name("orders"), _name("people")
    catalog.register_views({orders: t.order_sales, people: t.name_countries(t.customers)})
    return t.spark.sql(f"""
        SELECT o.customer_id, p.country, CAST(SUM(o.revenue) AS DECIMAL(38,2)) AS total
        FROM {orders} o JOIN {people} p ON p.customer_id = o.customer_id
        GROUP BY o.customer_id, p.country HAVING SUM(o.revenue) > 100000""")


# --- intake ----------------------------------------------------------------

PEOPLE = _table("id bigint, name string, balance double, nation int")


def _untidy(t: Tables) -> str:
    """Customers as CSV text: every 7th has a word for its balance, every 11th lacks the last field."""
    place = _place(t, "untidy")
    key, text = F.col("c_custkey"), lambda c: F.col(c).cast("string")
    balance = F.when(key % 7 == 0, "none").otherwise(text("c_acctbal"))
    fields = F.concat_ws(",", key.cast("string"), "c_name", balance, F.when(key % 11 != 0, text("c_nationkey")))
    head = t.customer.select(F.lit(",".join(PEOPLE.names)).alias("value")).limit(1)
    # One file for the header line and one for each task's rows would have headless files: every file gets its own.
    rows = t.customer.select(fields.alias("value"), (key % 3).alias("part"))
    for part in range(3):
        own = rows.filter(F.col("part") == part).select("value", F.lit(1).alias("turn"))
        head.select("value", F.lit(0).alias("turn")).union(own).repartition(1).sortWithinPartitions("turn").select("value").write.mode("append").text(place)
    return place


@query("q_csv_intake", """
    SELECT 'good' AS kind, c_custkey AS id, c_name AS name, c_acctbal AS balance, c_nationkey AS nation FROM (
        SELECT c_custkey, c_name, c_acctbal, CAST(c_nationkey AS INTEGER) AS c_nationkey FROM customer) t
    WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0
    UNION ALL SELECT 'reject', c_custkey, NULL, NULL, NULL FROM customer WHERE c_custkey % 7 = 0 OR c_custkey % 11 = 0""")
def csv_intake(t: Tables):
    """Rows that fit, and the ids of those set aside."""
    found = files.load_csv(t.spark, _untidy(t), PEOPLE, _place(t, "intake"))
    bad = found.rejects.select(F.lit("reject").alias("kind"), F.split("record", ",")[0].cast("bigint").alias("id"))
    return found.good.select(F.lit("good").alias("kind"), "*").unionByName(bad, allowMissingColumns=True)


# --- tables with a log -----------------------------------------------------

_CONTACTS = _table("case_id bigint, triggered string, triggered_on date, run string")


def _contacts(t: Tables, run: str, only: str) -> DataFrame:
    return t.orders.filter(only).select(
        F.col("o_custkey").alias("case_id"), F.lit("N").alias("triggered"), F.lit(None).cast("date").alias("triggered_on"), F.lit(run).alias("run")
    )


def _logged(t: Tables) -> ledger.Table:
    """Customers with an order: those with a closed one by the first run, the others by the second, which comes twice."""
    table = ledger.Table(t.spark, _place(t, "contacts"), _CONTACTS, ("case_id",), buckets=8)
    for run, only in (("first", "o_orderstatus = 'F'"), ("second", "true"), ("second", "true")):
        ledger.append_new(table, _contacts(t, run, only), run)
    return table


_RUNS = """SELECT o_custkey AS case_id, CASE WHEN BOOL_OR(o_orderstatus = 'F') THEN 'first' ELSE 'second' END AS run
    FROM orders GROUP BY o_custkey"""


@query("q_logged_append", _RUNS)
def logged_append(t: Tables):
    return ledger.read(_logged(t)).select("case_id", "run")


@query("q_logged_flags", f"""
    SELECT case_id, run, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Y' ELSE 'N' END AS triggered,
           CASE WHEN c_mktsegment = 'BUILDING' THEN DATE '2026-10-01' END AS triggered_on
    FROM ({_RUNS}) r JOIN customer ON c_custkey = case_id""")
def logged_flags(t: Tables):
    """Cases of one segment flagged; only files with such a case are written again."""
    table = _logged(t)
    sent = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("case_id"))
    for run in ("mark", "mark again"):
        campaign.mark_triggered_in(table, sent, MARKED_ON, run)
    return ledger.read(table).select("case_id", "run", "triggered", "triggered_on")


@query("q_step_counts", """
    SELECT 'urgent' AS step, COUNT(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT 'lines', COUNT(*) FROM lineitem UNION ALL SELECT 'none', COUNT(*) FROM orders WHERE o_orderkey < 0""")
def step_counts(t: Tables):
    """Rows per step of a run, counted while they are written."""
    steps = {"urgent": t.orders.filter("o_orderpriority = '1-URGENT'"), "lines": t.lineitem, "none": t.orders.filter("o_orderkey < 0")}
    seen = []
    for name, rows in steps.items():
        watched, counter = campaign.counted(rows, name)
        files.write_parquet(watched, _place(t, name))
        seen.append(counter)
    report = campaign.run_report(seen, list(steps))
    return files.from_rows(t.spark, list(report.items()), _table("step string, n bigint"))


_TEMPLATE = campaign.MessageTemplate("renewal", {"en": "Reply now", "pt": "Responda já", "es": "Conteste ya"})


@query("q_template_row", """
    SELECT 'SMS' || LPAD(CAST(MAX(p_partkey) + 1 AS VARCHAR), 9, '0') AS code, 'renewal' AS description,
           'Reply now' AS text_en, 'Responda já' AS text_pt, 'Conteste ya' AS text_es, 9 AS len_en, 11 AS len_pt, 11 AS len_es,
           DATE '2026-10-01' AS begin_dt, CAST(NULL AS DATE) AS end_dt, 'campaign-9' AS created_by
    FROM part""")
def template_row(t: Tables):
    """The template after all others, which are named by part; the tag of another campaign changes nothing."""
    codes = t.part.select(
        F.concat(F.lit("SMS"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("code"), F.lit("campaign-1").alias("created_by")
    )
    return campaign.template_row(codes, _TEMPLATE, MARKED_ON, "campaign-9")


@query("q_template_dates", """
    SELECT 'SMS' || p_partkey AS code, DATE '2026-10-01' AS begin_dt, CAST(NULL AS DATE) AS end_dt, DATE '2999-12-31' AS archive_dt
    FROM part WHERE p_size > 25 AND p_partkey % 5 <> 0""")
def template_dates(t: Tables):
    """Dates for templates of one tag (large parts) that have none (all but every fifth)."""
    code = F.concat(F.lit("SMS"), F.col("p_partkey").cast("string")).alias("code")
    tag = F.when(F.col("p_size") > 25, "campaign-9").otherwise("other").alias("created_by")
    dated = t.part.filter(F.col("p_partkey") % 5 == 0).select(code)
    return campaign.template_dates(t.part.select(code, tag), dated, MARKED_ON, "campaign-9")
