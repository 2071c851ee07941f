"""Text, date and number expressions over whole test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyframe.functions import dates, text
from tallyframe.functions.numbers import half_even, money
from tallyframe.queries.registry import Tables, query

# --- text ------------------------------------------------------------------


@query("q_trim", "SELECT c_custkey, c_name AS name FROM customer")
def trim(t: Tables):
    padded = F.concat(F.lit(" \t"), "c_name", F.lit("  \n"))
    return t.customer.select("c_custkey", text.strip(padded).alias("name"))


@query("q_upper", "SELECT p_partkey, UPPER(p_name) AS name_upper, LOWER(p_brand) AS brand_lower FROM part")
def upper(t: Tables):
    return t.part.select(
        "p_partkey", F.upper("p_name").alias("name_upper"), F.lower("p_brand").alias("brand_lower")
    )


@query("q_extract_num", r"""
    SELECT p_partkey,
           TRY_CAST(regexp_extract(p_brand, '([-+]?\d*\.?\d+)', 1) AS DOUBLE) AS brand_num,
           TRY_CAST(regexp_extract(p_name, '([-+]?\d*\.?\d+)', 1) AS DOUBLE) AS name_num,
           TRY_CAST(regexp_extract(CAST(p_retailprice AS VARCHAR) || 'Nm@' || p_size,
                                   '([-+]?\d*\.?\d+)', 1) AS DOUBLE) AS torque_num
    FROM part""")
def extract_num(t: Tables):
    torque = F.concat(
        F.col("p_retailprice").cast("string"), F.lit("Nm@"), F.col("p_size").cast("string")
    )
    return t.part.select(
        "p_partkey",
        text.first_number(F.col("p_brand")).alias("brand_num"),
        text.first_number(F.col("p_name")).alias("name_num"),
        text.first_number(torque).alias("torque_num"),
    )


@query("q_text_length", """
    SELECT doc_id, CAST(LENGTH(text) AS INTEGER) AS chars, CAST(STRLEN(text) AS INTEGER) AS bytes
    FROM documents""")
def text_length(t: Tables):
    return t.documents.select(
        "doc_id", F.length("text").alias("chars"), text.byte_length(F.col("text")).alias("bytes")
    )


@query("q_text_cap", """
    SELECT doc_id, SUBSTRING(text, 1, 3500) AS body, LENGTH(text) > 3500 AS truncated,
           STRLEN(text) > 4000 AS over_limit
    FROM documents""")
def text_cap(t: Tables):
    """The cap is the operator: text within 3500 characters, with what it cost as flags."""
    body = F.col("text")
    return t.documents.select(
        "doc_id",
        text.capped(body, 3500).alias("body"),
        text.is_over(body, 3500).alias("truncated"),
        (text.byte_length(body) > 4000).alias("over_limit"),
    )


_CODE = "'SMS' || LPAD(CAST(c_custkey AS VARCHAR), 7, '0')"


@query("q_next_code", f"""
    SELECT 'SMS' || LPAD(CAST(CAST(SUBSTRING(top, 4) AS BIGINT) + 1 AS VARCHAR), 7, '0')
           AS following
    FROM (SELECT MAX({_CODE}) AS top FROM customer) t""")
def next_code(t: Tables):
    codes = t.customer.select(
        F.concat(F.lit("SMS"), F.lpad(F.col("c_custkey").cast("string"), 7, "0")).alias("code")
    )
    return codes.agg(F.max("code").alias("top")).select(
        text.next_code(F.col("top")).alias("following")
    )


@query("q_blank_flag", """
    SELECT o_orderkey, COALESCE(NULLIF(UPPER(TRIM(pref)), ''), 'N') AS opt_in
    FROM (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Y' WHEN '2-HIGH' THEN NULL
                 WHEN '3-MEDIUM' THEN '' WHEN '4-NOT SPECIFIED' THEN ' ' ELSE 'N' END AS pref
          FROM orders) t
    WHERE COALESCE(NULLIF(TRIM(pref), ''), 'Y') = 'Y'""")
def blank_flag(t: Tables):
    priority = F.col("o_orderpriority")
    pref = (
        F.when(priority == "1-URGENT", "Y")
        .when(priority == "2-HIGH", F.lit(None))
        .when(priority == "3-MEDIUM", "")
        .when(priority == "4-NOT SPECIFIED", " ")
        .otherwise("N")
    )
    asked = t.orders.select("o_orderkey", pref.alias("pref"))
    return asked.filter(text.yes_or_unset(F.col("pref"))).select(
        "o_orderkey", text.flag_or_no(F.col("pref")).alias("opt_in")
    )


# --- dates -----------------------------------------------------------------

_AS_OF = dt.date(2026, 10, 1)


@query("q_add_months", """
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - INTERVAL '12' MONTH AS DATE) AS year_before,
           CAST(CASE WHEN CAST(o_orderdate AS DATE) = LAST_DAY(CAST(o_orderdate AS DATE))
                     THEN LAST_DAY(CAST(CAST(o_orderdate AS DATE) + INTERVAL '1' MONTH AS DATE))
                     ELSE CAST(o_orderdate AS DATE) + INTERVAL '1' MONTH END AS DATE) AS month_later
    FROM orders""")
def add_months(t: Tables):
    day = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey",
        F.add_months(day, -12).alias("year_before"),
        dates.add_months_eom(day, 1).alias("month_later"),
    )


@query("q_age_years", """
    SELECT o_orderkey,
           CAST(DATE_SUB('year', CAST(o_orderdate AS DATE), DATE '2026-10-01') AS INTEGER) AS years
    FROM orders""")
def age_years(t: Tables):
    return t.orders.select(
        "o_orderkey", dates.whole_years(F.col("o_orderdate").cast("date"), _AS_OF).alias("years")
    )


@query("q_due_date", """
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - INTERVAL '1' DAY AS DATE) AS day_before,
           UPPER(STRFTIME(CAST(o_orderdate AS DATE) + INTERVAL '15' DAY, '%d-%b-%Y')) AS due
    FROM orders""")
def due_date(t: Tables):
    day = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey",
        F.date_sub(day, 1).alias("day_before"),
        dates.day_month_year(dates.due_after(day, 15)).alias("due"),
    )


@query("q_parse_date", """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS day
    FROM orders""")
def parse_date(t: Tables):
    """Dates back from month/day/year text; pending orders hold no date in theirs."""
    written = F.when(F.col("o_orderstatus") == "P", F.lit("13/45/none")).otherwise(
        F.date_format("o_orderdate", "MM/dd/yyyy")
    )
    return t.orders.select("o_orderkey", dates.parse_date(written, "MM/dd/yyyy").alias("day"))


# --- numbers ---------------------------------------------------------------


@query("q_rounding", """
    SELECT l_orderkey, l_linenumber,
           ROUND(CAST(l_extendedprice AS DECIMAL(18,2)), 1) AS tenth,
           CAST(ROUND_EVEN(CAST(l_extendedprice AS DECIMAL(18,2)), 1) AS DECIMAL(18,1)) AS tenth_even,
           CAST(FLOOR(l_extendedprice) AS BIGINT) AS whole
    FROM lineitem""")
def rounding(t: Tables):
    price = money(F.col("l_extendedprice"))
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.round(price, 1).cast("decimal(18,1)").alias("tenth"),
        half_even(price, 1).cast("decimal(18,1)").alias("tenth_even"),
        F.floor("l_extendedprice").alias("whole"),
    )


@query("q_casts", """
    SELECT o_orderkey, TRY_CAST(k AS BIGINT) AS key_num, CAST(o_totalprice AS INTEGER) AS price_int,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price_text
    FROM (SELECT o_orderkey, FLOOR(o_totalprice) AS o_totalprice,
                 CASE WHEN o_orderstatus = 'P' THEN '1,2' ELSE CAST(o_orderkey AS VARCHAR) END AS k
          FROM orders) t""")
def casts(t: Tables):
    key = F.when(F.col("o_orderstatus") == "P", "1,2").otherwise(
        F.col("o_orderkey").cast("string")
    )
    price = F.floor("o_totalprice").cast("double")
    return t.orders.select(
        "o_orderkey",
        key.try_cast("bigint").alias("key_num"),
        price.cast("int").alias("price_int"),
        money(price).cast("string").alias("price_text"),
    )
