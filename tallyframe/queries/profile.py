"""Data profile over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions.numbers import as_flag
from tallyframe.operators import profiling
from tallyframe.operators.cleaning import clean_claims
from tallyframe.queries.registry import Tables, query


@query("q_class_balance", """
    SELECT quality, COUNT(*) AS n,
           ROUND(CAST(COUNT(*) * 100.0 AS DOUBLE) / (SELECT COUNT(*) FROM labels), 2) AS pct
    FROM labels GROUP BY quality""")
def class_balance(t: Tables):
    return profiling.value_shares(t.labels, "quality")


@query("q_missingness", """
    SELECT 'priority' AS "column", ROUND(AVG(CASE WHEN o_orderpriority = '5-LOW' THEN 1.0 ELSE 0.0 END), 9) AS missing FROM orders
    UNION ALL
    SELECT 'status', ROUND(AVG(CASE WHEN o_orderstatus = 'P' THEN 1.0 ELSE 0.0 END), 9) FROM orders
    UNION ALL
    SELECT 'price', ROUND(AVG(CASE WHEN o_totalprice < 50000 THEN 1.0 ELSE 0.0 END), 9) FROM orders""")
def missingness(t: Tables):
    gaps = t.orders.select(
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.when(F.col("o_totalprice") >= 50000, F.col("o_totalprice")).alias("price"),
    )
    return profiling.missing_shares(gaps).withColumn("missing", F.round("missing", 9))


@query("q_corr_target", """
    SELECT 'n_chars' AS "column",
           ROUND(CORR(CAST(d.n_chars AS DOUBLE), CAST(l.quality AS DOUBLE)), 6) AS r
    FROM documents d JOIN labels l ON l.doc_id = d.doc_id
    UNION ALL
    SELECT 'toxic', ROUND(CORR(CAST(l.toxic AS DOUBLE), CAST(l.quality AS DOUBLE)), 6)
    FROM documents d JOIN labels l ON l.doc_id = d.doc_id""")
def corr_target(t: Tables):
    return profiling.correlation_with(t.labelled, "quality", ["n_chars", "toxic"])


_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("q_corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, ROUND(CORR({a}, {b}), 6) AS r FROM lineitem"
    for a in _MEASURES for b in _MEASURES))
def corr_matrix(t: Tables):
    return profiling.correlation_matrix(t.lineitem, _MEASURES)


_WIDE = {f"m{k}": f"l_quantity * {k} + l_extendedprice * {13 - k} / 100" if k else "CASE WHEN l_linenumber > 1 THEN l_discount END" for k in range(14)}


@query("q_corr_wide", "WITH m AS MATERIALIZED (SELECT " + ", ".join(f"{e} AS {c}" for c, e in _WIDE.items()) + " FROM lineitem) " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, ROUND(CORR({a}, {b}), 6) AS r FROM m" for a in _WIDE for b in _WIDE))
def corr_wide(t: Tables):
    """Fourteen columns, one with gaps: all pairs from one set of matrix sums."""
    wide = t.lineitem.select(*[F.expr(e).cast("double").alias(c) for c, e in _WIDE.items()])
    return profiling.correlation_matrix(wide, list(_WIDE))


@query("q_rate_by_segment", """
    SELECT d.lang, ROUND(AVG(CAST(l.quality AS DOUBLE)), 6) AS rate
    FROM documents d JOIN labels l ON l.doc_id = d.doc_id GROUP BY d.lang""")
def rate_by_segment(t: Tables):
    return profiling.rate_by(t.labelled, "lang", "quality")


@query("q_rates_by_each", """
    SELECT 'lang' AS attribute, d.lang AS value, ROUND(AVG(CAST(l.toxic AS DOUBLE)), 6) AS rate
    FROM documents d JOIN labels l ON l.doc_id = d.doc_id GROUP BY d.lang
    UNION ALL
    SELECT 'source', d.source, ROUND(AVG(CAST(l.toxic AS DOUBLE)), 6)
    FROM documents d JOIN labels l ON l.doc_id = d.doc_id GROUP BY d.source""")
def rates_by_each(t: Tables):
    return profiling.rates_by_each(t.labelled, ["lang", "source"], "toxic")


@query("q_recode", """
    SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 1.0::DOUBLE
                           WHEN p_type = 'STANDARD' THEN 0.0::DOUBLE END AS flag
    FROM part""")
def recode(t: Tables):
    return t.part.select(
        "p_partkey", as_flag(F.col("p_type"), ("ECONOMY", "PROMO"), ("STANDARD",)).alias("flag")
    )


@query("q_claims_clean", r"""
    SELECT d.doc_id AS policy_id, d.lang, NULLIF(d.source, 'src0') AS source,
           d.n_chars || 'Nm@' || d.doc_id || 'rpm' AS max_torque,
           CAST(d.n_chars AS DOUBLE) AS max_torque_num,
           CAST(l.toxic AS DOUBLE) AS is_toxic, CAST(l.quality AS DOUBLE) AS is_claim
    FROM documents d JOIN labels l ON l.doc_id = d.doc_id""")
def claims_clean(t: Tables):
    """Documents and labels as three untidy sheets: padded, repeated, measures and flags in text."""
    policy = t.documents.select(
        F.col("doc_id").alias("Policy ID"),
        F.concat(F.lit(" "), "lang", F.lit("\t")).alias("lang"),
        F.when(F.col("source") == "src0", "  ").otherwise(F.col("source")).alias(" Source "),
    )
    car = t.documents.select(
        F.col("doc_id").alias("policy_id"),
        F.concat("n_chars", F.lit("Nm@"), "doc_id", F.lit("rpm")).alias("Max Torque"),
    )
    claim = t.labels.select(
        F.col("doc_id").alias("policy_id"),
        F.when(F.col("toxic") == 1, "Yes").otherwise("No").alias("is_toxic"),
        F.col("quality").alias("is_claim"),
    )
    return clean_claims(policy.union(policy), car, claim)
