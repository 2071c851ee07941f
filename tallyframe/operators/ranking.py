"""Rank, latest record, top rows per key.

All of these filter a rank by a constant, which Spark turns into a group limit
before the shuffle: each task sends at most that many rows per key, so a key
holding a third of the table does not arrive in one task whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def rank_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    places: int,
    into: str = "rk",
) -> DataFrame:
    """Rows whose rank within their key is at most ``places``; ties kept."""
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(into, F.rank().over(window))
    return ranked.filter(F.col(into) <= places).withColumn(into, F.col(into).cast("bigint"))


def rank_with_ties(
    df: DataFrame, keys: Sequence[str], value: str, places: int, into: str = "rk", largest: bool = True
) -> DataFrame:
    """As :func:`rank_within` by one column, for values that very many rows share.

    The window ranks distinct values with their row counts, of which no more
    than ``places`` can matter for a key; rows then find their rank by joining
    on key and value, where adaptive execution splits a hot pair. So rows that
    tie never come together. Costs a second read of ``df``. A NULL value ranks
    last.
    """
    order = F.col("__value").desc_nulls_last() if largest else F.col("__value").asc_nulls_last()
    counted = df.groupBy(*[F.col(k).alias(f"__of_{k}") for k in keys], F.col(value).alias("__value")).agg(F.count(F.lit(1)).alias("__n"))
    own = Window.partitionBy(*[f"__of_{k}" for k in keys]).orderBy(order)
    # A value with fewer than ``places`` distinct better ones; at least one row stands behind each.
    best = counted.withColumn("__nth", F.dense_rank().over(own)).filter(F.col("__nth") <= places)
    above = F.coalesce(F.sum("__n").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = best.withColumn(into, (above + 1).cast("bigint")).filter(F.col(into) <= places)
    same = [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys] + [F.col(value).eqNullSafe(F.col("__value"))]
    return df.join(cut, same).select(*df.columns, into)


def newest(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], rows: int = 1
) -> DataFrame:
    """The first ``rows`` rows per key in ``order``; the order should have no ties."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("__rn", F.row_number().over(window))
        .filter(F.col("__rn") <= rows)
        .drop("__rn")
    )
