"""Data profile: duplicates, missing shares, balance, rates, correlation."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.functions.numbers import percent_of
from tallyframe.plans.lineage import materialize
from tallyframe.plans.matrices import PARTS, cut, summed

#: Rows of so many columns are compared as they are; with more they are fingerprinted first.
NARROW = 4
#: Columns whose correlations are aggregate expressions; with more they come from matrix sums.
FEW_COLUMNS = 12


def _prints(df: DataFrame) -> dict[str, Column]:
    """Two 64-bit fingerprints of a whole row. Hashes pass over a NULL, so which columns are NULL is hashed too."""
    gaps = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in df.columns])
    return {"__p1": F.xxhash64(gaps, *df.columns), "__p2": F.xxhash64(F.lit("again"), *df.columns, gaps)}


def duplicate_rows(df: DataFrame) -> DataFrame:
    """The report of :func:`duplicate_report` over all columns, for wide rows.

    Rows are counted by fingerprint, so what is shuffled is 24 bytes a row,
    less what repeats within a task. Only rows whose fingerprint occurs again
    are compared by their columns. ``df`` is read twice.
    """
    marked = df.withColumns(_prints(df))
    counted = materialize(marked.groupBy("__p1", "__p2").agg(F.count(F.lit(1)).alias("__n")))
    repeated = counted.filter("__n > 1").select("__p1", "__p2")
    alike = marked.join(repeated, ["__p1", "__p2"], "left_semi")
    different = alike.groupBy("__p1", "__p2", *df.columns).agg(F.count(F.lit(1))).agg(F.count(F.lit(1)).alias("n"))
    rows, single = F.coalesce(F.sum("__n"), F.lit(0)), F.count(F.when(F.col("__n") == 1, 1))
    return counted.agg(rows.alias("total"), single.alias("single")).select(
        "total", (F.col("single") + different.scalar()).alias("distinct_rows"),
        (F.col("total") - F.col("single") - different.scalar()).alias("duplicates"),
    )


def duplicate_report(df: DataFrame, *keys: str) -> DataFrame:
    """Rows, distinct rows and surplus rows, over all columns or the named ones."""
    if not keys and len(df.columns) > NARROW:
        return duplicate_rows(df)
    groups = df.groupBy(*(keys or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    rows = F.coalesce(F.sum("n"), F.lit(0))
    return groups.agg(
        rows.alias("total"),
        F.count(F.lit(1)).alias("distinct_rows"),
        (rows - F.count(F.lit(1))).alias("duplicates"),
    )


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Rows and percent per value, NULL counted as a value."""
    rows = df.agg(F.count(F.lit(1)).alias("rows")).scalar()
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("pct", percent_of(F.col("n"), rows))


def missing_shares(df: DataFrame, *columns: str, top: int | None = None) -> DataFrame:
    """Share of NULLs per column, long form, largest first; one pass over the table."""
    names = columns or tuple(df.columns)
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in names])
    long = row.unpivot([], list(names), "column", "missing")
    ordered = long.orderBy(F.col("missing").desc(), "column")
    return ordered if top is None else ordered.limit(top)


def _numeric(name: str):
    """Double, with NaN as NULL."""
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def _corr(a: str, b: str) -> Column:
    """Pearson r over rows with both values; NULL where one of them does not vary."""
    x, y = _numeric(a), _numeric(b)
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(x) * F.var_pop(y)))


def correlation_with(
    df: DataFrame, target: str, columns: Sequence[str], places: int = 6
) -> DataFrame:
    """Pearson r of each column with the target, largest first; one pass."""
    row = df.agg(
        *[F.round(_corr(c, target), places).alias(c) for c in columns]
    )
    return row.unpivot([], list(columns), "column", "r").orderBy(
        F.col("r").desc_nulls_last(), "column"
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str], places: int = 6) -> DataFrame:
    """Pearson r of every pair of columns as (a, b, r), both orders and the diagonal.

    Each unordered pair is computed once, all in one pass.
    """
    if len(columns) > FEW_COLUMNS:
        return correlation_blocks(df, columns, places)
    pairs = list(combinations(columns, 2)) + [(c, c) for c in columns]
    row = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(a).alias("a"),
                    F.lit(b).alias("b"),
                    F.round(_corr(a, b), places).alias("r"),
                )
                for a, b in pairs
            ]
        ).alias("cells")
    )
    cells = row.select(F.inline("cells"))
    mirrored = cells.select(
        F.explode(
            F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b", "r"))).otherwise(
                F.array(
                    F.struct("a", "b", "r"),
                    F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "r"),
                )
            )
        ).alias("cell")
    )
    return mirrored.select("cell.*")


def comoments(df: DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sums over the rows in which both columns have a value: count, x, x squared, x times y, each a square matrix.

    x is the row's column, y the other; values are less their column's mean. A
    task sums matrices of its rows; blocks of these are added up in two steps.
    NULL, NaN and infinite values are missing.
    """
    k = len(columns)
    finite = {c: F.when(F.abs(F.col(c).cast("double")) < float("inf"), F.col(c).cast("double")).alias(c) for c in columns}
    rows = df.select(*finite.values())
    means = np.array([m or 0.0 for m in rows.agg(*[F.avg(c) for c in columns]).first()])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4 * k, k))
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.slice(low, 4096).columns]) - means
                here = np.isfinite(x)
                x, held = np.where(here, x, 0.0), here.astype(float)
                total += np.vstack([held.T @ held, x.T @ held, (x * x).T @ held, x.T @ x])
        yield cut(total)

    return tuple(summed(rows.mapInArrow(task, PARTS), (4 * k, k)).reshape(4, k, k))


def correlation_blocks(df: DataFrame, columns: Sequence[str], places: int = 6) -> DataFrame:
    """As :func:`correlation_matrix`, for hundreds of columns: one scan for the means, one for all pairs."""
    n, x, square, product = comoments(df, columns)
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = square - x * x / n
        # Round-off of a constant column is no spread.
        spread = np.where(spread > 1e-12 * np.maximum(square, 1e-300), spread, 0.0)
        r = (product - x * x.T / n) / np.sqrt(spread * spread.T)
    rows = [(a, b, float(r[i, j]) if np.isfinite(r[i, j]) else None) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    frame = df.sparkSession.createDataFrame(rows, "a string, b string, r double")
    return frame.withColumn("r", F.round("r", places))


def rate_by(df: DataFrame, key: str, flag: str, places: int = 6) -> DataFrame:
    """Mean of a 0/1 flag per group, highest first; rows without a group are left out."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.round(F.avg(F.col(flag).cast("double")), places).alias("rate"))
        .orderBy(F.col("rate").desc_nulls_last(), key)
    )


def rates_by_each(df: DataFrame, keys: Sequence[str], flag: str, places: int = 6) -> DataFrame:
    """Rates for several attributes at once, long form (attribute, value, rate)."""
    long = df.select(flag, *[F.col(k).cast("string").alias(k) for k in keys]).unpivot(
        [flag], list(keys), "attribute", "value"
    )
    return (
        long.filter(F.col("value").isNotNull())
        .groupBy("attribute", "value")
        .agg(F.round(F.avg(F.col(flag).cast("double")), places).alias("rate"))
    )
