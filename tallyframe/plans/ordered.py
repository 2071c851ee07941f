"""Whole-table order without moving the whole table into one task.

A window with an ORDER BY and no PARTITION BY sends every row to one task.
These functions range-partition by the order columns instead, work inside each
range, and add the offset of the ranges before it. The offset table has one
row per range, so only that summary is ever brought together.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.plans.lineage import materialize

_POSITION = "__position"
_RANGE = "__range"
_OFFSET = "__offset"

# monotonically_increasing_id() keeps the partition number above bit 33 and
# the row's place within its partition below it.
_RANGE_BITS = 33


def _laid_out(df: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Rows in range partitions, sorted, each stamped with its range and place.

    The result is written out: range bounds come from a sample, and evaluating
    the sample twice could put a row in another range the second time.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_POSITION, F.monotonically_increasing_id())
    )
    return materialize(placed).withColumn(_RANGE, F.shiftright(_POSITION, _RANGE_BITS))


def _with_offsets(laid: DataFrame, amount: Column) -> DataFrame:
    """Attach to each row the sum of ``amount`` over all ranges before its own."""
    per_range = laid.groupBy(_RANGE).agg(amount.alias("amount"))
    earlier = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        _RANGE,
        F.coalesce(F.sum("amount").over(earlier), F.lit(0)).alias(_OFFSET),
    )
    # One row per shuffle partition: bounded by the partition count, not by the data.
    return laid.join(F.broadcast(offsets), _RANGE)


def number_rows(
    df: DataFrame, *order: str, into: str = "row_num", start: int | Column = 1
) -> DataFrame:
    """Gap-free numbers in the order of ``order``, starting at ``start``.

    ``order`` must identify a row for the numbers to be repeatable. One shuffle
    and one write; no window over the rows themselves.
    """
    first = start if isinstance(start, Column) else F.lit(start)
    laid = _laid_out(df, order)
    place = F.col(_POSITION) - F.shiftleft(F.col(_RANGE), _RANGE_BITS)
    return (
        _with_offsets(laid, F.count(F.lit(1)))
        .withColumn(into, (F.col(_OFFSET) + place + first).cast("bigint"))
        .drop(_POSITION, _RANGE, _OFFSET)
    )


def running_total(df: DataFrame, amount: str, *order: str, into: str = "running") -> DataFrame:
    """Inclusive running sum of ``amount`` in the order of ``order``, over all rows."""
    laid = _laid_out(df, order)
    within = Window.partitionBy(_RANGE).orderBy(_POSITION).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        _with_offsets(laid, F.sum(amount))
        .withColumn(into, F.col(_OFFSET) + F.sum(amount).over(within))
        .drop(_POSITION, _RANGE, _OFFSET)
    )


def exact_median(
    df: DataFrame, value: str, *groups: str, into: str = "median", accuracy: int = 10_000
) -> DataFrame:
    """Exact median of ``value`` per group; the mean of the two middle values if even.

    A sketch per group first gives two values that enclose the median. A second
    pass counts what lies below them and keeps, counted, only the values
    between: a thousandth of the rows, fewer if values repeat. Their running
    count finds the middle. Both passes combine map-side, so a group with most
    of the rows is never in one task. Should a sketch miss its median, that
    group is ordered in full.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*groups, F.col(value).alias("__v"))
    if not groups:
        rows = rows.withColumn("__all", F.lit("all"))
    keys = list(groups) or ["__all"]
    margin = 5.0 / accuracy
    sketch = F.percentile_approx("__v", [0.5 - margin, 0.5 + margin], accuracy)
    groups_seen = materialize(
        rows.groupBy(*[F.col(k).alias(f"__of_{k}") for k in keys])
        .agg(F.count(F.lit(1)).alias("__size"), sketch.alias("__near"))
        .withColumns({"__from": F.col("__near")[0], "__to": F.col("__near")[1]})
        .drop("__near")
    )
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys])
    near = (
        rows.join(groups_seen, same)
        .filter(F.col("__v") <= F.col("__to"))
        # Everything below the enclosure shares one NULL, which sorts first.
        .withColumn("__v", F.when(F.col("__v") >= F.col("__from"), F.col("__v")))
    )
    found = materialize(_middle(near.select(*keys, "__v"), groups_seen, keys, same))
    missed = groups_seen.join(
        found.filter(F.col("__mid").isNotNull()), same, "left_anti"
    )
    if not missed.isEmpty():
        whole = rows.join(missed.select(*[f"__of_{k}" for k in keys]), same, "left_semi")
        found = found.join(missed, same, "left_anti").union(
            _middle(whole, missed, keys, same)
        )
    return found.select(*groups, F.col("__mid").alias(into))


def _middle(rows: DataFrame, sizes: DataFrame, keys: list[str], same: Column) -> DataFrame:
    """Mean of the middle values per group; NULL unless the rows given reach them.

    ``rows`` are counted per (group, value) before they are ordered; ``sizes``
    has each group's full row count, of which values above the middle may be
    left out of ``rows``.
    """
    counted = rows.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__n"))
    ranked = running_total(counted, "__n", *keys, "__v", into="__upto")
    starts = ranked.groupBy(*[F.col(k).alias(f"__at_{k}") for k in keys]).agg(
        F.min(F.col("__upto") - F.col("__n")).alias("__before")
    )
    here = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__at_{k}")) for k in keys])
    low = F.floor((F.col("__size") + 1) / 2)
    high = F.floor(F.col("__size") / 2) + 1
    upto = F.col("__upto") - F.col("__before")
    first = upto - F.col("__n") + 1
    middle = (
        ranked.join(starts, here)
        .join(sizes, same)
        .filter((first <= high) & (upto >= low))
        .select(
            *keys,
            F.col("__v").cast("double").alias("__v"),
            F.col("__v").isNull().alias("__outside"),
            (upto >= high).alias("__reaches"),
        )
    )
    # One or two distinct values per group. An enclosed median shows no NULL
    # and reaches the upper middle rank.
    enclosed = ~F.max("__outside") & F.max("__reaches")
    return middle.groupBy(*keys).agg(F.when(enclosed, F.avg("__v")).alias("__mid"))
