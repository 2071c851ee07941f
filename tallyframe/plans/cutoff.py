"""The k-th smallest value of a table, found without putting the table in order."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: Bits that one histogram tells apart; so few rows of a last bucket are looked at one by one.
BIN_BITS, FEW_ROWS = 12, 10_000

_ALL = "all"


@dataclass(frozen=True)
class Cut:
    """The k-th value: all rows below it are among the first k, and ``ties`` of those that have it."""

    value: int
    ties: int


def _same(group: str | None, key) -> Column:
    return F.lit(True) if group is None else F.col(group).eqNullSafe(F.lit(key))


def cutoffs(rows: DataFrame, value: str, wanted: Mapping, group: str | None = None) -> dict:
    """For each group the :class:`Cut` after its first k rows by ``value`` (a whole number).

    ``wanted`` has k by group (by None without groups); a group with fewer rows
    than k, or k below 1, gets None: all rows, or no cut. Histograms by the
    leading bits narrow down the one bucket that holds the k-th row, level by
    level; a level is one pass that combines map-side and sends a group's
    histogram of a few thousand counts to the driver. Meant for few groups,
    such as classes. No row is shuffled or sorted but those of the last bucket.
    NULL values are in no bucket.
    """
    rows = rows.filter(F.col(value).isNotNull()).select(value, *([group] if group else []))
    by = [group] if group else []
    bounds = rows.groupBy(*by).agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(F.lit(1)).alias("n")).collect()
    found, todo = {key: None for key in wanted}, {}
    for row in bounds:
        key = row[group] if group else None
        if key in wanted and row["n"] and 1 <= wanted[key] <= row["n"]:
            todo[key] = (row["lo"], row["hi"], wanted[key], row["n"])
    while todo:
        few = {key: state for key, state in todo.items() if state[3] <= FEW_ROWS or state[0] == state[1]}
        for key, (lo, hi, k, n) in few.items():
            del todo[key]
            if lo == hi:
                found[key] = Cut(lo, k)
                continue
            inside = rows.filter(_same(group, key) & F.col(value).between(lo, hi))
            values = [row[0] for row in inside.select(value).orderBy(value).collect()]  # FEW_ROWS at most
            found[key] = Cut(values[k - 1], k - values.index(values[k - 1]))
        if not todo:
            return found
        # Leading bits: buckets of one width, at most 2 ** BIN_BITS + 1 of them.
        shift = {key: max(0, (hi - lo).bit_length() - BIN_BITS) for key, (lo, hi, _, _) in todo.items()}
        inside, bucket = F.lit(False), F.lit(None).cast("bigint")
        for key, (lo, hi, _, _) in todo.items():
            own = _same(group, key) & F.col(value).between(lo, hi)
            inside, bucket = inside | own, F.when(own, F.shiftright(value, shift[key])).otherwise(bucket)
        counted = rows.filter(inside).groupBy(*by, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()
        for key, (lo, hi, k, _) in list(todo.items()):
            own = sorted((row["bucket"], row["n"]) for row in counted if group is None or row[group] == key)
            for number, n in own:
                if k <= n:
                    first = number << shift[key]
                    todo[key] = (max(lo, first), min(hi, first + (1 << shift[key]) - 1), k, n)
                    break
                k -= n
    return found
