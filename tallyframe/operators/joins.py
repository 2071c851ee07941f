"""Joins that keep their shape when one key holds much of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Rows and bytes (as text) of a lookup that is sent to every task.
LOOKUP_ROWS, LOOKUP_BYTES = 500_000, 64 << 20


def left_join_many(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Left outer join for a right side with many rows per key.

    Adaptive execution splits a hot key on the left of a left outer join, but
    not on the right, where splitting would repeat unmatched rows. So the
    matches come from an inner join, which is split on either side, and the
    rest from an anti join against the distinct right keys.

    ``left`` is read twice; pass a written or persisted frame if it is costly.
    """
    matched = left.join(right, list(keys))
    alone = left.join(right.select(*keys).distinct(), list(keys), "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def join_lookup(df: DataFrame, lookup: DataFrame, *keys: str, how: str = "inner", most_rows: int = LOOKUP_ROWS) -> DataFrame:
    """``df`` with the columns of a lookup table, sent to all tasks if it is small.

    The rows of ``lookup`` are counted and measured, no further than the limit,
    before the join is planned: an estimate from file sizes says little about
    what a frame holds. A larger one is joined by shuffle.
    """
    counted = lookup.limit(most_rows + 1).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("bytes")
    ).first()
    small = counted["rows"] <= most_rows and (counted["bytes"] or 0) <= LOOKUP_BYTES
    return df.join(F.broadcast(lookup) if small else lookup, list(keys), how)
