"""Keeping a result that several branches read."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def keep(df: DataFrame) -> DataFrame:
    """Persist in memory, spilling to disk; lost blocks are computed again from lineage."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` persisted for the length of a ``with`` block."""
    kept = keep(df)
    try:
        yield kept
    finally:
        kept.unpersist()
