"""Catalog tables: create, clone, append, scan, drop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "errorifexists",
    bucket_by: tuple[int, Sequence[str]] | None = None,
) -> None:
    """Managed table from a frame (``CREATE TABLE ... AS SELECT``).

    With ``bucket_by`` (count, columns) rows are laid out by those columns:
    tables bucketed alike are joined and grouped on them without a shuffle.
    """
    writer = df.write.mode(mode)
    if bucket_by:
        count, columns = bucket_by
        writer = writer.bucketBy(count, *columns).sortBy(*columns)
    writer.saveAsTable(name)


def empty_clone(df: DataFrame) -> DataFrame:
    """No rows, same columns: what ``SELECT ... WHERE 1 <> 1`` gives."""
    return df.sparkSession.createDataFrame([], df.schema)


def create_if_absent(spark: SparkSession, name: str, schema: T.StructType) -> bool:
    """Create an empty table unless it exists; says whether it was created."""
    if spark.catalog.tableExists(name):
        return False
    spark.createDataFrame([], schema).write.mode("ignore").saveAsTable(name)
    return True


def drop_if_present(spark: SparkSession, name: str) -> None:
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", {"name": name})


def append_by_name(df: DataFrame, name: str) -> None:
    """Append to a table, columns matched by name; missing ones become NULL."""
    target = df.sparkSession.table(name)
    unknown = set(df.columns) - set(target.columns)
    if unknown:
        raise ValueError(f"{name} has no columns {sorted(unknown)}")
    padded = target.limit(0).unionByName(df, allowMissingColumns=True)
    padded.select(*target.columns).write.mode("append").saveAsTable(name)


def peek_table(spark: SparkSession, name: str, rows: int = 5) -> DataFrame:
    """Any few rows of a catalog table."""
    return spark.table(name).limit(rows)


def register_views(frames: dict[str, DataFrame]) -> None:
    """Temp views over cleaned frames, for the jobs written as SQL text."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
