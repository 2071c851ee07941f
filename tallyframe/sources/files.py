"""File sources and sinks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    date_format: str = "yyyy-MM-dd",
    mode: str = "FAILFAST",
) -> DataFrame:
    """Headed CSV.

    With a schema there is no inference pass over the data and malformed rows
    fail (or go to ``_corrupt_record`` under ``PERMISSIVE`` if the schema has
    it), and so does a header that differs from the schema's names. Without one
    the types are inferred, which reads the files twice.
    """
    reader = spark.read.option("header", True).option("dateFormat", date_format)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    # Else Spark puts columns in the schema's order without a look at the header.
    return reader.schema(schema).option("mode", mode).option("enforceSchema", False).csv(path)


@dataclass(frozen=True)
class Intake:
    """What became of CSV files: rows that fit the schema, the others with their place, and how many of each."""

    good: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def load_csv(
    spark: SparkSession, path: str, schema: T.StructType, into: str, date_format: str = "yyyy-MM-dd"
) -> Intake:
    """Read headed CSV once and set aside records that do not fit.

    A record with a value that is not of its type, or with too few or too many
    fields, is a reject: its text, file and line number. Everything is written
    under ``into`` in the one pass that parses, counted while it is written,
    and read back. A file that does not begin with the schema's names is an
    error; header lines further down, as in files put together, and blank
    lines are passed over. Quoted text may not hold a line end.
    """
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad", "dateFormat": date_format}
    lines = spark.read.text(path).select(
        F.col("value").alias("__line"),
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__seen"),
    )
    parsed = lines.withColumn("__row", F.from_csv("__line", f"{names}, __bad string", options))
    header = F.lower(F.regexp_replace("__line", '[" \ufeff\r]', "")) == ",".join(schema.names).lower()
    kind = (
        F.when(F.trim("__line") == "", "blank").when(header, "header")
        .when(F.col("__row.__bad").isNotNull(), "reject").otherwise("good")
    )
    typed = parsed.select("*", *[F.col("__row")[n].alias(n) for n in schema.names], kind.alias("__kind"))
    counter = Observation("csv intake")
    kinds = ("good", "reject", "header", "blank")
    counted = typed.drop("__row").observe(counter, *[F.count(F.when(F.col("__kind") == k, 1)).alias(k) for k in kinds])
    counted.withColumn("__line", F.when(F.col("__kind") == "reject", F.col("__line"))).write.partitionBy("__kind").parquet(into)
    written = spark.read.parquet(into)
    # A row for each piece of a file that a task read: where it begins and how many lines it has.
    blocks = written.groupBy("__file", "__block").agg(
        F.min("__seen").alias("__lead"), F.count(F.lit(1)).alias("__lines"), F.min_by("__kind", "__seen").alias("__first")
    )
    headless = blocks.filter("__block = 0 and __first <> 'header'").select("__file").first()
    if headless:
        raise ValueError(f"{headless[0]} does not begin with {','.join(schema.names)}")
    earlier = Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("__before", F.coalesce(F.sum("__lines").over(earlier), F.lit(0)))
    rejects = written.filter("__kind = 'reject'").join(blocks, ["__file", "__block"]).select(
        F.col("__file").alias("file"), (F.col("__before") + F.col("__seen") - F.col("__lead") + 1).alias("line"), F.col("__line").alias("record")
    )
    return Intake(written.filter("__kind = 'good'").select(*schema.names), rejects, {k: counter.get[k] for k in kinds})


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_sheets(
    spark: SparkSession, paths: dict[str, str], schemas: dict[str, T.StructType] | None = None
) -> dict[str, DataFrame]:
    """Several sheets exported one file each, CSV or Parquet, as named tables."""
    schemas = schemas or {}
    return {
        name: read_csv(spark, path, schemas.get(name))
        if path.endswith(".csv")
        else read_parquet(spark, path)
        for name, path in paths.items()
    }


def from_rows(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """A frame from local rows or a pandas frame; for small parameter tables."""
    return spark.createDataFrame(rows, schema)


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()
) -> None:
    """Parquet sink, optionally partitioned (for example by order month)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Headed CSV, one file per task."""
    df.write.mode(mode).option("header", True).csv(path)


def write_pairs(df: DataFrame, path: str, key: str | Column, value: str | Column) -> None:
    """Text sink, one ``(key, value)`` line per row."""
    key = F.col(key) if isinstance(key, str) else key
    value = F.col(value) if isinstance(value, str) else value
    line = F.format_string("(%s, %s)", key.cast("string"), value.cast("string"))
    df.select(line.alias("value")).write.mode("errorifexists").text(path)


def _resolved(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark names it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return system.makeQualified(place).toString().rstrip("/")


def read_roots(df: DataFrame) -> set[str]:
    """The folders and files that a frame's plan reads, as they were given; no listing of files."""
    spark, roots = df.sparkSession, set()
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.nodeName().startswith(("LogicalRelation", "Relation")) and hasattr(leaf, "relation"):
            paths = leaf.relation().location().rootPaths()
            roots |= {_resolved(spark, paths.apply(k).toString()) for k in range(paths.size())}
    return roots


def write_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Write a changed copy of a table to a new path and read it back.

    Parquet has no UPDATE; a changed table is a new snapshot. Writing over a
    path the plan still reads would lose rows, so that is refused.
    """
    target = _resolved(df.sparkSession, path)
    if any(root == target or root.startswith(target + "/") for root in read_roots(df)):
        raise ValueError(f"{path} is read by the frame being written; choose a new path")
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
