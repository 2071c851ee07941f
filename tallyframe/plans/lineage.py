"""Writing an intermediate result to shared storage and reading it back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    It is the checkpoint folder the cluster names in ``spark.checkpoint.dir``.
    A local session without one uses a folder in its warehouse; on a cluster
    that is an error, because executors do not share a machine's own disk.
    :func:`drop_scratch` removes it when a job's results are written.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def drop_scratch(spark: SparkSession) -> None:
    """Delete this session's scratch folder; frames built on it cannot be read any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    system = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    system.delete(place, True)
    system.mkdirs(place)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where a value depends on how rows were laid out (partition numbers,
    row positions) or where one result feeds several branches. The written
    files outlive lost executors, and unlike ``checkpoint()`` they keep column
    pruning and size statistics for whatever reads them.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
