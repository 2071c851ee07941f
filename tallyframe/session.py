"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that hold on a laptop and on a cluster alike. Partition counts are
# left to adaptive execution: it coalesces small shuffle partitions and splits
# skewed ones at run time, so one starting number serves all data sizes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # transformWithState needs the RocksDB state store.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(
    app: str,
    master: str | None = None,
    extra: dict[str, str] | None = None,
    metastore: bool = False,
) -> SparkSession:
    """A session with the settings above; ``metastore=True`` adds Hive table support."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    if metastore:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()
