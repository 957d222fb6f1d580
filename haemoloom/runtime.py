"""Session conventions: UTC time and shared scratch space."""

import uuid

from pyspark.sql import SparkSession

# Settings for large runs. Joins may reuse a partitioning on some of their keys
# (bins stay partitioned by subject), plans are built without Python traces, and
# nanosecond times in Parquet files are read as integers.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}


def use_utc(spark: SparkSession) -> SparkSession:
    """Make date, year and text conversions of ``spark`` work in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor sees: ``spark.checkpoint.dir``, else one beside the warehouse's tables."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch").rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/haemoloom/{name}-{uuid.uuid4().hex}"


def use_checkpoints(spark: SparkSession) -> None:
    """Give iterative jobs a checkpoint folder, so that they survive lost executors."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
