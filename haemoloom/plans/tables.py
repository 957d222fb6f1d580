"""Plans that store their result: sessionized table, features table, metrics file."""

from pyspark.sql import DataFrame

from haemoloom.operators.metrics import rounded
from haemoloom.operators.sessions import sessionize
from haemoloom.plans.features import features_from_sessions
from haemoloom.settings import Settings
from haemoloom.sources.tables import replace_table


def create_sessionized_table(
    telemetry: DataFrame, table: str, settings: Settings = Settings(), path: str | None = None
) -> DataFrame:
    """Replace ``table`` with sessionized telemetry."""
    return replace_table(sessionize(telemetry, settings), table, path)


def write_clustered_sessions(
    sessionized: DataFrame, path: str, row_group_bytes: int = 32 << 20, files: int | None = None
) -> None:
    """Write sessionized telemetry for reads of single sessions.

    Files are cut and sorted by session and time, so a session lies in few row groups
    and a long one in several files. Minima, maxima and a Bloom filter of
    ``session_id`` let a reader skip the other row groups. The number of files is that
    of shuffle partitions, unless it is given.
    """
    files = files or int(sessionized.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["session_id", "datatime"]
    writer = sessionized.repartitionByRange(files, *order).sortWithinPartitions(*order).write.mode("overwrite")
    (
        writer.option("parquet.block.size", row_group_bytes)
        .option("parquet.bloom.filter.enabled#session_id", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .parquet(path)
    )


def create_bucketed_sessions(sessionized: DataFrame, table: str, buckets: int, path: str | None = None) -> DataFrame:
    """Replace ``table`` with sessionized telemetry in buckets by session, in which it is sorted by time.

    Bins, and windows over the bins of a session, then need no shuffle of readings.
    Buckets are by session and not by subject, so that a subject with many sessions
    is spread. Rows are shuffled to their buckets first, so each bucket is one file.
    """
    spark = sessionized.sparkSession
    writer = sessionized.repartition(buckets, "session_id").write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, "session_id").sortBy("session_id", "datatime").saveAsTable(table)
    return spark.table(table)


def create_features_table(
    sessionized: DataFrame,
    registration: DataFrame,
    demographics: DataFrame,
    table: str,
    settings: Settings = Settings(),
    path: str | None = None,
) -> DataFrame:
    """Replace ``table`` with training features, partitioned by split so that TRAIN reads prune."""
    features = features_from_sessions(sessionized, registration, demographics, settings)
    return replace_table(features, table, path, ["dataset_split"])


def write_metrics_csv(metrics: DataFrame, path: str) -> DataFrame:
    """Write evaluation metrics (one row) as CSV and return them rounded for display."""
    metrics.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return rounded(metrics)
