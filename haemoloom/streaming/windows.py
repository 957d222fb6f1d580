"""Bins and sessions that are closed by event time.

A row is given once its bin or session can get no more readings: when the watermark,
the latest time seen less the ``delay``, has passed its end. What is still open waits
in the state of the stream, one row per subject and open bin or session; a restart
goes on from the checkpoint and gives no row twice.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from haemoloom.functions.features import session_id
from haemoloom.operators.bins import bin_statistics
from haemoloom.operators.sessions import with_timestamp
from haemoloom.settings import SERVING, Settings

#: How long readings may be late before their bins and sessions are closed.
DELAY = "1 hour"


@dataclass(frozen=True)
class Progress:
    """What one run read and what came too late: rows that reached the state after it was closed."""

    readings: int
    late: int


def reading_stream(spark: SparkSession, folder: str, schema: StructType, files: int | None = None) -> DataFrame:
    """The Parquet files of ``folder`` as a stream, at most ``files`` at a time."""
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.parquet(folder)


def closed_bins(readings: DataFrame, settings: Settings = Settings(), delay: str = DELAY) -> DataFrame:
    """The bins of a stream of readings, by ``pid`` and ``time_bin``, with their statistics.

    Readings without a time are in no bin. A NULL pid is a subject too.
    """
    timed = with_timestamp(readings).withWatermark("datatime", delay)
    bins = timed.groupBy("pid", F.window("datatime", f"{settings.interval} minutes").alias("bin"))
    found = bins.agg(F.count(F.lit(1)).alias("readings"), *bin_statistics())
    return found.withColumn("time_bin", F.col("bin.start")).drop("bin")


def closed_sessions(readings: DataFrame, settings: Settings = Settings(semantics=SERVING), delay: str = DELAY) -> DataFrame:
    """The sessions of a stream of readings: ``pid``, ``session_start_ts``, ``last_ts``, ``readings`` and statistics.

    Readings are in one session while no pause between them is longer than the
    longest of ``settings``. Readings without a time are in no session. Sessions of
    one subject close in the order of their starts. Set
    ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` so that
    the readings of a hot subject are merged before the shuffle.
    """
    timed = with_timestamp(readings).withWatermark("datatime", delay)
    # A reading at the very end of a session still belongs to it.
    pause = f"{settings.longest_pause_us} microseconds"
    found = timed.groupBy("pid", F.session_window("datatime", pause).alias("session")).agg(
        F.max("datatime").alias("last_ts"), F.count(F.lit(1)).alias("readings"), *bin_statistics()
    )
    return found.withColumn("session_start_ts", F.col("session.start")).drop("session")


def numbered_sessions(closed: DataFrame) -> DataFrame:
    """Stored closed sessions with ``session_ordinal`` and ``session_id``, as sessions of all readings have them.

    A subject's sessions are bounded by the calendar.
    """
    ordinal = F.row_number().over(Window.partitionBy("pid").orderBy("session_start_ts")).cast("bigint")
    return closed.withColumn("session_ordinal", ordinal).withColumn("session_id", session_id(F.col("pid"), F.col("session_ordinal")))


def finished(query) -> Progress:
    """Wait for a query over all available files, and what it did."""
    query.awaitTermination()
    steps = query.recentProgress
    late = sum(state["numRowsDroppedByWatermark"] for step in steps for state in step["stateOperators"])
    return Progress(sum(step["numInputRows"] for step in steps), late)


def append_available(rows: DataFrame, path: str, checkpoint: str) -> Progress:
    """Append what the files that are there now close to the Parquet table at ``path``."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", path)
    return finished(writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
