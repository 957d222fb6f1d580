"""Bins that late readings may still change.

Each batch of a stream writes the states of the bins it touches to partitions of its
own, by day and batch. A batch that is run again replaces just these, so nothing
counts twice; late readings add a state to their bins and leave the others alone, and
no reading is dropped.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haemoloom.operators.moments import bin_states, merged_states, state_statistics
from haemoloom.operators.sessions import with_timestamp
from haemoloom.settings import Settings
from haemoloom.streaming.windows import Progress, finished

#: What a table of states is partitioned by.
PARTS = ["bin_date", "batch"]


def write_batch(readings: DataFrame, batch: int, path: str, settings: Settings = Settings()) -> None:
    """Replace the states that ``batch`` has written to ``path``."""
    states = bin_states(with_timestamp(readings), settings.interval)
    states = states.withColumns({"bin_date": F.to_date("time_bin"), "batch": F.lit(batch).cast("long")})
    # A day's bins of one batch go to one file per task that holds some.
    writer = states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*PARTS).parquet(path)


def refresh_bins(readings: DataFrame, path: str, checkpoint: str, settings: Settings = Settings()) -> Progress:
    """Add the files of a stream of readings that are there now to the states at ``path``."""
    writer = readings.writeStream.foreachBatch(lambda rows, batch: write_batch(rows, batch, path, settings))
    return finished(writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """One state per ``pid`` and ``time_bin``; a filter on ``bin_date`` reads these days only."""
    return merged_states(spark.read.parquet(path), ["bin_date", "pid", "time_bin"])


def read_bins(spark: SparkSession, path: str) -> DataFrame:
    """The bins with their statistics as they are now."""
    return state_statistics(read_states(spark, path))


def compact_day(spark: SparkSession, path: str, to: str, day: str) -> None:
    """Write the merged states of ``day`` to the table ``to``, as batch -1; running it again changes nothing."""
    states = read_states(spark, path).filter(F.col("bin_date") == F.lit(day).cast("date"))
    writer = states.withColumn("batch", F.lit(-1).cast("long")).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS).parquet(to)
