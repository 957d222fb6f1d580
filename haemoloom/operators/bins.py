"""Fixed-interval bins of readings."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haemoloom.functions.clock import as_timestamp, time_bin
from haemoloom.operators.enrich import chosen_weights, weight_choices
from haemoloom.settings import Settings

# Reading column -> name of its bin average.
AVERAGES = {
    "sbp": "avg_sbp",
    "dbp": "avg_dbp",
    "dia_temp_value": "avg_dia_temp",
    "conductivity": "avg_conductivity",
    "uf": "avg_uf_rate",
    "blood_flow": "avg_blood_flow",
}


def bin_statistics() -> list[Column]:
    """The aggregates of one bin: averages, lowest and spread of systolic pressure."""
    return [
        *[F.avg(source).alias(name) for source, name in AVERAGES.items()],
        F.min("sbp").alias("min_sbp"),
        F.stddev_samp("sbp").alias("stddev_sbp"),
        F.count("sbp").alias("sbp_readings"),
    ]


def timed(readings: DataFrame) -> DataFrame:
    """Readings that have a time; only they are in bins."""
    return readings.filter(F.col("datatime").isNotNull())


def slot_bins(readings: DataFrame, settings: Settings) -> DataFrame:
    """Bins per subject, before sessions are known.

    Rows without a time form one bin without a time, whose count matters for
    the numbering of sessions.
    """
    return readings.groupBy("pid", time_bin(F.col("datatime"), settings.interval).alias("time_bin")).agg(
        F.min("datatime").alias("first_ts"),
        F.max("datatime").alias("last_ts"),
        F.count(F.lit(1)).alias("readings"),
        *bin_statistics(),
    )


def session_bins(sessionized: DataFrame, settings: Settings) -> DataFrame:
    """Bins per subject and session, from sessionized readings.

    The start of a session is its given ``session_start_ts``, else its earliest
    reading. It is found over bins, so readings are reduced before the shuffle.
    """
    ts = as_timestamp(sessionized, "datatime")
    given = as_timestamp(sessionized, "session_start_ts")
    whole = Window.partitionBy("pid", "session_id")
    return (
        timed(sessionized.withColumns({"datatime": ts, "session_start_ts": given}))
        .groupBy("pid", "session_id", time_bin(F.col("datatime"), settings.interval).alias("time_bin"))
        .agg(
            F.min("datatime").alias("first_ts"),
            F.min("session_start_ts").alias("given_start"),
            *bin_statistics(),
        )
        .withColumn(
            "session_start_ts",
            F.coalesce(F.min("given_start").over(whole), F.min("first_ts").over(whole)),
        )
        .drop("first_ts", "given_start")
    )


def enriched_bins(rows: DataFrame, settings: Settings) -> DataFrame:
    """Bins of readings that already carry registration and demographic columns.

    Session constants are the lowest known value in the bin, and both weights come
    from one visit.
    """
    constants = ["gender", "birthday", "DM", "session_start_ts", "first_dialysis_ts"]
    return (
        timed(rows)
        .groupBy("pid", "session_id", time_bin(F.col("datatime"), settings.interval).alias("time_bin"))
        .agg(*bin_statistics(), *weight_choices(), *[F.min(c).alias(c) for c in constants])
        .withColumns({"weightstart": chosen_weights()[0], "dryweight": chosen_weights()[1]})
        .drop("pair", "any_start", "any_dry")
    )


def repeated_stddev(spread: Column, count: Column, copies: Column) -> Column:
    """Sample standard deviation after writing each of ``count`` values ``copies`` times."""
    squares = F.coalesce(spread * spread * (count - 1), F.lit(0.0))
    many = F.when(count > 0, F.sqrt(copies * squares / (copies * count - 1)))
    return F.when(copies == 1, spread).otherwise(many)
