"""Cleaning of the raw tables after their typed read."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haemoloom.functions.clock import as_timestamp
from haemoloom.functions.parsing import CLOCK_FORMATS, first_match, normalize_time_columns, parse_timestamp


def clean_demographics(raw: DataFrame) -> DataFrame:
    """``first_dialysis`` to a timestamp (bad text raises), ``DM`` to boolean (NULL kept)."""
    return normalize_time_columns(raw).withColumn("DM", F.col("DM").cast("boolean"))


def visit_time(day: Column, clock: Column) -> Column:
    """Day plus clock text (``H:mm`` or ``H:mm:ss``); NULL when it is no time."""
    return first_match(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), F.trim(clock)), CLOCK_FORMATS)


def next_day_clock(day: Column, clock: Column) -> Column:
    """Visit end whose hour is written as 24: the same minutes after midnight."""
    after_midnight = F.concat(F.lit("00:"), F.substring(clock, 4, 16))
    return visit_time(F.date_add(day, 1), after_midnight)


def clean_registration(raw: DataFrame) -> DataFrame:
    """Visit day, start and end as timestamps; text that is no time becomes NULL.

    The end may be given as hour 24, which is the next day's hour 0.
    """
    is_text = dict(raw.dtypes)["keyindate"] == "string"
    day = parse_timestamp(F.trim(F.col("keyindate"))) if is_text else as_timestamp(raw, "keyindate")
    clock = F.trim(F.col("dialysisend"))
    end = F.when(clock.startswith("24:"), next_day_clock(F.col("keyindate"), clock)).otherwise(
        visit_time(F.col("keyindate"), clock)
    )
    return raw.withColumn("keyindate", day).withColumns(
        {"dialysisstart": visit_time(F.col("keyindate"), F.col("dialysisstart")), "dialysisend": end}
    )


def clean_telemetry(raw: DataFrame) -> DataFrame:
    """``datatime`` to a timestamp; bad text raises."""
    return normalize_time_columns(raw)
