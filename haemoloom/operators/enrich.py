"""Joins of sessions with per-visit registration and per-subject demographics.

No side is broadcast by hand: Spark broadcasts one when its measured size is
under ``spark.sql.autoBroadcastJoinThreshold``, and shuffles otherwise.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haemoloom.functions.clock import as_timestamp

_DAY = "session_date"


def weight_choices() -> list[Column]:
    """Aggregates from which ``chosen_weights`` takes a group's weights."""
    pair = F.struct(
        F.col("weightstart").isNull().alias("no_start"),
        F.col("dryweight").isNull().alias("no_dry"),
        "weightstart",
        "dryweight",
    )
    return [F.min(pair).alias("pair"), F.min("weightstart").alias("any_start"), F.min("dryweight").alias("any_dry")]


def chosen_weights() -> list[Column]:
    """Both weights of the visit that sorts first among those with both; else the lowest known of each."""
    return [
        F.coalesce("pair.weightstart", "any_start").alias("weightstart"),
        F.coalesce("pair.dryweight", "any_dry").alias("dryweight"),
    ]


def registration_by_day(registration: DataFrame, one_per_day: bool = False) -> DataFrame:
    """One row per subject and day: the visit's weights and the number of visits.

    With several registrations on a day the weights come from the one with
    both present that sorts first. ``visits`` is the number of registrations
    that day, or 1 with ``one_per_day``.
    """
    dated = registration.withColumn(_DAY, F.to_date(as_timestamp(registration, "keyindate")))
    visits = F.lit(1).cast("bigint") if one_per_day else F.count(F.lit(1))
    return (
        dated.filter(F.col(_DAY).isNotNull())
        .groupBy("pid", _DAY)
        .agg(*weight_choices(), visits.alias("visits"))
        .select("pid", _DAY, *chosen_weights(), "visits")
    )


def demographics_by_subject(demographics: DataFrame) -> DataFrame:
    """One row per subject: lowest known value of each attribute, and the row count."""
    return demographics.groupBy("pid").agg(
        F.min("gender").alias("gender"),
        F.min("birthday").alias("birthday"),
        F.min("DM").alias("DM"),
        F.min(as_timestamp(demographics, "first_dialysis")).alias("first_dialysis_ts"),
        F.count(F.lit(1)).alias("profiles"),
    )


def join_registration(readings: DataFrame, registration: DataFrame, one_per_day: bool = False) -> DataFrame:
    """Inner join on subject and the date of the session's start.

    A day with several registrations repeats the readings once for each, unless
    ``one_per_day``. Sessions without a registration that day drop out.
    """
    rows = readings.withColumn(_DAY, F.to_date(as_timestamp(readings, "session_start_ts")))
    if one_per_day:
        return rows.join(registration_by_day(registration, True).drop("visits"), ["pid", _DAY])
    stamped = registration.withColumn("keyindate_ts", as_timestamp(registration, "keyindate"))
    return rows.join(stamped.withColumn(_DAY, F.to_date("keyindate_ts")), ["pid", _DAY])


def join_demographics(readings: DataFrame, demographics: DataFrame) -> DataFrame:
    """Inner join on subject, with ``first_dialysis`` also as a timestamp."""
    stamped = demographics.withColumn("first_dialysis_ts", as_timestamp(demographics, "first_dialysis"))
    return readings.join(stamped, "pid")


def enrich(
    readings: DataFrame,
    registration: DataFrame,
    demographics: DataFrame,
    one_per_day: bool = False,
) -> DataFrame:
    """Readings of any number of sessions with their registration and demographics."""
    return join_demographics(join_registration(readings, registration, one_per_day), demographics)


def join_visits(
    bins: DataFrame, registration: DataFrame, demographics: DataFrame, one_per_day: bool = False
) -> DataFrame:
    """Inner joins of session bins with one row per day and per subject.

    The repetition that several matches would cause is kept as the number
    ``copies`` instead of as rows.
    """
    return (
        bins.join(demographics_by_subject(demographics), "pid")
        .withColumn(_DAY, F.to_date("session_start_ts"))
        .join(registration_by_day(registration, one_per_day), ["pid", _DAY])
        .withColumn("copies", F.col("visits") * F.col("profiles"))
        .drop(_DAY, "visits", "profiles")
    )
