"""Feature plans.

``features_from_telemetry`` goes from raw telemetry to training features and
shuffles readings only after they are reduced to bins. ``features_from_sessions``
starts from a sessionized table. Both give the same rows. ``serving_features``
works on readings that already carry their registration and demographics.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haemoloom.functions import features as fn
from haemoloom.functions.clock import elapsed_minutes
from haemoloom.operators.bins import enriched_bins, repeated_stddev, session_bins, slot_bins
from haemoloom.operators.enrich import join_visits
from haemoloom.operators.sessions import attach_sessions, place_sessions, with_timestamp
from haemoloom.operators.temporal import add_temporal_features
from haemoloom.schemas import FEATURE_COLUMNS, SERVING_COLUMNS
from haemoloom.settings import SERVING, Settings

Columns = Callable[[DataFrame], DataFrame]


def add_static_features(bins: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Age, dialysis vintage, fluid to remove and minutes into the session."""
    start = F.col("session_start_ts")
    return bins.withColumns({
        "age_at_session": fn.age_at_session(start, F.col("birthday")),
        "dialysis_vintage_years": fn.dialysis_vintage(start, F.col("first_dialysis_ts"), settings.serving),
        "fluid_to_remove": F.col("weightstart") - F.col("dryweight"),
        "minutes_into_session": elapsed_minutes(start, F.col("time_bin"), settings.serving),
    })


def training_columns(bins: DataFrame) -> DataFrame:
    """The columns of the features table, in order, with the split."""
    named = {"dataset_split": fn.dataset_split(F.col("session_id")), "Pid": F.col("pid")}
    return bins.select(*[named.get(c, F.col(c)).alias(c) for c in FEATURE_COLUMNS])


def serving_columns(bins: DataFrame) -> DataFrame:
    """The columns of the scoring features, in order: no split, no bin time."""
    return bins.select(*SERVING_COLUMNS)


def _finished(bins, registration, demographics, settings, one_per_day, columns) -> DataFrame:
    # A join keeps or drops a session as a whole and repeats all its readings
    # alike, so the windows may run first and share the bins' partitioning.
    joined = join_visits(add_temporal_features(bins, settings), registration, demographics, one_per_day)
    spread = repeated_stddev(F.col("stddev_sbp"), F.col("sbp_readings"), F.col("copies"))
    return columns(add_static_features(joined.withColumn("stddev_sbp", spread), settings))


def features_from_telemetry(
    telemetry: DataFrame,
    registration: DataFrame,
    demographics: DataFrame,
    settings: Settings = Settings(),
    one_per_day: bool = False,
    columns: Columns = training_columns,
) -> DataFrame:
    """Features of all sessions found in raw telemetry; for training, unless ``columns`` is ``serving_columns``."""
    readings = with_timestamp(telemetry).filter(F.col("pid").isNotNull())
    # The bin at the epoch is two intervals wide. Bins that could hold a session
    # gap cannot stand for their readings when sessions are told apart.
    if 2 * settings.interval_us > settings.longest_pause_us + 1:
        return features_from_sessions(
            attach_sessions(readings, settings), registration, demographics, settings, one_per_day, columns
        )
    bins = place_sessions(slot_bins(readings, settings), settings, slot="time_bin")
    return _finished(
        bins.filter(F.col("time_bin").isNotNull()), registration, demographics, settings, one_per_day, columns
    )


def features_from_sessions(
    sessionized: DataFrame,
    registration: DataFrame,
    demographics: DataFrame,
    settings: Settings = Settings(),
    one_per_day: bool = False,
    columns: Columns = training_columns,
) -> DataFrame:
    """Features from a sessionized table; for training, unless ``columns`` is ``serving_columns``."""
    readings = sessionized.filter(F.col("pid").isNotNull())
    return _finished(session_bins(readings, settings), registration, demographics, settings, one_per_day, columns)


def serving_features(enriched: DataFrame, settings: Settings = Settings(semantics=SERVING)) -> DataFrame:
    """Scoring features of readings that already carry their visits, such as those of session CSV files.

    The label looks ahead over hypotensive bins, as in the training features.
    """
    bins = add_temporal_features(enriched_bins(enriched, settings), settings)
    return serving_columns(add_static_features(bins, settings))
