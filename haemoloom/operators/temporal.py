"""Lag, trend, rolling and look-ahead columns over the bins of a session.

All of them share one partitioning and one order, so Spark shuffles and sorts
once. Frames count bins, not minutes: absent bins are not filled in.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haemoloom.functions.features import hypotension
from haemoloom.settings import Settings


def bins_in_order():
    return Window.partitionBy("pid", "session_id").orderBy("time_bin")


def previous_bin(name: str) -> Column:
    """Value of the bin before; NULL on the first bin of a session."""
    return F.lag(name).over(bins_in_order())


def trend(name: str) -> Column:
    """Change since the bin before."""
    return F.col(name) - previous_bin(name)


def rolling(aggregate, name: str, settings: Settings) -> Column:
    """``aggregate`` over the current bin and the ``rolling_window`` bins before it."""
    return aggregate(name).over(bins_in_order().rowsBetween(-settings.rolling_window, 0))


def upcoming_hypotension(settings: Settings) -> Column:
    """1 when any of the next ``prediction_intervals`` bins is hypotensive, else 0."""
    ahead = bins_in_order().rowsBetween(1, settings.prediction_intervals)
    return F.coalesce(F.max(hypotension(F.col("min_sbp"), settings.threshold)).over(ahead), F.lit(0))


def add_temporal_features(bins: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return bins.select(
        "*",
        previous_bin("avg_sbp").alias("lag_1_avg_sbp"),
        trend("avg_sbp").alias("trend_1_sbp"),
        previous_bin("avg_uf_rate").alias("lag_1_avg_uf_rate"),
        trend("avg_conductivity").alias("trend_1_conductivity"),
        rolling(F.avg, "avg_sbp", settings).alias("rolling_avg_sbp"),
        rolling(F.max, "avg_sbp", settings).alias("rolling_max_sbp"),
        rolling(F.stddev_samp, "avg_sbp", settings).alias("rolling_stddev_sbp"),
        upcoming_hypotension(settings).alias("label"),
    )
