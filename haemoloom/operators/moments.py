"""Bins as states that merge: counts, means, lowest values and sums of squared differences.

States of parts of a bin merge to the state of the whole, in any order and at any
level, so late readings add a state and wider bins come from narrower ones without
the readings. Squares are taken about the means, so that small spreads of large
values are kept.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haemoloom.functions.clock import time_bin
from haemoloom.operators.bins import AVERAGES


def moment_states(readings: DataFrame, keys: list[str]) -> DataFrame:
    """One state per group of ``keys``: ``readings``, ``n_`` and ``mean_`` of each value, ``min_sbp`` and ``m2_sbp``."""
    counted = [c for x in AVERAGES for c in (F.count(x).alias(f"n_{x}"), F.avg(x).alias(f"mean_{x}"))]
    return readings.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("readings"),
        *counted,
        F.min("sbp").alias("min_sbp"),
        (F.var_pop("sbp") * F.count("sbp")).alias("m2_sbp"),
    )


def bin_states(readings: DataFrame, minutes: int) -> DataFrame:
    """The states of the readings' bins, by ``pid`` and ``time_bin``; readings without a time are in none."""
    timed = readings.filter(F.col("datatime").isNotNull())
    return moment_states(timed.withColumn("time_bin", time_bin(F.col("datatime"), minutes)), ["pid", "time_bin"])


def _mean(x: str) -> tuple[Column, Column]:
    return F.sum(F.col(f"n_{x}") * F.col(f"mean_{x}")), F.sum(f"n_{x}")


def merged_states(states: DataFrame, keys: list[str]) -> DataFrame:
    """One state per group of ``keys`` from the states of its parts.

    A group holds as many rows as it has parts, however many readings they stand for.
    """
    whole = Window.partitionBy(*keys)
    total, n = _mean("sbp")
    about = states.withColumn("_mean", total.over(whole) / F.nullif(n.over(whole), F.lit(0)))
    apart = F.col("mean_sbp") - F.col("_mean")
    means = [c for x in AVERAGES for c in (F.sum(f"n_{x}").alias(f"n_{x}"), (_mean(x)[0] / F.nullif(_mean(x)[1], F.lit(0))).alias(f"mean_{x}"))]
    return about.groupBy(*keys).agg(
        F.sum("readings").alias("readings"),
        *means,
        F.min("min_sbp").alias("min_sbp"),
        F.sum(F.col("m2_sbp") + F.col("n_sbp") * apart * apart).alias("m2_sbp"),
    )


def rolled_up(states: DataFrame, minutes: int) -> DataFrame:
    """The states of bins of ``minutes``, a multiple of the width of the bins in ``states``."""
    return merged_states(states.withColumn("time_bin", time_bin(F.col("time_bin"), minutes)), ["pid", "time_bin"])


def state_statistics(states: DataFrame) -> DataFrame:
    """``states`` as the statistics of bins, under the names that bins of readings have."""
    n = F.col("n_sbp")
    values = [F.col(f"mean_{x}").alias(name) for x, name in AVERAGES.items()]
    spread = F.when(n > 1, F.sqrt(F.col("m2_sbp") / (n - 1))).alias("stddev_sbp")
    return states.select("pid", "time_bin", "readings", *values, "min_sbp", spread, n.alias("sbp_readings"))
