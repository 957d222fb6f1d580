"""Time expressions on UTC timestamps."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOUR_US = 3_600_000_000
SECOND_US = 1_000_000
MINUTE_US = 60_000_000
DAY_US = 86_400_000_000


def whole_div(value: Column, divisor: int) -> Column:
    """Integer division toward zero."""
    return F.call_function("div", value, F.lit(divisor))


def epoch_ns_to_timestamp(ns: Column) -> Column:
    """Integer nanoseconds to a timestamp, rounded to the microsecond; NULL if out of range."""
    half = F.when(ns < 0, F.lit(-500)).otherwise(F.lit(500))
    return F.timestamp_micros(whole_div(F.try_add(ns, half), 1000))


def text_to_timestamp(text: Column) -> Column:
    """ISO text, or an integer as epoch nanoseconds; NULL if it is neither. Four digits are a year."""
    whole = text.rlike("^[+-]?[0-9]+$") & ~text.rlike("^[0-9]{4}$")
    return F.when(whole, epoch_ns_to_timestamp(text.try_cast("bigint"))).otherwise(F.try_to_timestamp(text))


def as_timestamp(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a UTC timestamp, whichever of its usual types it has.

    Integers, also as text, are epoch nanoseconds; zone-less timestamps and text are read as UTC.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return F.col(name)
    if isinstance(kind, T.IntegralType):
        return epoch_ns_to_timestamp(F.col(name).cast("bigint"))
    if isinstance(kind, T.StringType):
        return text_to_timestamp(F.trim(F.col(name)))
    return F.col(name).cast("timestamp")


def slot_start_us(ts: Column, width_us: int) -> Column:
    """Start, in epoch microseconds, of the aligned slot that holds ``ts``."""
    us = F.unix_micros(ts)
    return us - F.pmod(us, F.lit(width_us))


def time_bin(ts: Column, minutes: int) -> Column:
    """Start of the ``minutes``-wide bin that holds ``ts``, counted from the epoch.

    The division runs toward zero, so the bin at the epoch is twice as wide.
    """
    seconds = F.unix_seconds(ts)
    return F.timestamp_seconds(seconds - seconds % F.lit(minutes * 60))


def elapsed_us(start: Column, end: Column) -> Column:
    return F.unix_micros(end) - F.unix_micros(start)


def elapsed_hours(start: Column, end: Column, fractional: bool = False) -> Column:
    """Hours from ``start`` to ``end``: whole elapsed hours, or exact."""
    gap = elapsed_us(start, end)
    return gap / F.lit(float(HOUR_US)) if fractional else whole_div(gap, HOUR_US)


def elapsed_minutes(start: Column, end: Column, fractional: bool = False) -> Column:
    """Minutes from ``start`` to ``end``: whole minutes toward zero, or exact."""
    gap = elapsed_us(start, end)
    return gap / F.lit(float(MINUTE_US)) if fractional else whole_div(gap, MINUTE_US)
