"""Row-level feature expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from haemoloom.functions.clock import DAY_US, elapsed_us


def session_id(pid: Column, ordinal: Column) -> Column:
    """``pid_ordinal``; NULL when either part is NULL."""
    return F.concat(pid.cast("string"), F.lit("_"), ordinal.cast("string"))


def age_at_session(session_start: Column, birth_year: Column) -> Column:
    return F.year(session_start) - birth_year


def dialysis_vintage(session_start: Column, first_dialysis: Column, fractional: bool = False) -> Column:
    """Years since the first dialysis: calendar-year difference, or whole days / 365.25."""
    if fractional:
        us = elapsed_us(first_dialysis, session_start)
        whole_days = (us - F.pmod(us, F.lit(DAY_US))) / F.lit(float(DAY_US))
        return whole_days / F.lit(365.25)
    return (F.year(session_start) - F.year(first_dialysis)).cast("bigint")


def hypotension(min_sbp: Column, threshold: float) -> Column:
    """1 when the lowest systolic reading is under the threshold, else 0 (also for NULL)."""
    return F.when(min_sbp < F.lit(threshold), 1).otherwise(0)


def split_bucket(session: Column) -> Column:
    """Stable bucket 0..9 of a session, from the first 32 bits of its MD5."""
    head = F.conv(F.substring(F.md5(session), 1, 8), 16, 10)
    return head.cast("bigint") % F.lit(10)


def dataset_split(session: Column) -> Column:
    """TRAIN for about 80 % of sessions, else TEST; whole sessions stay together.

    The split is stable and session-level. It is MD5-based, so its members are
    not those of a split made with another hash.
    """
    return F.when(split_bucket(session) < 8, "TRAIN").otherwise("TEST")
