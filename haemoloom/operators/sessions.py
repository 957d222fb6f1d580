"""Split each subject's readings into sessions by time gap.

Nothing here puts all readings of one subject into one task. Readings that lie
closer together than the session gap can never be in two sessions, so they are
first reduced to one row per subject and aligned time slot (a partial
aggregation, before any shuffle). The windows run over those slots, whose
number per subject is bounded by the calendar and not by the row count. The
result is joined back to the readings on (subject, slot), a join with one row
per key on the slot side, which adaptive execution can split when a key is hot.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from haemoloom.functions.clock import HOUR_US, SECOND_US, as_timestamp, elapsed_hours, elapsed_us, slot_start_us
from haemoloom.functions.features import session_id
from haemoloom.schemas import SESSION_READING_COLUMNS
from haemoloom.settings import Settings

# Slot of readings without a time. No timestamp lies in it.
NO_TIME = -(2**63)

SLOT_KEYS = ["_subject", "_unknown", "slot"]

# Copies of one reading that a single row stands for while they are spread out.
COPIES_PER_ROW = 100_000


def with_timestamp(readings: DataFrame) -> DataFrame:
    """Readings with ``datatime`` as a timestamp (integers are epoch nanoseconds)."""
    if isinstance(readings.schema["datatime"].dataType, TimestampType):
        return readings
    return readings.withColumn("datatime", as_timestamp(readings, "datatime"))


def slot_of(width_us: int) -> Column:
    """Slot of a reading; never NULL, so that it can be a join key."""
    return F.coalesce(slot_start_us(F.col("datatime"), width_us), F.lit(NO_TIME))


def with_slot_keys(df: DataFrame) -> DataFrame:
    """Add non-NULL key columns for the subject; a NULL pid is a subject too.

    Joins and windows over ``SLOT_KEYS`` share one partitioning.
    """
    zero = F.lit(0).cast(df.schema["pid"].dataType)
    return df.withColumns({"_subject": F.coalesce("pid", zero), "_unknown": F.col("pid").isNull()})


def join_slots(readings: DataFrame, slots: DataFrame) -> DataFrame:
    """Readings with the columns of their (pid, slot) row."""
    return with_slot_keys(readings).join(with_slot_keys(slots).drop("pid"), SLOT_KEYS)


def reading_slots(readings: DataFrame, slot: Column) -> DataFrame:
    """One row per subject and slot: first and last time, and number of readings."""
    return readings.groupBy("pid", slot.alias("slot")).agg(
        F.min("datatime").alias("first_ts"),
        F.max("datatime").alias("last_ts"),
        F.count(F.lit(1)).alias("readings"),
    )


def place_sessions(slots: DataFrame, settings: Settings, slot: str = "slot") -> DataFrame:
    """Add ``opens``, ``session_ordinal``, ``session_id`` and ``session_start_ts`` to slots.

    ``slots`` holds one row per (pid, ``slot``) with first_ts, last_ts and
    readings, and no slot may be wide enough to hold a session gap. ``opens``
    counts the sessions that begin in the slot. A reading without a time is a
    session of its own beginning, and comes before all timed readings.
    """
    in_order = Window.partitionBy("pid").orderBy(F.col(slot).asc_nulls_first())
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    pause = elapsed_us(F.lag("last_ts").over(in_order), F.col("first_ts"))
    opens = (
        F.when(F.col("first_ts").isNull(), F.col("readings"))
        .when(pause.isNull() | (pause > settings.longest_pause_us), F.lit(1).cast("bigint"))
        .otherwise(F.lit(0).cast("bigint"))
    )
    # Sessions open later and later, so the latest opening so far is the session's
    # own. Without a subject there is no session id to tell sessions apart.
    start = F.when(F.col("pid").isNull(), F.min("first_ts").over(whole)).otherwise(
        F.max(F.when(F.col("opens") > 0, F.col("first_ts"))).over(so_far)
    )
    return (
        slots.withColumn("opens", opens)
        .withColumns({"session_ordinal": F.sum("opens").over(so_far), "session_start_ts": start})
        .withColumn("session_id", session_id(F.col("pid"), F.col("session_ordinal")))
    )


def session_slots(readings: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The slots of ``readings`` with their sessions; ``datatime`` must be a timestamp."""
    return place_sessions(reading_slots(readings, slot_of(settings.longest_pause_us + 1)), settings)


def attach_sessions(readings: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Add session_ordinal, session_id, session_start_ts and the slot's opening to all rows.

    ``opening`` is true on the timed readings at the very time a session
    begins: one reading, or several that share that time.
    """
    return placed_readings(readings, session_slots(readings.select("pid", "datatime"), settings), settings)


def placed_readings(readings: DataFrame, slots: DataFrame, settings: Settings) -> DataFrame:
    """``readings`` with the sessions of their ``slots``, and ``opening``."""
    slots = slots.select("pid", "slot", "first_ts", "opens", "session_ordinal", "session_id", "session_start_ts")
    placed = join_slots(readings.withColumn("slot", slot_of(settings.longest_pause_us + 1)), slots)
    # A difference, so that it stays a filter on joined rows and no join key:
    # readings are then shuffled once, whatever is asked about the opening.
    at_first = F.coalesce(elapsed_us(F.col("first_ts"), F.col("datatime")) == 0, F.lit(False))
    return placed.select(
        *readings.columns,
        "session_ordinal",
        "session_id",
        "session_start_ts",
        ((F.col("opens") > 0) & at_first).alias("opening"),
    )


def repeat_rows(df: DataFrame, copies: str, keys: list[str]) -> DataFrame:
    """Write every row ``copies`` times.

    Large counts are cut into pieces that are spread over the cluster before
    they are written out, so no task writes all copies of one row.
    """
    piece = F.explode(F.sequence(F.lit(0), F.call_function("div", F.col(copies) - 1, F.lit(COPIES_PER_ROW))))
    left = F.least(F.lit(COPIES_PER_ROW), F.col(copies) - F.col("_piece") * COPIES_PER_ROW)
    return (
        df.withColumn("_piece", piece)
        .repartition(*keys, "_piece")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), left)))
        .drop("_piece", "_copy", copies)
    )


def first_of_ties(ties: DataFrame, columns: list[str], keys: list[str], flag: str) -> DataFrame:
    """``ties`` with ``flag`` true on exactly one row of each group of ``keys``.

    It is the row that sorts first by ``columns``; of exact copies, any one.
    Copies are counted before they are shuffled and written out again after, and
    the first row is found by a partial aggregation, so neither many copies nor
    many different rows of one key meet in one task.
    """
    rest = [c for c in ties.columns if c not in columns]
    counted = ties.groupBy(*ties.columns).agg(F.count(F.lit(1)).alias("_same"))
    # All columns, so that both uses of the counted rows are alike and share their shuffle.
    values = F.struct(*[F.col(c) for c in (*columns, *rest, "_same")])
    firsts = counted.groupBy(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)]).agg(F.min(values).alias("_first"))
    same_key = [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)]
    kept = F.struct(F.lit(True).alias(flag), F.lit(1).cast("bigint").alias("_copies"))
    others = lambda n: F.struct(F.lit(False).alias(flag), n.alias("_copies"))
    parts = F.when(values.eqNullSafe(F.col("_first")), F.array(kept, others(F.col("_same") - 1))).otherwise(
        F.array(others(F.col("_same")))
    )
    marked = counted.join(firsts, same_key).select(*columns, *rest, F.explode(parts).alias("_part"))
    marked = marked.select(*columns, *rest, "_part.*").filter(F.col("_copies") > 0)
    return repeat_rows(marked, "_copies", keys)


def sessionize(readings: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Add is_new_session, session_id and session_start_ts to telemetry.

    Exactly one reading opens each session. When several share the opening
    time, it is the one that sorts first by its values. All other readings
    pass through unchanged; only those at an opening time are compared.
    """
    columns = [c for c in SESSION_READING_COLUMNS if c in readings.columns]
    return opening_flags(attach_sessions(with_timestamp(readings).select(columns), settings), columns)


def opening_flags(placed: DataFrame, columns: list[str]) -> DataFrame:
    """Readings with sessions and ``is_new_session``, which one reading at each opening has."""
    output = [*columns, "is_new_session", "session_id", "session_start_ts"]

    # A reading without a time always begins a session.
    body = placed.filter(~F.col("opening")).withColumn("is_new_session", F.col("datatime").isNull().cast("int"))
    heads = placed.filter("opening").select(*columns, "session_id", "session_start_ts")
    heads = first_of_ties(heads, columns, ["pid", "datatime"], "_opens")
    heads = heads.withColumn("is_new_session", F.col("_opens").cast("int"))
    return body.select(output).unionByName(heads.select(output))


def previous_times(timed: DataFrame) -> DataFrame:
    """``datatime`` of each subject's distinct times, how often it has it, and the time before.

    Times are looked for inside the second, then among earlier seconds of the hour,
    then among earlier hours: a second holds a million different times at most, an
    hour 3600 seconds, and hours are bounded by the calendar.
    """
    subject = ["_subject", "_unknown"]
    second, hour = slot_of(SECOND_US).alias("second"), slot_of(HOUR_US).alias("hour")
    times = timed.groupBy(*subject, "datatime").agg(F.count(F.lit(1)).alias("at_once"))
    times = times.select(*subject, "datatime", "at_once", second, hour)
    # The count keeps the three uses of the times alike, so that they share a shuffle.
    last = F.max(F.struct("datatime", "at_once"))
    seconds = times.groupBy(*subject, "hour", "second").agg(last.alias("last"))
    hours = seconds.groupBy(*subject, "hour").agg(F.max("last").alias("last"))
    within_hour = Window.partitionBy(*subject, "hour").orderBy("second")
    seconds = seconds.select(*subject, "second", F.lag("last.datatime").over(within_hour).alias("earlier_second"))
    hours = hours.select(*subject, "hour", F.lag("last.datatime").over(Window.partitionBy(*subject).orderBy("hour")).alias("earlier_hour"))
    within_second = Window.partitionBy(*subject, "second").orderBy("datatime")
    lagged = times.withColumn("earlier", F.lag("datatime").over(within_second))
    joined = lagged.join(seconds, [*subject, "second"]).join(hours, [*subject, "hour"])
    return joined.select(*subject, "datatime", "at_once", F.coalesce("earlier", "earlier_second", "earlier_hour").alias("before"))


def previous_reading(readings: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Add the subject's previous reading time and the hours since then.

    Of readings at one time, the one that sorts first by its values has the time
    before as its previous one; to the others it is their own time.
    """
    readings = with_timestamp(readings)
    columns = readings.columns
    zero = F.lit(0).cast(readings.schema["pid"].dataType)
    timed = readings.filter(F.col("datatime").isNotNull()).withColumns(
        {"_subject": F.coalesce("pid", zero), "_unknown": F.col("pid").isNull()}
    )
    found = timed.join(previous_times(timed.select("_subject", "_unknown", "datatime")), ["_subject", "_unknown", "datatime"])
    # A difference, so that it filters joined rows: both uses share their shuffles.
    alone = F.col("at_once") - 1 == 0
    single = found.filter(alone).select(*columns, F.col("before").alias("previous_ts"))
    ties = first_of_ties(found.filter(~alone).select(*columns, "before"), columns, ["pid", "datatime"], "_leads")
    tied = ties.select(*columns, F.when(F.col("_leads"), F.col("before")).otherwise(F.col("datatime")).alias("previous_ts"))
    untimed = readings.filter(F.col("datatime").isNull()).withColumn("previous_ts", F.lit(None).cast("timestamp"))
    gap = elapsed_hours(F.col("previous_ts"), F.col("datatime"), settings.serving)
    return single.unionByName(tied).unionByName(untimed).withColumn("gap_hours", gap)


def new_session_flags(readings: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Add ``is_new_session``: no previous reading, or a gap longer than the window."""
    gapped = previous_reading(readings, settings)
    starts = F.col("previous_ts").isNull() | (F.col("gap_hours") > settings.session_window)
    return gapped.withColumn("is_new_session", F.when(starts, 1).otherwise(0))


def with_group_start(df: DataFrame, key: str, name: str = "session_start_ts") -> DataFrame:
    """Add the earliest ``datatime`` of each ``key`` group to its rows.

    Groups are reduced before the shuffle and joined back, so that a hot group
    is never gathered in one task.
    """
    starts = df.groupBy(F.col(key).alias("_key")).agg(F.min("datatime").alias(name))
    return df.drop(name).join(starts, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")


def normalize_sessionized(sessionized: DataFrame) -> DataFrame:
    """A sessionized table with integer subjects, timestamps, and every session start.

    A missing start is the earliest reading of the session. Only sessions that
    lack a start on some row take part in the look-up.
    """
    typed = sessionized.withColumns({
        "pid": F.col("pid").cast("bigint"),
        "datatime": as_timestamp(sessionized, "datatime"),
        "session_start_ts": as_timestamp(sessionized, "session_start_ts"),
    })
    earliest = (
        typed.groupBy(F.col("session_id").alias("_session"))
        .agg(F.min("datatime").alias("_earliest"), F.bool_or(F.col("session_start_ts").isNull()).alias("_lacks"))
        .filter("_lacks")
    )
    return (
        typed.join(earliest, F.col("session_id").eqNullSafe(F.col("_session")), "left")
        .withColumn("session_start_ts", F.coalesce("session_start_ts", "_earliest"))
        .select(*typed.columns)
    )


def session_readings(sessionized: DataFrame, session: str) -> DataFrame:
    """The readings of one session, in time order."""
    return sessionized.filter(F.col("session_id") == F.lit(session)).orderBy("datatime")


def readings_of_sessions(sessionized: DataFrame, sessions: DataFrame) -> DataFrame:
    """The readings of all sessions listed in ``sessions``."""
    return sessionized.join(sessions.select("session_id"), "session_id", "left_semi")
