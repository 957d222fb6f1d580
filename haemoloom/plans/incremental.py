"""A sessionized table that grows run by run.

A run adds readings that are later than all of the runs before. What goes over from
run to run is one row per subject: its last time, and the number and start of its
last session. Each run writes its readings and its subjects to partitions of its own,
so a run that is repeated replaces what it wrote.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haemoloom.functions.clock import elapsed_us
from haemoloom.functions.features import session_id
from haemoloom.operators.sessions import (
    opening_flags,
    placed_readings,
    reading_slots,
    slot_of,
    with_slot_keys,
    with_timestamp,
)
from haemoloom.runtime import scratch_path
from haemoloom.schemas import SESSION_READING_COLUMNS
from haemoloom.settings import Settings

RUN = "run"


def _subjects(spark: SparkSession, folder: str, run: int, pid: str) -> DataFrame:
    """The subjects as the last run before ``run`` left them; none for the first run."""
    schema = f"pid {pid}, last_ts timestamp, session_ordinal bigint, session_start_ts timestamp"
    try:
        held = spark.read.schema(f"{schema}, {RUN} int").parquet(f"{folder}/subjects").filter(F.col(RUN) < run)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    last = held.agg(F.max(RUN)).first()[0]
    return held.filter(F.col(RUN).eqNullSafe(F.lit(last))).drop(RUN)


def _placed(slots: DataFrame, subjects: DataFrame, settings: Settings) -> DataFrame:
    """Slots with their sessions, going on from what is known of the subjects."""
    slots = slots.withColumns({"known": F.lit(0).cast("bigint"), "start": F.lit(None).cast("timestamp"), "new": F.lit(True)})
    before = subjects.select(
        "pid", F.lit(None).cast("bigint").alias("slot"), F.col("last_ts").alias("first_ts"), "last_ts",
        F.lit(0).cast("bigint").alias("readings"), F.col("session_ordinal").alias("known"),
        F.col("session_start_ts").alias("start"), F.lit(False).alias("new"),
    )
    both = slots.unionByName(before)
    in_order = Window.partitionBy("pid").orderBy("new", F.col("slot").asc_nulls_first())
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    pause = elapsed_us(F.lag("last_ts").over(in_order), F.col("first_ts"))
    opens = (
        F.when(~F.col("new"), F.col("known"))
        .when(F.col("first_ts").isNull(), F.col("readings"))
        .when(pause.isNull() | (pause > settings.longest_pause_us), F.lit(1).cast("bigint"))
        .otherwise(F.lit(0).cast("bigint"))
    )
    began = F.when(~F.col("new"), F.col("start")).otherwise(F.when(F.col("opens") > 0, F.col("first_ts")))
    earliest = F.min(F.coalesce("start", "first_ts")).over(whole)
    return (
        both.withColumn("opens", opens)
        .withColumn("session_ordinal", F.sum("opens").over(so_far))
        .withColumn("session_start_ts", F.when(F.col("pid").isNull(), earliest).otherwise(F.max(began).over(so_far)))
        .withColumn("session_id", session_id(F.col("pid"), F.col("session_ordinal")))
    )


def append_readings(readings: DataFrame, folder: str, run: int, settings: Settings = Settings()) -> None:
    """Add ``readings`` to the sessionized table in ``folder`` as run number ``run``.

    A run without readings leaves all subjects as they were. All runs together give what sessionizing all readings at once gives, if
    runs are added in order, each reading is later than its subject's in the runs before, and
    readings without a time come with a subject's first run; else it raises, and
    nothing is written.
    """
    spark = readings.sparkSession
    columns = [c for c in SESSION_READING_COLUMNS if c in readings.columns]
    readings = with_timestamp(readings).select(columns)
    slots = reading_slots(readings.select("pid", "datatime"), slot_of(settings.longest_pause_us + 1))
    subjects = _subjects(spark, folder, run, readings.schema["pid"].dataType.simpleString())
    placed_path = scratch_path(spark, "run-slots")
    _placed(slots, subjects, settings).write.parquet(placed_path)
    placed = spark.read.parquet(placed_path)
    known = with_slot_keys(subjects.select("pid", F.col("last_ts").alias("known_ts"))).drop("pid")
    late = with_slot_keys(placed.filter("new")).join(known, ["_subject", "_unknown"])
    wrong = late.filter(F.col("first_ts").isNull() | (F.col("first_ts") <= F.col("known_ts")))
    n = wrong.agg(F.coalesce(F.sum("readings"), F.lit(0))).first()[0]
    if n:
        raise ValueError(f"run {run} has slots of {n} readings that are not later than the runs before, or have no time")
    sessionized = opening_flags(placed_readings(readings, placed.filter("new"), settings), columns)
    _replace(sessionized, f"{folder}/readings", run)
    last = F.max_by(F.struct("session_ordinal", "session_start_ts"), F.struct("new", F.coalesce("slot", F.lit(0))))
    left = placed.groupBy("pid").agg(F.max("last_ts").alias("last_ts"), last.alias("session"))
    _replace(left.select("pid", "last_ts", "session.*"), f"{folder}/subjects", run)


def _replace(rows: DataFrame, path: str, run: int) -> None:
    writer = rows.withColumn(RUN, F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(RUN).parquet(path)


def sessionized_so_far(spark: SparkSession, folder: str) -> DataFrame:
    """The sessionized table of all runs."""
    return spark.read.parquet(f"{folder}/readings").drop(RUN)
