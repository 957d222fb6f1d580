"""The session CSV exchange format: fixed columns in fixed order."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haemoloom.functions.parsing import normalize_time_columns
from haemoloom.operators.sessions import with_group_start
from haemoloom.schemas import SESSION_CSV_COLUMNS, SESSION_CSV_TYPES
from haemoloom.sources.csv import read_csv_typed

_TIME_LAYOUT = "yyyy-MM-dd HH:mm:ss.SSSSSSXXX"


def read_session_csv(spark: SparkSession, path: str, day_first: bool = True) -> DataFrame:
    """Session readings with parsed times and the start of each session.

    ``day_first`` says how to read slash-separated dates.
    """
    typed = read_csv_typed(spark, path, SESSION_CSV_TYPES, integers_required=False)
    return with_group_start(normalize_time_columns(typed, day_first), "session_id")


def write_session_csv(sessions: DataFrame, path: str, file_per_session: bool = False) -> None:
    """Write sessions with the fixed columns, replacing what ``path`` holds.

    ``file_per_session`` gives each session a folder of its own. It suits a
    chosen set of sessions, not a whole history.
    """
    rows = sessions.select(*SESSION_CSV_COLUMNS)
    folders = []
    if file_per_session:
        # The partition column leaves the file, so a copy of the id goes there.
        # Rebalancing gathers small sessions and splits large ones.
        rows = rows.withColumn("session", F.col("session_id")).hint("rebalance", "session")
        folders = ["session"]
    # Inside each file, readings are in time order.
    rows = rows.sortWithinPartitions(*folders, "session_id", "datatime")
    rows.write.mode("overwrite").option("header", True).option("timestampFormat", _TIME_LAYOUT).partitionBy(
        *folders
    ).csv(path)
