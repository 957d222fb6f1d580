"""JSON Lines reads that set bad lines apart."""

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haemoloom.functions.parsing import read_as
from haemoloom.operators.sessions import with_group_start
from haemoloom.schemas import TELEMETRY

BAD = "_bad_line"


class JsonLines(NamedTuple):
    rows: DataFrame
    rejects: DataFrame


def as_text(schema: T.StructType) -> T.StructType:
    """``schema`` with text in place of all types that JSON writes in several ways."""
    exact = (T.DoubleType, T.StringType)
    return T.StructType([T.StructField(f.name, f.dataType if isinstance(f.dataType, exact) else T.StringType()) for f in schema])


def typed(row: Column, field: T.StructField) -> Column:
    """A field of ``row``, read by ``as_text``, in its own type; NULL if it does not fit. A fraction fits no integer."""
    text, kind = row[field.name], field.dataType.simpleString()
    if isinstance(field.dataType, (T.DoubleType, T.StringType)):
        return text
    if isinstance(field.dataType, T.IntegralType):
        return F.coalesce(text.try_cast(kind), F.when(text.try_cast("double") % 1 == 0, text.try_cast("double").try_cast(kind)))
    return read_as(F.trim(text), kind)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> JsonLines | None:
    """Rows of a JSON Lines file or folder, and its lines that do not fit ``schema``.

    None when the path does not exist. Absent fields are NULL. Times are ISO text
    or integer nanoseconds, as a number or as text; whole numbers with a decimal
    point fit integer fields, and 0 and 1 fit truth values.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    wide = T.StructType([*as_text(schema), T.StructField(BAD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    parsed = lines.filter(F.trim("value") != "").select("value", F.from_json("value", wide, options).alias("row"))
    row = F.col("row")
    values = F.struct(*[typed(row, f).alias(f.name) for f in schema]).alias("typed")
    parsed = parsed.select("value", "row", values)
    unfit = [F.col(f"typed.{f.name}").isNull() & row[f.name].isNotNull() for f in schema]
    bad = F.array_contains(F.array(row[BAD].isNotNull(), *unfit), True)
    return JsonLines(
        rows=parsed.filter(~bad).select(*[f"typed.{f.name}" for f in schema]),
        rejects=parsed.filter(bad).select(F.col("value").alias("line")),
    )


def read_machine_jsonl(spark: SparkSession, path: str) -> JsonLines:
    """Telemetry from JSON Lines, with the earliest time per subject and its date, and the lines that are none.

    The start is per subject, not per session. A missing path gives no rows.
    """
    read = read_jsonl(spark, path, TELEMETRY)
    if read is None:
        read = JsonLines(spark.createDataFrame([], TELEMETRY), spark.createDataFrame([], "line string"))
    started = with_group_start(read.rows, "pid")
    return JsonLines(started.withColumn("session_date", F.to_date("session_start_ts")), read.rejects)
