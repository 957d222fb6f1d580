"""Casts of text columns that fail with the column's name, and time parsing."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haemoloom.functions.clock import as_timestamp, text_to_timestamp
from haemoloom.schemas import TIME_COLUMNS

# Accepted date and time layouts besides ISO 8601.
DAY_FIRST_FORMATS = ["d/M/yyyy", "d/M/yyyy H:mm", "d/M/yyyy H:mm:ss"]
MONTH_FIRST_FORMATS = ["M/d/yyyy", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss"]
YEAR_FIRST_FORMATS = ["yyyy/M/d", "yyyy/M/d H:mm", "yyyy/M/d H:mm:ss"]
CLOCK_FORMATS = ["yyyy-MM-dd H:mm", "yyyy-MM-dd H:mm:ss"]


def conversion_failed(name: str, target: str, text: Column) -> Column:
    """An expression that raises, naming the column and the offending text."""
    return F.raise_error(
        F.concat(
            F.lit(f"column '{name}' holds no {target}: "),
            F.coalesce(text, F.lit("nothing")),
        )
    )


def read_as(text: Column, target: str) -> Column:
    """``text`` as ``target``, or NULL if it is none.

    Numbers with a fraction lose it in an integer. Truth values are true/false in
    any case, or numbers (zero is false).
    """
    if target == "bigint":
        return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))
    if target == "boolean":
        return F.coalesce(text.try_cast("boolean"), text.try_cast("double") != 0)
    if target == "timestamp":
        return parse_timestamp(text)
    return text.try_cast(target)


def strict_cast(name: str, target: str, integers_required: bool = True) -> Column:
    """Text column ``name`` as ``target``; a bad value raises and names the column.

    A missing value is NULL, but an error in an integer column unless
    ``integers_required`` is off.
    """
    text = F.col(name)
    if target == "string":
        return text
    value = read_as(F.trim(text), target)
    bad = value.isNull()
    if target != "bigint" or not integers_required:
        bad = bad & text.isNotNull()
    return F.when(bad, conversion_failed(name, target, text)).otherwise(value)


def first_match(text: Column, formats: list[str]) -> Column:
    """``text`` as a timestamp by the first layout that fits, else NULL."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(layout)) for layout in formats])


def parse_timestamp(text: Column, day_first: bool = True) -> Column:
    """ISO text, integer nanoseconds, or slash-separated dates (day first unless told otherwise); NULL if none fits."""
    slashes = DAY_FIRST_FORMATS if day_first else MONTH_FIRST_FORMATS
    return F.coalesce(text_to_timestamp(text), first_match(text, slashes + YEAR_FIRST_FORMATS))


def normalize_time_columns(df: DataFrame, day_first: bool = True) -> DataFrame:
    """Turn every known time column that ``df`` has into a timestamp.

    Text that is no time raises and names the column; NULL stays NULL.
    """
    parsed = {}
    for name in (c for c in df.columns if c in TIME_COLUMNS):
        if isinstance(df.schema[name].dataType, T.StringType):
            when = parse_timestamp(F.trim(F.col(name)), day_first)
            bad = when.isNull() & F.col(name).isNotNull()
            parsed[name] = F.when(bad, conversion_failed(name, "timestamp", F.col(name))).otherwise(when)
        else:
            parsed[name] = as_timestamp(df, name)
    return df.withColumns(parsed) if parsed else df
