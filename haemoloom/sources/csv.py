"""Typed CSV reads of the raw tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haemoloom.functions.parsing import strict_cast
from haemoloom.schemas import MISSING_TEXT
from haemoloom.sources.tables import first_rows

CSV_FILES = "*.[cC][sS][vV]"


def read_csv_text(spark: SparkSession, path: str, files: str | None = None, multi_line: bool = False) -> DataFrame:
    """All columns as text, with missing-value text as NULL.

    ``files`` is a name pattern that picks files of a folder. Files whose header
    differs from the others' raise.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False).option("multiLine", multi_line)
    if files:
        reader = reader.option("pathGlobFilter", files)
    text = reader.csv(path)
    return text.select(*[F.when(~F.col(c).isin(MISSING_TEXT), F.col(c)).alias(c) for c in text.columns])


def read_csv_typed(
    spark: SparkSession,
    path: str,
    schema: T.StructType | dict[str, str],
    limit: int | None = None,
    order_by: str | None = None,
    files: str | None = None,
    integers_required: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Read CSV and cast the columns that ``schema`` names.

    Text that does not fit its type raises with the column's name. Columns
    absent from the file are skipped, and unnamed ones stay text. A missing
    integer raises too, unless ``integers_required`` is off. ``limit`` keeps the
    first rows, by ``order_by`` if given. ``multi_line`` reads line breaks in quotes, and
    then a file is not split.
    """
    if isinstance(schema, T.StructType):
        schema = {f.name: f.dataType.simpleString() for f in schema}
    text = read_csv_text(spark, path, files, multi_line)
    typed = text.select(*[
        strict_cast(c, schema[c], integers_required).alias(c) if c in schema else F.col(c) for c in text.columns
    ])
    return typed if limit is None else first_rows(typed, limit, [order_by] if order_by else [])


def read_csv_folder(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | dict[str, str],
    integers_required: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Every CSV file of a folder, whichever case its suffix has."""
    return read_csv_typed(
        spark, folder, schema, files=CSV_FILES, integers_required=integers_required, multi_line=multi_line
    )
