"""Catalog tables and Parquet files. Every write replaces the whole target."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    df.write.mode("overwrite").parquet(path, partitionBy=partition_by)


def replace_table(
    df: DataFrame, table: str, path: str | None = None, partition_by: list[str] | None = None
) -> DataFrame:
    """Create or replace ``table`` with the rows of ``df`` and return it.

    With ``path`` the files lie there, else in the catalog's warehouse.
    """
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def load_table(spark: SparkSession, parquet_path: str, table: str, path: str | None = None) -> DataFrame:
    """Replace ``table`` with the content of Parquet files; their schema becomes the table's."""
    return replace_table(spark.read.parquet(parquet_path), table, path)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("num_rows"))


def first_rows(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """The first ``n`` rows by ``order_by``, missing values first; any ``n`` without an order."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
