"""Raw CSV files to cleaned Parquet files and catalog tables."""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from haemoloom.operators.cleaning import clean_demographics, clean_registration, clean_telemetry
from haemoloom.runtime import use_utc
from haemoloom.schemas import DEMOGRAPHICS, REGISTRATION, TELEMETRY
from haemoloom.sources.csv import read_csv_typed
from haemoloom.sources.tables import load_table, write_parquet


class RawTable(NamedTuple):
    file: str
    schema: T.StructType
    clean: Callable[[DataFrame], DataFrame]


# File name of each raw table, without its suffix.
RAW_TABLES = {
    "demographics": RawTable("idp", DEMOGRAPHICS, clean_demographics),
    "registration": RawTable("d1", REGISTRATION, clean_registration),
    "telemetry": RawTable("vip", TELEMETRY, clean_telemetry),
}


def read_raw(spark: SparkSession, folder: str, name: str, limit: int | None = None) -> DataFrame:
    """One raw table, typed and cleaned; ``limit`` reads only that many rows."""
    raw = RAW_TABLES[name]
    return raw.clean(read_csv_typed(use_utc(spark), f"{folder}/{raw.file}.csv", raw.schema, limit))


def csv_to_parquet(spark: SparkSession, csv_folder: str, parquet_folder: str) -> None:
    """Write every raw table as Parquet."""
    for name, raw in RAW_TABLES.items():
        write_parquet(read_raw(spark, csv_folder, name), f"{parquet_folder}/{raw.file}.parquet")


def parquet_to_tables(spark: SparkSession, parquet_folder: str, tables: dict[str, str]) -> dict[str, DataFrame]:
    """Replace catalog tables from Parquet; ``tables`` maps raw tables to table names."""
    return {
        name: load_table(use_utc(spark), f"{parquet_folder}/{RAW_TABLES[name].file}.parquet", table)
        for name, table in tables.items()
    }
