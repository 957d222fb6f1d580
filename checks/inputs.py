"""Telemetry, registration and demographics derived from the given tables.

``checks.oracle`` states the same expressions in SQL.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haemoloom.runtime import use_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


#: The subject of every third event.
DOMINANT = 3


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with all that the given events lack.

    One subject has a third of all, some readings have no subject or no time, some
    are there twice, and to some there is another at the same time.
    """
    event, user = F.col("event_id"), F.col("user_id")
    once, twice, tied = F.array(F.lit(0)), F.array(F.lit(0), F.lit(0)), F.array(F.lit(0), F.lit(1))
    forms = F.when(event % 20 == 0, twice).when(event % 20 == 1, tied).otherwise(once)
    number = event + F.col("form") * F.lit(1_000_000_000_000)
    value = F.col("value") + 8 * F.col("form")
    return table(spark, sf_dir, "events").withColumn("form", F.explode(forms)).select(
        F.when(event % 23 != 0, F.when(event % 3 == 0, F.lit(DOMINANT).cast("bigint")).otherwise(user)).alias("pid"),
        F.when((event % 13 != 0) | (user % 4 != 3), F.col("ts").cast("timestamp")).alias("datatime"),
        number.alias("measuretime"),
        (60 + F.floor(value / 4)).alias("sbp"),
        (40 + F.floor(value / 8)).alias("dbp"),
        (35 + value / 400).alias("dia_temp_value"),
        (13 + value / 250).alias("conductivity"),
        (value / 500).alias("uf"),
        (150 + value / 4).alias("blood_flow"),
        number.alias("time"),
    )


def registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    start = 50 + key % 40
    # Visits of one day share key % 30, and still differ in what they lose.
    dry = start - (1 + F.floor(key / 30) % 3)
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("pid"),
        F.timestamp_seconds(1_704_067_200 + (key % 30) * 86_400).alias("keyindate"),
        F.format_string("%d:%02d", 6 + key % 6, key % 60).alias("dialysisstart"),
        F.when(key % 17 == 0, "unknown")
        .otherwise(F.format_string("%d:%02d", 12 + key % 13, key % 60))
        .alias("dialysisend"),
        start.cast("double").alias("weightstart"),
        (dry + 0.5).cast("double").alias("weightend"),
        dry.cast("double").alias("dryweight"),
        (36 + (key % 10) / 10).alias("temperature"),
    )


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First dialysis is in epoch nanoseconds, as stored tables have it."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("pid"),
        F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
        (1930 + key % 60).alias("birthday"),
        ((1_262_304_000 + (key % 4000) * 86_400) * 1_000_000_000).alias("first_dialysis"),
        (key % 3 == 0).alias("DM"),
    )


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a score that is a function of their length."""
    size = F.col("n_chars")
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", "n_chars")
        .join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
        .select("doc_id", F.col("quality").alias("label"), (size / (size + 2000.0)).alias("score"))
    )


def plain(df: DataFrame, exact: tuple[str, ...] = ()) -> DataFrame:
    """Zone-less timestamps, dates as text and doubles rounded to 9 digits, as in the SQL.

    Columns named in ``exact`` are not rounded.
    """

    def column(name, kind):
        if isinstance(kind, T.TimestampType):
            return f"CAST(`{name}` AS TIMESTAMP_NTZ) AS `{name}`"
        if isinstance(kind, T.DateType):
            return f"CAST(`{name}` AS STRING) AS `{name}`"
        if isinstance(kind, T.DoubleType) and name not in exact:
            return f"round(`{name}`, 9) AS `{name}`"
        return f"`{name}`"

    return df.selectExpr(*[column(f.name, f.dataType) for f in df.schema])
