from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from haemoloom.functions.clock import epoch_ns_to_timestamp, time_bin
from haemoloom.functions.parsing import normalize_time_columns, parse_timestamp, strict_cast
from haemoloom.operators.cleaning import clean_demographics, clean_registration, clean_telemetry


def values(df):
    return [tuple(r) for r in df.collect()]


def test_registration_clock(spark):
    raw = spark.createDataFrame(
        [
            ("2024-01-01", "08:00", "24:30"),
            ("2024-01-01", "8:05:30", "12:15"),
            ("2024-12-31", "24:10", "24:05:09"),
            ("2024-01-01", "soon", "late"),
            ("not a day", "08:00", "09:00"),
            ("1/2/2024", None, "23:59"),
        ],
        "keyindate string, dialysisstart string, dialysisend string",
    )
    assert values(clean_registration(raw)) == [
        (datetime(2024, 1, 1), datetime(2024, 1, 1, 8), datetime(2024, 1, 2, 0, 30)),
        (datetime(2024, 1, 1), datetime(2024, 1, 1, 8, 5, 30), datetime(2024, 1, 1, 12, 15)),
        # Only the end may be written as hour 24.
        (datetime(2024, 12, 31), None, datetime(2025, 1, 1, 0, 5, 9)),
        (datetime(2024, 1, 1), None, None),
        (None, None, None),
        (datetime(2024, 2, 1), None, datetime(2024, 2, 1, 23, 59)),
    ]


def test_demographics_keep_missing_truth_values(spark):
    raw = spark.createDataFrame(
        [(1, "2020-01-01", True), (2, None, None)], "pid bigint, first_dialysis string, DM boolean"
    )
    assert values(clean_demographics(raw)) == [(1, datetime(2020, 1, 1), True), (2, None, None)]


def test_telemetry_time(spark):
    raw = spark.createDataFrame([("2024-01-01T00:00:00",), ("2024-01-01 10:00:00+00:00",)], "datatime string")
    assert values(clean_telemetry(raw)) == [(datetime(2024, 1, 1),), (datetime(2024, 1, 1, 10),)]
    with pytest.raises(PySparkException, match="datatime"):
        clean_telemetry(spark.createDataFrame([("yesterday",)], "datatime string")).collect()


def test_time_columns_are_parsed_where_present(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00", "1/04/2014", 1_704_067_200_000_000_000, "2024")],
        "datatime string, first_dialysis_ts string, keyindate bigint, other string",
    )
    row = normalize_time_columns(df).first()
    assert tuple(row) == (datetime(2024, 1, 1), datetime(2014, 4, 1), datetime(2024, 1, 1), "2024")
    month_first = normalize_time_columns(df, day_first=False).first()
    assert month_first.first_dialysis_ts == datetime(2014, 1, 4)


def test_parse_timestamp_layouts(spark):
    texts = ["2014-04-01", "1/04/2014", "13/4/2014 7:05", "2014/4/1", "2014-04-01 10:00:00+02:00", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_timestamp(F.col("t"))).collect()]
    assert got == [
        datetime(2014, 4, 1),
        datetime(2014, 4, 1),
        datetime(2014, 4, 13, 7, 5),
        datetime(2014, 4, 1),
        datetime(2014, 4, 1, 8),
        None,
        None,
    ]


@pytest.mark.parametrize(
    "target, text, value",
    [
        ("bigint", " 12 ", 12),
        ("bigint", "12.0", 12),
        ("bigint", "9007199254740993", 9007199254740993),
        ("double", "1.5", 1.5),
        ("double", None, None),
        ("boolean", "TRUE", True),
        ("boolean", "0", False),
        ("boolean", None, None),
        ("string", "x", "x"),
        ("timestamp", "2024-01-01", datetime(2024, 1, 1)),
    ],
)
def test_strict_cast(spark, target, text, value):
    df = spark.createDataFrame([(text,)], "a string")
    assert df.select(strict_cast("a", target)).first()[0] == value


@pytest.mark.parametrize(
    "target, text", [("bigint", "x"), ("bigint", None), ("double", "x"), ("boolean", "perhaps"), ("timestamp", "x")]
)
def test_strict_cast_names_the_column(spark, target, text):
    df = spark.createDataFrame([(text,)], "weight string")
    with pytest.raises(PySparkException, match="'weight' holds no " + target):
        df.select(strict_cast("weight", target)).collect()


def test_nanoseconds_round_to_microseconds(spark):
    df = spark.createDataFrame([(1_499,), (1_500,), (-1_500,), (-1_499,), (2**63 - 1,)], "ns bigint")
    got = [r[0] for r in df.select(F.unix_micros(epoch_ns_to_timestamp(F.col("ns")))).collect()]
    assert got == [1, 2, -2, -1, None]


def test_time_bins_divide_toward_zero(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 10, 29, 59),), (datetime(1969, 12, 31, 23, 59, 59),)], "t timestamp"
    )
    got = [r[0] for r in df.select(time_bin(F.col("t"), 15)).collect()]
    assert got == [datetime(2024, 1, 1, 10, 15), datetime(1970, 1, 1)]
    assert df.select(F.to_date("t")).first()[0] == date(2024, 1, 1)
