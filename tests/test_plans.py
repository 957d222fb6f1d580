"""What reaches the scans: only the columns and rows that are needed."""

import re

import pytest
from pyspark.sql import functions as F

from haemoloom.operators.sessions import sessionize
from haemoloom.plans.chosen import load_session, load_sessions
from haemoloom.plans.features import features_from_sessions, features_from_telemetry
from test_features import random_inputs


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stored")
    readings, visits, profiles = random_inputs(spark, 8)
    frames = {
        "telemetry": readings.withColumns({"measuretime": F.lit(1), "time": F.lit(2)}),
        "registration": visits.withColumn("dialysisstart", F.col("keyindate")),
        "demographics": profiles.withColumn("note", F.lit("x")),
        "sessionized": sessionize(readings),
    }
    for name, df in frames.items():
        df.write.parquet(f"{folder}/{name}")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in frames}


def scans(plan):
    return re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*?Location: [^\n]*?/(\w+)\][^\n]*?ReadSchema: (\S+)", plan)


def test_features_read_only_their_columns(spark, stored):
    plan = plan_of(features_from_telemetry(stored["telemetry"], stored["registration"], stored["demographics"]))
    read = {name: set(re.findall(r"(\w+)#", columns)) for columns, name, _ in scans(plan)}
    assert read["telemetry"] == {
        "pid", "datatime", "sbp", "dbp", "dia_temp_value", "conductivity", "uf", "blood_flow"
    }
    assert read["registration"] == {"pid", "keyindate", "weightstart", "dryweight"}
    assert read["demographics"] == {"pid", "gender", "birthday", "DM", "first_dialysis"}
    assert plan.count("FileScan parquet") == 3  # telemetry is read once


def test_narrow_use_of_features_narrows_the_scan(spark, stored):
    df = features_from_sessions(stored["sessionized"], stored["registration"], stored["demographics"])
    plan = plan_of(df.select("session_id", "time_bin", "min_sbp", "label"))
    read = {name: set(re.findall(r"(\w+)#", columns)) for columns, name, _ in scans(plan)}
    assert read["sessionized"] == {"pid", "datatime", "sbp", "session_id", "session_start_ts"}


def test_one_session_is_filtered_in_the_scan(spark, stored):
    tables = stored["sessionized"], stored["registration"], stored["demographics"]
    session = features_from_sessions(*tables).first().session_id
    df = load_session(*tables, session)
    assert f"EqualTo(session_id,{session})" in plan_of(df)
    wanted = spark.createDataFrame([(session,)], "session_id string")
    assert load_sessions(*tables, wanted).count() == df.count() > 0
    assert {r.session_id for r in df.select("session_id").collect()} == {session}


def test_flags_are_not_computed_for_features(spark, stored):
    """Which reading opens a session does not matter to features; nothing is exploded for them."""
    inputs = stored["telemetry"], stored["registration"], stored["demographics"]
    assert "Generate" not in plan_of(features_from_telemetry(*inputs))
