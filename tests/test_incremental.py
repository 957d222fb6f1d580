"""Sessionized tables in runs, clusters and buckets."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from haemoloom.operators.bins import session_bins
from haemoloom.operators.sessions import attach_sessions, sessionize
from haemoloom.operators.temporal import add_temporal_features
from haemoloom.plans.features import features_from_sessions
from haemoloom.plans.incremental import append_readings, sessionized_so_far
from haemoloom.plans.tables import create_bucketed_sessions, write_clustered_sessions
from haemoloom.settings import SERVING, Settings
from test_streaming import BEGIN, SCHEMA, plain, reading, readings


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def by_day(rows, days=1):
    """Rows in runs; those without a time come with the first."""
    runs = {}
    for r in rows:
        runs.setdefault(0 if r[1] is None else (r[1] - BEGIN).days // days, []).append(r)
    return sorted(runs.items())


@pytest.mark.parametrize("semantics", ["batch", SERVING])
def test_runs_equal_one_full_run(spark, tmp_path, semantics):
    """With sessions over the cuts, ties and copies, NULL subjects, values and times, and runs done again."""
    settings, folder = Settings(semantics=semantics), str(tmp_path)
    rows = readings(n=250, days=12)
    rows += [reading(9, 47.9), reading(9, 48.0), reading(9, 48.0, 90), reading(9, 48.0, 90)]  # one session over a cut
    rows += [reading(10, 35.0), reading(10, 48.0), reading(11, 30.0), reading(11, 75.5)]  # 13 hours, and days without
    for run, part in by_day(rows, 2):
        for _ in range(2 if run in (0, 2) else 1):
            append_readings(table(spark, part), folder, run, settings)
    got = sessionized_so_far(spark, folder)
    want = sessionize(table(spark, rows), settings)
    assert got.columns == want.columns
    assert plain(got) == plain(want)


def test_readings_that_are_not_later_are_refused(spark, tmp_path):
    folder = str(tmp_path)
    append_readings(table(spark, [reading(1, 5), reading(2, 9)]), folder, 0)
    for bad in (reading(1, 5), reading(1, 4), reading(1, None)):
        with pytest.raises(ValueError, match="1 readings"):
            append_readings(table(spark, [reading(2, 20), bad]), folder, 1)
    append_readings(table(spark, [reading(1, 5.5), reading(3, 1)]), folder, 1)
    assert sorted(r.session_id for r in sessionized_so_far(spark, folder).collect()) == ["1_1", "1_1", "2_1", "3_1"]


def test_runs_without_readings(spark, tmp_path):
    folder = str(tmp_path)
    for run, rows in enumerate([[], [reading(1, 0)], [], [reading(1, 50)]]):
        append_readings(table(spark, rows), folder, run)
    assert sorted(r.session_id for r in sessionized_so_far(spark, folder).collect()) == ["1_1", "1_2"]


def many_sessions(spark):
    made = random.Random(3)
    rows = [reading(p, s * 40 + made.random() * 3, made.randint(70, 160)) for p in range(40) for s in range(25) for _ in range(8)]
    return attach_sessions(table(spark, rows)).drop("opening", "session_ordinal")


def rows_scanned(df) -> int:
    """Rows that the scan of an executed plan gave to the filter above it."""
    plan = df._jdf.queryExecution().executedPlan()
    scan = plan.collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value()


def test_one_session_reads_few_row_groups(spark, tmp_path):
    sessions, path, unsorted = many_sessions(spark), str(tmp_path / "clustered"), str(tmp_path / "plain")
    write_clustered_sessions(sessions, path, row_group_bytes=4096)
    sessions.orderBy(F.rand(1)).write.option("parquet.block.size", 4096).parquet(unsorted)
    wanted = F.col("session_id") == "17_3"
    found, other = (spark.read.parquet(p).filter(wanted) for p in (path, unsorted))
    assert plain(found) == plain(other) == plain(sessions.filter(wanted))
    found, other = (spark.read.parquet(p).filter(wanted) for p in (path, unsorted))
    found._jdf.queryExecution().executedPlan()
    counts = []
    for df in (found, other):
        df._jdf.collectToPython()
        counts.append(rows_scanned(df))
    assert counts[0] * 5 < counts[1]
    # A session that does not exist, between others, is in no row group by the Bloom filter.
    none = spark.read.parquet(path).filter(F.col("session_id") == "17_30")
    none._jdf.collectToPython()
    assert rows_scanned(none) == 0


def test_a_long_session_is_in_several_files(spark, tmp_path):
    sessions = attach_sessions(table(spark, [reading(1, i / 1000) for i in range(5000)] + [reading(2, 1)])).drop("opening")
    write_clustered_sessions(sessions, str(tmp_path / "hot"))
    held = spark.read.parquet(str(tmp_path / "hot")).filter("pid = 1").groupBy(F.input_file_name()).count().collect()
    assert len(held) > 1


def exchanges(df) -> int:
    df.collect()
    return str(df._jdf.queryExecution().executedPlan()).count("Exchange hashpartitioning")


@pytest.fixture
def bucketed(spark, tmp_path):
    name = f"bucketed_{uuid.uuid4().hex}"
    sessions = many_sessions(spark)
    yield sessions, create_bucketed_sessions(sessions, name, 8, str(tmp_path / "buckets"))
    spark.sql(f"DROP TABLE {name}")


def test_buckets_need_no_shuffle_of_readings(spark, bucketed):
    sessions, stored = bucketed
    bins = session_bins(stored, Settings())
    windows = add_temporal_features(bins, Settings())
    assert exchanges(bins) == 0
    assert exchanges(windows) == 0
    assert plain(windows) == plain(add_temporal_features(session_bins(sessions, Settings()), Settings()))


def test_features_from_buckets_shuffle_no_readings(spark, bucketed):
    sessions, stored = bucketed
    visits = spark.range(40).selectExpr(
        "id AS pid", "timestamp'2024-03-01' AS keyindate", "timestamp'2024-03-01' AS dialysisstart", "timestamp'2024-03-01' AS dialysisend",
        "70.0D AS weightstart", "68.0D AS weightend", "67.0D AS dryweight", "36.5D AS temperature",
    )
    people = spark.range(40).selectExpr("id AS pid", "'F' AS gender", "1950 AS birthday", "timestamp'2015-01-01' AS first_dialysis", "true AS DM")
    found = features_from_sessions(stored, visits, people)
    assert plain(found) == plain(features_from_sessions(sessions, visits, people))
    # The readings' scan is under an aggregation and a window before anything is exchanged.
    lines = str(found._jdf.queryExecution().executedPlan()).split("\n")
    scan = next(i for i, line in enumerate(lines) if "blood_flow" in line and "Scan" in line)
    above = [line for line in lines[:scan] if "Exchange" in line or "HashAggregate" in line]
    assert "HashAggregate" in above[-1] and "HashAggregate" in above[-2]


