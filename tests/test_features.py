import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from haemoloom.functions import clock
from haemoloom.functions import features as fn
from haemoloom.operators.bins import repeated_stddev
from haemoloom.operators.enrich import enrich, join_demographics, join_registration
from haemoloom.operators.sessions import sessionize
from haemoloom.plans.features import features_from_sessions, features_from_telemetry, serving_columns, serving_features
from haemoloom.schemas import FEATURE_COLUMNS, SERVING_COLUMNS, SESSION_CSV_COLUMNS
from haemoloom.settings import SERVING, Settings
from haemoloom.sources.session_csv import read_session_csv

SERVE = Settings(semantics=SERVING)
DAY = datetime(2024, 1, 1)
READING = (
    "pid bigint, datatime timestamp, sbp bigint, dbp bigint, dia_temp_value double, conductivity double, "
    "uf double, blood_flow double"
)
REGISTRATION = (
    "pid bigint, keyindate timestamp, weightstart double, weightend double, dryweight double, temperature double"
)
DEMOGRAPHICS = "pid bigint, gender string, birthday bigint, DM boolean, first_dialysis timestamp"

GOLDEN_READINGS = [
    (1, DAY, 120, 80, 36.0, 13.5, 0.3, 250.0),
    (1, DAY + timedelta(minutes=5), 110, 76, 36.0, 13.7, 0.5, 270.0),
    (1, DAY + timedelta(minutes=17), 84, 60, 36.2, 13.9, 0.2, 240.0),
    (1, DAY + timedelta(minutes=31), 128, 74, 36.4, 14.0, 0.8, 260.0),
]
GOLDEN_VISIT = [(1, DAY, 81.5, 80.0, 78.0, 36.2)]
GOLDEN_PROFILE = [(1, "M", 1961, False, datetime(2018, 1, 1))]

# Worked out by hand from the readings above.
GOLDEN_BINS = [
    dict(avg_sbp=115, min_sbp=110, stddev_sbp=7.071068, avg_dbp=78, avg_conductivity=13.6, avg_uf_rate=0.4,
         avg_blood_flow=260, lag_1_avg_sbp=None, trend_1_sbp=None, lag_1_avg_uf_rate=None,
         trend_1_conductivity=None, rolling_avg_sbp=115, rolling_max_sbp=115, rolling_stddev_sbp=None,
         minutes_into_session=0, label=1),
    dict(avg_sbp=84, min_sbp=84, stddev_sbp=None, avg_dbp=60, avg_conductivity=13.9, avg_uf_rate=0.2,
         avg_blood_flow=240, lag_1_avg_sbp=115, trend_1_sbp=-31, lag_1_avg_uf_rate=0.4,
         trend_1_conductivity=0.3, rolling_avg_sbp=99.5, rolling_max_sbp=115, rolling_stddev_sbp=21.920310,
         minutes_into_session=15, label=0),
    dict(avg_sbp=128, min_sbp=128, stddev_sbp=None, avg_dbp=74, avg_conductivity=14, avg_uf_rate=0.8,
         avg_blood_flow=260, lag_1_avg_sbp=84, trend_1_sbp=44, lag_1_avg_uf_rate=0.2, trend_1_conductivity=0.1,
         rolling_avg_sbp=109, rolling_max_sbp=128, rolling_stddev_sbp=22.605309, minutes_into_session=30, label=0),
]


def golden_inputs(spark):
    return (
        spark.createDataFrame(GOLDEN_READINGS, READING),
        spark.createDataFrame(GOLDEN_VISIT, REGISTRATION),
        spark.createDataFrame(GOLDEN_PROFILE, DEMOGRAPHICS),
    )


def check_golden(rows):
    assert len(rows) == 3
    for row, expected in zip(rows, GOLDEN_BINS):
        for name, value in {**expected, "age_at_session": 63, "fluid_to_remove": 3.5}.items():
            assert row[name] == (None if value is None else pytest.approx(value, abs=1e-6)), name


def test_golden_training_features(spark):
    df = features_from_telemetry(*golden_inputs(spark))
    assert df.columns == FEATURE_COLUMNS
    rows = df.orderBy("time_bin").collect()
    check_golden(rows)
    assert [r.dialysis_vintage_years for r in rows] == [6, 6, 6]
    assert [r.time_bin for r in rows] == [DAY + timedelta(minutes=15 * i) for i in range(3)]


def test_golden_serving_features(spark):
    readings, visits, profiles = golden_inputs(spark)
    df = serving_features(enrich(sessionize(readings), visits, profiles))
    assert df.columns == SERVING_COLUMNS
    rows = df.orderBy("minutes_into_session").collect()
    check_golden(rows)
    assert all(r.dialysis_vintage_years == pytest.approx(2191 / 365.25) for r in rows)


def test_weights_of_a_day_come_from_one_visit(spark):
    readings, _, profiles = golden_inputs(spark)
    visits = spark.createDataFrame([(1, DAY, 60.0, 60.0, 59.0, 36.0), (1, DAY, 61.0, 60.0, 58.0, 36.0)], REGISTRATION)
    training = features_from_telemetry(readings, visits, profiles).collect()
    scoring = serving_features(enrich(sessionize(readings), visits, profiles)).collect()
    binned = features_from_telemetry(readings, visits, profiles, columns=serving_columns).collect()
    assert {r.fluid_to_remove for r in [*training, *scoring, *binned]} == {1.0}


def test_scoring_features_by_bins_equal_those_by_rows(spark):
    inputs = random_inputs(spark, 4)
    by_rows = serving_features(enrich(sessionize(inputs[0], SERVE), *inputs[1:]), SERVE)
    by_bins = features_from_telemetry(*inputs, SERVE, columns=serving_columns)
    assert by_bins.columns == by_rows.columns == SERVING_COLUMNS
    shown = lambda df: sorted(
        (tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.filter("pid IS NOT NULL").collect()), key=repr
    )
    assert shown(by_bins) == shown(by_rows)


def random_inputs(spark, seed=1):
    """Subjects with gaps, untimed rows, several visits a day and several profiles."""
    rng = random.Random(seed)
    readings = []
    for pid in range(12):
        time = DAY + timedelta(minutes=rng.randrange(600))
        for _ in range(rng.choice([1, 40, 200])):
            time += timedelta(minutes=rng.choice([1, 4, 9, 40, 200, 800, 1500]), microseconds=rng.randrange(10**6))
            readings.append(
                (pid, None if rng.random() < 0.02 else time, rng.choice([None, *range(70, 150)]), rng.randrange(40, 90),
                 35 + rng.random(), 13 + rng.random(), rng.random(), 150 + 100 * rng.random())
            )
    visits = []
    for pid in range(11):
        for day in range(60):
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                start = 50 + rng.randrange(40)
                visits.append((pid, DAY + timedelta(days=day, hours=rng.randrange(24)), float(start), None,
                               rng.choice([None, start - 2.0, start - 1.0]), 36.0))
    profiles = [(pid, "FM"[pid % 2], 1950 + pid, pid % 3 == 0, datetime(2010 + pid, 5, 1)) for pid in range(10)]
    profiles += [(3, None, 1944, None, datetime(2009, 1, 1))]  # a second profile
    return (
        spark.createDataFrame(readings, READING),
        spark.createDataFrame(visits, REGISTRATION),
        spark.createDataFrame(profiles, DEMOGRAPHICS),
    )


def by_key(df):
    names = [c for c in df.columns if c not in ("Pid", "session_id", "time_bin")]
    return {(r.Pid, r.session_id, r.time_bin): [r[c] for c in names] for r in df.collect()}


def same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and a == pytest.approx(b, abs=1e-9))


@pytest.mark.parametrize(
    "settings",
    [
        Settings(),
        Settings(semantics=SERVING),
        Settings(interval=120, session_window=3),
        Settings(interval=600, session_window=2),
        Settings(interval=1, rolling_window=0, prediction_intervals=1),
    ],
)
def test_both_feature_plans_agree(spark, settings):
    inputs = random_inputs(spark)
    direct = by_key(features_from_telemetry(*inputs, settings))
    stored = by_key(features_from_sessions(sessionize(inputs[0], settings), *inputs[1:], settings))
    assert direct.keys() == stored.keys() and direct
    for key in direct:
        assert all(map(same, direct[key], stored[key])), (key, direct[key], stored[key])


def test_repetition_kept_as_a_number_equals_repeated_rows(spark):
    """Statistics of bins joined with counted visits equal those over rows joined with all visits."""
    readings, visits, profiles = random_inputs(spark, 4)
    ours = {
        (r.session_id, r.time_bin): r
        for r in features_from_telemetry(readings, visits, profiles, Settings(interval=60)).collect()
    }
    rows = join_demographics(join_registration(sessionize(readings), visits.drop("temperature")), profiles)
    theirs = (
        rows.filter("datatime IS NOT NULL")
        .groupBy("session_id", clock.time_bin(F.col("datatime"), 60).alias("time_bin"))
        .agg(
            F.avg("sbp").alias("avg_sbp"),
            F.stddev_samp("sbp").alias("stddev_sbp"),
            F.min("sbp").alias("min_sbp"),
            F.avg("uf").alias("avg_uf_rate"),
            F.min("gender").alias("gender"),
            F.count(F.lit(1)).alias("n"),
        )
        .collect()
    )
    assert len(theirs) == len(ours)
    for row in theirs:
        mine = ours[row.session_id, row.time_bin]
        for name in ("avg_sbp", "stddev_sbp", "min_sbp", "avg_uf_rate", "gender"):
            assert same(mine[name], row[name]), (name, mine, row)


def test_one_visit_per_day(spark):
    readings, visits, profiles = random_inputs(spark, 4)
    all_visits = by_key(features_from_telemetry(readings, visits, profiles))
    one_visit = by_key(features_from_telemetry(readings, visits, profiles, one_per_day=True))
    assert all_visits.keys() == one_visit.keys()
    table = sessionize(readings)
    repeated = join_registration(table, visits)
    single = join_registration(table, visits, one_per_day=True)
    assert single.count() < repeated.count()
    days = [df.select("pid", "session_date").distinct().count() for df in (single, repeated)]
    assert days[0] == days[1]


def test_label_looks_only_ahead(spark):
    settings = Settings(prediction_intervals=3)
    rows = features_from_telemetry(*random_inputs(spark, 9), settings).collect()
    by_session = {}
    for r in sorted(rows, key=lambda r: r.time_bin):
        by_session.setdefault(r.session_id, []).append(r)
    for bins in by_session.values():
        low = [r.min_sbp is not None and r.min_sbp < settings.threshold for r in bins]
        assert [r.label for r in bins] == [int(any(low[i + 1 : i + 4])) for i in range(len(bins))]
    assert {r.label for r in rows} == {0, 1}


def test_missing_session_start_is_the_earliest_reading(spark):
    readings, visits, profiles = golden_inputs(spark)
    table = sessionize(readings).withColumn("session_start_ts", F.lit(None).cast("timestamp"))
    check_golden(features_from_sessions(table, visits, profiles).orderBy("time_bin").collect())


def test_first_bin_minutes_run_toward_zero(spark):
    df = spark.createDataFrame([(DAY + timedelta(minutes=14, seconds=30), DAY)], "a timestamp, b timestamp")
    row = df.select(
        clock.elapsed_minutes(F.col("a"), F.col("b")).alias("whole"),
        clock.elapsed_minutes(F.col("a"), F.col("b"), fractional=True).alias("exact"),
        clock.elapsed_hours(F.col("b"), F.col("b") + F.expr("INTERVAL '12:59:59' HOUR TO SECOND")).alias("hours"),
    ).first()
    assert (row.whole, row.exact, row.hours) == (-14, -14.5, 12)


def test_session_over_midnight_joins_on_its_start_day(spark):
    late = DAY + timedelta(hours=23, minutes=50)
    times = [late, late + timedelta(minutes=30)]
    readings = spark.createDataFrame([(1, t, 100, 70, 36.5, 1.0, 0.5, 300.0) for t in times], READING)
    _, visits, profiles = golden_inputs(spark)
    assert features_from_telemetry(readings, visits, profiles).count() == 2


def test_frames_count_bins_and_not_minutes(spark, tmp_path):
    """A session in a CSV file, with bins absent in between."""
    header = ",".join(SESSION_CSV_COLUMNS)
    clock_sbp = [("09:07:30", 120), ("09:14:59", 110), ("10:00:00", 95), ("11:31:00", 85), ("12:05:00", 100), ("13:44:00", 90)]
    rows = [
        f"7,2015-02-03 {clock}+00:00,7_1,2/03/2011,{sbp},52,37,14,0.75,200,70,68.2,68,36.3,F,1934,TRUE"
        for clock, sbp in clock_sbp
    ]
    (tmp_path / "s.csv").write_text("\n".join([header, *rows]) + "\n")
    got = serving_features(read_session_csv(spark, str(tmp_path / "s.csv"))).orderBy("minutes_into_session").collect()
    assert [r.avg_sbp for r in got] == [115, 95, 85, 100, 90]
    assert [r.minutes_into_session for r in got] == [-7.5, 52.5, 142.5, 172.5, 262.5]
    assert [r.lag_1_avg_sbp for r in got] == [None, 115, 95, 85, 100]
    assert [r.rolling_avg_sbp for r in got] == [115, 105, pytest.approx(295 / 3), 98.75, 92.5]
    assert [r.rolling_max_sbp for r in got] == [115, 115, 115, 115, 100]
    assert [r.label for r in got] == [1, 1, 0, 0, 0]
    assert {(r.fluid_to_remove, r.age_at_session, r.gender, r.DM) for r in got} == {(2, 81, "F", True)}
    assert got[0].dialysis_vintage_years == pytest.approx(1434 / 365.25)


def test_split_is_stable_and_about_four_fifths(spark):
    df = spark.range(20_000).select(fn.session_id(F.col("id"), F.lit(1)).alias("session_id"))
    split = df.select("session_id", fn.dataset_split(F.col("session_id")).alias("s"))
    share = split.filter("s = 'TRAIN'").count() / 20_000
    assert 0.78 < share < 0.82
    fixed = spark.createDataFrame([("1025914_118",)], "session_id string")
    assert fixed.select(fn.split_bucket(F.col("session_id"))).first()[0] == 6


def test_repeated_stddev_of_single_readings(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, 1, 2), (None, 0, 2), (2.0, 2, 1)], "s double, n bigint, k bigint")
    got = [r[0] for r in df.select(repeated_stddev(F.col("s"), F.col("n"), F.col("k"))).collect()]
    assert got == [None, 0.0, None, 2.0]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("all_keys, shuffles", [(True, 5), (False, 4)])
def test_readings_are_reduced_before_any_shuffle(spark, all_keys, shuffles):
    """Without broadcasts: bins are shuffled to be reduced, to be ordered and (if all join keys
    must match) to meet their visits; each joined table is shuffled once or twice."""
    changed = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.requireAllClusterKeysForCoPartition": str(all_keys).lower(),
    }
    before = {name: spark.conf.get(name) for name in changed}
    try:
        for name, value in changed.items():
            spark.conf.set(name, value)
        plan = plan_of(features_from_telemetry(*golden_inputs(spark)))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    lines = plan.splitlines()
    bins_side = lines[: next(i for i, line in enumerate(lines) if "partial_avg(sbp" in line)]
    assert sum("Exchange hashpartitioning(pid" in line for line in bins_side) == shuffles - 2
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Python" not in plan
