"""Streams against the batch operators on the same readings."""

import random
import uuid
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from haemoloom.operators.bins import slot_bins
from haemoloom.operators.moments import bin_states, merged_states, rolled_up, state_statistics
from haemoloom.operators.sessions import sessionize
from haemoloom.settings import SERVING, Settings
from haemoloom.streaming import late, windows

SCHEMA = (
    "pid long, datatime timestamp, sbp long, dbp long, dia_temp_value double, conductivity double, uf double, blood_flow double"
)
BEGIN = datetime(2024, 3, 1, tzinfo=timezone.utc)
STATISTICS = ["pid", "time_bin", "readings", "avg_sbp", "min_sbp", "stddev_sbp", "avg_uf_rate"]


def reading(pid, hours, sbp=100):
    ts = None if hours is None else BEGIN + timedelta(hours=hours)
    return (pid, ts, sbp, 60, 36.5, 14.0, 0.5, 250.0)


def readings(seed=1, n=600, days=20):
    made = random.Random(seed)
    rows = [reading(made.choice([1, 1, 1, 2, 3, None]), made.randint(0, days * 24 * 4) / 4 + made.choice([0, 0.01, 0.2]), made.randint(60, 180)) for _ in range(n)]
    return [*rows, *rows[:30], reading(2, None), reading(None, None), (4, BEGIN, None, None, None, None, None, None)]


def folder(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def add(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def plain(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def by_time(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1]))


def closed_before(spark, rows, delay=timedelta(hours=1)):
    return max(r[1] for r in rows if r[1]) - delay


def expected_bins(spark, rows, before=None):
    bins = slot_bins(spark.createDataFrame(rows, SCHEMA), Settings()).filter("time_bin IS NOT NULL")
    if before:
        bins = bins.filter(F.col("time_bin") + F.expr("INTERVAL 15 MINUTES") <= F.lit(before))
    return plain(bins.select(STATISTICS))


def expected_sessions(spark, rows, before, settings):
    found = sessionize(spark.createDataFrame(rows, SCHEMA).filter("pid IS NOT NULL AND datatime IS NOT NULL"), settings)
    grouped = found.groupBy("pid", "session_id").agg(F.min("datatime").alias("start"), F.max("datatime").alias("last"), F.count("*").alias("n"))
    end = F.unix_micros("last") + settings.longest_pause_us
    return plain(grouped.filter(end <= F.unix_micros(F.lit(before))).select("pid", "session_id", "start", "last", "n"))


def run(spark, path, closed, out, check, files=None):
    rows = closed(windows.reading_stream(spark, path, spark.createDataFrame([], SCHEMA).schema, files))
    progress = windows.append_available(rows, out, check)
    return progress, spark.read.schema(rows.schema).parquet(out)


@pytest.mark.parametrize("semantics", ["batch", SERVING])
def test_closed_sessions_equal_batch_sessions(spark, tmp_path, semantics):
    path, out, check = (folder(tmp_path) for _ in range(3))
    settings, rows = Settings(semantics=semantics), readings()
    # Pauses of just the longest length, and a microsecond more.
    pause = timedelta(microseconds=settings.longest_pause_us)
    ends = [reading(7, 0)[:1] + (BEGIN + t,) + reading(7, 0)[2:] for t in (timedelta(0), pause, 2 * pause + timedelta(microseconds=1))]
    add(spark, rows + ends, path)
    progress, closed = run(spark, path, lambda s: windows.closed_sessions(s, settings), out, check)
    got = windows.numbered_sessions(closed.filter("pid IS NOT NULL"))
    want = expected_sessions(spark, rows + ends, closed_before(spark, rows), settings)
    assert plain(got.select("pid", "session_id", "session_start_ts", "last_ts", "readings")) == want
    assert progress.readings == len(rows) + 3 and progress.late == 0
    assert len([w for w in want if w[0] == 7]) == 2
    # What is not closed is still counted by batch sessions.
    assert len(want) < len(expected_sessions(spark, rows + ends, BEGIN + timedelta(days=90), settings))


@pytest.mark.parametrize("files", [None, 1])
def test_restarts_give_no_row_twice(spark, tmp_path, files):
    path, out, check, sessions_out, sessions_check = (folder(tmp_path) for _ in range(5))
    rows = by_time(readings())
    cuts = [rows[:200], rows[200:420], rows[420:]]
    settings = Settings(semantics=SERVING)
    for i, part in enumerate(cuts):
        add(spark, part, path)
        seen = [r for p in cuts[: i + 1] for r in p]
        _, bins = run(spark, path, windows.closed_bins, out, check, files)
        _, closed = run(spark, path, windows.closed_sessions, sessions_out, sessions_check, files)
        before = closed_before(spark, seen)
        assert plain(bins.select(STATISTICS)) == expected_bins(spark, seen, before)
        got = windows.numbered_sessions(closed.filter("pid IS NOT NULL"))
        assert plain(got.select("pid", "session_id", "session_start_ts", "last_ts", "readings")) == expected_sessions(spark, seen, before, settings)
    progress, again = run(spark, path, windows.closed_bins, out, check, files)
    assert progress.readings == 0 and again.count() == bins.count()


def test_late_readings_are_kept_within_the_delay_and_counted_beyond(spark, tmp_path):
    path, out, check = (folder(tmp_path) for _ in range(3))
    first = [reading(1, h / 10) for h in range(100)]
    add(spark, first, path)
    run(spark, path, lambda s: windows.closed_bins(s, delay="2 hours"), out, check)
    in_time, too_late = [reading(1, 9.05, 50)], [reading(1, 3.05, 50)]
    add(spark, in_time + too_late, path)
    add(spark, [reading(1, 30.0)], path)
    progress, bins = run(spark, path, lambda s: windows.closed_bins(s, delay="2 hours"), out, check)
    want = expected_bins(spark, first + in_time + [reading(1, 30.0)], BEGIN + timedelta(hours=28))
    assert plain(bins.select(STATISTICS)) == want
    assert progress.late == 1


def test_empty_stream(spark, tmp_path):
    path, out, check = (folder(tmp_path) for _ in range(3))
    add(spark, [], path)
    assert run(spark, path, windows.closed_bins, out, check)[1].collect() == []


def test_late_files_change_only_their_bins(spark, tmp_path):
    path, states, check = (folder(tmp_path) for _ in range(3))
    schema = spark.createDataFrame([], SCHEMA).schema
    rows = readings()
    add(spark, rows, path)
    progress = late.refresh_bins(windows.reading_stream(spark, path, schema), states, check)
    assert (progress.readings, progress.late) == (len(rows), 0)
    before = late.read_bins(spark, states)
    assert plain(before.select(STATISTICS)) == expected_bins(spark, rows)
    held = {tuple(r) for r in before.select(STATISTICS).collect()}
    belated = [reading(1, 30.01, 40), reading(1, 30.02, 41), reading(3, 100.0, 42)]
    add(spark, belated, path)
    late.refresh_bins(windows.reading_stream(spark, path, schema), states, check)
    after = late.read_bins(spark, states)
    assert plain(after.select(STATISTICS)) == expected_bins(spark, rows + belated)
    assert len({tuple(r) for r in after.select(STATISTICS).collect()} - held) == 2


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    states, compact = folder(tmp_path), folder(tmp_path)
    rows = readings()
    parts = [spark.createDataFrame(p, SCHEMA) for p in (rows[:300], rows[300:])]
    for batch in (0, 1, 1, 0):
        late.write_batch(parts[batch], batch, states)
        if batch:
            assert plain(late.read_bins(spark, states).select(STATISTICS)) == expected_bins(spark, rows)
    assert plain(late.read_bins(spark, states).select(STATISTICS)) == expected_bins(spark, rows)
    for _ in range(2):
        late.compact_day(spark, states, compact, "2024-03-05")
    day = F.to_date("time_bin") == F.lit("2024-03-05").cast("date")
    assert plain(late.read_bins(spark, compact).select(STATISTICS)) == plain(late.read_bins(spark, states).filter(day).select(STATISTICS))


def test_wider_bins_roll_up_from_narrow_ones(spark):
    rows = spark.createDataFrame(readings(), SCHEMA)
    for minutes in (15, 60, 360, 1440):
        got = state_statistics(rolled_up(bin_states(rows, 15), minutes))
        want = slot_bins(rows, Settings(interval=minutes)).filter("time_bin IS NOT NULL")
        assert plain(got.select(STATISTICS)) == plain(want.select(STATISTICS))


def test_merged_states_keep_tiny_spreads(spark):
    """Spreads a billion times smaller than the values, in states merged in two orders."""
    made = random.Random(2)
    rows = [(1, BEGIN, i % 7, i % 3, 1e9 + made.random()) for i in range(500)]
    df = spark.createDataFrame(rows, "pid long, datatime timestamp, a int, b int, sbp double")
    df = df.withColumns({c: F.lit(1.0) for c in ("dbp", "dia_temp_value", "conductivity", "uf", "blood_flow")})
    df = df.withColumn("time_bin", F.col("datatime"))
    from haemoloom.operators.moments import moment_states

    states = moment_states(df, ["pid", "time_bin", "a", "b"])
    once = merged_states(states, ["pid", "time_bin"])
    twice = merged_states(merged_states(states, ["pid", "time_bin", "a"]), ["pid", "time_bin"])
    want = df.agg(F.stddev_samp(F.col("sbp") - 1e9)).first()[0]
    for merged in (once, twice):
        assert abs(state_statistics(merged).first().stddev_sbp - want) < 1e-6 * want
