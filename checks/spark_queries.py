"""Registered queries: one per operator, each over the whole given tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.inputs import demographics, plain, registration, scored_documents, table, telemetry
from haemoloom.functions import clock, parsing
from haemoloom.functions import features as fn
from haemoloom.operators import bins, cleaning, enrich, metrics, moments, risk, sessions, temporal
from haemoloom.plans import boosting, classifier, features, incremental, tables
from haemoloom.plans.risk import risk_from_csv
from haemoloom.runtime import scratch_path
from haemoloom.schemas import (
    DEMOGRAPHICS,
    MODEL_FEATURES,
    REGISTRATION,
    SERVING_COLUMNS,
    SESSION_CSV_COLUMNS,
    SESSION_READING_COLUMNS,
    TELEMETRY,
)
from haemoloom.settings import SERVING, Settings
from haemoloom.sources import csv, jsonl, payload, session_csv
from haemoloom.sources import tables as stored
from haemoloom.streaming import late, windows

Query = Callable[[SparkSession, str], DataFrame]

_DEFAULT = Settings()
_SERVING = Settings(semantics=SERVING)
_SESSION = "8_1"
_TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


# --- shared steps -----------------------------------------------------------


def _sessionized(spark, sf_dir, settings=_DEFAULT):
    return sessions.sessionize(telemetry(spark, sf_dir), settings)


def _placed(spark, sf_dir, settings=_DEFAULT):
    """Readings with their sessions, for steps that need no opening flag."""
    return sessions.attach_sessions(telemetry(spark, sf_dir), settings)


def _features(spark, sf_dir, settings=_DEFAULT):
    return features.features_from_telemetry(
        telemetry(spark, sf_dir), registration(spark, sf_dir), demographics(spark, sf_dir), settings
    )


def _serving(spark, sf_dir, sessions_by=_DEFAULT):
    """Scoring features, with the sessions that ``sessions_by`` finds."""
    placed = _placed(spark, sf_dir, sessions_by)
    return features.features_from_sessions(
        placed, registration(spark, sf_dir), demographics(spark, sf_dir), _SERVING, columns=features.serving_columns
    )


def _bins(spark, sf_dir, settings=_DEFAULT):
    return bins.session_bins(_placed(spark, sf_dir), settings)


def _enriched(spark, sf_dir, settings=_DEFAULT):
    return enrich.enrich(
        _placed(spark, sf_dir, settings), registration(spark, sf_dir), demographics(spark, sf_dir)
    )


def _stored(spark, df, name):
    """``df`` written to the shared folder and read back."""
    path = scratch_path(spark, name)
    stored.write_parquet(df, path)
    return spark.read.parquet(path)


def _csv_of(spark, df, name):
    """``df`` as CSV files, with its times as text."""
    path = scratch_path(spark, name)
    text = [
        F.date_format(c, _TIME_TEXT).alias(c) if kind.startswith("timestamp") else F.col(c) for c, kind in df.dtypes
    ]
    df.select(*text).write.option("header", True).csv(path)
    return path


def _table_name(name):
    return f"haemoloom_{name}"


# --- end to end -------------------------------------------------------------


def sessionize(spark, sf_dir):
    return plain(_sessionized(spark, sf_dir))


def sessionize_serving(spark, sf_dir):
    return plain(_sessionized(spark, sf_dir, _SERVING))


def features_full(spark, sf_dir):
    return plain(_features(spark, sf_dir))


def features_coarse(spark, sf_dir):
    return plain(_features(spark, sf_dir, Settings(session_window=24, interval=360)))


def features_wide_bins(spark, sf_dir):
    """Bins wider than the session gap."""
    return plain(_features(spark, sf_dir, Settings(session_window=3, interval=720)))


def features_serving(spark, sf_dir):
    inputs = telemetry(spark, sf_dir), registration(spark, sf_dir), demographics(spark, sf_dir)
    return plain(features.features_from_telemetry(*inputs, _SERVING, columns=features.serving_columns))


# --- sources and sinks ------------------------------------------------------


def _telemetry_csv(spark, sf_dir):
    return _csv_of(spark, telemetry(spark, sf_dir), "telemetry_csv")


def src_csv_typed(spark, sf_dir):
    return plain(csv.read_csv_typed(spark, _telemetry_csv(spark, sf_dir), TELEMETRY, integers_required=False))


def src_csv_limit(spark, sf_dir):
    path = _telemetry_csv(spark, sf_dir)
    return plain(csv.read_csv_typed(spark, path, TELEMETRY, 100, "measuretime", integers_required=False))


def src_csv_glob(spark, sf_dir):
    """The folder also holds files that are not CSV."""
    path = _telemetry_csv(spark, sf_dir)
    table(spark, sf_dir, "nation").write.mode("append").json(path)
    return plain(csv.read_csv_folder(spark, path, TELEMETRY, integers_required=False))


def clean_demographics(spark, sf_dir):
    raw = demographics(spark, sf_dir).withColumn(
        "first_dialysis",
        F.date_format(clock.epoch_ns_to_timestamp(F.col("first_dialysis")), "d/MM/yyyy"),
    )
    typed = csv.read_csv_typed(spark, _csv_of(spark, raw, "demographics_csv"), DEMOGRAPHICS)
    return plain(cleaning.clean_demographics(typed))


def clean_registration(spark, sf_dir):
    typed = csv.read_csv_typed(spark, _csv_of(spark, registration(spark, sf_dir), "registration_csv"), REGISTRATION)
    return plain(cleaning.clean_registration(typed))


def clean_telemetry(spark, sf_dir):
    as_text = telemetry(spark, sf_dir).withColumn("datatime", F.date_format("datatime", _TIME_TEXT))
    return plain(cleaning.clean_telemetry(as_text))


def sink_parquet(spark, sf_dir):
    return plain(_stored(spark, telemetry(spark, sf_dir), "telemetry"))


def load_table(spark, sf_dir):
    source = scratch_path(spark, "load_source")
    stored.write_parquet(telemetry(spark, sf_dir), source)
    loaded = stored.load_table(spark, source, _table_name("loaded"), scratch_path(spark, "loaded"))
    return stored.row_count(loaded)


def src_table(spark, sf_dir):
    name = _table_name("telemetry")
    stored.replace_table(telemetry(spark, sf_dir), name, scratch_path(spark, "telemetry"))
    return plain(stored.read_table(spark, name))


def src_session_csv(spark, sf_dir):
    path = scratch_path(spark, "session_csv")
    session_csv.write_session_csv(_enriched(spark, sf_dir), path)
    return plain(session_csv.read_session_csv(spark, path))


def sink_session_csv(spark, sf_dir):
    path = scratch_path(spark, "session_csv")
    session_csv.write_session_csv(_enriched(spark, sf_dir), path)
    return plain(session_csv.read_session_csv(spark, path).select(*SESSION_CSV_COLUMNS))


def _telemetry_jsonl(spark, sf_dir):
    """Telemetry as JSON Lines, with the nation names as lines that are no JSON.

    Times are ISO text, nanoseconds as a number or nanoseconds as text, and every
    other pressure has a decimal point.
    """
    path = scratch_path(spark, "telemetry_jsonl")
    ns = (F.unix_micros("datatime") * 1000).cast("string")
    by = F.col("measuretime") % 3
    time = F.when(by == 0, F.concat(F.lit('"'), F.date_format("datatime", _TIME_TEXT), F.lit('"')))
    time = F.coalesce(time.when(by == 1, ns).otherwise(F.concat(F.lit('"'), ns, F.lit('"'))), F.lit("null"))
    point = F.when(F.col("measuretime") % 2 == 0, ".0").otherwise("")
    rest = F.to_json(F.struct(*[c for c in telemetry(spark, sf_dir).columns if c not in ("datatime", "sbp")]))
    head = F.concat(F.lit('{"datatime":'), time, F.lit(',"sbp":'), F.col("sbp").cast("string"), point, F.lit(","))
    telemetry(spark, sf_dir).select(F.concat(head, F.substring(rest, 2, 1 << 20)).alias("line")).write.text(path)
    table(spark, sf_dir, "nation").select("n_name").write.mode("append").text(path)
    return path


def src_jsonl(spark, sf_dir):
    return plain(jsonl.read_jsonl(spark, _telemetry_jsonl(spark, sf_dir), TELEMETRY).rows)


def src_machine_jsonl(spark, sf_dir):
    rows = jsonl.read_machine_jsonl(spark, _telemetry_jsonl(spark, sf_dir)).rows
    return plain(rows.select("pid", "datatime", "sbp", "session_start_ts", "session_date"))


def _payload_features(spark, sf_dir):
    return _serving(spark, sf_dir)


def sink_payload_json(spark, sf_dir):
    """Written documents, read as JSON, with their session and the lowest pressures in time order."""
    path = scratch_path(spark, "payload")
    payload.write_payload(payload.payload_documents(_payload_features(spark, sf_dir)), path)
    written = spark.read.schema(
        "instances array<struct<min_sbp: double>>, parameters struct<session_id: string, part: string>"
    ).json(path)
    shown = F.transform("instances.min_sbp", lambda v: F.coalesce(v.cast("bigint").cast("string"), F.lit("none")))
    return written.select(
        "parameters.session_id",
        F.col("parameters.part").cast("bigint").alias("part"),
        F.size("instances").cast("bigint").alias("instances"),
        F.array_join(shown, ",").alias("pressures"),
    )


def src_payload_json(spark, sf_dir):
    path = scratch_path(spark, "payload")
    payload.write_payload(payload.payload_documents(_payload_features(spark, sf_dir)), path)
    return plain(payload.payload_instances(payload.read_payload(spark, path)).drop("part", "place"))


def sink_sessionized(spark, sf_dir):
    name = _table_name("sessionized")
    return plain(
        tables.create_sessionized_table(telemetry(spark, sf_dir), name, path=scratch_path(spark, "sessionized"))
    )


def sink_features(spark, sf_dir):
    """Sessionized table first, then the features table from it."""
    sessionized = tables.create_sessionized_table(
        telemetry(spark, sf_dir), _table_name("sessions_of_features"), path=scratch_path(spark, "sessionized")
    )
    written = tables.create_features_table(
        sessionized,
        registration(spark, sf_dir),
        demographics(spark, sf_dir),
        _table_name("features"),
        path=scratch_path(spark, "features"),
    )
    return plain(written)


def sink_eval_csv(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    tables.write_metrics_csv(metrics.evaluate(scored_documents(spark, sf_dir)), path)
    read = csv.read_csv_typed(spark, path, {name: "double" for name in _METRICS})
    return metrics.rounded(read)


# --- projections, filters, predicates ---------------------------------------


def prj_normalize_telemetry(spark, sf_dir):
    """Sessionized readings with text subjects, and without a start where the pressure is even."""
    start = F.when(F.col("sbp") % 2 == 1, F.col("session_start_ts"))
    rows = _sessionized(spark, sf_dir).withColumns({"pid": F.col("pid").cast("string"), "session_start_ts": start})
    return plain(
        sessions.normalize_sessionized(rows)
        .withColumnRenamed("pid", "Pid")
        .withColumnRenamed("datatime", "measurement_timestamp")
    )


def prj_passthrough(spark, sf_dir):
    rows = telemetry(spark, sf_dir)
    return plain(
        rows.withColumns({"pulse_pressure": F.col("sbp") - F.col("dbp"), "reading_date": F.to_date("datatime")})
    )


def prj_features_final(spark, sf_dir):
    inputs = _placed(spark, sf_dir), registration(spark, sf_dir), demographics(spark, sf_dir)
    return plain(features.features_from_sessions(*inputs))


def prj_rename(spark, sf_dir):
    names = ["avg_sbp", "min_sbp", "stddev_sbp", *list(bins.AVERAGES.values())[1:]]
    return plain(_bins(spark, sf_dir).select("pid", "session_id", "time_bin", *names))


def prj_model_inputs(spark, sf_dir):
    return plain(classifier.model_inputs(_features(spark, sf_dir)))


def _sessionized_table(spark, sf_dir):
    """A stored sessionized table, so that filters reach its scan."""
    return tables.create_sessionized_table(
        telemetry(spark, sf_dir), _table_name("sessions_to_choose"), path=scratch_path(spark, "sessionized")
    )


def flt_session(spark, sf_dir):
    return plain(sessions.session_readings(_sessionized_table(spark, sf_dir), _SESSION))


def flt_session_bulk(spark, sf_dir):
    rows = _sessionized_table(spark, sf_dir)
    wanted = rows.groupBy("session_id").agg(F.min("sbp").alias("lowest")).filter(F.col("lowest") < 65)
    return plain(sessions.readings_of_sessions(rows, wanted))


def flt_ts_not_null(spark, sf_dir):
    return plain(bins.timed(telemetry(spark, sf_dir)).select(*SESSION_READING_COLUMNS))


def flt_train(spark, sf_dir):
    rows = classifier.train_rows(_features(spark, sf_dir))
    return plain(rows.select("session_id", "time_bin", "avg_sbp", "label"))


def flt_threshold(spark, sf_dir):
    flag = fn.hypotension(F.col("min_sbp"), _DEFAULT.threshold)
    return plain(_bins(spark, sf_dir).select("pid", "session_id", "time_bin", "min_sbp", flag.alias("hypotensive")))


# --- joins ------------------------------------------------------------------

_JOINED = ["pid", "datatime", "session_id", "sbp", "weightstart", "dryweight", "session_date"]


def join_registration(spark, sf_dir):
    rows = enrich.join_registration(_placed(spark, sf_dir), registration(spark, sf_dir))
    return plain(rows.select(*_JOINED))


def join_registration_one_per_day(spark, sf_dir):
    rows = enrich.join_registration(_placed(spark, sf_dir), registration(spark, sf_dir), one_per_day=True)
    return plain(rows.select(*_JOINED))


def join_demographics(spark, sf_dir):
    rows = enrich.join_demographics(_placed(spark, sf_dir), demographics(spark, sf_dir))
    return plain(
        rows.select("pid", "datatime", "session_id", "sbp", "gender", "birthday", "DM", "first_dialysis_ts")
    )


def join_enrich(spark, sf_dir):
    rows = enrich.enrich(_sessionized(spark, sf_dir), registration(spark, sf_dir), demographics(spark, sf_dir))
    return plain(rows.select(*SESSION_CSV_COLUMNS, "is_new_session", "session_start_ts"))


# --- aggregations -----------------------------------------------------------

_BIN_KEY = ["pid", "session_id", "time_bin"]


def agg_time_bins(spark, sf_dir):
    return plain(_bins(spark, sf_dir).select(*_BIN_KEY, F.col("sbp_readings").alias("readings")))


def agg_avg(spark, sf_dir):
    return plain(_bins(spark, sf_dir).select(*_BIN_KEY, *bins.AVERAGES.values()))


def agg_min(spark, sf_dir):
    return plain(_bins(spark, sf_dir).select(*_BIN_KEY, "min_sbp"))


def agg_stddev(spark, sf_dir):
    return plain(_bins(spark, sf_dir, Settings(interval=360)).select(*_BIN_KEY, "stddev_sbp"))


def agg_any_value(spark, sf_dir):
    constants = ["session_start_ts", "weightstart", "dryweight", "gender", "birthday", "DM", "first_dialysis_ts"]
    return plain(bins.enriched_bins(_enriched(spark, sf_dir), _DEFAULT).select(*_BIN_KEY, *constants))


def agg_session_risk(spark, sf_dir):
    label = fn.hypotension(F.col("min_sbp"), 75.0).cast("string")
    return risk.session_risk(_bins(spark, sf_dir).select("session_id", label.alias("predicted_label")))


def agg_row_count(spark, sf_dir):
    return stored.row_count(table(spark, sf_dir, "events"))


def agg_class_weights(spark, sf_dir):
    return plain(risk.class_weights(classifier.train_rows(_features(spark, sf_dir))))


# --- windows ----------------------------------------------------------------


def win_gap(spark, sf_dir):
    rows = sessions.previous_reading(telemetry(spark, sf_dir))
    return plain(rows.select("pid", "datatime", "previous_ts", "gap_hours"))


def win_new_session(spark, sf_dir):
    return plain(sessions.new_session_flags(telemetry(spark, sf_dir)).select("pid", "datatime", "is_new_session"))


def win_session_ordinal(spark, sf_dir):
    return plain(_placed(spark, sf_dir).select("pid", "datatime", "session_ordinal"))


def win_session_start(spark, sf_dir):
    return plain(_placed(spark, sf_dir).select("pid", "datatime", "session_id", "session_start_ts"))


def _windowed(name, expression, *keep) -> Query:
    """A query that adds one window column to the bins; ``expression`` builds it."""

    def query(spark, sf_dir):
        return plain(_bins(spark, sf_dir).select(*_BIN_KEY, *keep, expression().alias(name)))

    return query


win_lag_sbp = _windowed("lag_1_avg_sbp", lambda: temporal.previous_bin("avg_sbp"))
win_lag_uf = _windowed("lag_1_avg_uf_rate", lambda: temporal.previous_bin("avg_uf_rate"))
win_trend_sbp = _windowed("trend_1_sbp", lambda: temporal.trend("avg_sbp"))
win_trend_conductivity = _windowed("trend_1_conductivity", lambda: temporal.trend("avg_conductivity"))
win_rolling_avg = _windowed("rolling_avg_sbp", lambda: temporal.rolling(F.avg, "avg_sbp", _DEFAULT))
win_rolling_max = _windowed("rolling_max_sbp", lambda: temporal.rolling(F.max, "avg_sbp", _DEFAULT))
win_rolling_stddev = _windowed("rolling_stddev_sbp", lambda: temporal.rolling(F.stddev_samp, "avg_sbp", _DEFAULT))
win_label_lookahead = _windowed("label", lambda: temporal.upcoming_hypotension(_DEFAULT))


# --- sorts and limits -------------------------------------------------------


def sort_session_time(spark, sf_dir):
    return plain(sessions.session_readings(_placed(spark, sf_dir), _SESSION).select("pid", "datatime", "sbp"))


def sort_for_windows(spark, sf_dir):
    """Lags over a table that is stored in buckets by session, and in order."""
    rows = tables.create_bucketed_sessions(
        _placed(spark, sf_dir), _table_name("bucketed_sessions"), 16, scratch_path(spark, "bucketed-sessions")
    )
    binned = bins.session_bins(rows, _DEFAULT)
    return plain(binned.select(*_BIN_KEY, "avg_sbp", temporal.previous_bin("avg_sbp").alias("lag_1_avg_sbp")))


def limit_head(spark, sf_dir):
    rows = stored.first_rows(telemetry(spark, sf_dir), 5, ["pid", "datatime", "measuretime"])
    return plain(rows.select(*SESSION_READING_COLUMNS))


# --- streams and stored states ----------------------------------------------


def _arriving(spark, sf_dir, name, when=None):
    """A stream over telemetry files in a folder of their own, and the folder."""
    path = scratch_path(spark, name)
    readings = telemetry(spark, sf_dir)
    stored.write_parquet(readings if when is None else readings.filter(when), path)
    return windows.reading_stream(spark, path, readings.schema), path


def _closed(spark, sf_dir, name, closed):
    readings, path = _arriving(spark, sf_dir, name)
    rows = closed(readings)
    windows.append_available(rows, f"{path}-closed", f"{path}-checkpoint")
    return spark.read.schema(rows.schema).parquet(f"{path}-closed")


def stream_bins(spark, sf_dir):
    rows = _closed(spark, sf_dir, "stream-bins", windows.closed_bins)
    return plain(rows.select("pid", "time_bin", "readings", "avg_sbp", "min_sbp", "stddev_sbp", "avg_conductivity"))


def stream_sessions(spark, sf_dir):
    rows = windows.numbered_sessions(_closed(spark, sf_dir, "stream-sessions", windows.closed_sessions))
    return plain(rows.select("pid", "session_id", "session_start_ts", "last_ts", "readings", "avg_sbp", "min_sbp"))


def stream_late_bins(spark, sf_dir):
    """A tenth of all readings arrives in files of its own, after the bins were first written."""
    belated = F.col("measuretime") % 10 == 0
    readings, path = _arriving(spark, sf_dir, "stream-late", ~belated)
    run = lambda: late.refresh_bins(readings, f"{path}-states", f"{path}-checkpoint")
    run()
    telemetry(spark, sf_dir).filter(belated).write.mode("append").parquet(path)
    run()
    rows = late.read_bins(spark, f"{path}-states")
    return plain(rows.select("pid", "time_bin", "readings", "avg_sbp", "min_sbp", "stddev_sbp", "avg_conductivity"))


def agg_rolled_bins(spark, sf_dir):
    """Six-hour bins from stored quarter-hour states."""
    states = _stored(spark, moments.bin_states(telemetry(spark, sf_dir), _DEFAULT.interval), "bin-states")
    rows = moments.state_statistics(moments.rolled_up(states, 360))
    return plain(rows.select("pid", "time_bin", "readings", "avg_sbp", "min_sbp", "stddev_sbp", "avg_conductivity"))


def sink_sessionized_runs(spark, sf_dir):
    """The sessionized table in three runs: ten days with all readings without a time, ten days and the rest."""
    folder = scratch_path(spark, "sessionized-runs")
    readings = telemetry(spark, sf_dir)
    begin = readings.agg(F.min(F.to_date("datatime"))).first()[0]
    part = F.least(F.floor(F.datediff(F.coalesce(F.to_date("datatime"), F.lit(begin)), F.lit(begin)) / 10), F.lit(2))
    for run in range(3):
        incremental.append_readings(readings.filter(part == run), folder, run)
    return plain(incremental.sessionized_so_far(spark, folder))


def sink_clustered_sessions(spark, sf_dir):
    """Chosen sessions read from files that are clustered by session."""
    path = scratch_path(spark, "clustered-sessions")
    tables.write_clustered_sessions(_placed(spark, sf_dir), path)
    rows = spark.read.parquet(path)
    return plain(rows.filter(F.col("session_id").isin("8_1", "1_2", "5_3")).select(*SESSION_READING_COLUMNS, "session_id"))


# --- scalar functions -------------------------------------------------------


def fn_epoch_to_ts(spark, sf_dir):
    ns = F.unix_micros(F.col("ts").cast("timestamp")) * 1000 + F.col("event_id") % 1000
    rows = table(spark, sf_dir, "events").select("event_id", ns.alias("ns"))
    return plain(rows.select("event_id", clock.epoch_ns_to_timestamp(F.col("ns")).alias("datatime")))


def fn_cast(spark, sf_dir):
    return plain(
        table(spark, sf_dir, "events").select(
            "event_id",
            parsing.read_as(F.col("user_id").cast("string"), "string").alias("pid_text"),
            parsing.read_as(F.round("value").cast("string"), "bigint").alias("whole"),
            parsing.read_as(F.col("event_type"), "bigint").alias("not_a_number"),
            parsing.read_as(F.col("ts").cast("string"), "timestamp").cast("date").alias("day"),
        )
    )


def fn_date(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    return plain(rows.select("event_id", F.to_date(clock.as_timestamp(rows, "ts")).alias("day")))


def fn_time_bin(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    return plain(
        table(spark, sf_dir, "events").select(
            "event_id", clock.time_bin(ts, 15).alias("bin_15"), clock.time_bin(ts, 360).alias("bin_360")
        )
    )


def fn_age(spark, sf_dir):
    return plain(_features(spark, sf_dir).select("session_id", "time_bin", "age_at_session"))


def _static_bins(spark, sf_dir):
    return enrich.join_visits(_bins(spark, sf_dir), registration(spark, sf_dir), demographics(spark, sf_dir))


def fn_vintage(spark, sf_dir):
    ends = F.col("session_start_ts"), F.col("first_dialysis_ts")
    return plain(
        _static_bins(spark, sf_dir).select(
            "session_id",
            "time_bin",
            fn.dialysis_vintage(*ends).alias("dialysis_vintage_years"),
            fn.dialysis_vintage(*ends, fractional=True).alias("vintage_serving"),
        )
    )


def fn_fluid_to_remove(spark, sf_dir):
    return plain(_features(spark, sf_dir).select("session_id", "time_bin", "fluid_to_remove"))


def fn_minutes_into_session(spark, sf_dir):
    ends = F.col("session_start_ts"), F.col("time_bin")
    return plain(
        _bins(spark, sf_dir).select(
            "session_id",
            "time_bin",
            clock.elapsed_minutes(*ends).alias("minutes_into_session"),
            clock.elapsed_minutes(*ends, fractional=True).alias("minutes_serving"),
        )
    )


def fn_hour_gap(spark, sf_dir):
    ends = F.col("previous_ts"), F.col("datatime")
    return plain(
        sessions.previous_reading(telemetry(spark, sf_dir)).select(
            "pid",
            "datatime",
            clock.elapsed_hours(*ends).alias("hours"),
            clock.elapsed_hours(*ends, fractional=True).alias("hours_serving"),
        ),
        exact=("hours_serving",),
    )


def fn_session_id(spark, sf_dir):
    named = fn.session_id(F.col("pid"), F.col("session_ordinal")).alias("session_id")
    return _placed(spark, sf_dir).select("pid", "session_ordinal", named)


def fn_split(spark, sf_dir):
    named = sessions.session_slots(telemetry(spark, sf_dir)).select("session_id").distinct()
    session = F.col("session_id")
    return named.select(
        session, fn.split_bucket(session).alias("bucket"), fn.dataset_split(session).alias("dataset_split")
    )


fn_coalesce = _windowed(
    "sbp_before", lambda: F.coalesce(temporal.previous_bin("avg_sbp"), F.col("avg_sbp"))
)


def fn_if(spark, sf_dir):
    flag = fn.hypotension(F.col("min_sbp"), _DEFAULT.threshold)
    return plain(_bins(spark, sf_dir).select("session_id", "time_bin", flag.alias("flag")))


def fn_case(spark, sf_dir):
    kind = (
        F.when(F.col("previous_ts").isNull(), "first")
        .when(F.col("gap_hours") > _DEFAULT.session_window, "new")
        .otherwise("same")
    )
    return plain(sessions.previous_reading(telemetry(spark, sf_dir)).select("pid", "datatime", kind.alias("kind")))


def norm_time_columns(spark, sf_dir):
    """ISO text in one column and day-first dates in the other."""
    first = F.date_format(clock.epoch_ns_to_timestamp(F.col("first_dialysis")), "d/MM/yyyy")
    text = (
        telemetry(spark, sf_dir)
        .select("pid", F.date_format("datatime", _TIME_TEXT).alias("datatime"))
        .join(demographics(spark, sf_dir).select("pid", first.alias("first_dialysis")), "pid")
    )
    return plain(parsing.normalize_time_columns(text))


def fn_date_format(spark, sf_dir):
    start = cleaning.visit_time(F.col("keyindate"), F.col("dialysisstart"))
    return plain(registration(spark, sf_dir).select("pid", F.date_format("keyindate", "yyyy-MM-dd").alias("day"), start.alias("start")))


def fn_starts_with(spark, sf_dir):
    """A cleaned end on the next day is one whose text starts with hour 24."""
    rows = cleaning.clean_registration(registration(spark, sf_dir).withColumn("as_text", F.col("dialysisend")))
    late = F.coalesce(F.to_date("dialysisend") > F.to_date("keyindate"), F.lit(False))
    return rows.select("pid", F.col("as_text").alias("dialysisend"), late.alias("after_midnight"))


def fn_substr(spark, sf_dir):
    late = cleaning.next_day_clock(F.col("keyindate"), F.col("dialysisend"))
    return plain(registration(spark, sf_dir).select("pid", "dialysisend", late.alias("minutes")))


def fn_add_day(spark, sf_dir):
    midnight = cleaning.next_day_clock(F.col("keyindate"), F.lit("24:00"))
    return plain(registration(spark, sf_dir).select("pid", F.to_date(midnight).alias("next_day")))


def fn_tz_align(spark, sf_dir):
    """A zone-less first dialysis against a zoned session start, both taken as UTC."""
    first = clock.epoch_ns_to_timestamp(F.col("first_dialysis")).cast("timestamp_ntz")
    naive = demographics(spark, sf_dir).withColumn("first_dialysis", first)
    rows = enrich.join_demographics(_placed(spark, sf_dir), naive)
    days = F.floor(clock.elapsed_us(F.col("first_dialysis_ts"), F.col("session_start_ts")) / float(clock.DAY_US))
    return plain(rows.select("pid", "datatime", days.alias("days")))


def fn_round(spark, sf_dir):
    return metrics.rounded(
        table(spark, sf_dir, "events").select("event_id", (F.col("value") / 3).alias("value_4"))
    )


# --- machine learning on tables ---------------------------------------------

_METRICS = ["precision", "recall", "accuracy", "f1_score", "log_loss", "roc_auc"]
_fitted: dict = {}


def _model(spark, sf_dir):
    """The stored features of ``sf_dir`` and a model fitted on them, once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _fitted:
        rows = _stored(spark, _features(spark, sf_dir), "training_features")
        _fitted[key] = (rows, classifier.train(rows))
    return _fitted[key]


def ml_train(spark, sf_dir):
    """What the model was fitted on and the size of what was fitted."""
    rows, model = _model(spark, sf_dir)
    trees = model.stages[-1]
    weights = risk.class_weights(classifier.train_rows(rows))
    return plain(
        weights.select(
            "label", "class_rows", "class_weight", F.lit(trees.getNumTrees).alias("trees"), F.lit(trees.numFeatures).alias("inputs")
        )
    )


def ml_explain(spark, sf_dir):
    """The model's inputs, and whether their importances are shares of one."""
    found = classifier.feature_importance(_model(spark, sf_dir)[1], spark)
    whole = found.agg(F.sum("importance").alias("total"))
    return found.select(
        "feature", (F.col("importance") >= 0).alias("is_share"), F.round(whole.scalar(), 9).alias("total")
    )


def ml_evaluate(spark, sf_dir):
    return plain(metrics.evaluate(scored_documents(spark, sf_dir)))


def ml_evaluate_model(spark, sf_dir):
    """Which metrics of the classifier on TEST rows equal those that a plain count over its scores gives."""
    rows, model = _model(spark, sf_dir)
    found = classifier.evaluate_model(model, rows)
    scored = _stored(spark, classifier.predict(model, classifier.test_rows(rows)).select("label", "probability_1"), "test_scores")
    score, positive = F.col("probability_1"), F.col("label") == 1
    hit, p = score >= 0.5, F.greatest(F.least(score, F.lit(1 - 1e-15)), F.lit(1e-15))
    # A positive's share of negatives under it, from its rank among all rows; ranks
    # run over distinct scores, of which trees give few.
    counts = scored.groupBy("probability_1").agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    under = F.sum("neg").over(Window.orderBy("probability_1").rowsBetween(Window.unboundedPreceding, -1))
    won = counts.withColumn("won", F.col("pos") * (F.coalesce(under, F.lit(0)) + F.col("neg") / 2))
    area = won.agg((F.sum("won") / (F.sum("pos") * F.sum("neg"))).alias("roc_auc"))
    plainly = scored.agg(
        (F.count_if(hit & positive) / F.count_if(hit)).alias("precision"),
        (F.count_if(hit & positive) / F.count_if(positive)).alias("recall"),
        F.avg((hit == positive).cast("double")).alias("accuracy"),
        (2 * F.count_if(hit & positive) / (F.count_if(hit) + F.count_if(positive))).alias("f1_score"),
        F.avg(-F.log(F.when(positive, p).otherwise(1 - p))).alias("log_loss"),
    )
    model_s = found.select(F.struct(*_METRICS)).scalar().alias("found")
    both = plainly.select("*", area.scalar().alias("roc_auc"), model_s)
    near = [F.struct(F.lit(m).alias("metric"), (F.abs(F.col(f"found.{m}") - F.col(m)) < 1e-9).alias("agrees")) for m in _METRICS]
    return both.select(F.explode(F.array(*near)).alias("row")).select("row.*")


def ml_predict(spark, sf_dir):
    """Each scored row, and whether its probabilities and its label belong together."""
    rows, model = _model(spark, sf_dir)
    zero, one = F.col("probability_0"), F.col("probability_1")
    return plain(
        classifier.predict(model, rows).select(
            "session_id",
            "time_bin",
            (F.abs(zero + one - 1) < 1e-9).alias("sums_to_one"),
            (F.col("predicted_label") == F.when(one > zero, "1").otherwise("0")).alias("label_is_larger"),
        )
    )


def ml_export(spark, sf_dir):
    """Each scored row, and whether the model gives it the same score after it was saved and loaded again."""
    rows, model = _model(spark, sf_dir)
    path = scratch_path(spark, "model")
    classifier.export_model(model, path)
    keys = ["session_id", "time_bin"]
    before = classifier.predict(model, rows).select(*keys, F.col("probability_1").alias("before"))
    after = classifier.predict(classifier.load_model(path), rows).select(*keys, F.col("probability_1").alias("after"))
    return plain(before.join(after, keys).select(*keys, (F.col("before") == F.col("after")).alias("same_score")))


def ml_csv_to_risk(spark, sf_dir):
    """Each session of the CSV files, and whether its risk is high just when one of its bins is predicted positive."""
    path = scratch_path(spark, "sessions_to_score")
    session_csv.write_session_csv(_enriched(spark, sf_dir), path)
    model = _model(spark, sf_dir)[1]
    found = risk_from_csv(spark, path, model).select("session_id", F.col("risk").alias("found"))
    bins_ = classifier.predict(model, _serving(spark, sf_dir)).groupBy("session_id")
    wanted = bins_.agg(F.when(F.max("predicted_label") == "1", "High").otherwise("Low").alias("wanted"))
    return found.join(wanted, "session_id", "full").select(
        "session_id", F.coalesce(F.col("found") == F.col("wanted"), F.lit(False)).alias("agrees")
    )


def _boosted(spark, sf_dir):
    """The stored features of ``sf_dir`` and a boosted model table read back from its file, once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, "boosted")
    if key not in _fitted:
        rows = _stored(spark, _features(spark, sf_dir), "boosted_features")
        path = scratch_path(spark, "boosted_model")
        boosting.export_boosted(boosting.train_boosted(rows), path)
        _fitted[key] = (rows, boosting.load_boosted(spark, path))
    return _fitted[key]


def ml_boosted_train(spark, sf_dir):
    """Cover of the first root, a quarter of the rows when classes weigh alike, and whether covers of children add up."""
    _, model = _boosted(spark, sf_dir)
    ends = model.select("tree", F.floor((F.col("node") - 1) / 2).alias("above"), F.col("cover").alias("part")).filter("above >= 0")
    parts = ends.groupBy("tree", "above").agg(F.sum("part").alias("parts"))
    splits = model.filter("input IS NOT NULL")
    both = splits.join(parts, (splits["tree"] == parts["tree"]) & (splits["node"] == parts["above"]), "left")
    adds = both.agg(F.coalesce(F.bool_and(F.abs(F.col("cover") - F.coalesce("parts", F.lit(0.0))) < 1e-6), F.lit(True)))
    root = model.filter("tree = 0 AND node = 0")
    return root.select(F.round("cover", 6).alias("root_cover"), adds.scalar().alias("covers_add"))


def ml_boosted_predict(spark, sf_dir):
    """Each row scored from the model table, and whether its probabilities and its label belong together."""
    rows, model = _boosted(spark, sf_dir)
    zero, one = F.col("probability_0"), F.col("probability_1")
    return plain(
        boosting.score_boosted(model, rows).select(
            "session_id",
            "time_bin",
            ((F.abs(zero + one - 1) < 1e-9) & one.between(0, 1)).alias("sums_to_one"),
            (F.col("predicted_label") == F.when(one > zero, "1").otherwise("0")).alias("label_is_larger"),
        )
    )


def ml_attributions(spark, sf_dir):
    """Each row, and whether what its inputs contribute adds up to the margin that the expressions give."""
    rows, model = _boosted(spark, sf_dir)
    scored = boosting.with_margin(model, rows, boosting.numeric_inputs(rows), "margin")
    found = boosting.contributions(model, scored, keep=("session_id", "time_bin", "margin"))
    whole = F.col("base") + F.aggregate("contributions", F.lit(0.0), lambda total, x: total + x)
    return plain(found.select("session_id", "time_bin", (F.abs(whole - F.col("margin")) < 1e-9).alias("adds_up")))


def ml_global_attribution(spark, sf_dir):
    """The model's inputs, and whether each has a mean absolute contribution."""
    rows, model = _boosted(spark, sf_dir)
    return boosting.global_attribution(model, rows).select("feature", (F.col("attribution") >= 0).alias("is_mean"))


_NAMES = """
sessionize sessionize_serving features_full features_coarse features_wide_bins features_serving
src_csv_typed src_csv_limit src_csv_glob clean_demographics clean_registration clean_telemetry
sink_parquet load_table src_table src_session_csv sink_session_csv src_jsonl src_machine_jsonl
sink_payload_json src_payload_json sink_sessionized sink_features sink_eval_csv
prj_normalize_telemetry prj_passthrough prj_features_final prj_rename prj_model_inputs
flt_session flt_session_bulk flt_ts_not_null flt_train flt_threshold
join_registration join_registration_one_per_day join_demographics join_enrich
agg_time_bins agg_avg agg_min agg_stddev agg_any_value agg_session_risk agg_row_count agg_class_weights
win_gap win_new_session win_session_ordinal win_session_start win_lag_sbp win_lag_uf win_trend_sbp
win_trend_conductivity win_rolling_avg win_rolling_max win_rolling_stddev win_label_lookahead
sort_session_time sort_for_windows limit_head
stream_bins stream_sessions stream_late_bins agg_rolled_bins sink_sessionized_runs sink_clustered_sessions
fn_epoch_to_ts fn_cast fn_date fn_time_bin fn_age fn_vintage fn_fluid_to_remove fn_minutes_into_session
fn_hour_gap fn_session_id fn_split fn_coalesce fn_if fn_case norm_time_columns fn_date_format
fn_starts_with fn_substr fn_add_day fn_tz_align fn_round
ml_train ml_explain ml_evaluate ml_evaluate_model ml_predict ml_export ml_csv_to_risk
ml_boosted_train ml_boosted_predict ml_attributions ml_global_attribution
""".split()


def queries() -> dict[str, Query]:
    return {name: globals()[name] for name in _NAMES}
