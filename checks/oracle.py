"""SQL counterparts of the registered queries, written over the whole given tables.

They use plain per-subject windows and joins, so they check the slot-wise
operators independently.
"""

from haemoloom.schemas import MODEL_FEATURES

INPUTS = """
forms AS (
  SELECT *, 0 AS form FROM events
  UNION ALL SELECT *, 0 AS form FROM events WHERE event_id % 20 = 0
  UNION ALL SELECT *, 1 AS form FROM events WHERE event_id % 20 = 1),
telemetry AS (
  SELECT CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 3 ELSE user_id END AS pid,
         CASE WHEN event_id % 13 <> 0 OR user_id % 4 <> 3 THEN ts END AS datatime,
         event_id + form * 1000000000000 AS measuretime,
         60 + CAST(floor((value + 8 * form) / 4) AS BIGINT) AS sbp,
         40 + CAST(floor((value + 8 * form) / 8) AS BIGINT) AS dbp,
         35 + (value + 8 * form) / 400 AS dia_temp_value,
         13 + (value + 8 * form) / 250 AS conductivity,
         (value + 8 * form) / 500 AS uf,
         150 + (value + 8 * form) / 4 AS blood_flow,
         event_id + form * 1000000000000 AS "time"
  FROM forms),
registration AS (
  SELECT o_custkey AS pid,
         TIMESTAMP '2024-01-01' + to_days(CAST(o_orderkey % 30 AS INTEGER)) AS keyindate,
         CAST(6 + o_orderkey % 6 AS VARCHAR) || ':' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') AS dialysisstart,
         CASE WHEN o_orderkey % 17 = 0 THEN 'unknown'
              ELSE CAST(12 + o_orderkey % 13 AS VARCHAR) || ':' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0')
         END AS dialysisend,
         CAST(50 + o_orderkey % 40 AS DOUBLE) AS weightstart,
         CAST(50 + o_orderkey % 40 - (1 + (o_orderkey // 30) % 3) AS DOUBLE) + 0.5 AS weightend,
         CAST(50 + o_orderkey % 40 - (1 + (o_orderkey // 30) % 3) AS DOUBLE) AS dryweight,
         36 + CAST(o_orderkey % 10 AS DOUBLE) / 10 AS temperature
  FROM orders),
demographics AS (
  SELECT c_custkey AS pid,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         1930 + c_custkey % 60 AS birthday,
         TIMESTAMP '2010-01-01' + to_days(CAST(c_custkey % 4000 AS INTEGER)) AS first_dialysis_ts,
         c_custkey % 3 = 0 AS DM
  FROM customer)
"""

READING = "pid, datatime, sbp, dbp, dia_temp_value, conductivity, uf, blood_flow"


# Of readings at one time, the one that sorts first by its values comes first.
IN_ORDER = "PARTITION BY pid ORDER BY " + ", ".join(f"{c} NULLS FIRST" for c in READING.split(", ")[1:])


def sessions(hours: int = 12, serving: bool = False, source: str = "telemetry") -> str:
    """CTEs from the given tables to ``sessionized``."""
    gap = "epoch_us(datatime) - epoch_us(previous_ts)" if serving else "date_sub('hour', previous_ts, datatime)"
    limit = hours * 3_600_000_000 if serving else hours
    return f"""WITH {INPUTS},
lagged AS (
  SELECT *, lag(datatime) OVER ({IN_ORDER}) AS previous_ts FROM {source}),
flagged AS (
  SELECT *, CASE WHEN previous_ts IS NULL OR {gap} > {limit} THEN 1 ELSE 0 END AS is_new_session FROM lagged),
numbered AS (
  SELECT *, CAST(sum(is_new_session) OVER (PARTITION BY pid ORDER BY datatime NULLS FIRST) AS BIGINT)
            AS session_ordinal FROM flagged),
named AS (
  SELECT *, CAST(pid AS VARCHAR) || '_' || CAST(session_ordinal AS VARCHAR) AS session_id FROM numbered),
sessionized AS (
  SELECT *, min(datatime) OVER (PARTITION BY session_id) AS session_start_ts FROM named)"""


def combined(hours: int = 12, serving: bool = False) -> str:
    return sessions(hours, serving) + """,
combined AS (
  SELECT m.pid, m.datatime, m.sbp, m.dbp, m.dia_temp_value, m.conductivity, m.uf, m.blood_flow,
         m.is_new_session, m.session_id, m.session_start_ts,
         r.keyindate, r.weightstart, r.weightend, r.dryweight, r.temperature,
         p.gender, p.birthday, p.DM, p.first_dialysis_ts
  FROM sessionized m
  JOIN registration r ON m.pid = r.pid AND CAST(m.session_start_ts AS DATE) = CAST(r.keyindate AS DATE)
  JOIN demographics p ON m.pid = p.pid)"""


def _bin(minutes: int) -> str:
    width = minutes * 60_000_000
    return f"make_timestamp(CAST((epoch_us(datatime) // CAST({width} AS BIGINT)) * CAST({width} AS BIGINT) AS BIGINT))"


_STATISTICS = """count(*) AS readings, avg(sbp) AS avg_sbp, min(sbp) AS min_sbp, stddev_samp(sbp) AS stddev_sbp,
         avg(dbp) AS avg_dbp, avg(dia_temp_value) AS avg_dia_temp, avg(conductivity) AS avg_conductivity,
         avg(uf) AS avg_uf_rate, avg(blood_flow) AS avg_blood_flow"""


def bins(minutes: int = 15) -> str:
    """CTEs to ``binned``: bins of sessionized readings without the joins."""
    return sessions() + f""",
binned AS (
  SELECT pid, session_id, {_bin(minutes)} AS time_bin, min(session_start_ts) AS session_start_ts, {_STATISTICS}
  FROM sessionized WHERE datatime IS NOT NULL GROUP BY 1, 2, 3)"""


_BIN_WINDOW = "PARTITION BY session_id ORDER BY time_bin"


def temporal(source: str, rolling: int = 3, ahead: int = 5, threshold: float = 90.0) -> str:
    frame = f"{_BIN_WINDOW} ROWS BETWEEN {rolling} PRECEDING AND CURRENT ROW"
    return f"""temporal AS (
  SELECT *,
         lag(avg_sbp) OVER ({_BIN_WINDOW}) AS lag_1_avg_sbp,
         avg_sbp - lag(avg_sbp) OVER ({_BIN_WINDOW}) AS trend_1_sbp,
         lag(avg_uf_rate) OVER ({_BIN_WINDOW}) AS lag_1_avg_uf_rate,
         avg_conductivity - lag(avg_conductivity) OVER ({_BIN_WINDOW}) AS trend_1_conductivity,
         avg(avg_sbp) OVER ({frame}) AS rolling_avg_sbp,
         max(avg_sbp) OVER ({frame}) AS rolling_max_sbp,
         stddev_samp(avg_sbp) OVER ({frame}) AS rolling_stddev_sbp,
         coalesce(max(CASE WHEN min_sbp < {threshold} THEN 1 ELSE 0 END) OVER (
           {_BIN_WINDOW} ROWS BETWEEN 1 FOLLOWING AND {ahead} FOLLOWING), 0) AS label
  FROM {source})"""


def features(hours=12, minutes=15, serving_gap=False, serving_values=False) -> str:
    """CTEs to ``features``: one row per bin with all feature columns, unrounded."""
    if serving_values:
        vintage = """floor((epoch_us(session_start_ts) - epoch_us(first_dialysis_ts)) / 86400000000.0) / 365.25"""
        into = "(epoch_us(time_bin) - epoch_us(session_start_ts)) / 60000000.0"
    else:
        vintage = "year(session_start_ts) - year(first_dialysis_ts)"
        into = "date_sub('minute', session_start_ts, time_bin)"
    return combined(hours, serving_gap) + f""",
binned AS (
  SELECT pid, session_id, {_bin(minutes)} AS time_bin, min(session_start_ts) AS session_start_ts, {_STATISTICS},
         min({{'start': weightstart, 'dry': dryweight}}) AS weights,
         min(gender) AS gender, min(birthday) AS birthday, bool_and(DM) AS DM,
         min(first_dialysis_ts) AS first_dialysis_ts
  FROM combined WHERE datatime IS NOT NULL GROUP BY 1, 2, 3),
{temporal("binned")},
features AS (
  SELECT *,
         CASE WHEN CAST('0x' || substr(md5(session_id), 1, 8) AS BIGINT) % 10 < 8 THEN 'TRAIN' ELSE 'TEST' END
           AS dataset_split,
         year(session_start_ts) - birthday AS age_at_session,
         {vintage} AS dialysis_vintage_years,
         weights.start - weights.dry AS fluid_to_remove,
         {into} AS minutes_into_session
  FROM temporal)"""


def r9(name: str) -> str:
    """A double column rounded to 9 digits, without a negative zero."""
    return f"round({name}, 9) + 0.0 AS {name}"


_STATISTIC_COLUMNS = ", ".join([
    r9("avg_sbp"), "min_sbp", r9("stddev_sbp"), r9("avg_dbp"), r9("avg_dia_temp"),
    r9("avg_conductivity"), r9("avg_uf_rate"), r9("avg_blood_flow"),
    r9("lag_1_avg_sbp"), r9("trend_1_sbp"), r9("lag_1_avg_uf_rate"), r9("trend_1_conductivity"),
    r9("rolling_avg_sbp"), r9("rolling_max_sbp"), r9("rolling_stddev_sbp"),
])

FEATURES_SELECT = f"""dataset_split, pid AS "Pid", session_id, time_bin,
  age_at_session, dialysis_vintage_years, {r9("fluid_to_remove")}, minutes_into_session, gender, DM AS "DM",
  {_STATISTIC_COLUMNS}, label"""

# Model inputs: with fractional years and minutes, and with whole ones.
INPUTS_SELECT = f"""age_at_session, {r9("dialysis_vintage_years")}, {r9("fluid_to_remove")},
  {r9("minutes_into_session")}, gender, DM AS "DM", {_STATISTIC_COLUMNS}"""
WHOLE_INPUTS_SELECT = f"""age_at_session, dialysis_vintage_years, {r9("fluid_to_remove")},
  minutes_into_session, gender, DM AS "DM", {_STATISTIC_COLUMNS}"""

READING_R9 = ", ".join(
    ["pid", "datatime", "sbp", "dbp", r9("dia_temp_value"), r9("conductivity"), r9("uf"), r9("blood_flow")]
)

SCORED = """WITH scored AS (
  SELECT d.doc_id, l.quality AS label, d.n_chars / (d.n_chars + 2000.0) AS score
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
ranked AS (
  SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS place FROM scored),
totals AS (
  SELECT CAST(sum(label) AS DOUBLE) AS p, CAST(count(*) - sum(label) AS DOUBLE) AS n,
         CAST(sum(CASE WHEN score >= 0.5 AND label = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
         CAST(sum(CASE WHEN score >= 0.5 AND label = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
         sum(-(CASE WHEN label = 1 THEN ln(greatest(least(score, 1 - 1e-15), 1e-15))
               ELSE ln(1 - greatest(least(score, 1 - 1e-15), 1e-15)) END)) AS loss,
         sum(CASE WHEN label = 1 THEN place ELSE 0 END) AS places
  FROM ranked),
metrics AS (
  SELECT tp / (tp + fp) AS "precision", tp / p AS recall, (tp + n - fp) / (p + n) AS accuracy,
         2 * tp / (2 * tp + fp + p - tp) AS f1_score, loss / (p + n) AS log_loss,
         (places - p * (p + 1) / 2) / (p * n) AS roc_auc
  FROM totals)"""

METRIC_NAMES = ["precision", "recall", "accuracy", "f1_score", "log_loss", "roc_auc"]


def metrics(digits: int) -> str:
    return SCORED + "SELECT " + ", ".join(
        f'round("{m}", {digits}) + 0.0 AS "{m}"' for m in METRIC_NAMES
    ) + " FROM metrics"


def _inputs(select: str) -> str:
    return f"WITH {INPUTS} {select}"


def _sessions(select: str) -> str:
    return f"{sessions()} {select}"


def _bins(select: str, minutes: int = 15) -> str:
    return f"{bins(minutes)} {select}"


def _temporal(columns: str) -> str:
    return f"{bins()}, {temporal('binned')} SELECT pid, session_id, time_bin, {columns} FROM temporal"


def _features(select: str, **options) -> str:
    return f"{features(**options)} {select}"


_SESSION_CSV = f"""SELECT pid, datatime, session_id, first_dialysis_ts, CAST(sbp AS DOUBLE) AS sbp,
  CAST(dbp AS DOUBLE) AS dbp, {r9("dia_temp_value")},
  {r9("conductivity")}, {r9("uf")}, {r9("blood_flow")}, {r9("weightstart")}, {r9("weightend")},
  {r9("dryweight")}, {r9("temperature")}, gender, birthday, DM AS "DM" """

_SESSIONIZED = f"SELECT {READING_R9}, is_new_session, session_id, session_start_ts FROM sessionized"

_TELEMETRY = f'SELECT {READING_R9}, measuretime, "time" FROM telemetry'

_RISK = """, scored AS (
  SELECT session_id, CASE WHEN min_sbp < 75 THEN '1' ELSE '0' END AS predicted_label FROM binned)
SELECT session_id, bool_or(predicted_label = '1') AS high_risk,
       CASE WHEN bool_or(predicted_label = '1') THEN 'High' ELSE 'Low' END AS risk
FROM scored GROUP BY session_id"""

_CLOCK = """CASE WHEN dialysisend = 'unknown' THEN NULL
     ELSE keyindate + to_hours(CAST(split_part(dialysisend, ':', 1) AS INTEGER))
                    + to_minutes(CAST(split_part(dialysisend, ':', 2) AS INTEGER)) END AS dialysisend"""
_CLOCK_START = """keyindate + to_hours(CAST(split_part(dialysisstart, ':', 1) AS INTEGER))
                    + to_minutes(CAST(split_part(dialysisstart, ':', 2) AS INTEGER)) AS dialysisstart"""


# A stream's watermark an hour behind the latest reading, in whole milliseconds.
_WATERMARK = "(SELECT (epoch_us(max(datatime)) // 1000) * 1000 - 3600000000 FROM telemetry)"


def _plain_bins(minutes: int = 15, closed: bool = False) -> str:
    """Bins by subject and time, without sessions."""
    limit = f"HAVING max(epoch_us({_bin(minutes)})) + {minutes} * 60000000 <= {_WATERMARK}" if closed else ""
    shown = ", ".join(r9(c) for c in ("avg_sbp", "stddev_sbp", "avg_conductivity"))
    return _inputs(f"""SELECT pid, time_bin, readings, min_sbp, {shown} FROM (
        SELECT pid, {_bin(minutes)} AS time_bin, {_STATISTICS}
        FROM telemetry WHERE datatime IS NOT NULL GROUP BY 1, 2 {limit})""")


def oracle_sql() -> dict[str, str]:
    return {
        # Streams and stored states
        "stream_bins": _plain_bins(closed=True),
        "stream_sessions": f"""{sessions(serving=True, source="(SELECT * FROM telemetry WHERE datatime IS NOT NULL)")}
            SELECT pid, session_id, min(datatime) AS session_start_ts, max(datatime) AS last_ts, count(*) AS readings,
                   round(avg(sbp), 9) AS avg_sbp, min(sbp) AS min_sbp
            FROM sessionized GROUP BY pid, session_ordinal, session_id
            HAVING epoch_us(max(datatime)) + 12 * 3600000000 <= {_WATERMARK}""",
        "stream_late_bins": _plain_bins(),
        "agg_rolled_bins": _plain_bins(360),
        "sink_sessionized_runs": _sessions(_SESSIONIZED),
        "sink_clustered_sessions": _sessions(
            f"SELECT {READING_R9}, session_id FROM sessionized WHERE session_id IN ('8_1', '1_2', '5_3')"
        ),
        # End to end
        "sessionize": _sessions(_SESSIONIZED),
        "sessionize_serving": f"{sessions(serving=True)} {_SESSIONIZED}",
        "features_full": _features(f"SELECT {FEATURES_SELECT} FROM features"),
        "features_coarse": _features(f"SELECT {FEATURES_SELECT} FROM features", hours=24, minutes=360),
        "features_wide_bins": _features(f"SELECT {FEATURES_SELECT} FROM features", hours=3, minutes=720),
        "features_serving": _features(
            f"SELECT pid, session_id, {INPUTS_SELECT}, label FROM features", serving_gap=True, serving_values=True
        ),
        # Sources and sinks
        "src_csv_typed": _inputs(_TELEMETRY),
        "src_csv_limit": _inputs(f"{_TELEMETRY} ORDER BY measuretime LIMIT 100"),
        "src_csv_glob": _inputs(_TELEMETRY),
        "clean_demographics": _inputs(
            'SELECT pid, gender, birthday, first_dialysis_ts AS first_dialysis, DM AS "DM" FROM demographics'
        ),
        "clean_registration": _inputs(
            f"""SELECT pid, keyindate, {_CLOCK_START}, {_CLOCK}, weightstart, weightend, dryweight,
            {r9("temperature")} FROM registration"""
        ),
        "clean_telemetry": _inputs(_TELEMETRY),
        "sink_parquet": _inputs(_TELEMETRY),
        "load_table": _inputs("SELECT count(*) AS num_rows FROM telemetry"),
        "src_table": _inputs(_TELEMETRY),
        "src_session_csv": f"{combined()} {_SESSION_CSV}, session_start_ts FROM combined",
        "sink_session_csv": f"{combined()} {_SESSION_CSV} FROM combined",
        "src_jsonl": _inputs(_TELEMETRY),
        "src_machine_jsonl": _inputs(
            """SELECT pid, datatime, sbp, min(datatime) OVER (PARTITION BY pid) AS session_start_ts,
            CAST(CAST(min(datatime) OVER (PARTITION BY pid) AS DATE) AS VARCHAR) AS session_date FROM telemetry"""
        ),
        "sink_payload_json": _features(
            """SELECT session_id, CAST(0 AS BIGINT) AS part, count(*) AS instances,
            string_agg(coalesce(CAST(min_sbp AS VARCHAR), 'none'), ',' ORDER BY time_bin) AS pressures
            FROM features GROUP BY session_id""",
            serving_values=True,
        ),
        "src_payload_json": _features(
            "SELECT * REPLACE (CAST(age_at_session AS DOUBLE) AS age_at_session, CAST(min_sbp AS DOUBLE) AS min_sbp) "
            f"FROM (SELECT session_id, {INPUTS_SELECT} FROM features)",
            serving_values=True,
        ),
        "sink_sessionized": _sessions(_SESSIONIZED),
        "sink_features": _features(f"SELECT {FEATURES_SELECT} FROM features"),
        "sink_eval_csv": metrics(4),
        # Projections, filters, predicates
        "prj_normalize_telemetry": _sessions(
            f"""SELECT pid AS "Pid", datatime AS measurement_timestamp, sbp, dbp, {r9("dia_temp_value")},
            {r9("conductivity")}, {r9("uf")}, {r9("blood_flow")}, is_new_session, session_id,
            coalesce(CASE WHEN sbp % 2 = 1 THEN session_start_ts END, min(datatime) OVER (PARTITION BY session_id))
              AS session_start_ts
            FROM sessionized"""
        ),
        "prj_passthrough": _inputs(
            f"""SELECT {READING_R9}, measuretime, "time", sbp - dbp AS pulse_pressure,
            CAST(CAST(datatime AS DATE) AS VARCHAR) AS reading_date FROM telemetry"""
        ),
        "prj_features_final": _features(f"SELECT {FEATURES_SELECT} FROM features"),
        "prj_rename": _bins(
            f"""SELECT pid, session_id, time_bin, {r9("avg_sbp")}, min_sbp, {r9("stddev_sbp")}, {r9("avg_dbp")},
            {r9("avg_dia_temp")}, {r9("avg_conductivity")}, {r9("avg_uf_rate")}, {r9("avg_blood_flow")} FROM binned"""
        ),
        "prj_model_inputs": _features(f"SELECT {WHOLE_INPUTS_SELECT}, label FROM features"),
        "flt_session": _sessions(f"{_SESSIONIZED} WHERE session_id = '8_1'"),
        "flt_session_bulk": _sessions(
            f"""{_SESSIONIZED} WHERE session_id IN (
            SELECT session_id FROM sessionized GROUP BY session_id HAVING min(sbp) < 65)"""
        ),
        "flt_ts_not_null": _inputs(f"SELECT {READING_R9} FROM telemetry WHERE datatime IS NOT NULL"),
        "flt_train": _features(
            f"SELECT session_id, time_bin, {r9('avg_sbp')}, label FROM features WHERE dataset_split = 'TRAIN'"
        ),
        "flt_threshold": _bins(
            """SELECT pid, session_id, time_bin, min_sbp, CASE WHEN min_sbp < 90 THEN 1 ELSE 0 END AS hypotensive
            FROM binned"""
        ),
        # Joins
        "join_registration": _sessions(
            """SELECT m.pid, m.datatime, m.session_id, m.sbp, r.weightstart, r.dryweight,
            CAST(CAST(m.session_start_ts AS DATE) AS VARCHAR) AS session_date
            FROM sessionized m JOIN registration r
            ON m.pid = r.pid AND CAST(m.session_start_ts AS DATE) = CAST(r.keyindate AS DATE)"""
        ),
        "join_registration_one_per_day": _sessions(
            """, per_day AS (
              SELECT pid, CAST(keyindate AS DATE) AS day, min({'s': weightstart, 'd': dryweight}) AS w
              FROM registration GROUP BY 1, 2)
            SELECT m.pid, m.datatime, m.session_id, m.sbp, r.w.s AS weightstart, r.w.d AS dryweight,
            CAST(r.day AS VARCHAR) AS session_date
            FROM sessionized m JOIN per_day r ON m.pid = r.pid AND CAST(m.session_start_ts AS DATE) = r.day"""
        ),
        "join_demographics": _sessions(
            """SELECT m.pid, m.datatime, m.session_id, m.sbp, p.gender, p.birthday, p.DM AS "DM", p.first_dialysis_ts
            FROM sessionized m JOIN demographics p ON m.pid = p.pid"""
        ),
        "join_enrich": f"""{combined()} SELECT * REPLACE (CAST(sbp AS BIGINT) AS sbp, CAST(dbp AS BIGINT) AS dbp)
            FROM ({_SESSION_CSV}, is_new_session, session_start_ts FROM combined)""",
        # Aggregations
        "agg_time_bins": _bins("SELECT pid, session_id, time_bin, readings FROM binned"),
        "agg_avg": _bins(
            f"""SELECT pid, session_id, time_bin, {r9("avg_sbp")}, {r9("avg_dbp")}, {r9("avg_dia_temp")},
            {r9("avg_conductivity")}, {r9("avg_uf_rate")}, {r9("avg_blood_flow")} FROM binned"""
        ),
        "agg_min": _bins("SELECT pid, session_id, time_bin, min_sbp FROM binned"),
        "agg_stddev": _bins(f"SELECT pid, session_id, time_bin, {r9('stddev_sbp')} FROM binned", 360),
        "agg_any_value": _features(
            """SELECT pid, session_id, time_bin, session_start_ts, weights.start AS weightstart, weights.dry AS dryweight,
            gender, birthday, DM AS "DM", first_dialysis_ts FROM features"""
        ),
        "agg_session_risk": bins() + _RISK,
        "agg_row_count": "SELECT count(*) AS num_rows FROM events",
        "agg_class_weights": _features(
            """, counts AS (
              SELECT label, count(*) AS class_rows FROM features WHERE dataset_split = 'TRAIN' GROUP BY label)
            SELECT label, class_rows,
                   round(sum(class_rows) OVER () / (count(*) OVER () * class_rows), 9) AS class_weight FROM counts"""
        ),
        # Windows
        "win_gap": _sessions(
            "SELECT pid, datatime, previous_ts, date_sub('hour', previous_ts, datatime) AS gap_hours FROM flagged"
        ),
        "win_new_session": _sessions("SELECT pid, datatime, is_new_session FROM flagged"),
        "win_session_ordinal": _sessions("SELECT pid, datatime, session_ordinal FROM numbered"),
        "win_session_start": _sessions("SELECT pid, datatime, session_id, session_start_ts FROM sessionized"),
        "win_lag_sbp": _temporal(r9("lag_1_avg_sbp")),
        "win_lag_uf": _temporal(r9("lag_1_avg_uf_rate")),
        "win_trend_sbp": _temporal(r9("trend_1_sbp")),
        "win_trend_conductivity": _temporal(r9("trend_1_conductivity")),
        "win_rolling_avg": _temporal(r9("rolling_avg_sbp")),
        "win_rolling_max": _temporal(r9("rolling_max_sbp")),
        "win_rolling_stddev": _temporal(r9("rolling_stddev_sbp")),
        "win_label_lookahead": _temporal("label"),
        # Sorts and limits
        "sort_session_time": _sessions("SELECT pid, datatime, sbp FROM sessionized WHERE session_id = '8_1'"),
        "sort_for_windows": _temporal(f"{r9('avg_sbp')}, {r9('lag_1_avg_sbp')}"),
        "limit_head": _inputs(f"SELECT {READING_R9} FROM telemetry ORDER BY pid NULLS FIRST, datatime NULLS FIRST, measuretime LIMIT 5"),
        # Scalar functions
        "fn_epoch_to_ts": """SELECT event_id,
            make_timestamp(CAST((epoch_us(ts) * 1000 + event_id % 1000 + 500) // 1000 AS BIGINT)) AS datatime
            FROM events""",
        "fn_cast": """SELECT event_id, CAST(user_id AS VARCHAR) AS pid_text, CAST(round(value) AS BIGINT) AS whole,
            TRY_CAST(event_type AS BIGINT) AS not_a_number, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events""",
        "fn_date": "SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events",
        "fn_time_bin": """SELECT event_id, make_timestamp((epoch_us(ts) // 900000000) * 900000000) AS bin_15,
            make_timestamp((epoch_us(ts) // CAST(21600000000 AS BIGINT)) * CAST(21600000000 AS BIGINT)) AS bin_360
            FROM events""",
        "fn_age": _features("SELECT session_id, time_bin, age_at_session FROM features"),
        "fn_vintage": _features(
            """SELECT session_id, time_bin, dialysis_vintage_years,
            round(floor((epoch_us(session_start_ts) - epoch_us(first_dialysis_ts)) / 86400000000.0) / 365.25, 9)
              AS vintage_serving FROM features"""
        ),
        "fn_fluid_to_remove": _features(f"SELECT session_id, time_bin, {r9('fluid_to_remove')} FROM features"),
        "fn_minutes_into_session": _bins(
            """SELECT session_id, time_bin, date_sub('minute', session_start_ts, time_bin) AS minutes_into_session,
            round((epoch_us(time_bin) - epoch_us(session_start_ts)) / 60000000.0, 9) AS minutes_serving FROM binned"""
        ),
        "fn_hour_gap": _sessions(
            """SELECT pid, datatime, date_sub('hour', previous_ts, datatime) AS hours,
            (epoch_us(datatime) - epoch_us(previous_ts)) / 3600000000.0 AS hours_serving FROM flagged"""
        ),
        "fn_session_id": _sessions("SELECT pid, session_ordinal, session_id FROM sessionized"),
        "fn_split": _sessions(
            """SELECT session_id, CAST('0x' || substr(md5(session_id), 1, 8) AS BIGINT) % 10 AS bucket,
            CASE WHEN CAST('0x' || substr(md5(session_id), 1, 8) AS BIGINT) % 10 < 8 THEN 'TRAIN' ELSE 'TEST' END
              AS dataset_split FROM sessionized GROUP BY session_id"""
        ),
        "fn_coalesce": _temporal("round(coalesce(lag_1_avg_sbp, avg_sbp), 9) AS sbp_before"),
        "fn_if": _bins("SELECT session_id, time_bin, CASE WHEN min_sbp < 90 THEN 1 ELSE 0 END AS flag FROM binned"),
        "fn_case": _sessions(
            """SELECT pid, datatime, CASE WHEN previous_ts IS NULL THEN 'first'
            WHEN date_sub('hour', previous_ts, datatime) > 12 THEN 'new' ELSE 'same' END AS kind FROM flagged"""
        ),
        "norm_time_columns": _inputs(
            """SELECT t.pid, t.datatime, d.first_dialysis_ts AS first_dialysis
            FROM telemetry t JOIN demographics d ON t.pid = d.pid"""
        ),
        "fn_date_format": _inputs(f"SELECT pid, strftime(keyindate, '%Y-%m-%d') AS day, {_CLOCK_START.replace('AS dialysisstart', 'AS start')} FROM registration"
        ),
        "fn_starts_with": _inputs(
            "SELECT pid, dialysisend, starts_with(dialysisend, '24:') AS after_midnight FROM registration"
        ),
        "fn_substr": _inputs(
            """SELECT pid, dialysisend, CASE WHEN dialysisend <> 'unknown' THEN date_trunc('day', keyindate) + INTERVAL 1 DAY
            + to_minutes(CAST(substr(dialysisend, 4) AS INTEGER)) END AS minutes FROM registration"""
        ),
        "fn_add_day": _inputs("SELECT pid, CAST(CAST(keyindate AS DATE) + 1 AS VARCHAR) AS next_day FROM registration"),
        "fn_tz_align": _sessions(
            """SELECT m.pid, m.datatime,
            CAST(floor((epoch_us(m.session_start_ts) - epoch_us(p.first_dialysis_ts)) / 86400000000.0) AS BIGINT)
              AS days
            FROM sessionized m JOIN demographics p ON m.pid = p.pid"""
        ),
        "fn_round": "SELECT event_id, round(value / 3, 4) AS value_4 FROM events",
        # Machine learning on tables
        "ml_evaluate": metrics(9),
        "ml_evaluate_model": "SELECT unnest(" + repr(METRIC_NAMES) + ") AS metric, true AS agrees",
        "ml_train": _features(
            """SELECT label, count(*) AS class_rows,
            round(CAST(sum(count(*)) OVER () AS DOUBLE) / count(*) OVER () / count(*), 9) AS class_weight,
            20 AS trees, 41 AS inputs FROM features WHERE dataset_split = 'TRAIN' GROUP BY label"""
        ),
        "ml_explain": f"SELECT unnest({MODEL_FEATURES!r}) AS feature, true AS is_share, CAST(1 AS DOUBLE) AS total",
        "ml_predict": _features("SELECT session_id, time_bin, true AS sums_to_one, true AS label_is_larger FROM features"),
        "ml_export": _features("SELECT session_id, time_bin, true AS same_score FROM features"),
        "ml_csv_to_risk": _features("SELECT DISTINCT session_id, true AS agrees FROM features"),
        "ml_boosted_train": _features(
            "SELECT round(count(*) / 4.0, 6) AS root_cover, true AS covers_add FROM features WHERE dataset_split = 'TRAIN' AND label IN (0, 1)"
        ),
        "ml_boosted_predict": _features("SELECT session_id, time_bin, true AS sums_to_one, true AS label_is_larger FROM features"),
        "ml_attributions": _features("SELECT session_id, time_bin, true AS adds_up FROM features"),
        "ml_global_attribution": f"SELECT unnest({MODEL_FEATURES!r}) AS feature, true AS is_mean",
    }
