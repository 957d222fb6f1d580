"""Table schemas and fixed column lists.

All times are UTC. Integer epochs are nanoseconds (see ``functions.clock``).
"""

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column names, their order and their types are the exchange
# contract of the tables and files, so they are stated literally.
# ---------------------------------------------------------------------------

TELEMETRY = T.StructType([
    T.StructField("pid", T.LongType()),
    T.StructField("datatime", T.TimestampType()),
    T.StructField("measuretime", T.LongType()),
    T.StructField("sbp", T.LongType()),
    T.StructField("dbp", T.LongType()),
    T.StructField("dia_temp_value", T.DoubleType()),
    T.StructField("conductivity", T.DoubleType()),
    T.StructField("uf", T.DoubleType()),
    T.StructField("blood_flow", T.DoubleType()),
    T.StructField("time", T.LongType()),
])

DEMOGRAPHICS = T.StructType([
    T.StructField("pid", T.LongType()),
    T.StructField("gender", T.StringType()),
    T.StructField("birthday", T.LongType()),
    T.StructField("first_dialysis", T.StringType()),
    T.StructField("DM", T.BooleanType()),
])

REGISTRATION = T.StructType([
    T.StructField("pid", T.LongType()),
    T.StructField("keyindate", T.StringType()),
    T.StructField("dialysisstart", T.StringType()),
    T.StructField("dialysisend", T.StringType()),
    T.StructField("weightstart", T.DoubleType()),
    T.StructField("weightend", T.DoubleType()),
    T.StructField("dryweight", T.DoubleType()),
    T.StructField("temperature", T.DoubleType()),
])

# Telemetry columns that a sessionized table keeps, in order.
SESSION_READING_COLUMNS = [
    "pid",
    "datatime",
    "sbp",
    "dbp",
    "dia_temp_value",
    "conductivity",
    "uf",
    "blood_flow",
]

# Columns of the session CSV exchange format, in order.
SESSION_CSV_COLUMNS = [
    "pid",
    "datatime",
    "session_id",
    "first_dialysis_ts",
    "sbp",
    "dbp",
    "dia_temp_value",
    "conductivity",
    "uf",
    "blood_flow",
    "weightstart",
    "weightend",
    "dryweight",
    "temperature",
    "gender",
    "birthday",
    "DM",
]

SESSION_CSV_TYPES = {
    "pid": "bigint",
    "session_id": "string",
    "sbp": "double",
    "dbp": "double",
    "dia_temp_value": "double",
    "conductivity": "double",
    "uf": "double",
    "blood_flow": "double",
    "weightstart": "double",
    "weightend": "double",
    "dryweight": "double",
    "temperature": "double",
    "gender": "string",
    "birthday": "bigint",
    "DM": "boolean",
}

# Known time columns that are parsed wherever they are present.
TIME_COLUMNS = [
    "datatime",
    "session_start_ts",
    "session_date",
    "keyindate",
    "dialysisstart",
    "dialysisend",
    "first_dialysis",
    "first_dialysis_ts",
    "keyindate_ts",
]

# Columns of the training features table, in order.
FEATURE_COLUMNS = [
    "dataset_split",
    "Pid",
    "session_id",
    "time_bin",
    "age_at_session",
    "dialysis_vintage_years",
    "fluid_to_remove",
    "minutes_into_session",
    "gender",
    "DM",
    "avg_sbp",
    "min_sbp",
    "stddev_sbp",
    "avg_dbp",
    "avg_dia_temp",
    "avg_conductivity",
    "avg_uf_rate",
    "avg_blood_flow",
    "lag_1_avg_sbp",
    "trend_1_sbp",
    "lag_1_avg_uf_rate",
    "trend_1_conductivity",
    "rolling_avg_sbp",
    "rolling_max_sbp",
    "rolling_stddev_sbp",
    "label",
]

# Model inputs, in the order of a payload instance.
MODEL_FEATURES = [
    "DM",
    "age_at_session",
    "avg_blood_flow",
    "avg_conductivity",
    "avg_dbp",
    "avg_dia_temp",
    "avg_sbp",
    "avg_uf_rate",
    "dialysis_vintage_years",
    "fluid_to_remove",
    "gender",
    "lag_1_avg_sbp",
    "lag_1_avg_uf_rate",
    "min_sbp",
    "minutes_into_session",
    "rolling_avg_sbp",
    "rolling_max_sbp",
    "rolling_stddev_sbp",
    "stddev_sbp",
    "trend_1_conductivity",
    "trend_1_sbp",
]

# Columns of the serving features, in order.
SERVING_COLUMNS = ["pid", "session_id", *MODEL_FEATURES, "label"]

# Text that a CSV reader takes as a missing value.
MISSING_TEXT = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# ---------------------------------------------------------------------------

_CATEGORICAL = {"DM": T.BooleanType(), "gender": T.StringType()}

# One payload instance: a struct of the model inputs.
INSTANCE = T.StructType(
    [T.StructField(name, _CATEGORICAL.get(name, T.DoubleType())) for name in MODEL_FEATURES]
)
