import json
from datetime import date, datetime
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haemoloom.operators.enrich import enrich
from haemoloom.operators.sessions import sessionize
from haemoloom.plans import chosen, setup
from haemoloom.plans.features import serving_features
from haemoloom.runtime import SESSION_CONF, scratch_path, shared_folder
from haemoloom.schemas import MODEL_FEATURES, SESSION_CSV_COLUMNS, TELEMETRY
from haemoloom.sources import csv, jsonl, payload, session_csv, tables
from test_features import golden_inputs

TYPES = {"pid": "bigint", "weight": "double", "absent": "double"}


def test_typed_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("pid,weight,note\n1,70.5,x\n2,NA,\n3.0,nan,null\n")
    df = csv.read_csv_typed(spark, str(tmp_path / "a.csv"), TYPES)
    assert df.dtypes == [("pid", "bigint"), ("weight", "double"), ("note", "string")]
    assert [tuple(r) for r in df.collect()] == [(1, 70.5, "x"), (2, None, None), (3, None, None)]


def test_typed_csv_fails_with_the_column(spark, tmp_path):
    (tmp_path / "a.csv").write_text("pid,weight\n1,heavy\n")
    with pytest.raises(PySparkException, match="'weight' holds no double.*heavy"):
        csv.read_csv_typed(spark, str(tmp_path / "a.csv"), TYPES).collect()
    (tmp_path / "b.csv").write_text("pid,weight\n,1\n")
    with pytest.raises(PySparkException, match="'pid' holds no bigint.*nothing"):
        csv.read_csv_typed(spark, str(tmp_path / "b.csv"), TYPES).collect()


def test_csv_limit_and_folder(spark, tmp_path):
    (tmp_path / "a.csv").write_text("pid,weight\n3,1\n1,1\n")
    (tmp_path / "B.CSV").write_text("pid,weight\n2,1\n4,1\n")
    (tmp_path / "c.txt").write_text("no table\n")
    df = csv.read_csv_folder(spark, str(tmp_path), TYPES)
    assert sorted(r.pid for r in df.collect()) == [1, 2, 3, 4]
    first = csv.read_csv_typed(spark, str(tmp_path), TYPES, limit=2, order_by="pid", files=csv.CSV_FILES)
    assert [r.pid for r in first.collect()] == [1, 2]


def test_folder_with_different_headers_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("pid,weight\n3,1\n")
    (tmp_path / "b.csv").write_text("weight,pid\n2,1\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        csv.read_csv_folder(spark, str(tmp_path), TYPES).collect()


def enriched(spark):
    readings, visits, profiles = golden_inputs(spark)
    return enrich(sessionize(readings), visits, profiles)


def test_session_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "sessions")
    session_csv.write_session_csv(enriched(spark), path)
    assert spark.read.option("header", True).csv(path).columns == SESSION_CSV_COLUMNS
    back = session_csv.read_session_csv(spark, path)
    names = [*SESSION_CSV_COLUMNS, "session_start_ts"]
    written = enriched(spark).select(names).orderBy("datatime").collect()
    assert back.select(names).orderBy("datatime").collect() == written


def test_session_csv_per_session(spark, tmp_path):
    path = str(tmp_path / "sessions")
    chosen.export_csv(enriched(spark), path)
    assert [p.name for p in (tmp_path / "sessions").glob("session=*")] == ["session=1_1"]
    one = spark.read.option("header", True).csv(f"{path}/session=1_1")
    assert one.columns == SESSION_CSV_COLUMNS and one.count() == 4


def test_session_csv_with_day_first_dates(spark, tmp_path):
    header = ",".join(SESSION_CSV_COLUMNS)
    row = "7,2015-02-03 15:04:14+00:00,7_1,2/03/2011,112,52,37,14,0.75,0,70,68.2,68,36.3,F,1934,TRUE"
    (tmp_path / "s.csv").write_text(f"{header}\n{row}\n")
    got = session_csv.read_session_csv(spark, str(tmp_path / "s.csv")).first()
    assert got.first_dialysis_ts == datetime(2011, 3, 2)
    assert got.datatime == got.session_start_ts == datetime(2015, 2, 3, 15, 4, 14)
    assert got.DM is True and got.blood_flow == 0.0


def test_jsonl_sets_bad_lines_apart(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\nnot json\n\n{"a": 2, "b": "x"}\n{"a": "one"}\n')
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    read = jsonl.read_jsonl(spark, str(tmp_path / "a.jsonl"), schema)
    assert sorted(map(tuple, read.rows.collect())) == [(1, None), (2, "x")]
    assert {r.line for r in read.rejects.collect()} == {"not json", '{"a": "one"}'}


def test_jsonl_missing_file(spark, tmp_path):
    assert jsonl.read_jsonl(spark, str(tmp_path / "none.jsonl"), TELEMETRY) is None
    empty, rejects = jsonl.read_machine_jsonl(spark, str(tmp_path / "none.jsonl"))
    assert rejects.count() == 0
    assert empty.count() == 0 and "session_start_ts" in empty.columns


def test_machine_jsonl_starts_per_subject(spark, tmp_path):
    lines = [
        {"pid": 1, "datatime": "2024-01-01T00:00:00"},
        {"pid": 1, "datatime": "2024-01-05T01:00:00"},
        {"pid": 2, "datatime": "2024-01-02T01:00:00"},
    ]
    (tmp_path / "m.jsonl").write_text("\n".join(map(json.dumps, lines)))
    rows = jsonl.read_machine_jsonl(spark, str(tmp_path / "m.jsonl")).rows.orderBy("pid", "datatime").collect()
    assert [r.session_start_ts for r in rows] == [datetime(2024, 1, 1)] * 2 + [datetime(2024, 1, 2, 1)]
    assert [r.session_date for r in rows] == [date(2024, 1, 1)] * 2 + [date(2024, 1, 2)]


def test_payload_document(spark, tmp_path):
    documents = payload.payload_documents(serving_features(enriched(spark)))
    document = json.loads(documents.first().payload)
    assert document["parameters"] == {"session_id": "1_1", "part": "0"}
    assert [list(i) for i in document["instances"]] == [MODEL_FEATURES] * 3
    assert [i["avg_sbp"] for i in document["instances"]] == [115.0, 84.0, 128.0]
    assert document["instances"][0]["lag_1_avg_sbp"] is None
    chosen.export_payload(enriched(spark), str(tmp_path / "p"))
    read = payload.read_payload(spark, str(tmp_path / "p"))
    assert (read.first().session_id, read.first().part) == ("1_1", 0)
    rows = payload.payload_instances(read).collect()
    assert [(r.session_id, r.place, r.avg_sbp) for r in rows] == [("1_1", 0, 115.0), ("1_1", 1, 84.0), ("1_1", 2, 128.0)]


def test_integer_times_are_read_alike_everywhere(spark, tmp_path):
    ns, day = 1_704_067_200_000_000_000, datetime(2024, 1, 1)
    lines = [f'{{"pid":1,"datatime":{ns}}}', f'{{"pid":1,"datatime":"{ns}"}}', '{"pid":1,"datatime":"2024-01-01T00:00:00"}']
    (tmp_path / "t.jsonl").write_text("\n".join(lines))
    read = jsonl.read_jsonl(spark, str(tmp_path / "t.jsonl"), TELEMETRY)
    assert [r.datatime for r in read.rows.collect()] == [day] * 3 and read.rejects.count() == 0
    assert [r.datatime for r in jsonl.read_machine_jsonl(spark, str(tmp_path / "t.jsonl")).rows.collect()] == [day] * 3
    header = ",".join(SESSION_CSV_COLUMNS)
    row = f"7,{ns},7_1,1500000000000000,112,52,37,14,0.75,0,70,68.2,68,36.3,F,1934,TRUE"
    (tmp_path / "s.csv").write_text(f"{header}\n{row}\n")
    got = session_csv.read_session_csv(spark, str(tmp_path / "s.csv")).first()
    assert got.datatime == day and got.first_dialysis_ts == datetime(1970, 1, 18, 8, 40)


def test_whole_numbers_with_a_point_fit_integers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"pid":1,"sbp":110.0}\n{"pid":1.0,"sbp":111}\n{"pid":1,"sbp":110.5}\n{"pid":1,"datatime":"soon"}\n')
    rows, rejects = jsonl.read_machine_jsonl(spark, str(tmp_path / "a.jsonl"))
    assert sorted(r.sbp for r in rows.collect()) == [110, 111]
    assert {r.line for r in rejects.collect()} == {'{"pid":1,"sbp":110.5}', '{"pid":1,"datatime":"soon"}'}


@pytest.mark.parametrize(
    ("line", "said"),
    [('{"instances": [', "no payload"), ('{"instances": [{"DM": "perhaps"}]}', "field DM"), ('{"instances": [{"avg_sbp": "x"}]}', "no payload")],
)
def test_a_payload_that_does_not_fit_is_reported(spark, tmp_path, line, said):
    (tmp_path / "p.json").write_text(line)
    with pytest.raises(Exception, match=said):
        payload.payload_instances(payload.read_payload(spark, str(tmp_path / "p.json"))).collect()


def test_numbers_are_truth_values_in_payloads(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"instances": [{"DM": 1}, {"DM": 0}, {"DM": true}, {"DM": null}, {}]}')
    rows = payload.payload_instances(payload.read_payload(spark, str(tmp_path / "p.json"))).orderBy("place").collect()
    assert [r.DM for r in rows] == [True, False, True, None, None]


def test_long_sessions_take_several_documents(spark):
    parts = payload.payload_documents(serving_features(enriched(spark)), per_document=2).orderBy("part").collect()
    sizes = [[i["avg_sbp"] for i in json.loads(p.payload)["instances"]] for p in parts]
    assert sizes == [[115.0, 84.0], [128.0]]


def test_payload_defaults(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n  "parameters": {"x": 1}\n}')
    (tmp_path / "b.json").write_text("{}")
    read = payload.read_payload(spark, str(tmp_path), one_per_file=True)
    rows = read.collect()
    assert sorted(list(r.parameters.items()) for r in rows) == [[], [("x", "1")]]
    assert [r.instances for r in rows] == [[], []]
    assert payload.payload_instances(read).count() == 0


def test_instances_one_by_one(spark):
    rows = payload.instance_json(serving_features(enriched(spark))).collect()
    assert len(rows) == 3 and all(list(json.loads(r.instance)) == MODEL_FEATURES for r in rows)


def test_tables_are_replaced(spark, tmp_path):
    for n in (3, 5):
        source = str(tmp_path / f"source{n}")
        tables.write_parquet(spark.range(n), source)
        loaded = tables.load_table(spark, source, "replaced", str(tmp_path / f"table{n}"))
        assert tables.row_count(loaded).first().num_rows == n
    assert tables.read_table(spark, "replaced").count() == 5
    spark.sql("DROP TABLE replaced")


def test_nanosecond_parquet_is_read_as_integers(spark, tmp_path):
    moments = pa.array([1_704_067_200_000_000_000], pa.timestamp("ns"))
    table = pa.table({"pid": [1], "datatime": moments, "sbp": [100]})
    pq.write_table(table, tmp_path / "t.parquet", version="2.6")
    name = "spark.sql.legacy.parquet.nanosAsLong"
    spark.conf.set(name, SESSION_CONF[name])
    try:
        row = sessionize(spark.read.parquet(str(tmp_path / "t.parquet"))).first()
    finally:
        spark.conf.unset(name)
    assert row.datatime == datetime(2024, 1, 1)


def test_scratch_paths_lie_in_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_folder(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_shared_folder_is_the_session_s_or_beside_its_tables():
    conf = {"spark.sql.warehouse.dir": "file:/tables"}
    assert shared_folder(SimpleNamespace(conf=conf)) == "file:/tables/_scratch"
    assert shared_folder(SimpleNamespace(conf=conf | {"spark.checkpoint.dir": "hdfs:/shared/"})) == "hdfs:/shared"


def test_setup_from_csv(spark, tmp_path):
    raw = tmp_path / "csv"
    raw.mkdir()
    (raw / "idp.csv").write_text("pid,gender,birthday,first_dialysis,DM\n1,F,1980,2020-01-01,True\n")
    (raw / "d1.csv").write_text(
        "pid,keyindate,dialysisstart,dialysisend,weightstart,weightend,dryweight,temperature\n"
        "1,2024-01-01,08:00,24:30,70,69,68,36.5\n"
    )
    (raw / "vip.csv").write_text(
        "pid,datatime,measuretime,sbp,dbp,dia_temp_value,conductivity,uf,blood_flow,time\n"
        "1,2024-01-01T00:00:00,1,100,70,36.5,1.1,0.5,300,1\n"
    )
    setup.csv_to_parquet(spark, str(raw), str(tmp_path / "parquet"))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS raw_db LOCATION '{tmp_path / 'db'}'")
    names = {name: f"raw_db.{name}" for name in setup.RAW_TABLES}
    loaded = setup.parquet_to_tables(spark, str(tmp_path / "parquet"), names)
    assert {name: df.count() for name, df in loaded.items()} == dict.fromkeys(names, 1)
    visit = loaded["registration"].first()
    assert visit.dialysisend == datetime(2024, 1, 2, 0, 30)
    assert loaded["telemetry"].select(F.year("datatime")).first()[0] == 2024
    assert setup.read_raw(spark, str(raw), "telemetry", limit=0).count() == 0
    spark.sql("DROP DATABASE raw_db CASCADE")


def test_typed_csv_with_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "a.CSV").write_text('pid,note\n1,"one\ntwo"\n2,three\n')
    rows = csv.read_csv_folder(spark, str(tmp_path), {"pid": "bigint"}, multi_line=True).collect()
    assert sorted(map(tuple, rows)) == [(1, "one\ntwo"), (2, "three")]


def test_first_rows_have_missing_values_first(spark):
    rows = spark.createDataFrame([(2, "a"), (None, "b"), (1, "d"), (1, "c")], "pid bigint, name string")
    assert [r.name for r in tables.first_rows(rows, 3, ["pid", "name"]).collect()] == ["b", "c", "d"]
    assert tables.first_rows(rows, 3, []).count() == 3
    assert tables.first_rows(rows.limit(0), 3, ["pid"]).collect() == []
