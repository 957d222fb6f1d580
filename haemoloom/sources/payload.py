"""Scoring payloads: ``{"instances": [...], "parameters": {...}}`` documents, or one instance a line."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haemoloom.schemas import INSTANCE, MODEL_FEATURES
from haemoloom.sources.jsonl import BAD, as_text, typed

_KEEP_NULLS = {"ignoreNullFields": "false"}

_RAW = T.StructType([
    T.StructField("instances", T.ArrayType(as_text(INSTANCE))),
    T.StructField("parameters", T.MapType(T.StringType(), T.StringType())),
    T.StructField(BAD, T.StringType()),
])


def instance() -> Column:
    """The model inputs as one struct, in payload order and types."""
    return F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in INSTANCE])


def _time_order(features: DataFrame) -> str:
    return "time_bin" if "time_bin" in features.columns else "minutes_into_session"


def instance_json(features: DataFrame) -> DataFrame:
    """One JSON object per feature row, for bulk scoring, with its session and its place in time."""
    return features.select("session_id", _time_order(features), F.to_json(instance(), _KEEP_NULLS).alias("instance"))


def payload_documents(features: DataFrame, per_document: int | None = None) -> DataFrame:
    """Payload documents per session, with instances in time order.

    A session is one document, so it must fit a row; ``per_document`` cuts it into
    ``part`` 0, 1 and so on of that many instances. Documents name their session
    and part among their parameters.
    """
    order = _time_order(features)
    # With the subject, the features' own partitioning serves again.
    keys = [c for c in features.columns if c.lower() in ("pid", "session_id")]
    place = F.row_number().over(Window.partitionBy(keys).orderBy(order))
    part = F.call_function("div", F.col("place") - 1, F.lit(per_document)) if per_document else F.lit(0)
    named = F.create_map(F.lit("session_id"), F.col("session_id"), F.lit("part"), F.col("part").cast("string"))
    instances = F.transform("placed", lambda row: row["instance"])
    return (
        features.select(*keys, place.alias("place"), instance().alias("instance"))
        .withColumn("part", part.cast("bigint"))
        .groupBy(*keys, "part")
        .agg(F.sort_array(F.collect_list(F.struct("place", "instance"))).alias("placed"))
        .select(
            "session_id",
            "part",
            F.to_json(F.struct(instances.alias("instances"), named.alias("parameters")), _KEEP_NULLS).alias("payload"),
        )
    )


def write_payload(documents: DataFrame, path: str) -> None:
    """Write payload documents, one per line, replacing what ``path`` holds."""
    documents.select("payload").write.mode("overwrite").text(path)


def read_payload(spark: SparkSession, path: str, one_per_file: bool = False) -> DataFrame:
    """Payload documents as ``instances`` (an array), ``parameters`` (a map), ``session_id`` and ``part``.

    All may be absent from a document; the first two are then empty. Documents are
    one per line, or ``one_per_file`` over any number of lines. A document that is
    no JSON, and a value that does not fit its field, raise and say which.
    """
    lines = spark.read.text(path, wholetext=one_per_file).filter(F.trim("value") != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    read = lines.select("value", F.from_json("value", _RAW, options).alias("document"))
    broken = F.raise_error(F.concat(F.lit("this is no payload: "), F.left("value", F.lit(200))))

    def converted(row: Column) -> Column:
        values = []
        for field in INSTANCE:
            value = typed(row, field)
            unfit = F.concat(F.lit(f"field {field.name} of a payload holds no {field.dataType.simpleString()}: "), row[field.name].cast("string"))
            values.append(F.when(value.isNull() & row[field.name].isNotNull(), F.raise_error(unfit)).otherwise(value).alias(field.name))
        return F.struct(*values)

    whole = F.when(F.col(f"document.{BAD}").isNotNull(), broken).otherwise(F.col("document.instances"))
    parameters = F.coalesce("document.parameters", F.create_map().cast("map<string,string>"))
    instances = F.transform(F.coalesce(whole, F.array().cast(T.ArrayType(as_text(INSTANCE)))), converted)
    return read.select(
        instances.alias("instances"),
        parameters.alias("parameters"),
        parameters["session_id"].alias("session_id"),
        parameters["part"].cast("bigint").alias("part"),
    )


def payload_instances(payload: DataFrame) -> DataFrame:
    """One row per instance: its session, part and place, and the model inputs as columns."""
    rows = payload.select("session_id", "part", F.posexplode("instances").alias("place", "row"))
    return rows.select("session_id", "part", "place", *[f"row.{c}" for c in MODEL_FEATURES])
