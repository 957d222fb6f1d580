"""From session CSV files or payloads to the risk of each session."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from haemoloom.operators.risk import session_risk
from haemoloom.plans.classifier import predict
from haemoloom.plans.features import serving_features
from haemoloom.sources.payload import payload_instances, read_payload
from haemoloom.sources.session_csv import read_session_csv


def risk_of_sessions(enriched: DataFrame, model: PipelineModel) -> DataFrame:
    """Risk per session of readings that carry registration and demographics."""
    return session_risk(predict(model, serving_features(enriched)))


def risk_from_payload(spark: SparkSession, path: str, model: PipelineModel, one_per_file: bool = False) -> DataFrame:
    """Risk of every session whose payload documents lie at ``path``."""
    return session_risk(predict(model, payload_instances(read_payload(spark, path, one_per_file))))


def risk_from_csv(spark: SparkSession, path: str, model: PipelineModel) -> DataFrame:
    """Risk of every session in the CSV file or folder at ``path``."""
    return risk_of_sessions(read_session_csv(spark, path), model)
