"""Training run: sessions, features, model, quality."""

from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from haemoloom.plans.classifier import evaluate_model, export_model, train
from haemoloom.plans.tables import create_features_table, create_sessionized_table
from haemoloom.runtime import use_utc
from haemoloom.settings import Settings


# The published default names of the tables.
class TableNames(NamedTuple):
    telemetry: str = "real_time_machine_data"
    registration: str = "registration_data"
    demographics: str = "patient_demographics"
    sessionized: str = "sessionized_machine_data"
    features: str = "training_features"


def build_tables(spark: SparkSession, names: TableNames = TableNames(), settings: Settings = Settings()) -> DataFrame:
    """Replace the sessionized and the features table; returns the features."""
    use_utc(spark)
    sessionized = create_sessionized_table(spark.table(names.telemetry), names.sessionized, settings)
    return create_features_table(
        sessionized, spark.table(names.registration), spark.table(names.demographics), names.features, settings
    )


def train_and_export(
    spark: SparkSession,
    model_path: str,
    names: TableNames = TableNames(),
    settings: Settings = Settings(),
    skip_features: bool = False,
    **options,
) -> tuple[PipelineModel, DataFrame]:
    """Fit on TRAIN, save the model, and return it with its quality on TEST.

    ``skip_features`` trains on the features table as it is.
    """
    features = spark.table(names.features) if skip_features else build_tables(spark, names, settings)
    model = train(features, **options)
    export_model(model, model_path)
    return model, evaluate_model(model, features)
