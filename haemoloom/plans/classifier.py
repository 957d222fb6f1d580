"""Boosted-tree classifier of upcoming hypotension, on Spark ML."""

import re

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haemoloom.operators.metrics import evaluate
from haemoloom.operators.risk import class_weights
from haemoloom.runtime import use_checkpoints
from haemoloom.schemas import MODEL_FEATURES

# Default hyper-parameters of the boosted trees.
ROUNDS = 20
LEARNING_RATE = 0.3
TREE_DEPTH = 6

_CATEGORY = "gender"
_VALUES = [c for c in MODEL_FEATURES if c != _CATEGORY]


def model_inputs(features: DataFrame, label: str | None = "label") -> DataFrame:
    """The model's input columns, with the label if there is one."""
    return features.select(*MODEL_FEATURES, *([label] if label else []))


def train_rows(features: DataFrame) -> DataFrame:
    return features.filter(F.col("dataset_split") == "TRAIN")


def test_rows(features: DataFrame) -> DataFrame:
    return features.filter(F.col("dataset_split") == "TEST")


def _stages(**options) -> list:
    # Missing values become 0 next to a flag, so that trees can tell them apart.
    filled = ", ".join(
        f"coalesce(cast(`{c}` as double), 0D) AS `{c}__value`, cast(`{c}` IS NULL as double) AS `{c}__missing`"
        for c in _VALUES
    )
    trees = {"maxIter": ROUNDS, "stepSize": LEARNING_RATE, "maxDepth": TREE_DEPTH, "seed": 17, **options}
    return [
        SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"),
        StringIndexer(inputCol=_CATEGORY, outputCol=f"{_CATEGORY}__value", handleInvalid="keep"),
        VectorAssembler(
            inputCols=[f"{c}__value" for c in MODEL_FEATURES] + [f"{c}__missing" for c in _VALUES],
            outputCol="inputs__vector",
        ),
        GBTClassifier(
            featuresCol="inputs__vector",
            labelCol="label__double",
            weightCol="class_weight",
            # Walking a row down from the root costs less than keeping its node: trees are shallow.
            cacheNodeIds=False,
            checkpointInterval=5,
            **trees,
        ),
    ]


def train(features: DataFrame, balanced: bool = True, **options) -> PipelineModel:
    """Fit the classifier on the TRAIN rows of ``features``.

    ``features`` should be a stored table: fitting reads it several times.
    ``options`` override the tree parameters.
    """
    use_checkpoints(features.sparkSession)
    rows = model_inputs(train_rows(features)).filter(F.col("label").isin(0, 1))
    rows = rows.withColumn("label__double", F.col("label").cast("double"))
    if balanced:
        # Two classes, so two rows: this side cannot grow with the data.
        weights = F.broadcast(class_weights(rows).select("label", "class_weight"))
        rows = rows.join(weights, "label")
    else:
        rows = rows.withColumn("class_weight", F.lit(1.0))
    return Pipeline(stages=_stages(**options)).fit(rows)


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Add ``predicted_label`` (text) and the probabilities of both classes."""
    scores = vector_to_array("probability")
    scored = (
        model.transform(features)
        .withColumn("predicted_label", F.col("prediction").cast("int").cast("string"))
        .withColumn("probability_0", scores[0])
        .withColumn("probability_1", scores[1])
    )
    return scored.select(*features.columns, "predicted_label", "probability_0", "probability_1")


def evaluate_model(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Quality on the TEST rows of ``features``."""
    return evaluate(predict(model, test_rows(features)), "label", "probability_1")


def feature_importance(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """Global importance of each model input; a missing-value flag counts to its input."""
    columns = model.stages[2].getInputCols()
    weights = model.stages[-1].featureImportances.toArray()
    total = dict.fromkeys(MODEL_FEATURES, 0.0)
    for column, weight in zip(columns, weights):
        total[re.sub("__(value|missing)$", "", column)] += float(weight)
    return spark.createDataFrame(list(total.items()), "feature string, importance double")


def export_model(model: PipelineModel, path: str) -> None:
    """Save the model, replacing what ``path`` holds."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
