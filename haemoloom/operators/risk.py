"""Risk per session from scored bins."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def session_risk(scored: DataFrame) -> DataFrame:
    """High risk when any bin of the session is predicted as ``"1"``."""
    return (
        scored.groupBy("session_id")
        .agg(F.bool_or(F.coalesce(F.col("predicted_label") == "1", F.lit(False))).alias("high_risk"))
        .withColumn("risk", F.when(F.col("high_risk"), "High").otherwise("Low"))
    )


def class_weights(rows: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("class_rows"))
    all_classes = Window.partitionBy()  # one row per class
    share = F.sum("class_rows").over(all_classes) / F.count(F.lit(1)).over(all_classes)
    return counts.withColumn("class_weight", share / F.col("class_rows"))
