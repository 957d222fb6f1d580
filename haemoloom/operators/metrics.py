"""Quality metrics of a binary classifier, as one aggregation over scored rows.

Scores are first counted per distinct value, which shrinks the data before any
ordering. The area under the ROC curve is the exact rank statistic: for every
distinct score, the negatives below it plus half of the negatives at it. The
running count of negatives is built in two levels, over a number of score bands
and then inside each band, so no task orders all scores. The counts are stored in
the shared folder, so rows are scored once.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haemoloom.runtime import scratch_path

# Score bands; with more distinct scores, more bands keep each of them small.
BANDS = 512
_SMALLEST = 1e-15  # keeps the logarithm of a score of 0 or 1 finite


def score_counts(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Positives and negatives per distinct score."""
    return (
        scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(
            F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("positives"),
            F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("negatives"),
        )
    )


def negatives_below(counts: DataFrame, bands: int = BANDS) -> DataFrame:
    """Add the number of negatives with a lower score."""
    cuts = [i / bands for i in range(1, bands)]
    edges = counts.agg(F.percentile_approx("score", cuts, 10 * bands).alias("edges"))
    band = F.size(F.filter("edges", lambda edge: edge < F.col("score")))
    # Never NULL, so that no null check on it is pushed below the counting.
    banded = counts.withColumn("edges", edges.scalar()).select(
        "score", "positives", "negatives", F.coalesce(band, F.lit(0)).alias("band")
    )
    # One row per band, so this window is small by construction.
    in_order = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        banded.groupBy("band")
        .agg(F.sum("negatives").alias("band_negatives"))
        .select("band", F.coalesce(F.sum("band_negatives").over(in_order), F.lit(0)).alias("before_band"))
    )
    inside = Window.partitionBy("band").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    return (
        banded.join(before, "band")
        .withColumn("below", F.col("before_band") + F.coalesce(F.sum("negatives").over(inside), F.lit(0)))
        .drop("band", "before_band")
    )


def evaluate(
    scored: DataFrame, label: str = "label", score: str = "score", cutoff: float = 0.5, bands: int = BANDS
) -> DataFrame:
    """One row: precision, recall, accuracy, f1_score, log_loss and roc_auc.

    ``score`` is the probability of class 1; a row counts as predicted positive
    from ``cutoff`` on. A metric without a denominator is NULL.
    """
    path = scratch_path(scored.sparkSession, "score-counts")
    score_counts(scored, label, score).write.parquet(path)
    ranked = negatives_below(scored.sparkSession.read.parquet(path), bands)
    hit = F.col("score") >= F.lit(cutoff)
    p = F.greatest(F.least(F.col("score"), F.lit(1.0 - _SMALLEST)), F.lit(_SMALLEST))
    sums = ranked.agg(
        F.sum(F.when(hit, F.col("positives")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("negatives")).otherwise(0)).alias("fp"),
        F.sum("positives").alias("p"),
        F.sum("negatives").alias("n"),
        F.sum(-(F.col("positives") * F.log(p) + F.col("negatives") * F.log(1 - p))).alias("loss"),
        F.sum(F.col("positives") * (F.col("below") + F.col("negatives") / 2.0)).alias("rank_sum"),
    )
    tp, fp, pos, neg = (F.col(c) for c in ("tp", "fp", "p", "n"))
    return sums.select(
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, pos).alias("recall"),
        F.try_divide(tp + neg - fp, pos + neg).alias("accuracy"),
        F.try_divide(2 * tp, 2 * tp + fp + (pos - tp)).alias("f1_score"),
        F.try_divide(F.col("loss"), pos + neg).alias("log_loss"),
        F.try_divide(F.col("rank_sum"), pos.cast("double") * neg).alias("roc_auc"),
    )


def rounded(metrics: DataFrame, digits: int = 4) -> DataFrame:
    """Numeric columns rounded for display."""
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    return metrics.select(
        *[F.round(c, digits).alias(c) if kind in numeric else F.col(c) for c, kind in metrics.dtypes]
    )
