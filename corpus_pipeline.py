"""A corpus for training from raw documents, in five stages that are each stored."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haemoloom.llm import exact_dedup, line_rules, near_dedup, packing, personal_data
from haemoloom.llm.common import stored


def _recounted(before: DataFrame, after: DataFrame) -> DataFrame:
    """``after`` with ``n_chars`` of its texts as they are now, if ``before`` had that column."""
    if "n_chars" not in before.columns:
        return after
    return after.withColumn("n_chars", F.length("text").cast(before.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that too many documents of their source share."""
    return _recounted(docs, line_rules.clean_documents(docs))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of equal texts."""
    return exact_dedup.without_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.without_near_duplicates(docs)


def personal_data_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the kind of each piece of personal data in its place."""
    return _recounted(docs, personal_data.redact(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, of a power of two ids each."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_duplicates),
    ("near dedup", near_duplicates),
    ("personal data", personal_data_removed),
    ("packing", packed),
]

#: Shingle similarity and BPE are beyond SQL; the tests rebuild each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``; each result is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "corpus-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
