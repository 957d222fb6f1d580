"""Compare registered queries with their SQL on the same tables.

Usage: python -m checks.compare SF_DIR [NAME ...]
"""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks import oracle, spark_queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def lines(frame: pd.DataFrame) -> list[tuple]:
    """Rows as text in sorted order, with columns in name order."""
    frame = frame[sorted(frame.columns)]
    cells = {}
    for name in frame.columns:
        column = frame[name]
        if pd.api.types.is_datetime64_any_dtype(column):
            column = column.astype("datetime64[us]")
        cells[name] = [
            "" if pd.isna(v) else repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
            for v in column.tolist()
        ]
    return sorted(zip(*cells.values()))


def difference(spark: SparkSession, db, sf_dir: str, name: str) -> str | None:
    """None when both sides agree, else what differs first."""
    left = spark_queries.queries()[name](spark, sf_dir)
    right = db.sql(oracle.oracle_sql()[name]).df()
    if sorted(left.columns) != sorted(right.columns):
        return f"columns {sorted(left.columns)} != {sorted(right.columns)}"
    ours, theirs = lines(left.toPandas()), lines(right)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)} rows"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} rows differ, first: {wrong[0]}" if wrong else None


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    failed = 0
    for name in names or list(spark_queries.queries()):
        begin = time.time()
        try:
            if name in oracle.oracle_sql():
                found = difference(spark, db, sf_dir, name)
                verdict = found or "same"
                failed += found is not None
            else:
                verdict = f"{spark_queries.queries()[name](spark, sf_dir).count()} rows, no SQL"
        except Exception as error:  # report and go on with the next query
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
            failed += 1
        print(f"{name:32s} {time.time() - begin:6.1f}s  {verdict}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
