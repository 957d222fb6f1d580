"""Steps that the operators share: stored intermediate tables and Arrow columns."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haemoloom.runtime import scratch_path

#: White space between words, in every contract of this package.
SPACE = r"[\x20\x09-\x0D]"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: it cuts lineage and is computed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def text_keys(text: Column) -> list[Column]:
    """128 bits of a text, as columns ``h1`` and ``h2``."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2")]


def byte_texts(column: pa.Array) -> list[bytes]:
    """Whole texts as UTF-8; NULL is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    """Whole texts; NULL is empty."""
    return [x or "" for x in column.to_pylist()]


def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """One list per array."""
    ends = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(x) for x in parts], out=ends[1:])
    values = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))
