"""Documents as token ids in Parquet files that are read selectively.

Rows are sorted by id across files. Ids are lists with dictionary encoding, the
other columns are delta encoded, row groups and pages have set sizes, and Spark's
writer adds a page index; so a reader of few documents or of metadata alone skips
the rest.
"""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haemoloom.llm.common import lists, text_or_empty, texts
from haemoloom.llm.encoder import encoder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2

#: Bytes of a row group and of a page, and rows of a page at most.
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 4096

_SCHEMA = "doc_id long, part int, start_in_part long, n_tokens long, ids array<int>"


def _encoded(path: str, end: int):
    def encode(batches):
        running = 0
        for batch in batches:
            found = [encoder(path).ids(t, end) for t in texts(batch.column(2))]
            counts = np.array([len(x) for x in found], np.int64)
            starts = running + np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64) if len(counts) else counts
            running += int(counts.sum())
            columns = [batch.column(0), batch.column(1), pa.array(starts), pa.array(counts), lists(found, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "start_in_part", "n_tokens", "ids"])

    return encode


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    partitions: int | None = None,
) -> None:
    """Write the ids of each whole text, and ``end_id`` after them, in ascending order of id.

    A NULL text is empty. Rows with NULL id come first; rows with one id are ordered
    by their text and all written. An empty table gives files without rows.
    Columns other than the two named are not written.
    """
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    dealt = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    encoded = dealt.select("doc_id", F.spark_partition_id().alias("part"), "text").mapInArrow(
        _encoded(vocabulary, end_id), _SCHEMA
    )
    writer = encoded.write.option("parquet.writer.version", "PARQUET_2_0").option("compression", "zstd")
    for column in ("doc_id", "part", "start_in_part", "n_tokens"):
        writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
    (
        writer.option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .parquet(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids``; ``start`` counts the ids of all documents before.

    Starts come from the metadata columns: one sum per written partition, so the
    running sum over them has as many rows as there are files. That number, which
    the writer is told, bounds what is broadcast; ids are not shuffled.
    """
    files = spark.read.schema(_SCHEMA).parquet(path)
    sums = files.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = F.coalesce(F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select("part", before.alias("before"))
    return files.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("before") + F.col("start_in_part")).alias("start"), "n_tokens", "ids"
    )


def with_crc32(df: DataFrame, ids: str = "ids") -> DataFrame:
    """``df`` with its last column, the token ids, replaced by their CRC-32 as ``ids_crc32`` and counted as ``n_ids``.

    The sum is unsigned and runs over little-endian unsigned 32-bit integers.
    """
    keep = [c for c in df.columns if c != ids]
    fields = {f.name: f for f in df.schema.fields}
    schema = ", ".join(f"`{c}` {fields[c].dataType.simpleString()}" for c in keep) + ", n_ids long, ids_crc32 long"

    def digest(batches):
        for batch in batches:
            column = batch.column(len(keep))
            values = column.values.to_numpy(zero_copy_only=False).astype("<u4")
            ends = column.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
            columns = [batch.column(i) for i in range(len(keep))]
            columns += [pa.array(np.diff(ends).astype(np.int64)), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "n_ids", "ids_crc32"])

    return df.select(*keep, ids).mapInArrow(digest, schema)
