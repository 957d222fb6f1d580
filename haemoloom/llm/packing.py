"""Packing by powers of two.

A document's ids are cut into full sequences and pieces whose lengths are the
binary digits of the rest. Each piece is a sequence of its own, and sequences of
one length form a bucket; so no sequence crosses documents and none is padded.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haemoloom.llm.common import lists, stored, text_or_empty, texts
from haemoloom.llm.encoder import encoder
from haemoloom.llm.token_files import END_ID, VOCABULARY

SEQUENCE_TOKENS = 4096

#: Tasks whose pieces are numbered together.
PARTS_TOGETHER = 1000

_SCHEMA = (
    "doc_id long, start long, length long, doc_tokens long, part int, place long, ids array<int>"
)


def piece_lengths(n: int, most: int = SEQUENCE_TOKENS) -> list[int]:
    """Lengths of the pieces of ``n`` ids, longest first; ``most`` is a power of two."""
    rest = n % most
    return [most] * (n // most) + [1 << b for b in range(most.bit_length() - 1, -1, -1) if rest >> b & 1]


def _pieces(path: str, end: int, most: int):
    def cut(batches):
        seen = dict.fromkeys((1 << b for b in range(most.bit_length())), 0)
        for batch in batches:
            ids, parts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = []
            for doc_id, part, text in zip(ids, parts, texts(batch.column(2))):
                found, start = encoder(path).ids(text, end), 0
                for length in piece_lengths(len(found), most):
                    rows.append((doc_id, start, length, len(found), part, seen[length], found[start : start + length]))
                    seen[length] += 1
                    start += length
            columns = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)] + [lists(list(columns[6]), pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "doc_tokens", "part", "place", "ids"])

    return cut


def pack(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
    sequence_tokens: int = SEQUENCE_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``doc_tokens``, ``sequence_id``, ``offset``, ``ids``.

    ``sequence_id`` numbers sequences without gaps, longest bucket first. A NULL
    text is empty and is one piece that holds ``end_id`` alone; NULL or repeated ids
    are kept as they are, each row being a document. Other columns are not looked
    at. An empty table has no pieces.
    """
    if sequence_tokens & (sequence_tokens - 1):
        raise ValueError("sequence_tokens must be a power of two")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.spark_partition_id().alias("part"), text_or_empty(text_col).alias("text")
    )
    pieces = stored(rows.mapInArrow(_pieces(vocabulary, end_id, sequence_tokens), _SCHEMA), "pieces")
    # One count per bucket and task. They are numbered in groups of tasks: first the
    # groups among one another, then the tasks inside theirs, so no task orders all
    # counts. Pieces are joined to them as their sizes suggest.
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = stored(counts.withColumn("group", F.call_function("div", F.col("part"), F.lit(PARTS_TOGETHER))), "piece-counts")
    before = lambda window: F.coalesce(F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = counts.groupBy("length", "group").agg(F.sum("n").alias("n"))
    groups = groups.select("length", "group", before(Window.orderBy(F.desc("length"), "group")).alias("of_groups"))
    inside = before(Window.partitionBy("length", "group").orderBy("part"))
    firsts = counts.withColumn("of_parts", inside).join(groups, ["length", "group"])
    firsts = firsts.select("length", "part", (F.col("of_groups") + F.col("of_parts")).alias("before"))
    return pieces.join(firsts, ["length", "part"]).select(
        "doc_id",
        "start",
        "length",
        "doc_tokens",
        (F.col("before") + F.col("place")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        "ids",
    )
