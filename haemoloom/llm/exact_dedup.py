"""Exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed number of bytes. Distinct blocks are sorted
and numbered; the number is the block's name. Then adjacent names are paired and
the distinct pairs named in the same way, until each document has one name. Two
documents have the same name at the same level exactly when their texts are equal.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haemoloom.llm.common import SPACE, stored, text_or_empty

BLOCK_BYTES = 8192

#: Names are numbered inside this many hash buckets; a bucket is the unit of sorting.
NAME_BUCKETS = 1 << 16

#: Stands for the missing right half of a pair.
NO_NAME = -1


def block_print(block: Column) -> Column:
    """128 bits that route a block to its name. Blocks that share them are told apart by content."""
    return F.struct(F.xxhash64(block).alias("h1"), F.xxhash64(F.lit("second"), block).alias("h2"))


def _blocks(body: Column, size: int) -> Column:
    """The blocks of ``body``. The array around it keeps it from being computed for each block."""
    cut = F.transform(
        F.array(body),
        lambda b: F.transform(
            F.sequence(F.lit(0), F.greatest(F.ceil(F.length(b) / size).cast("int") - 1, F.lit(0))),
            lambda i: F.substring(b, i * size + 1, F.lit(size)),
        ),
    )
    return cut[0]


def _named(keys: DataFrame) -> DataFrame:
    """Distinct ``keys``, sorted and numbered, with the number in ``name``."""
    bucket = F.pmod(F.xxhash64(*keys.columns), F.lit(NAME_BUCKETS))
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(*keys.columns))
    numbered = keys.withColumn("bucket", bucket).withColumn("rank", rank.cast("long") - 1)
    return numbered.select(*keys.columns, (F.col("bucket") + NAME_BUCKETS * F.col("rank")).alias("name"))


def _base(docs, id_col, text_col, block_bytes, print_of, carry, with_blocks) -> DataFrame:
    """One stored row per row of ``docs``: its number, id, digest and the prints (or contents) of its blocks."""
    body = F.regexp_replace(text_or_empty(text_col), SPACE + "+", " ").cast("binary")
    whole = [F.struct(*[F.col(c) for c in docs.columns]).alias("doc")] if carry else []
    blocks = _blocks(body, block_bytes)
    prints = F.transform(blocks, lambda b: F.struct(print_of(b).alias("print"), b.alias("block")) if with_blocks else print_of(b))
    return stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("doc_id"),
            F.sha2(body, 256).alias("text_sha256"),
            prints.alias("prints"),
            *whole,
        ),
        "exact-base",
    )


def _identities(base: DataFrame, keys: DataFrame, key: Column, names: list[str]) -> DataFrame:
    """``row``, ``level`` and ``name`` of each document; ``keys`` are the distinct keys of blocks."""
    places = base.select("row", F.size("prints").alias("n"), F.posexplode("prints").alias("pos", "place"))
    chain = places.select("row", "n", "pos", key.alias("key")).join(
        _named(keys).select(F.struct(*names).alias("key"), "name"), "key"
    )
    chain = stored(chain.drop("key"), "exact-names")
    most = base.agg(F.max(F.size("prints"))).first()[0] or 1
    done, level = [], 0
    while True:
        done.append(chain.filter("n = 1").select("row", F.lit(level).alias("level"), "name"))
        if most == 1:
            break
        half = F.col("pos") % 2
        pairs = chain.filter("n > 1").groupBy("row", "n", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
            F.max(F.when(half == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(half == 1, F.col("name"))), F.lit(NO_NAME).cast("long")).alias("right"),
        )
        named = pairs.join(_named(pairs.select("left", "right").distinct()), ["left", "right"])
        shorter = named.select("row", F.ceil(F.col("n") / 2).cast("int").alias("n"), "pos", "name")
        chain, most, level = stored(shorter, "exact-names"), (most + 1) // 2, level + 1
    identities = done[0]
    for more in done[1:]:
        identities = identities.union(more)
    return identities


def name_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    print_of: Callable[[Column], Column] = block_print,
    carry: bool = False,
) -> tuple[DataFrame, DataFrame | None]:
    """Each row of ``docs`` with its identity: ``row``, ``doc_id``, ``text_sha256``, ``level``, ``name``.

    Contents of blocks are shuffled once, without repeats; documents carry the
    prints of their blocks. If two contents share a print, which 128 bits make all
    but impossible, blocks are named by print and content instead. With ``carry``, the
    second result has each ``row`` with its whole input row in ``doc``. NULL texts count as empty; an empty
    text is one empty block.
    """
    base = _base(docs, id_col, text_col, block_bytes, print_of, carry, False)
    body = F.regexp_replace(text_or_empty("text"), SPACE + "+", " ").cast("binary")
    source = base.select("doc." + text_col) if carry else docs.select(F.col(text_col).alias("text"))
    blocks = source.toDF("text").select(F.explode(_blocks(body, block_bytes)).alias("block"))
    contents = blocks.select(print_of(F.col("block")).alias("print"), "block").distinct()
    prints = stored(contents.groupBy("print").agg(F.count("*").alias("contents")), "exact-prints")
    if prints.filter("contents > 1").isEmpty():
        identities = _identities(base, prints.select("print.*"), F.col("place"), ["h1", "h2"])
    else:
        base = _base(docs, id_col, text_col, block_bytes, print_of, carry, True)
        keys = base.select(F.explode("prints").alias("place")).select("place.print.h1", "place.print.h2", "place.block").distinct()
        key = F.struct(F.col("place.print.h1").alias("h1"), F.col("place.print.h2").alias("h2"), F.col("place.block").alias("block"))
        identities = _identities(base, keys, key, ["h1", "h2", "block"])
    named = base.drop("prints", "doc").join(identities, "row")
    return named, base.select("row", "doc") if carry else None


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are identical after each run of white space became
    one space. The row with the smallest id of a group stays; a NULL id comes after
    all others, and of rows with equal text and id the first read stays. Other
    columns are not looked at. An empty table gives an empty result.
    """
    return _judged(name_documents(docs, id_col, text_col, **options)[0]).drop("row")


def _judged(named: DataFrame) -> DataFrame:
    named = stored(named, "exact-named")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), "row")
    # Stored, so that the join meets one row per group and can split a hot one.
    groups = named.groupBy("level", "name").agg(F.min(order).alias("first"), F.count("*").alias("group_size"))
    groups = stored(groups, "exact-groups")
    return named.join(groups, ["level", "name"]).select(
        "row",
        "doc_id",
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
    )


def without_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    named, whole = name_documents(docs, id_col, text_col, carry=True)
    return whole.join(_judged(named).filter("kept").select("row"), "row").select("doc.*")
