"""Quality rules on lines that many documents share.

Lines are normalised and hashed, and the distinct documents of each host that
hold a line are counted. Lines above the limit are boilerplate: they are removed,
and a document of which little is left is rejected.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haemoloom.llm.common import SPACE, byte_texts, stored, text_keys, text_or_empty

#: A line is boilerplate in a host if more distinct documents than both hold it.
LEAST_DOCUMENTS = 20
HOST_SHARE = 0.10

#: Percent of a document's words that must be left.
LEAST_LEFT = 30

#: Base rules.
LEAST_WORDS = 20
MOST_REPEATED = 30
WINDOW = 8
SYMBOLS = b"#*$%&|<>"

_SPACES = b" \t\n\x0b\x0c\r"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: The seed of Spark's xxhash64, so that both sides name lines alike.
_SEED = 42

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_LINES = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())]))
_SCHEMA = (
    "row long, doc_id long, host string, h1 long, h2 long, "
    + ", ".join(f"{c} long" for c in _COUNTS)
    + ", lines array<struct<line: long, words: long>>"
)


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words (a power of two) that occur twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.uint64, len(words))
    # Equal windows have equal sums; when all sums differ, no window repeats.
    mixed = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    total = np.zeros(n, np.uint64)
    for i in range(window):
        total = total * np.uint64(0xBF58476D1CE4E5B9) + mixed[i : i + n]
    if len(np.unique(total)) == n:
        return 0
    width = 1
    while width < window:
        pairs = ids[:-width] * np.uint64(len(words)) + ids[width:]
        ids = np.unique(pairs, return_inverse=True)[1].astype(np.uint64)
        width *= 2
    starts = np.flatnonzero(np.bincount(ids.astype(np.int64))[ids.astype(np.int64)] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def _measured(text: bytes) -> tuple[list[int], list[dict]]:
    """The base counts of a text, and its distinct normalised lines with the words they hold."""
    words = text.split()
    chars = np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    blanks = len(text) - len(text.translate(None, _SPACES))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    seen, repeats, lines = set(), 0, {}
    for raw in text.split(b"\n"):
        held = raw.split()
        if held:
            repeats += raw in seen
            seen.add(raw)
            line = b" ".join(held).lower()
            lines[line] = lines.get(line, 0) + len(held)
    counts = [len(words), int(chars) - blanks, symbols, repeats, repeated_words(words)]
    named = [{"line": _signed(xxhash.xxh64_intdigest(k, _SEED)), "words": v} for k, v in lines.items()]
    return counts, named


def _measure(batches):
    for batch in batches:
        found = [_measured(t) for t in byte_texts(batch.column(5))]
        columns = [batch.column(i) for i in range(5)]
        columns += [pa.array([counts[i] for counts, _ in found], pa.int64()) for i in range(len(_COUNTS))]
        columns += [pa.array([lines for _, lines in found], _LINES)]
        yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "host", "h1", "h2", *_COUNTS, "lines"])


def frequent_lines(measured: DataFrame, least_documents: int, host_share: float) -> DataFrame:
    """``host`` and ``line`` of the boilerplate. Copies of a text are one document."""
    places = measured.select("host", "h1", "h2", F.explode("lines.line").alias("line"))
    counts = places.distinct().groupBy("host", "line").agg(F.count("*").alias("documents"))
    counts = counts.filter(F.col("documents") > least_documents)
    hosts = measured.select("host", "h1", "h2").distinct().groupBy("host").agg(F.count("*").alias("of_host"))
    return counts.join(hosts, "host").filter(F.col("documents") > host_share * F.col("of_host")).select("host", "line")


def _judged(rows: DataFrame, least_documents: int, host_share: float, least_left: int) -> DataFrame:
    """Counts and verdict of each of ``rows`` (row, doc_id, host, h1, h2, text); ``removed`` lists its boilerplate."""
    measured = stored(rows.mapInArrow(_measure, _SCHEMA), "lines")
    places = measured.select("row", "host", F.explode("lines").alias("held")).select("row", "host", "held.*")
    removed = (
        places.join(frequent_lines(measured, least_documents, host_share), ["host", "line"])
        .groupBy("row")
        .agg(F.sum("words").alias("removed_words"), F.collect_list(F.struct("line", "words")).alias("removed"))
    )
    n, gone = F.col("n_words"), F.coalesce(F.col("removed_words"), F.lit(0))
    failed = (n < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * n)
    return measured.drop("lines").join(removed, "row", "left").select(
        "doc_id", "host", "h1", "h2", *_COUNTS,
        failed.alias("base_failed"),
        (~failed & (100 * (n - gone) >= least_left * n)).alias("kept"),
        "removed_words",
        "removed",
    )


def _spared(judged: DataFrame, least_documents: int, host_share: float, least_left: int) -> DataFrame:
    """One document for each set of lines that only its own copies make frequent: ``doc_id``, ``host``, ``h1``, ``h2``, ``removed``.

    A frequent line is shared if it is frequent too among the documents that have
    enough left without their frequent lines. A document that has too little left, but
    enough without its shared lines, is a copy; the first of the copies with the same
    other lines is spared and loses its shared lines only.
    """
    text = ["host", "h1", "h2"]
    depleted = F.col("removed").isNotNull() & (100 * (F.col("n_words") - F.col("removed_words")) < least_left * F.col("n_words"))
    texts = judged.select(*text, depleted.alias("depleted")).distinct()
    others = texts.groupBy("host").agg(F.count_if(~F.col("depleted")).alias("others"))
    apart = judged.filter(F.col("removed").isNotNull() & ~depleted).select(*text, F.explode("removed.line").alias("line")).distinct()
    shared = apart.groupBy("host", "line").agg(F.count("*").alias("documents")).filter(F.col("documents") > least_documents)
    shared = shared.join(others, "host").filter(F.col("documents") > host_share * F.col("others")).select("host", "line", F.lit(True).alias("shared"))
    # Repeated rows share all of this, so they are one document here.
    copies = judged.filter(depleted & ~F.col("base_failed")).dropDuplicates(["doc_id", *text])
    lines = copies.select("doc_id", *text, "n_words", F.explode("removed").alias("held")).select("doc_id", *text, "n_words", "held.*")
    lines = lines.join(shared, ["host", "line"], "left")
    own = F.array_sort(F.collect_list(F.when(F.col("shared").isNull(), F.col("line"))))
    of_copy = lines.groupBy("doc_id", *text, "n_words").agg(
        own.alias("own"),
        F.collect_list(F.when(F.col("shared"), F.col("line"))).alias("removed"),
        F.coalesce(F.sum(F.when(F.col("shared"), F.col("words"))), F.lit(0)).alias("gone"),
    )
    of_copy = of_copy.filter(100 * (F.col("n_words") - F.col("gone")) >= least_left * F.col("n_words"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h1", "h2", "removed")).alias("first")
    spared = of_copy.groupBy("host", *text_keys(F.col("own").cast("string"))).agg(first)
    return spared.select("first.doc_id", "host", "first.h1", "first.h2", "first.removed")


def _keys(id_col: str, text_col: str, host_col: str) -> list[Column]:
    """What a document is judged by: rows that share these keys share the verdict."""
    host = F.coalesce(F.col(host_col), F.lit("")).alias("host")
    return [F.col(id_col).cast("long").alias("doc_id"), host, *text_keys(text_or_empty(text_col))]


def _rows(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    keys = _keys(id_col, text_col, host_col)
    return docs.select(F.monotonically_increasing_id().alias("row"), *keys, F.col(text_col).alias("text"))


def judge_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    least_documents: int = LEAST_DOCUMENTS,
    host_share: float = HOST_SHARE,
    least_left: int = LEAST_LEFT,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, its counts, ``base_failed`` and ``kept``.

    A line counts once for each distinct text of a host. A NULL text has no words
    and fails; a NULL host is the host with the empty name; NULL and repeated ids
    are kept as they are. Other columns are not looked at. An empty table gives an
    empty result.
    """
    rows = _rows(docs, id_col, text_col, host_col)
    return _judged(rows, least_documents, host_share, least_left).drop("host", "h1", "h2", "removed_words", "removed")


def _normal(line: Column) -> Column:
    return F.translate(F.trim(F.regexp_replace(line, SPACE + "+", " ")), _CAPITALS, _CAPITALS.lower())


def clean_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    least_documents: int = LEAST_DOCUMENTS,
    host_share: float = HOST_SHARE,
    least_left: int = LEAST_LEFT,
) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns and without boilerplate lines in their texts.

    Of copies whose lines are frequent only through one another, one document is kept.
    """
    rows = _rows(docs, id_col, text_col, host_col)
    judged = stored(_judged(rows, least_documents, host_share, least_left), "line-verdicts")
    names = ["host", "h1", "h2"]
    verdicts = judged.filter("kept").select("doc_id", *names, F.col("removed.line").alias("removed"))
    verdicts = verdicts.union(_spared(judged, least_documents, host_share, least_left))
    verdicts = verdicts.withColumnRenamed("doc_id", "id").dropDuplicates(["id", *names])
    keyed = docs.select(*_keys(id_col, text_col, host_col), F.struct(*[F.col(c) for c in docs.columns]).alias("doc"))
    held = F.filter(
        F.split(F.col("doc")[text_col], "\n"), lambda x: ~F.array_contains(F.col("removed"), F.xxhash64(_normal(x)))
    )
    text = F.when(F.col("removed").isNull(), F.col("doc")[text_col]).otherwise(F.array_join(held, "\n"))
    columns = [text.alias(c) if c == text_col else F.col("doc")[c].alias(c) for c in docs.columns]
    same = F.col("doc_id").eqNullSafe(F.col("id"))
    for name in names:
        same = same & (keyed[name] == verdicts[name])
    return keyed.join(verdicts, same).select(*columns)
