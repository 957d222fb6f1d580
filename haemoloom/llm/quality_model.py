"""Quality scores of documents by gradient-boosted trees over document statistics."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haemoloom.llm.common import byte_texts, lists, stored
from haemoloom.llm.trees import Trees, fit_trees

#: Labelled rows that the model is fitted on at most, chosen by a hash of their id.
TRAINING_ROWS = 50_000

#: Rows whose id has this remainder are held out.
FOLDS, HELD_OUT = 4, 2

#: A score of at least this is predicted to be 1.
LEAST_SCORE = 0.7

_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_CLASSES = {
    "capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digits": b"0123456789",
    "stops": b".,;:",
    "shouts": b"!?",
    "symbols": b"#*$%&@^~=+",
    "brackets": b"<>(){}[]/\\|_",
    "quotes": b"\"'`",
}
_PIPES = ord("|")

STATISTICS = (
    "words", "chars", "lines", "words_per_line", "word_length", "word_length_spread", "longest_word",
    "distinct_words", "commonest_word", "repeats_of_word_before", "distinct_pairs", "distinct_lines",
    "capital_words", "upper_words", "stopped_words", "letterless_words", "letters", "pipes", *_CLASSES, "byte_entropy",
)


def statistics(text: bytes) -> list[float]:
    """The inputs of the model, in the order of ``STATISTICS``, from the whole text."""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n = len(words)
    bytes_ = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = len(text)
    lengths = np.fromiter(map(len, words), np.int64, n)
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, n)
    pairs = ids[:-1] * n + ids[1:]
    rows = [r for r in text.split(b"\n") if r.strip()]
    initials = np.frombuffer(b"".join([w[:1] for w in words]), np.uint8)
    finals = np.frombuffer(b"".join([w[-1:] for w in words]), np.uint8)
    share = bytes_[bytes_ > 0] / chars
    return [
        np.log1p(n), np.log1p(chars), np.log1p(len(rows)), np.log1p(n / max(len(rows), 1)),
        lengths.mean(), lengths.std(), np.log1p(lengths.max()),
        len(names) / n, np.bincount(ids).max() / n, (ids[1:] == ids[:-1]).sum() / n, len(np.unique(pairs)) / n,
        len(set(rows)) / max(len(rows), 1),
        ((initials >= 0x41) & (initials <= 0x5A)).sum() / n, sum(map(bytes.isupper, words)) / n,
        np.isin(finals, np.frombuffer(b".,;:!?", np.uint8)).sum() / n, (~_LETTERS[initials]).sum() / n,
        bytes_[_LETTERS].sum() / chars, bytes_[_PIPES] / n,
        *[sum(int(bytes_[b]) for b in held) / n for held in _CLASSES.values()],
        float(-(share * np.log2(share)).sum()),
    ]


def _describe(batches):
    for batch in batches:
        rows = [np.array(statistics(t), np.float32) for t in byte_texts(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), lists(rows, pa.float32())], ["doc_id", "inputs"])


def _fold(id_: str):
    return F.crc32(F.col(id_).cast("string").cast("binary")) % FOLDS


def fit_quality(described: DataFrame, labels: DataFrame, label_col: str = "quality", training_rows: int = TRAINING_ROWS) -> Trees:
    """Trees fitted on ``training_rows`` labelled rows at most, none of them held out.

    Rows with NULL id or label teach nothing. Of more rows than ``training_rows``,
    those whose ids have the smallest hashes are taken, so the driver holds a
    bounded number of rows however many there are.
    """
    known = labels.select(F.col("doc_id").alias("label_id"), F.col(label_col).alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & F.col("label_id").isNotNull()).filter(_fold("label_id") != HELD_OUT)
    chosen = known.orderBy(F.xxhash64("label_id"), "label_id", "label").limit(training_rows)
    taught = described.join(chosen, described["doc_id"] == chosen["label_id"]).select("inputs", "label", "doc_id")
    # Repeated documents could make more rows of the chosen labels.
    taught = taught.orderBy(F.xxhash64("doc_id"), "doc_id", "label", "inputs").limit(training_rows).select("inputs", "label").toArrow()
    rows = taught.column(0).combine_chunks()
    rows = rows.values.to_numpy(zero_copy_only=False) if len(rows) else np.zeros(0)
    return fit_trees(rows.reshape(-1, len(STATISTICS)).astype(np.float64), taught.column(1).to_numpy().astype(np.float64))


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    training_rows: int = TRAINING_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    Scores come from the text alone; a NULL text is empty and is scored like one.
    Without labels every score is the same prior, 0.5. A row with NULL id is not
    held out; repeated rows are scored alike. Other columns are not looked at. An
    empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    described = stored(rows.mapInArrow(_describe, "doc_id long, inputs array<float>"), "quality-inputs")
    trees = fit_quality(described, labels, label_col, training_rows)

    def score(batches):
        for batch in batches:
            column = batch.column(1)
            values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
            scores = trees.scores(values.reshape(-1, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["doc_id", "score"])

    scored = described.mapInArrow(score, "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(_fold("doc_id") == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= LEAST_SCORE, 1).otherwise(0).alias("predicted"),
    )
