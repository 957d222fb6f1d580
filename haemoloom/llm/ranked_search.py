"""Ranked lexical search by presence masks.

Each task lays the impacts of its documents out as a matrix of terms by documents.
For an item, the rows of its terms packed to bits are one mask per document: which
terms it has. Documents of one mask form a group, and a mask's greatest score is the
sum over its terms of the greatest impact that any document has. Groups are scored
exactly by falling greatest score, until no group left can reach the item's list.
Lists of the tasks are merged at the end.
"""

import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haemoloom.llm.common import byte_texts, lists, stored, text_or_empty

#: Documents listed for an item.
TOP = 20

#: Occurrences of terms in the items that are searched for together; an item that has
#: more is searched for alone.
TERMS_TOGETHER = 20_000

#: Impacts of a matrix, and documents of one at least.
MATRIX = 8 << 20
LEAST_DOCUMENTS = 256

#: Documents that are scored before the lists are looked at again, at least.
SCORED_TOGETHER = 64

#: Bytes of a long text that are split together.
TOGETHER = 1 << 22

# Bytes of terms stay, in lower case; all others end a term.
_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def term_parts(text: bytes):
    """The terms of a UTF-8 text in order, in bounded lists."""
    text = text.translate(_TERM_BYTES)
    start = 0
    while len(text) - start > TOGETHER and (end := text.find(b" ", start + TOGETHER)) >= 0:
        yield text[start:end].split()
        start = end
    yield text[start:].split()


def _item_terms(batches):
    for batch in batches:
        counted = [sum(map(Counter, term_parts(t)), Counter()) for t in byte_texts(batch.column(1))]
        terms = pa.array([[*c.keys()] for c in counted], pa.list_(pa.binary()))
        times = pa.array([[*c.values()] for c in counted], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), terms, times], ["item_id", "terms", "times"])


def _blocks(items: DataFrame, id_col: str, text_col: str):
    """Lists of (item_id, {term: occurrences}), each with a bounded number of terms."""
    rows = items.select(F.col(id_col).cast("long").alias("item_id"), text_or_empty(text_col).alias("text"))
    counted = rows.mapInArrow(_item_terms, "item_id long, terms array<binary>, times array<long>")
    block, size = [], 0
    for row in counted.toLocalIterator():
        if block and size + len(row.terms) > TERMS_TOGETHER:
            yield block
            block, size = [], 0
        block.append((row.item_id, {bytes(t): n for t, n in zip(row.terms, row.times)}))
        size += len(row.terms)
    if block:
        yield block


def _postings(docs: DataFrame, vocabulary: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``n`` (all its terms), ``terms`` (places in ``vocabulary``) and ``times`` of documents with a term, stored."""
    number = {t: i for i, t in enumerate(vocabulary)}

    def count(batches):
        for batch in batches:
            ids, sizes, terms, times = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1))):
                n, found = 0, Counter()
                for part in term_parts(text):
                    n += len(part)
                    found.update(map(number.get, part))
                found.pop(None, None)
                if n:
                    ids.append(doc_id)
                    sizes.append(n)
                    terms.append(np.fromiter(found.keys(), np.int32, len(found)))
                    times.append(np.fromiter(found.values(), np.int64, len(found)))
            columns = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), lists(terms, pa.int32()), lists(times, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "times"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return stored(rows.mapInArrow(count, "doc_id long, n long, terms array<int>, times array<long>"), "search-postings")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class _Lists:
    """The best (score, doc_id) of each item so far."""

    def __init__(self, n: int, top: int):
        self.top, self.held, self.least = top, [[] for _ in range(n)], [1] * n

    def add(self, item: int, scores: np.ndarray, ids: list) -> None:
        best = [(-s, i is None, i) for s, i in zip(scores.tolist(), ids) if s >= self.least[item]]
        if best:
            # Of equal scores lower ids come first, and NULL ids last.
            ranked = sorted([*self.held[item], *best], key=lambda x: x[:2] + (x[2] or 0,))
            self.held[item] = ranked[: self.top]
            if len(self.held[item]) == self.top:
                self.least[item] = max(1, -self.held[item][-1][0])


def _masks(present: np.ndarray) -> np.ndarray:
    """One number per column: equal where the same rows are true."""
    packed = np.packbits(present, axis=0, bitorder="little")
    words = np.zeros((present.shape[1], -(-len(packed) // 8) * 8), np.uint8)
    words[:, : len(packed)] = packed.T
    words = words.view(np.uint64)
    mask = words[:, 0]
    for i in range(1, words.shape[1]):
        one, two = (np.unique(x, return_inverse=True) for x in (mask, words[:, i]))
        mask = one[1].astype(np.uint64) * np.uint64(len(two[0])) + two[1].astype(np.uint64)
    return mask


def _search_matrix(impact: np.ndarray, ids: list, items: list, best: _Lists) -> None:
    """Add to ``best`` what documents (columns of ``impact``) score for ``items``, a list of (terms, weights)."""
    greatest = impact.max(axis=1, initial=0)
    for item, (terms, weights) in enumerate(items):
        caps = weights * greatest[terms]
        if caps.sum() < best.least[item]:
            continue
        useful = caps > 0
        rows = terms[useful]
        of_item = impact[rows]
        present = of_item > 0
        masks, first, group = np.unique(_masks(present), return_index=True, return_inverse=True)
        bounds = caps[useful] @ present[:, first]
        ends = np.cumsum(np.bincount(group, minlength=len(masks)))
        by_group = np.argsort(group, kind="stable")
        order = np.argsort(-bounds, kind="stable")
        at = 0
        while at < len(order) and bounds[order[at]] >= best.least[item]:
            documents = []
            while at < len(order) and len(documents) < SCORED_TOGETHER and bounds[order[at]] >= best.least[item]:
                g = order[at]
                documents.extend(by_group[ends[g - 1] if g else 0 : ends[g]].tolist())
                at += 1
            scores = weights[useful] @ of_item[:, documents].astype(np.int64)
            best.add(item, scores, [ids[d] for d in documents])


def _search(items: list, n_terms: int, n_docs: int, n_all: int, top: int):
    def search(batches):
        best = _Lists(len(items), top)
        width = max(LEAST_DOCUMENTS, MATRIX // max(1, n_terms))
        for batch in batches:
            for at in range(0, batch.num_rows, width):
                part = batch.slice(at, width)
                ids, sizes = part.column(0).to_pylist(), part.column(1).to_pylist()
                m = np.array([75 + 25 * n * n_docs // n_all for n in sizes], np.int64)
                terms, times = part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy()
                document = np.repeat(np.arange(len(ids)), np.diff(part.column(2).offsets.to_numpy()))
                impact = np.zeros((n_terms, len(ids)), np.int32)
                impact[terms, document] = 1_000_000_000 * times // (1000 * times + 12 * m[document])
                _search_matrix(impact, ids, items, best)
        rows = [(i, -s, doc_id) for i, held in enumerate(best.held) for s, _, doc_id in held]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "score", "doc_id"])

    return search


def _search_block(docs: DataFrame, block: list, top: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = sorted({t for _, terms in block for t in terms})
    number = {t: i for i, t in enumerate(vocabulary)}
    postings = _postings(docs, vocabulary, id_col, text_col)
    n_docs, n_all = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One row per term of the block.
    counts = postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = {row["term"]: weight(n_docs, row["count"]) for row in counts}
    items = []
    for _, terms in block:
        held = [(number[t], weights[number[t]] * n) for t, n in terms.items() if number[t] in weights]
        items.append((np.array([t for t, _ in held], np.int64), np.array([w for _, w in held], np.int64)))
    found = postings.mapInArrow(_search(items, len(vocabulary), n_docs, n_all, top), "item long, score long, doc_id long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    ids = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], "item long, item_id long")
    return ranked.join(ids, "item").select("item_id", "rank", "doc_id", "score")


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The ``top`` documents of each item: ``item_id``, ``rank`` from 1, ``doc_id``, ``score``.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z lower-cased.
    Documents are scored by how rare an item's terms are in ``docs`` and how often
    they stand in a document relative to its length; equal scores go by ascending
    id, NULL ids last. Only documents with a score above 0 are listed. A NULL text
    has no term. Repeated rows of either table are each a document or an item of
    its own, and NULL item ids stay. Other columns are not looked at. Without
    documents or items the result is empty.

    Items are searched for in blocks of at most ``TERMS_TOGETHER`` terms, which is
    what a task and the driver hold; documents are read once per block, and each
    task passes on ``top`` rows per item.
    """
    found = [_search_block(docs, block, top, id_col, text_col) for block in _blocks(items, item_id_col, item_text_col)]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.union, found)
