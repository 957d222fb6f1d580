import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from haemoloom.llm import ranked_search
from haemoloom.llm.ranked_search import _masks, rank_documents
from rows import CLASHING, awkward, documents, plain, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(rows, items, top=20):
    docs = [(doc_id, Counter(terms(text))) for doc_id, text, *_ in rows]
    docs = [(i, c) for i, c in docs if c]
    n_docs, n_all = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    found = []
    for item_id, text in items:
        scored = []
        for doc_id, counts in docs:
            m = 75 + 25 * sum(counts.values()) * n_docs // n_all
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 12 * m))
                for t in terms(text) if t in counts
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        found += [(item_id, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored)[:top], 1)]
    return sorted(found, key=repr)


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def many():
    made = random.Random(4)
    rows = [(i, prose(made.randint(0, 40), made.randint(1, 80)) + " " + prose(100 + i, 20), None, None, None) for i in range(400)]
    copies = [(1000 + i, rows[3][1], None, None, None) for i in range(300)]
    items = [(i, " ".join(made.choice(rows)[1].split(" ")[: made.randint(1, 90)])) for i in range(25)]
    return rows + copies, [*items, (99, prose(1, 150) + " " + prose(2, 90)), (100, "nowhere-to-be-found"), (101, "")]


def test_lists_match_brute_force(spark):
    rows, items = many()
    got = rank_documents(documents(spark, rows).repartition(5), benchmark(spark, items))
    assert plain(got) == expected(rows, items)


def test_blocks_and_small_matrices_change_nothing(spark, monkeypatch):
    rows, items = many()
    want = plain(rank_documents(documents(spark, rows), benchmark(spark, items), top=7))
    monkeypatch.setattr(ranked_search, "TERMS_TOGETHER", 200)
    monkeypatch.setattr(ranked_search, "MATRIX", 10)
    monkeypatch.setattr(ranked_search, "LEAST_DOCUMENTS", 16)
    monkeypatch.setattr(ranked_search, "SCORED_TOGETHER", 1)
    assert plain(rank_documents(documents(spark, rows), benchmark(spark, items), top=7)) == want == expected(rows, items, 7)


@pytest.mark.parametrize("extra", [False, True])
def test_awkward_rows(spark, extra):
    items = [(1, "A b C"), (1, "a B c"), (None, "b"), (2, None), (3, ""), (4, "中文 é Σ"), (5, "a a a b mail"), (6, "x" * 40_000)]
    table = benchmark(spark, items)
    if extra:
        table = table.withColumns({c: table["text"] for c in [*CLASHING, "doc_id", "rank", "score", "terms", "n"]})
    assert plain(rank_documents(documents(spark, extra=extra), table)) == expected(awkward(), items)


def test_empty_tables(spark):
    assert rank_documents(documents(spark, []), benchmark(spark, [(1, "a")])).collect() == []
    assert rank_documents(documents(spark), benchmark(spark, [])).collect() == []
    assert rank_documents(documents(spark, [(1, None, None, None, None)]), benchmark(spark, [(1, "a")])).collect() == []


def test_long_texts_are_split_in_parts(monkeypatch):
    monkeypatch.setattr(ranked_search, "TOGETHER", 50)
    text = prose(6, 400) + " " + "y" * 500 + ". " + prose(7, 30)
    parts = list(ranked_search.term_parts(text.encode()))
    assert len(parts) > 10
    assert [t.decode() for part in parts for t in part] == terms(text)


@pytest.mark.parametrize("n", [1, 7, 8, 64, 65, 130])
def test_masks_tell_columns_apart(n):
    present = np.random.default_rng(n).random((n, 300)) < 0.03
    masks = _masks(present)
    same = [tuple(c) for c in present.T]
    assert len(set(masks.tolist())) == len(set(same))
    assert len({*zip(masks.tolist(), same)}) == len(set(same))
