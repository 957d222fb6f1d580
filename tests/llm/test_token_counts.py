import random

import pytest
import public_tokenizers
from sentencepiece import SentencePieceProcessor

from haemoloom.llm.token_counts import VOCABULARY, Pieces, count_tokens, pieces
from rows import awkward, documents, plain, prose

LIBRARY = SentencePieceProcessor(model_file=VOCABULARY)


def expected(rows, limit=4096):
    found = []
    for doc_id, text, *_ in rows:
        n = len(LIBRARY.encode(text or ""))
        found.append((doc_id, len((text or "").encode()), n, n > limit))
    return sorted(found, key=repr)


@pytest.mark.parametrize("extra", [False, True])
def test_awkward_rows(spark, extra):
    assert plain(count_tokens(documents(spark, extra=extra))) == expected(awkward())


def test_empty_table(spark):
    assert count_tokens(documents(spark, [])).collect() == []


def test_smallest_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert plain(count_tokens(docs, limit=100)) == expected([tuple(r) for r in docs.select("doc_id", "text").collect()], 100)


def test_random_texts_match_the_library():
    made = random.Random(5)
    alphabet = ["a", "b", "i", "n", "g", "th", "e", " ", "  ", "▁", "\n", "\t", "1", "é", "中", "ing", "\U0001f600", "ऀ", "\x00", "<s>", "<0x0A>"]
    texts = ["".join(made.choice(alphabet) for _ in range(made.randint(0, 300))) for _ in range(1500)]
    assert pieces(VOCABULARY).count(texts) == [len(x) for x in LIBRARY.encode(texts)]


def test_long_runs_match_the_library():
    texts = ["x" * 30_000, " " * 9_999 + "w", "ng" * 15_000, "=" * 3_000 + "-" * 999, "中文" * 4_000, "a " * 600_000, prose(3, 200_000)]
    assert Pieces(VOCABULARY).count(texts) == [len(x) for x in LIBRARY.encode(texts)]


def test_merging_at_once_equals_one_by_one():
    """Also where a merge makes a pair that comes before the next merge of the same rank."""
    of, made = pieces(VOCABULARY), random.Random(8)
    words = ["▁" * made.randint(0, 40) + "".join(made.choice("aeginst") for _ in range(made.randint(1, 60))) for _ in range(400)]
    alone = [of._one_by_one([int(of.of_char[ord(c)]) for c in w]) for w in words]
    assert of.merged(words).tolist() == alone


def test_words_are_forgotten_without_changing_counts(monkeypatch):
    monkeypatch.setattr("haemoloom.llm.token_counts.WORDS_KEPT", 50)
    monkeypatch.setattr("haemoloom.llm.token_counts.TOGETHER", 300)
    texts = [prose(i, 100) for i in range(30)]
    assert Pieces(VOCABULARY).count(texts) == [len(x) for x in LIBRARY.encode(texts)]


def test_other_vocabularies_are_refused():
    with pytest.raises(Exception):
        Pieces(public_tokenizers.path("word_bpe_49k.json"))
