"""Token files, packing and BPE against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from haemoloom.llm.bpe import bpe, encode_documents, encoding_digests, merge_ids
from haemoloom.llm.encoder import encoder
from haemoloom.llm.packing import pack, piece_lengths
from haemoloom.llm.token_files import VOCABULARY, read_token_files, with_crc32, write_token_files
from haemoloom.runtime import scratch_path
from rows import awkward, documents, plain

LIBRARY = Tokenizer.from_file(VOCABULARY)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def odd_texts():
    made = random.Random(5)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|", "'s", "'LL", "é", "ΑΣ", "İ", "\x85", "\x1d", "가", "中", "ﬁ", "ǅ"]
    parts += list("aAbBzZ 0123 \t\n.,!?éÉßñÑ²½ªº\x00\U0001f600")
    return ["".join(made.choice(parts) for _ in range(made.randint(0, 25))) for _ in range(4000)]


def test_encoders_match_the_library():
    for text in odd_texts():
        want = library_ids(text)
        assert encoder(VOCABULARY).ids(text).tolist() == want
        assert bpe(VOCABULARY).encode(text) == want
        assert bpe(VOCABULARY).decode(want) == LIBRARY.decode(want, skip_special_tokens=False)


def test_a_very_long_word_is_merged():
    word = "ab" * 30_000 + "c"
    assert bpe(VOCABULARY).encode(word) == library_ids(word)


def test_merges_take_the_leftmost_of_the_lowest_rank():
    made = random.Random(3)
    for _ in range(300):
        pairs = {(made.randint(0, 9), made.randint(0, 9)): None for _ in range(12)}
        merged = [10 + i for i in range(len(pairs))]
        ranks = {a << 16 | b: rank for rank, (a, b) in enumerate(pairs)}
        word = [made.randint(0, 9) for _ in range(made.randint(0, 20))]
        slow = list(word)
        while hits := [(ranks[k], i) for i in range(len(slow) - 1) if (k := slow[i] << 16 | slow[i + 1]) in ranks]:
            rank, i = min(hits)
            slow[i : i + 2] = [merged[rank]]
        assert merge_ids(word, ranks, merged) == slow


@pytest.mark.parametrize("extra", [False, True])
def test_bpe_of_documents(spark, extra):
    want = []
    for doc_id, text, *_ in awkward():
        ids = library_ids(text)
        want.append((doc_id, len(ids), " ".join(map(str, ids)), LIBRARY.decode(ids, skip_special_tokens=False)))
    docs = documents(spark, extra=extra)
    assert plain(encode_documents(docs)) == sorted(want, key=repr)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert plain(encoding_digests(docs)) == sorted(((a, b, digest(c), digest(d)) for a, b, c, d in want), key=repr)


@pytest.mark.parametrize("extra", [False, True])
def test_token_files_are_sorted_and_read_back(spark, extra):
    path = scratch_path(spark, "test-tokens")
    write_token_files(documents(spark, extra=extra), path)
    read = with_crc32(read_token_files(spark, path)).collect()
    assert sum(r.n_tokens for r in read) == sum(len(library_ids(t)) + 1 for _, t, *_ in awkward())
    assert all(r.n_tokens == r.n_ids for r in read)
    got = sorted(read, key=lambda r: r.start)
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
    ids = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids)
    want = sorted(((doc_id, crc([*library_ids(t), 2])) for doc_id, t, *_ in awkward()), key=repr)
    assert sorted(((r.doc_id, r.ids_crc32) for r in read), key=repr) == want


def test_token_files_have_the_encodings_asked_for(spark):
    import glob

    import pyarrow.parquet as pq

    path = scratch_path(spark, "test-tokens")
    write_token_files(documents(spark).filter("doc_id > 4"), path, partitions=1)
    file = pq.ParquetFile(glob.glob(path.removeprefix("file:") + "/part-*")[0])
    columns = {file.metadata.row_group(0).column(i).path_in_schema: file.metadata.row_group(0).column(i) for i in range(5)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    tokens = columns["ids.list.element"]
    assert "RLE_DICTIONARY" in tokens.encodings and tokens.has_offset_index and tokens.has_column_index


@pytest.mark.parametrize("n", [1, 2, 3, 4095, 4096, 4097, 12_289, 50_000])
def test_pieces_are_powers_of_two(n):
    lengths = piece_lengths(n)
    assert sum(lengths) == n and all(x & (x - 1) == 0 and x <= 4096 for x in lengths)
    assert len({x for x in lengths if x < 4096}) == sum(x < 4096 for x in lengths)


@pytest.mark.parametrize("extra", [False, True])
def test_packing_holds_each_id_once(spark, extra):
    pieces = pack(documents(spark, extra=extra)).collect()
    assert sorted(p.sequence_id for p in pieces) == list(range(len(pieces)))
    by_sequence = sorted(pieces, key=lambda p: p.sequence_id)
    assert [p.length for p in by_sequence] == sorted((p.length for p in pieces), reverse=True)
    assert all(p.length == len(p.ids) and p.offset == 0 and p.length & (p.length - 1) == 0 for p in pieces)
    held = {}
    for p in pieces:
        held.setdefault(p.doc_id, []).append(p)
    for doc_id in (1, 4, 5, 11):
        text = next(t for i, t, *_ in awkward() if i == doc_id)
        own = sorted(held[doc_id], key=lambda p: p.start)
        ids = [i for p in own for i in p.ids]
        assert ids == [*library_ids(text), 2] and all(p.doc_tokens == len(ids) for p in own)
        assert [p.start for p in own] == np.cumsum([0, *[p.length for p in own]])[:-1].tolist()


def test_empty_table(spark):
    empty = documents(spark, [])
    path = scratch_path(spark, "test-tokens")
    write_token_files(empty, path)
    assert read_token_files(spark, path).collect() == []
    assert pack(empty).collect() == [] and encode_documents(empty).collect() == []


def test_packing_needs_a_power_of_two(spark):
    with pytest.raises(ValueError, match="power of two"):
        pack(documents(spark), sequence_tokens=1000)
