"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

The leaves of the tree are the pairs of adjacent symbols of a word, each holding
its merge rank and place; the root is the leftmost pair of lowest rank. A merge
changes three leaves, so a word of n symbols takes n log n steps however long it
is. Distinct words are encoded once per worker.
"""

import hashlib
import json
import re
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from haemoloom.llm.common import text_or_empty, texts
from haemoloom.llm.encoder import BYTE_LETTERS, WORD, in_byte_letters, is_plain
from haemoloom.llm.token_files import VOCABULARY

#: Distinct words remembered by a worker; then it starts afresh.
WORDS_KEPT = 350_000


#: Above every number in the tree: there is no such merge.
NO_PAIR = 1 << 62


def merge_ids(symbols: list[int], ranks: dict[int, int], merged: list[int]) -> list[int]:
    """Ids of ``symbols`` after all merges, lowest rank first and leftmost of equal ranks.

    ``ranks`` has the rank of a pair under ``left << 16 | right``, and ``merged``
    the id that a merge of each rank makes.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    ids, rank_of = list(symbols), ranks.get
    # Leaf of place i: rank * n + i of the pair that starts there.
    size = 1 << (n - 2).bit_length()
    tree = [NO_PAIR] * (2 * size)
    for i in range(n - 1):
        rank = rank_of(ids[i] << 16 | ids[i + 1])
        if rank is not None:
            tree[size + i] = rank * n + i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while (least := tree[1]) != NO_PAIR:
        rank, left = divmod(least, n)
        right, leader = after[left], before[left]
        follower = after[right]
        ids[left], ids[right] = merged[rank], -1
        after[left] = follower
        changed = [(right, NO_PAIR)] if right < n - 1 else []
        here = NO_PAIR
        if follower < n:
            before[follower] = left
            rank = rank_of(ids[left] << 16 | ids[follower])
            if rank is not None:
                here = rank * n + left
        changed.append((left, here))
        if leader >= 0:
            rank = rank_of(ids[leader] << 16 | ids[left])
            changed.append((leader, NO_PAIR if rank is None else rank * n + leader))
        for place, number in changed:
            i = size + place
            tree[i] = number
            i >>= 1
            while i:
                a, b = tree[2 * i], tree[2 * i + 1]
                if b < a:
                    a = b
                if tree[i] == a:
                    break
                tree[i] = a
                i >>= 1
    return [i for i in ids if i >= 0]


class _Words(dict):
    """(number of ids, ids as text, tokens as text) of a word, found when first asked for."""

    def __init__(self, encode, decode):
        super().__init__()
        self.encode, self.decode = encode, decode

    def __missing__(self, word: str) -> tuple[int, str, str]:
        if len(self) >= WORDS_KEPT:
            self.clear()
        ids = self.encode(word)
        found = (len(ids), " ".join(map(str, ids)), self.decode(ids))
        if len(word) <= 64:
            self[word] = found
        return found


class Bpe:
    """A BPE vocabulary file. Normaliser and splitter of unusual texts are the file's own."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model = held["model"]
        vocabulary = model["vocab"]
        if len(vocabulary) > 1 << 16:
            raise ValueError("ids of this vocabulary do not fit 16 bits")
        end = model["end_of_word_suffix"] or ""
        self.inner = {c: vocabulary[c] for c in BYTE_LETTERS}
        self.last = {c: vocabulary[c + end] for c in BYTE_LETTERS}
        self.ranks = {vocabulary[a] << 16 | vocabulary[b]: i for i, (a, b) in enumerate(model["merges"])}
        self.merged = [vocabulary[a + b] for a, b in model["merges"]]
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        self.tokens = {i: t for t, i in [*vocabulary.items(), *self.special.items()]}
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        own = Tokenizer.from_file(path)
        self.normalise = own.normalizer.normalize_str
        self.split = own.pre_tokenizer.pre_tokenize_str
        self.lettered = _Words(self._encode_lettered, self.decode)
        self.words = _Words(lambda word: self._encode_lettered(in_byte_letters(word)), self.decode)

    def _encode_lettered(self, word: str) -> list[int]:
        inner = self.inner
        return merge_ids([*[inner[c] for c in word[:-1]], self.last[word[-1]]], self.ranks, self.merged)

    def pieces(self, text: str) -> list[tuple[int, str, str]]:
        """What each word or special token of ``text`` becomes."""
        if is_plain(text):
            return list(map(self.words.__getitem__, WORD.findall(text.lower())))
        found = []
        for part in self.at_special.split(text):
            if part in self.special:
                found.append((1, str(self.special[part]), part))
            elif part:
                found += [self.lettered[word] for word, _ in self.split(self.normalise(part))]
        return found

    def encode(self, text: str) -> list[int]:
        return [int(i) for _, ids, _ in self.pieces(text) for i in ids.split()]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by spaces, as a file without a decoder asks for; unknown ids are left out."""
        return " ".join([self.tokens[i] for i in ids if i in self.tokens])


@cache
def bpe(path: str) -> Bpe:
    """One vocabulary per worker and file."""
    return Bpe(path)


def encode_documents(
    docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (decimal, one space between) and ``decoded`` of each whole text.

    A NULL text is empty and has no ids. NULL and repeated ids are kept, and other
    columns are not looked at. An empty table gives an empty result.
    """
    return _mapped(docs, vocabulary, id_col, text_col, "ids", "decoded", lambda text: text)


def encoding_digests(
    docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """As ``encode_documents``, with SHA-256 digests in place of ids and decoded texts."""
    return _mapped(
        docs, vocabulary, id_col, text_col, "ids_sha256", "decoded_sha256",
        lambda text: hashlib.sha256(text.encode()).hexdigest(),
    )


def _mapped(docs, vocabulary, id_col, text_col, ids_name, decoded_name, shown) -> DataFrame:
    def encode(batches):
        for batch in batches:
            counts, ids, decoded = [], [], []
            for text in texts(batch.column(1)):
                pieces = bpe(vocabulary).pieces(text)
                counts.append(sum(p[0] for p in pieces))
                ids.append(shown(" ".join([p[1] for p in pieces])))
                decoded.append(shown(" ".join([p[2] for p in pieces])))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", ids_name, decoded_name])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(encode, f"doc_id long, n_tokens long, {ids_name} string, {decoded_name} string")
