"""Token counts of whole texts by rank-synchronous merging of arrays.

A sentencepiece BPE vocabulary merges, again and again, the pair of adjacent symbols
whose piece has the best score, leftmost first. No piece holds a space after another
character, so words with the spaces before them merge on their own. The distinct
words of many texts lie one after the other in flat arrays; each step looks up all
adjacent pairs, takes the lowest rank of every word and merges it in all words at
once. What a word has left in the end is its number of tokens.
"""

import heapq
import re
from functools import cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from haemoloom.llm.common import text_or_empty, texts

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")

#: Tokens of a document above which it is marked.
LIMIT = 4096

#: Characters of texts whose new words are merged together, and of a part of a long text.
TOGETHER = 1 << 20

#: Distinct words remembered by a worker; then it starts afresh.
WORDS_KEPT = 400_000

#: Longest remembered word.
WORD_KEPT = 64

SPACE = "▁"

#: Above every rank: there is no such piece.
NO_RANK = np.int64(1 << 40)

_PROBE = "A  probe,   of 123 \t<s>\n▁ é中ऀ\U0001f600 the then thing      end "


class Pieces:
    """A vocabulary as arrays: symbols of characters, ranks of pairs and the symbols that they make."""

    def __init__(self, path: str):
        self.library = SentencePieceProcessor(model_file=path)
        of = self.library
        plain = [i for i in range(of.vocab_size()) if not (of.is_control(i) or of.is_unknown(i) or of.is_byte(i))]
        scores = {of.id_to_piece(i): of.get_score(i) for i in plain}
        if any(SPACE in p[1:] and p.strip(SPACE) for p in scores):
            raise ValueError("pieces of this vocabulary go over the end of a word")
        names = sorted({*scores, *(c for p in scores for c in p)})
        number = {name: i for i, name in enumerate(names)}
        by_score = {s: i for i, s in enumerate(sorted(set(scores.values()), reverse=True))}
        # Characters of no piece: four symbols, by the number of their bytes.
        self.n = len(names) + 4
        self.weight = np.array([1 if x in scores else len(x.encode()) for x in names] + [1, 2, 3, 4], np.int64)
        codes = np.arange(0x110000)
        self.of_char = (len(names) + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)).astype(np.int64)
        for name, i in number.items():
            if len(name) == 1:
                self.of_char[ord(name)] = i
        pairs = [
            (number[p[:i]] * self.n + number[p[i:]], by_score[score], number[p])
            for p, score in scores.items()
            for i in range(1, len(p))
            if p[:i] in number and p[i:] in number
        ]
        self.keys, self.ranks, self.made = (np.array(x, np.int64) for x in zip(*sorted(pairs)))
        # A rank is safe if no pair with a symbol that it makes is of the same or a lower rank.
        own = np.full(self.n, -1, np.int64)
        own[self.made] = self.ranks
        left, right = own[self.keys // self.n], own[self.keys % self.n]
        self.safe = np.ones(len(by_score), bool)
        self.safe[left[(left >= 0) & (self.ranks <= left)]] = False
        self.safe[right[(right >= 0) & (self.ranks <= right)]] = False
        held = {c for p in scores if len(p) > 1 for c in p}
        alone = re.escape("".join(chr(c) for c in range(0x80) if chr(c) not in held and c != 0x20))
        #: Words with the spaces before them, spaces before nothing, and characters that never merge.
        self.word = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+|[{alone}]")
        self.known: dict[str, int] = {}
        if self.count([_PROBE]) != [len(of.encode(_PROBE))]:
            raise ValueError("this vocabulary normalises texts or is no BPE with byte fallback")

    def _found(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and made symbol of each pair; ``NO_RANK`` if no piece is made."""
        key = left * self.n + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK), self.made[at]

    def merged(self, words: list[str]) -> np.ndarray:
        """The number of tokens of each word."""
        lengths = np.array([len(w) for w in words], np.int64)
        symbols = self.of_char[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        owner = np.repeat(np.arange(len(words)), lengths)
        counts = np.bincount(owner, self.weight[symbols], len(words)).astype(np.int64)
        while len(symbols):
            same = owner[1:] == owner[:-1]
            rank, made = self._found(symbols[:-1], symbols[1:])
            rank, made = np.append(np.where(same, rank, NO_RANK), NO_RANK), np.append(made, 0)
            starts = np.flatnonzero(np.concatenate([[True], ~same]))
            low = np.minimum.reduceat(rank, starts)
            spans = np.diff(np.append(starts, len(symbols)))
            going = np.repeat(low < NO_RANK, spans)
            lowest = np.repeat(low, spans)
            # Of pairs that overlap the first is taken: every other one of a run, in each word.
            hit = (rank == lowest) & going
            run = np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1]]))
            places = np.flatnonzero(hit)
            first = run[np.searchsorted(run, places, "right") - 1]
            taken = places[(places - first) % 2 == 0]
            alone = self._out_of_order(symbols, owner, made, lowest, taken)
            if len(alone):
                for word in alone:
                    mine = owner == word
                    counts[word] = self._one_by_one(symbols[mine].tolist())
                    going &= ~mine
                taken = taken[going[taken]]
            counts -= np.bincount(
                owner[taken], self.weight[symbols[taken]] + self.weight[symbols[taken + 1]] - 1, len(words)
            ).astype(np.int64)
            symbols = symbols.copy()
            symbols[taken] = made[taken]
            going[taken + 1] = False
            symbols, owner = symbols[going], owner[going]
        return counts

    def _out_of_order(self, symbols, owner, made, lowest, taken) -> np.ndarray:
        """Words in which merging all of ``taken`` at once could differ from one after the other.

        A merge may make a pair that comes before the next one only if its rank is not safe.
        """
        taken = taken[~self.safe[lowest[taken]]]
        if not len(taken):
            return taken
        n = len(symbols)
        is_taken = np.zeros(n, bool)
        is_taken[taken] = True
        before = np.where(is_taken[np.maximum(taken - 2, 0)] & (taken > 1), made[np.maximum(taken - 2, 0)], symbols[np.maximum(taken - 1, 0)])
        with_before = (taken > 0) & (owner[np.maximum(taken - 1, 0)] == owner[taken])
        behind = np.minimum(taken + 2, n - 1)
        with_behind = (taken + 2 < n) & (owner[behind] == owner[taken])
        early = with_before & (self._found(before, made[taken])[0] <= lowest[taken])
        early |= with_behind & (self._found(made[taken], symbols[behind])[0] <= lowest[taken])
        return np.unique(owner[taken[early]])

    def _one_by_one(self, symbols: list[int]) -> int:
        """Tokens of one word whose merges are done singly, lowest rank first and leftmost of equal ranks."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks, made = (x.tolist() for x in self._found(np.array(symbols[:-1], np.int64), np.array(symbols[1:], np.int64)))
        waiting = [(r, i, symbols[i], symbols[i + 1], m) for i, (r, m) in enumerate(zip(ranks, made)) if r < NO_RANK]
        heapq.heapify(waiting)

        def look(i: int, j: int) -> None:
            key = symbols[i] * self.n + symbols[j]
            at = int(np.searchsorted(self.keys, key))
            if at < len(self.keys) and self.keys[at] == key:
                heapq.heappush(waiting, (int(self.ranks[at]), i, symbols[i], symbols[j], int(self.made[at])))

        while waiting:
            _, i, one, two, new = heapq.heappop(waiting)
            j = after[i]
            if symbols[i] != one or j >= n or symbols[j] != two:
                continue
            symbols[i], symbols[j] = new, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                look(i, after[i])
            if before[i] >= 0:
                look(before[i], i)
        return int(sum(self.weight[s] for s in symbols if s >= 0))

    def _parts(self, text: str):
        """``text`` with marked spaces, in parts that end where a word does."""
        if not text:
            return
        text = SPACE + text.replace(" ", SPACE)
        start = 0
        while len(text) - start > TOGETHER:
            end = text.find(SPACE, start + TOGETHER)
            while end > 0 and text[end - 1] == SPACE:
                end = text.find(SPACE, end + 1)
            if end < 0:
                break
            yield text[start:end]
            start = end
        yield text[start:]

    def _sums(self, held: list[tuple[int, list[str]]], totals: list[int]) -> None:
        """Add the tokens of the words of texts to the texts' ``totals``."""
        if len(self.known) > WORDS_KEPT:
            self.known.clear()
        new = list({w for _, found in held for w in found} - self.known.keys())
        fresh = dict(zip(new, self.merged(new).tolist())) if new else {}
        self.known.update(fresh)
        for i, found in held:
            totals[i] += sum(map(self.known.__getitem__, found))
        for word in new:
            if len(word) > WORD_KEPT:
                del self.known[word]

    def count(self, batch: list[str]) -> list[int]:
        """The number of tokens of each whole text."""
        totals, held, size = [0] * len(batch), [], 0
        for i, text in enumerate(batch):
            for part in self._parts(text):
                held.append((i, self.word.findall(part)))
                size += len(part)
                if size >= TOGETHER:
                    self._sums(held, totals)
                    held, size = [], 0
        self._sums(held, totals)
        return totals


@cache
def pieces(path: str) -> Pieces:
    """One vocabulary per worker and file."""
    return Pieces(path)


def count_tokens(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    limit: int = LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of each whole text; one row per row.

    Tokens are those of the sentencepiece library without begin and end; special
    strings inside texts are ordinary text. A NULL text is empty and has no token.
    NULL and repeated ids are kept, each row being a document. Other columns are
    not looked at. An empty table gives an empty result. Texts stay in their
    partitions, so nothing is shuffled.
    """

    def count(batches):
        for batch in batches:
            found = texts(batch.column(1))
            sizes = [len(t.encode()) for t in found]
            counts = np.array(pieces(vocabulary).count(found), np.int64)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts), pa.array(counts > limit)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
