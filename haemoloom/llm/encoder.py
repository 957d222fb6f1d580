"""Token ids of whole texts with a BPE vocabulary of the tokenizers library.

Words repeat, so each distinct word is encoded once per worker: texts in plain
Latin letters are split as the vocabulary's own normaliser and splitter do, and
the library's BPE model encodes the words. All other texts, and texts that may
hold a special token, go through the library as a whole.
"""

import re
import unicodedata
from array import array
from functools import cache

import numpy as np
from tokenizers import Tokenizer

#: Distinct words remembered by a worker; then it starts afresh.
WORDS_KEPT = 400_000

#: Above this code point letters combine or change case by context.
LATIN_END = 0x250

_LATIN = [chr(c) for c in range(LATIN_END)]
_LETTERS = "".join(re.escape(c) for c in _LATIN if unicodedata.category(c)[0] == "L")
_NUMBERS = "".join(re.escape(c) for c in _LATIN if unicodedata.category(c)[0] == "N")
_SPACES = r"\x09-\x0D\x20\x85\xA0"

#: Words of a lower-cased Latin text, as the vocabulary's splitter finds them.
WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+")

_NOT_PLAIN = re.compile(rf"[^\x00-\u{LATIN_END - 1:04x}]|<\|")


def is_plain(text: str) -> bool:
    """Whether ``text`` is Latin only and cannot hold a special token such as ``<|endoftext|>``."""
    return _NOT_PLAIN.search(text) is None


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


BYTE_LETTERS = _byte_letters()


def in_byte_letters(word: str) -> str:
    return word if word.isascii() and word.isalnum() else "".join(BYTE_LETTERS[b] for b in word.encode())


class WordIds(dict):
    """Ids of a word as 16-bit integers, encoded when first asked for."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> bytes:
        if len(self) >= WORDS_KEPT:
            self.clear()
        ids = array("H", [t.id for t in self.model.tokenize(in_byte_letters(word))]).tobytes()
        if len(word) <= 64:
            self[word] = ids
        return ids


class Encoder:
    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this vocabulary do not fit 16 bits")
        self.words = WordIds(self.tokenizer.model)

    def ids(self, text: str, end: int | None = None) -> np.ndarray:
        """Unsigned 32-bit ids of the whole ``text``, and the id ``end`` after them."""
        if is_plain(text):
            got = np.frombuffer(b"".join(map(self.words.__getitem__, WORD.findall(text.lower()))), np.uint16)
        else:
            got = self.tokenizer.encode(text, add_special_tokens=False).ids
        out = np.empty(len(got) + (end is not None), "<u4")
        out[: len(got)] = got
        if end is not None:
            out[-1] = end
        return out


@cache
def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary."""
    return Encoder(path)
