"""Awkward documents, and helpers for the tests of this folder."""

import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"

#: Names that operators might use for columns of their own.
CLASHING = ["row", "part", "key", "name", "node", "block", "level", "h1", "body", "spans", "rule", "start", "doc", "text_sha256", "kept"]


def prose(seed: int, words: int) -> str:
    made = random.Random(seed)
    syllables = ["an", "ber", "co", "dé", "el", "für", "go", "ha", "in", "ño"]
    return " ".join("".join(made.choice(syllables) for _ in range(made.randint(1, 4))) for _ in range(words))


def awkward() -> list[tuple]:
    """NULLs in every column, empty and very long texts, ties and repeated rows."""
    long = prose(1, 30_000) + "\n" + "x" * 40_000 + " 1.2.3.4 " + "9" * 5_000
    near = prose(7, 120).split(" ")
    return [
        (1, "a b\tc", "en", "s", 5),
        (2, "a  b \n c", "en", "s", None),
        (3, None, None, None, None),
        (4, "", "en", "s", 0),
        (None, "a b c", "en", None, 5),
        (None, None, None, None, None),
        (5, long, "de", "t", len(long)),
        (6, long, "de", "t", len(long)),
        (6, long, "de", "t", len(long)),
        (7, "a b c", "fr", "t", 5),
        (7, "another text of one id", "fr", "t", 5),
        (8, " ".join(near), "fr", "t", 5),
        (9, " ".join(near[:60] + ["changed"] + near[61:]), "fr", "t", 5),
        (10, " ".join(near[:20] + prose(8, 100).split(" ")), "fr", "t", 5),
        (11, "Σ İ ıß <|endoftext|> 'S don't \x85\x1c 中文 ﬁ é \U0001f600", "xx", "t", 5),
        (12, "mail a.b@c.de, ip 10.0.0.300 and 010.1.2.3.4 card 4111 1111-1111 1111 call +1 (555) 123-4567.", "en", "t", 5),
    ]


def documents(spark, rows=None, extra=False):
    df = spark.createDataFrame(awkward() if rows is None else rows, DOCUMENT)
    return df.withColumns({c: df["lang"] for c in CLASHING}) if extra else df


def plain(df) -> list[tuple]:
    """Rows in an order that NULLs don't disturb."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
