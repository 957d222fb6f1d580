import hashlib
import re

import pytest
from pyspark.sql import functions as F

from haemoloom.llm.exact_dedup import exact_duplicates, name_documents, without_exact_duplicates
from rows import awkward, documents, plain


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    groups = {}
    for i, (doc_id, text, *_) in enumerate(rows):
        groups.setdefault(normal(text), []).append((doc_id is None, doc_id or 0, i))
    found = []
    for i, (doc_id, text, *_) in enumerate(rows):
        group = groups[normal(text)]
        no_id, keep, first = min(group)
        digest = hashlib.sha256(normal(text).encode()).hexdigest()
        found.append((doc_id, None if no_id else keep, len(group), i == first, digest))
    return sorted(found, key=repr)


@pytest.mark.parametrize("block_bytes", [8192, 7])
@pytest.mark.parametrize("extra", [False, True])
def test_groups_match_brute_force(spark, block_bytes, extra):
    docs = documents(spark, extra=extra).coalesce(1)
    assert plain(exact_duplicates(docs, block_bytes=block_bytes)) == expected(awkward())


def test_blocks_that_share_a_print_are_told_apart(spark):
    weak = lambda block: F.struct(F.lit(0).cast("long").alias("h1"), F.length(block).cast("long").alias("h2"))
    docs = documents(spark).coalesce(1)
    assert plain(exact_duplicates(docs, block_bytes=64, print_of=weak)) == expected(awkward())


def test_texts_that_differ_in_one_late_block_have_different_names(spark):
    rows = [(i, "ab" * 500 + tail, None, None, None) for i, tail in enumerate(["", "a", "b", "ab", "a", ""])]
    named = name_documents(documents(spark, rows), block_bytes=16)[0].select("doc_id", "level", "name").collect()
    names = {r.doc_id: (r.level, r.name) for r in named}
    assert names[0] == names[5] and names[1] == names[4]
    assert len(set(names.values())) == 4


def test_rows_that_stay_keep_their_columns(spark):
    docs = documents(spark, extra=True).coalesce(1)
    stay = without_exact_duplicates(docs)
    assert stay.columns == docs.columns
    assert stay.count() == len({normal(text) for _, text, *_ in awkward()})


def test_empty_table(spark):
    assert exact_duplicates(documents(spark, [])).collect() == []
