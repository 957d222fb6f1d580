"""The stages of the pipeline against brute force, each on what the one before kept."""

import random

import numpy as np
import pytest
import test_exact_dedup
import test_line_rules
import test_near_dedup
import test_personal_data
from test_tokens import crc, library_ids

import corpus_pipeline
from haemoloom.llm.token_files import with_crc32
from rows import awkward, documents, prose

PERSONAL = ["me@mail.example.com", "10.0.0.7", "4111 1111 1111 1111", "+1 (988) 555-2485"]


def corpus():
    made, rows = random.Random(6), []
    for i in range(80):
        lines = [prose(10 * i + k, made.randint(15, 40)) for k in range(3)]
        if i % 2:
            lines.insert(made.randint(0, 3), "Subscribe to our letter")
        if i % 5 == 0:
            lines[0] += " " + made.choice(PERSONAL) + " and more"
        rows.append("\n".join(lines))
    rows += [rows[3], rows[3].replace(" ", "  "), rows[8]]
    rows += [" ".join([*rows[k].split(" ")[:-1], "changed"]) for k in (1, 8, 9)]
    rows += ["too short", "", None, "word " * 100]
    return [(i, t, "en", "s", len(t or "")) for i, t in enumerate(rows)] + [r for r in awkward() if r[0] and r[0] > 7]


def kept_by_quality(rows):
    verdicts = test_line_rules.expected(rows, 20, 0.1)
    kept = {v[0] for v in verdicts if v[-1]}
    out = []
    for doc_id, text, *rest in rows:
        if doc_id in kept:
            lines = [x for x in text.split("\n") if test_line_rules.lower(" ".join(test_line_rules.words_of(x))) != "subscribe to our letter"]
            out.append((doc_id, "\n".join(lines), *rest))
    return out


def redacted(text):
    spans = sorted((a, b, kind) for kind, found in test_personal_data.base(text).items() for a, b in found)
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


@pytest.fixture(scope="module")
def stages(spark):
    """Rows after each stage, and those that brute force keeps of its input."""
    docs = documents(spark, [r for r in dict((r[0], r) for r in corpus()).values()])
    found = []
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        docs = stage(spark, docs, "")
        docs = docs.cache()  # stands for the tool's write and read between stages
        found.append((name, before, docs))
    return dict((name, (before, after)) for name, before, after in found)


def rows_of(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages_are_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "near dedup", "personal data", "packing"]


def test_all_but_the_last_keep_the_columns(stages):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(after.columns == columns for name, (_, after) in stages.items() if name != "packing")


def test_quality(stages):
    before, after = stages["quality rules"]
    assert rows_of(after) == sorted((r[0], r[1]) for r in kept_by_quality(before))
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_exact(stages):
    before, after = stages["exact dedup"]
    kept = {r[0] for r in test_exact_dedup.expected(before) if r[3]}
    assert rows_of(after) == sorted((r[0], r[1]) for r in before if r[0] in kept)
    assert len(kept) < len(before)


def test_near(stages):
    before, after = stages["near dedup"]
    kept = {r[0] for r in test_near_dedup.expected(before) if r[3]}
    assert rows_of(after) == sorted((r[0], r[1]) for r in before if r[0] in kept)
    assert len(kept) < len(before)


def test_personal(stages):
    before, after = stages["personal data"]
    assert rows_of(after) == sorted((r[0], redacted(r[1])) for r in before)
    assert any("<EMAIL>" in t for _, t in rows_of(after))


def test_packing(stages):
    before, after = stages["packing"]
    held = {}
    for p in with_crc32(after).collect():
        held.setdefault(p.doc_id, []).append(p)
    assert set(held) == {r[0] for r in before}
    for doc_id, text, *_ in before:
        ids = [*library_ids(text), 2]
        cuts = np.cumsum([0, *[p.length for p in sorted(held[doc_id], key=lambda p: p.start)]])
        assert cuts[-1] == len(ids)
        assert [p.ids_crc32 for p in sorted(held[doc_id], key=lambda p: p.start)] == [crc(ids[a:b]) for a, b in zip(cuts, cuts[1:])]


def test_run_reads_the_table_and_applies_all_stages(spark, stages, tmp_path):
    documents(spark, [r for r in dict((r[0], r) for r in corpus()).values()]).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "start", "length").collect()
    assert sorted(map(tuple, got)) == sorted((p.doc_id, p.start, p.length) for p in stages["packing"][1].collect())
