import zlib

import numpy as np
import pytest

from haemoloom.llm.quality_model import STATISTICS, score_quality, statistics
from haemoloom.llm.trees import fit_trees
from rows import awkward, documents, prose

SMALL = "/root/testdata/sf0.01"


def test_trees_learn_a_rule_of_two_inputs():
    rows = np.random.default_rng(1).normal(size=(4000, 5))
    labels = ((rows[:, 1] > 0.3) ^ (rows[:, 3] > 0)).astype(float)
    trees = fit_trees(rows[:3000], labels[:3000])
    assert ((trees.scores(rows[3000:]) > 0.5) == labels[3000:]).mean() > 0.97


def test_flat_walk_equals_a_walk_row_by_row():
    rows = np.random.default_rng(2).normal(size=(500, 4))
    trees = fit_trees(rows, (rows.sum(axis=1) > 0).astype(float), rounds=7, depth=3)

    def walk(row):
        total = trees.prior
        for inputs, thresholds, values in zip(trees.inputs, trees.thresholds, trees.values):
            at = 0
            for _ in range(trees.depth):
                at = 2 * at + (1 if row[inputs[at]] <= thresholds[at] else 2)
            total += values[at]
        return total

    assert np.allclose(trees.margins(rows), [walk(r) for r in rows])


def test_no_rows_or_one_label_give_the_prior():
    assert fit_trees(np.zeros((0, 3)), np.zeros(0)).scores(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert len(set(fit_trees(np.ones((9, 3)), np.ones(9)).scores(np.eye(3)).tolist())) == 1


def test_statistics_are_finite_for_all_texts():
    for _, text, *_ in awkward():
        found = statistics((text or "").encode())
        assert len(found) == len(STATISTICS) and np.isfinite(found).all()


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    got = score_quality(spark.read.parquet(f"{SMALL}/documents.parquet"), labels).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [r.predicted == truth[r.doc_id] for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and np.mean(held) > 0.95


@pytest.mark.parametrize("extra", [False, True])
def test_awkward_rows(spark, extra):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, None), (None, 1), (8, 1), (8, 1), (5, 7)], "doc_id long, quality int")
    got = score_quality(documents(spark, extra=extra), labels).collect()
    assert len(got) == len(awkward())
    by_text = {}
    texts = {i: t for i, t, *_ in awkward()}
    for r in got:
        if r.doc_id in (3, 4, 5, 6):
            by_text.setdefault(texts[r.doc_id] or "", set()).add(r.score)
    assert all(len(scores) == 1 for scores in by_text.values())


def test_training_rows_are_bounded_and_chosen_alike(spark):
    docs = documents(spark, [(i, prose(i, 30) if i % 2 else "x " * 30, None, None, None) for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    runs = [{r.doc_id: r.score for r in score_quality(docs.repartition(n), labels, training_rows=60).collect()} for n in (1, 5)]
    assert runs[0] == runs[1]
    assert all((score > 0.5) == (doc_id % 2 == 1) for doc_id, score in runs[0].items())


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert score_quality(documents(spark, []), labels).collect() == []
    assert {r.score for r in score_quality(documents(spark), labels).collect()} == {0.5}
