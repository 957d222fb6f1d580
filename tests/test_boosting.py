import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import auc
from haemoloom.plans import boosting, classifier
from haemoloom.plans.features import features_from_telemetry
from test_features import random_inputs

INPUTS = ["p", "q", "r", "s", "t"]
OPTIONS = {"rounds": 3, "depth": 3, "bins": 16, "least_weight": 0.5}


def sample(n=300, seed=4):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 5)), 1)
    x[rng.random((n, 5)) < 0.15] = np.nan
    score = np.nan_to_num(x[:, 0], nan=1.5) - np.nan_to_num(x[:, 1] * x[:, 2], nan=-1)
    y = (score + rng.normal(scale=0.5, size=n) > 0).astype(int)
    return x, y


def as_frame(spark, x, y):
    rows = [(*(None if math.isnan(v) else float(v) for v in row), int(label)) for row, label in zip(x, y)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in INPUTS) + ", label int")


def columns():
    return {c: F.col(c) for c in INPUTS}


@pytest.fixture(scope="module")
def fitted(spark):
    x, y = sample()
    df = as_frame(spark, x, y)
    model = boosting.fit_boosted(df, columns(), **OPTIONS)
    return x, y, df, model, [boosting.Node(*r) for r in model.collect()]


def walk(nodes, tree, row, at=0):
    """Node reached in a tree, in plain loops."""
    by_node = {n.node: n for n in nodes if n.tree == tree}
    while by_node[at].input:
        n, v = by_node[at], row[INPUTS.index(by_node[at].input)]
        at = 2 * at + 1 + (not (n.missing_left if math.isnan(v) else v <= n.threshold))
    return at


def plain_margin(nodes, row):
    trees = sorted({n.tree for n in nodes})
    return sum(next(n.value for n in nodes if (n.tree, n.node) == (t, walk(nodes, t, row))) for t in trees)


def test_each_split_is_the_best_of_all(fitted):
    """Every split, side for missing values, leaf value and cover against loops over all edges."""
    x, y, _, _, nodes = fitted
    edges = [sorted({n for n in np.quantile(c[~np.isnan(c)], np.arange(1, 16) / 16, method="inverted_cdf")}) for c in x.T]
    share = y.mean()
    margin = np.full(len(y), math.log(share / (1 - share)))
    assert next(n.value for n in nodes if n.tree == -1) == pytest.approx(margin[0])
    for tree in range(3):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        own = {n.node: n for n in nodes if n.tree == tree}
        members = {0: np.ones(len(y), bool)}
        for at in sorted(own):
            inside = members[at]
            assert own[at].cover == pytest.approx(h[inside].sum())
            gains = {}
            for j, left_of in itertools.product(range(5), (True, False)):
                for edge in edges[j]:
                    left = inside & np.where(np.isnan(x[:, j]), left_of, x[:, j] <= edge)
                    right = inside & ~left
                    if (inside & (x[:, j] > edge)).any() and min(h[left].sum(), h[right].sum()) >= 0.5:
                        part = [g[s].sum() ** 2 / (h[s].sum() + 1) for s in (left, right, inside)]
                        gains[j, edge, left_of] = part[0] + part[1] - part[2]
            best = max(gains.values(), default=0)
            n = own[at]
            if n.input is None:
                assert at >= 7 or best <= 1e-6
                assert n.value == pytest.approx(-0.3 * g[inside].sum() / (h[inside].sum() + 1))
                margin[inside] += n.value
                continue
            assert gains[INPUTS.index(n.input), n.threshold, n.missing_left] == pytest.approx(best)
            column = x[:, INPUTS.index(n.input)]
            left = np.where(np.isnan(column), n.missing_left, column <= n.threshold)
            members[2 * at + 1], members[2 * at + 2] = inside & left, inside & ~left


def test_scores_from_the_stored_table(spark, fitted, tmp_path):
    x, _, df, model, nodes = fitted
    boosting.export_boosted(model, str(tmp_path / "m"))
    loaded = boosting.load_boosted(spark, str(tmp_path / "m"))
    got = boosting.with_margin(loaded, df, columns()).select(*INPUTS, "margin").collect()
    assert len(got) == len(x)
    for r in got:
        assert r.margin == pytest.approx(plain_margin(nodes, [math.nan if v is None else v for v in r[:5]]), abs=1e-12)


def test_contributions_against_all_subsets(fitted):
    x, _, df, model, nodes = fitted
    by_tree = {t: {n.node: n for n in nodes if n.tree == t} for t in {n.tree for n in nodes}}

    def expected(tree, at, row, known):
        n = tree[at]
        if n.input is None:
            return n.value
        sides = 2 * at + 1, 2 * at + 2
        if n.input in known:
            v = row[INPUTS.index(n.input)]
            return expected(tree, sides[not (n.missing_left if math.isnan(v) else v <= n.threshold)], row, known)
        return sum(tree[s].cover / n.cover * expected(tree, s, row, known) for s in sides)

    def worth(row, known):
        return sum(expected(tree, 0, row, known) for tree in by_tree.values())

    got = boosting.contributions(model, df, columns(), tuple(INPUTS)).collect()
    assert len(got) == len(x)
    for r in got[:25]:
        row = [math.nan if v is None else v for v in r[:5]]
        assert r.base == pytest.approx(worth(row, ()))
        for i, name in enumerate(INPUTS):
            others = [c for c in INPUTS if c != name]
            shapley = 0.0
            for size in range(5):
                for known in itertools.combinations(others, size):
                    share = math.factorial(size) * math.factorial(4 - size) / math.factorial(5)
                    shapley += share * (worth(row, (*known, name)) - worth(row, known))
            assert r.contributions[i] == pytest.approx(shapley, abs=1e-12)
    for r in got:
        row = [math.nan if v is None else v for v in r[:5]]
        assert r.base + sum(r.contributions) == pytest.approx(plain_margin(nodes, row), abs=1e-12)


def test_empty_and_one_sided_tables(spark):
    x, y = sample(20)
    df = as_frame(spark, x, y)
    empty = boosting.fit_boosted(df.filter("false"), columns(), **OPTIONS).collect()
    assert [(r.tree, r.value, r.cover) for r in empty] == [(-1, 0.0, 0.0)]
    ones = boosting.fit_boosted(df.withColumn("label", F.lit(1)), columns(), **OPTIONS)
    scores = {r.margin > -1 for r in boosting.with_margin(ones, df, columns()).collect()}
    assert scores == {True}
    blank = df.select(*[F.lit(None).cast("double").alias(c) for c in INPUTS], "label")
    lone = boosting.fit_boosted(blank, columns(), **OPTIONS)
    assert {r.input for r in lone.collect()} == {None}


def test_unknown_input_raises(fitted):
    _, _, df, model, _ = fitted
    with pytest.raises(Exception, match="model input without a column"):
        boosting.with_margin(model, df, {"p": F.col("p")}).collect()


def test_held_out_quality_is_not_below_the_pipeline(spark, tmp_path):
    rule = (F.col("avg_sbp") < 105) | (F.col("lag_1_avg_sbp").isNull() & (F.col("gender") == "F"))
    made = features_from_telemetry(*random_inputs(spark, 12)).withColumn("label", F.when(rule, 1).otherwise(0))
    made.write.parquet(str(tmp_path / "features"))
    features = spark.read.parquet(str(tmp_path / "features"))
    model = boosting.train_boosted(features, rounds=5, depth=4)
    score = boosting.score_boosted(model, features.filter("dataset_split = 'TEST'"))
    rows = score.select("label", "probability_1", "predicted_label").collect()
    other = classifier.evaluate_model(classifier.train(features, maxIter=5, maxDepth=4), features).first()
    assert auc(*zip(*[(r.label, r.probability_1) for r in rows])) >= other.roc_auc - 1e-9
    assert {r.predicted_label for r in rows} == {"0", "1"}
    shares = {r.feature: r.attribution for r in boosting.global_attribution(model, features).collect()}
    assert len(shares) == 21 and max(shares, key=shares.get) == "avg_sbp"


def test_a_level_shuffles_cells(spark):
    """Gradient sums by node, input and bin against loops; no row is written once per input on the way."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 3))
    x[rng.random(x.shape) < 0.2] = np.nan
    rows = [([None if math.isnan(v) else float(v) for v in r], float(i % 2), 1.0 + i % 3) for i, r in enumerate(x)]
    rows = spark.createDataFrame(rows, "x array<double>, y double, w double").repartition(3)
    edges = [[-0.5, 0.0, 0.5], [0.0], []]
    rows = boosting._binned(rows, edges).withColumn("margin", F.lit(0.25))
    cells = boosting._cells(rows, {0: (0, 1, True)}, [1, 2], 3, 4, 2)
    assert "Generate" not in cells._jdf.queryExecution().executedPlan().toString()
    wanted = {}
    p = 1 / (1 + math.exp(-0.25))
    for i, r in enumerate(x):
        node = 1 if math.isnan(r[0]) or r[0] <= 0.0 else 2
        for j, v in enumerate(r):
            sums = wanted.setdefault((node, j, -1 if math.isnan(v) else sum(e < v for e in edges[j])), [0.0, 0.0])
            sums[0] += (1 + i % 3) * (p - i % 2)
            sums[1] += (1 + i % 3) * p * (1 - p)
    got = {(r.node, r.j, r.bin): (r.g, r.h) for r in cells.collect()}
    assert got.keys() == wanted.keys()
    assert all(got[k] == pytest.approx(wanted[k]) for k in got)


def test_inputs_are_computed_once_a_row(spark):
    """Two nodes of one tree that ask the same of an input see the same value, also of a random one."""
    nodes = [(0, 0, "p", 0.5, True, 0.0, 4.0), (0, 1, "p", 0.5, True, 0.0, 2.0), (0, 2, None, None, None, 0.0, 2.0)]
    nodes += [(0, 3, None, None, None, 0.0, 1.0), (0, 4, None, None, None, 1.0, 1.0)]
    model = spark.createDataFrame(nodes, boosting.MODEL_SCHEMA)
    scored = boosting.with_margin(model, spark.range(1000), {"p": F.rand(5)})
    assert {r.margin for r in scored.collect()} == {0.0}


def test_a_leaf_is_worked_out_once_a_pattern(monkeypatch):
    """However many rows there are; also where a path has too many inputs for a table."""
    counted = []
    plainly = boosting._pattern_contributions

    def count(path, patterns):
        counted.append(len(patterns))
        return plainly(path, patterns)

    monkeypatch.setattr(boosting, "_pattern_contributions", count)
    m = 10
    path = boosting._Path(2.0, list(range(m)), [0.5 + i / 40 for i in range(m)], [[(i, True)] for i in range(m)])
    splits = [(j, 0.0, True) for j in range(m)]
    rows = np.where(np.arange(5000)[:, None] % 4 == np.arange(m) % 4, 1.0, -1.0)
    rows[::5, 2] = np.nan
    direct = boosting._path_contributions([path], splits, [None], rows)
    assert counted == [5]
    table = plainly(path, np.arange(2**m))
    assert np.allclose(boosting._path_contributions([path], splits, [table], rows), direct)
    whole = 2.0 * (np.isnan(rows) | (rows <= 0)).all(axis=1)
    assert direct.sum(axis=1) + 2.0 * math.prod(path.shares) == pytest.approx(whole)


def test_global_attribution_averages_rows_where_they_are(spark):
    x, _ = sample(40)
    names = list(boosting.MODEL_FEATURES)
    rows = spark.createDataFrame([tuple(float(v) for v in np.nan_to_num(r)) for r in np.resize(x, (40, 21))], ", ".join(f"{c} double" for c in names))
    rows = rows.withColumn("gender", F.lit("M"))
    model = boosting.fit_boosted(rows.withColumn("label", (F.col(names[2]) > 0).cast("int")), boosting.numeric_inputs(rows), **OPTIONS)
    found = boosting.global_attribution(model, rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Aggregate") and "Generate" not in plan[plan.index("Aggregate"):]
    each = boosting.contributions(model, rows).collect()
    wanted = {c: sum(abs(r.contributions[j]) for r in each) / 40 for j, c in enumerate(names)}
    assert {r.feature: r.attribution for r in found.collect()} == pytest.approx(wanted)
    assert boosting.global_attribution(model, rows.filter("false")).collect() == []
