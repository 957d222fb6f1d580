"""Second-order boosted trees fitted by aggregation, kept as a table and scored by expressions.

A model is a table with one row per node: ``tree``, ``node``, ``input``, ``threshold``,
``missing_left``, ``value`` and ``cover``. Children of node ``i`` are ``2 i + 1``, where
values up to the threshold go, and ``2 i + 2``; missing values take the side that the
split learnt for them. A leaf has no input. Tree -1 holds the margin that all rows start
with. The driver sees nodes and bin edges, never rows or histograms.
"""

import math
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haemoloom.operators.risk import class_weights
from haemoloom.runtime import scratch_path
from haemoloom.schemas import MODEL_FEATURES

MODEL_SCHEMA = "tree int, node int, input string, threshold double, missing_left boolean, value double, cover double"

#: Bin of missing values.
_MISSING = -1


class Node(NamedTuple):
    tree: int
    node: int
    input: str | None
    threshold: float | None
    missing_left: bool | None
    value: float
    cover: float


def numeric_inputs(features: DataFrame) -> dict[str, Column]:
    """The model's inputs as doubles; gender is 1 for M, 0 for F and else missing."""
    gender = F.when(F.col("gender") == "M", 1.0).when(F.col("gender") == "F", 0.0)
    return {c: gender if c == "gender" else F.col(c).cast("double") for c in MODEL_FEATURES}


def _known(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _edges(rows: DataFrame, width: int, bins: int) -> list[list[float]]:
    """Increasing upper edges of each input's bins, but for the last bin."""
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(F.col("x")[j], shares, 10_000).alias(f"e{j}") for j in range(width)]).first()
    return [sorted(set(edges or [])) for edges in found]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of lists of ``width`` as rows; missing doubles are NaN."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _lists(values: np.ndarray) -> pa.Array:
    """The rows of ``values`` as a column of lists."""
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def _packed(b: np.ndarray) -> pa.Array:
    """Binned rows as a column of one value of bytes each, which is read and passed on faster than a list."""
    offsets = np.arange(len(b) + 1, dtype=np.int32) * (2 * b.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(b), [None, pa.py_buffer(offsets), pa.py_buffer(b.tobytes())])


def _unpacked(column: pa.Array, width: int) -> np.ndarray:
    if not len(column):
        return np.zeros((0, width), np.int16)
    return np.frombuffer(column.buffers()[2], np.int16, len(column) * width).reshape(-1, width)


def _binned(rows: DataFrame, edges: list[list[float]]) -> DataFrame:
    """``rows`` with ``b``, the packed bins of ``x``, in place of ``x``."""
    width = len(edges)

    def place(batches):
        for batch in batches:
            x = _matrix(batch.column(0), width)
            b = np.empty(x.shape, np.int16)
            for j, own in enumerate(edges):
                b[:, j] = np.where(np.isnan(x[:, j]), _MISSING, np.searchsorted(own, x[:, j]))
            yield pa.RecordBatch.from_arrays([_packed(b), *batch.columns[1:]], ["b", *batch.schema.names[1:]])

    rest = [c for c in rows.columns if c != "x"]
    schema = T.StructType().add("b", "binary")
    return rows.select("x", *rest).mapInArrow(place, T.StructType([*schema, *rows.select(*rest).schema]))


def _reached(b: np.ndarray, splits: dict[int, tuple], levels: int) -> np.ndarray:
    """The node that each binned row reaches in a tree of ``levels``; ``splits`` has input, bin and missing side of each split."""
    size = 2 ** (levels + 1)
    inputs, lasts, missing_left = np.full(size, -1), np.full(size, _MISSING), np.zeros(size, bool)
    for at, (j, last, left) in splits.items():
        inputs[at], lasts[at], missing_left[at] = j, last, left
    node, row = np.zeros(len(b), np.int64), np.arange(len(b))
    for _ in range(levels):
        j = inputs[node]
        own = b[row, j]
        left = np.where(own == _MISSING, missing_left[node], own <= lasts[node])
        node = np.where(j < 0, node, 2 * node + 2 - left)
    return node


def _cells(rows: DataFrame, splits: dict[int, tuple], grown: list[int], width: int, bins: int, depth: int) -> DataFrame:
    """Sums ``g`` and ``h`` of the gradients in the nodes ``grown`` by ``node``, ``j`` and ``bin``.

    A task adds up its rows in arrays as large as nodes times inputs times bins, so that
    cells are shuffled, not one row per value.
    """
    shape = len(grown), width, bins + 1

    def add_up(batches):
        place = np.full(2 ** (depth + 1), -1)
        place[grown] = np.arange(len(grown))
        counts, g, h = np.zeros(shape, np.int64), np.zeros(shape), np.zeros(shape)
        each = len(grown) * (bins + 1)
        for batch in batches:
            b = _unpacked(batch.column(0), width)
            at = place[_reached(b, splits, depth)]
            inside = at >= 0
            y, w, margin = (batch.column(i).to_numpy(zero_copy_only=False)[inside] for i in (1, 2, 3))
            chance = 1 / (1 + np.exp(-margin))
            steps = w * (chance - y), w * chance * (1 - chance)
            first = at[inside] * (bins + 1) - _MISSING
            for j, own in enumerate(b[inside].T):
                cell = first + own
                counts[:, j] += np.bincount(cell, minlength=each).reshape(-1, bins + 1)
                for total, step in zip((g, h), steps):
                    total[:, j] += np.bincount(cell, step, each).reshape(-1, bins + 1)
        node, j, own = filled = np.nonzero(counts)
        columns = [np.array(grown)[node], j, own + _MISSING]
        columns = [pa.array(c.astype(np.int32)) for c in columns] + [pa.array(total[filled]) for total in (g, h)]
        yield pa.RecordBatch.from_arrays(columns, ["node", "j", "bin", "g", "h"])

    found = rows.select("b", "y", "w", "margin").mapInArrow(add_up, "node int, j int, bin int, g double, h double")
    # By input and node, as the windows over bins need them.
    return found.repartition("node", "j").groupBy("node", "j", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def _with_values(rows: DataFrame, splits: dict[int, tuple], values: list[float], width: int, depth: int) -> DataFrame:
    """``rows`` with the value of the leaf that each reaches added to its margin."""

    def add(batches):
        for batch in batches:
            reached = _reached(_unpacked(batch.column(0), width), splits, depth)
            margin = batch.column(3).to_numpy(zero_copy_only=False) + np.array(values)[reached]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(margin)], ["b", "y", "w", "margin"])

    rows = rows.select("b", "y", "w", "margin")
    return rows.mapInArrow(add, rows.schema)


def _best_splits(sums: DataFrame, smooth: float, least_weight: float, least_gain: float) -> DataFrame:
    """The best split of each node from sums ``g`` and ``h`` by ``node``, ``j`` and ``bin``, if one gains enough.

    A window holds the bins of one input in one node.
    """
    cell = Window.partitionBy("node", "j")
    known = F.col("bin") != _MISSING
    upto = cell.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    columns = {}
    for s in ("g", "h"):
        columns[f"{s}_all"] = F.sum(s).over(cell)
        columns[f"{s}_missing"] = F.sum(F.when(known, 0.0).otherwise(F.col(s))).over(cell)
        columns[f"{s}_known"] = F.sum(F.when(known, F.col(s)).otherwise(0.0)).over(upto)
    sums = sums.withColumns(columns).withColumn("last", F.max("bin").over(cell)).filter(known & (F.col("bin") < F.col("last")))
    ways = sums.withColumn("missing_left", F.explode(F.array(F.lit(True), F.lit(False))))
    side = lambda s: F.col(f"{s}_known") + F.when(F.col("missing_left"), F.col(f"{s}_missing")).otherwise(0.0)
    part = lambda g, h: g * g / (h + smooth)
    ways = ways.withColumns({"g_left": side("g"), "h_left": side("h")})
    g_right, h_right = F.col("g_all") - F.col("g_left"), F.col("h_all") - F.col("h_left")
    gain = part(F.col("g_left"), F.col("h_left")) + part(g_right, h_right) - part(F.col("g_all"), F.col("h_all"))
    ways = ways.filter((F.col("h_left") >= least_weight) & (h_right >= least_weight)).withColumn("gain", gain)
    # Of equal gains, which sums may give with different last digits, the first input and bin.
    order = F.struct(F.round("gain", 9), -F.col("j"), -F.col("bin"), "missing_left")
    best = ways.filter(F.col("gain") > least_gain).groupBy("node")
    split = F.struct("j", "bin", "missing_left", "g_all", "h_all", "g_left", "h_left")
    return best.agg(F.max_by(split, order).alias("split")).select("node", "split.*")


def fit_boosted(
    rows: DataFrame,
    inputs: dict[str, Column],
    label: str = "label",
    weight: Column | None = None,
    rounds: int = 20,
    depth: int = 6,
    rate: float = 0.3,
    bins: int = 64,
    smooth: float = 1.0,
    least_weight: float = 1.0,
    least_gain: float = 1e-6,
) -> DataFrame:
    """The model table for the probability that ``label`` is 1.

    Rows whose label is neither 0 nor 1 are left out; NULL and NaN inputs are missing.
    Without rows the model is its starting margin, 0. Each round reads binned rows with
    their margins from the shared folder and writes them anew, so a lost executor costs
    one step and plans stay short.
    """
    spark = rows.sparkSession
    names = list(inputs)
    weight = F.lit(1.0) if weight is None else weight.cast("double")
    values = F.array(*[_known(c.cast("double")) for c in inputs.values()])
    rows = rows.filter(F.col(label).isin(0, 1)).select(values.alias("x"), F.col(label).cast("double").alias("y"), weight.alias("w"))
    rows = _stored(rows, "boost-rows")
    edges = _edges(rows, len(names), bins)
    total = rows.agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("y")).alias("wy")).first()
    share = total.wy / total.w if total.w else 0.5
    prior = math.log(share / (1 - share)) if 0 < share < 1 else 0.0
    made = [Node(-1, 0, None, None, None, prior, float(total.w or 0))]
    rows = _stored(_binned(rows, edges).withColumn("margin", F.lit(prior)), "boost-bins")
    for tree in range(rounds if total.w else 0):
        splits: dict[int, tuple] = {}
        sums: dict[int, tuple] = {}
        grown = [0]
        for _ in range(depth):
            cells = _cells(rows, splits, grown, len(names), bins, depth)
            found = _best_splits(cells, smooth, least_weight, least_gain).collect()  # one row per node of the level
            for r in found:
                splits[r.node] = (r.j, r.bin, r.missing_left)
                sums |= {r.node: (r.g_all, r.h_all), 2 * r.node + 1: (r.g_left, r.h_left)}
                sums[2 * r.node + 2] = (r.g_all - r.g_left, r.h_all - r.h_left)
            grown = [child for r in found for child in (2 * r.node + 1, 2 * r.node + 2)]
            if not grown:
                break
        if not splits:  # no later round finds a split either
            break
        values = [0.0] * 2 ** (depth + 1)
        for at, (g, h) in sums.items():
            if at in splits:
                j, last, missing_left = splits[at]
                made.append(Node(tree, at, names[j], edges[j][last], missing_left, 0.0, h))
            else:
                values[at] = -rate * g / (h + smooth)
                made.append(Node(tree, at, None, None, None, values[at], h))
        rows = _stored(_with_values(rows, splits, values, len(names), depth), "boost-bins")
    return spark.createDataFrame(made, MODEL_SCHEMA)


def train_boosted(features: DataFrame, balanced: bool = True, **options) -> DataFrame:
    """A model table fitted on the TRAIN rows of ``features``, with classes of equal weight if ``balanced``."""
    rows = features.filter(F.col("dataset_split") == "TRAIN").filter(F.col("label").isin(0, 1))
    if not balanced:
        return fit_boosted(rows, numeric_inputs(rows), **options)
    # Two classes, so two rows: this side cannot grow with the data.
    rows = rows.join(F.broadcast(class_weights(rows).select("label", "class_weight")), "label")
    return fit_boosted(rows, numeric_inputs(rows), weight=F.col("class_weight"), **options)


def with_margin(model: DataFrame, rows: DataFrame, inputs: dict[str, Column], name: str = "margin") -> DataFrame:
    """Add the margin of each row: one walk down each tree of the model table, in array expressions.

    The table is read as one value, so it may come from any file; its size is that of
    the trees. An input that the model names and ``inputs`` does not raises.
    """
    place = F.when(F.col("input").isNull(), F.lit(-1))
    for j, own in enumerate(inputs):
        place = place.when(F.col("input") == own, j)
    place = place.otherwise(F.raise_error(F.concat(F.lit("model input without a column: "), F.col("input"))))
    # In the order of nodes, each split's children follow those of the splits before it.
    before = Window.partitionBy("tree").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    left = 2 * F.coalesce(F.count("input").over(before), F.lit(0)) + 1
    node = F.struct("node", place.cast("int").alias("input"), "threshold", "missing_left", "value", left.cast("int").alias("left"))
    trees = model.select("tree", node.alias("node")).groupBy("tree")
    trees = trees.agg(F.max("node.node").alias("last"), F.sort_array(F.collect_list("node")).alias("nodes"))
    every = trees.agg(F.sort_array(F.collect_list(F.struct("tree", "last", "nodes"))).alias("trees"))
    values = F.array(*[_known(c.cast("double")) for c in inputs.values()])

    def leaf(tree: Column, row: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            here = F.get(tree["nodes"], at)
            own = F.get(row, here["input"])
            left = F.when(own.isNull(), here["missing_left"]).otherwise(own <= here["threshold"])
            return F.when(here["input"] < 0, at).when(left, here["left"]).otherwise(here["left"] + 1)

        levels = F.sequence(F.lit(0), F.floor(F.log2(tree["last"] + F.lit(1.0))).cast("int"))
        return F.get(tree["nodes"], F.aggregate(levels, F.lit(0), step))["value"]

    def total(row: Column) -> Column:
        return F.aggregate(F.col("trees__"), F.lit(0.0), lambda sum_, tree: sum_ + leaf(tree, row))

    # A lambda's argument is computed once a row, and not again at every node.
    margin = F.transform(F.array(values), total)[0]
    return rows.withColumn("trees__", every.scalar()).withColumn(name, margin).drop("trees__")


def score_boosted(model: DataFrame, features: DataFrame) -> DataFrame:
    """Add ``predicted_label`` (text) and the probabilities of both classes, from the model table alone."""
    one = 1 / (1 + F.exp(-F.col("margin__")))
    scored = with_margin(model, features, numeric_inputs(features), "margin__").withColumn("probability_1", one)
    scored = scored.withColumn("probability_0", 1 - F.col("probability_1"))
    label = (F.col("probability_1") > F.col("probability_0")).cast("int").cast("string")
    return scored.select(*features.columns, label.alias("predicted_label"), "probability_0", "probability_1")


def export_boosted(model: DataFrame, path: str) -> None:
    """Write the model table as one Parquet file, replacing what ``path`` holds."""
    model.coalesce(1).write.mode("overwrite").parquet(path)


def load_boosted(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MODEL_SCHEMA).parquet(path)


#: Inputs of a path up to which what they contribute is tabled for all patterns of passed splits.
_TABLED = 8


class _Path(NamedTuple):
    """A leaf: for each input on its path, the share of training weight that its splits let through, and its splits."""

    value: float
    inputs: list[int]
    shares: list[float]
    splits: list[list[tuple[int, bool]]]  # place among all splits, path goes left


def _paths(nodes: list[Node], names: list[str]) -> tuple[list[_Path], list[tuple[int, float, bool]]]:
    """The leaves, and all different splits as input, threshold and side of missing values."""
    found, every = [], {}
    for _, tree in groupby(sorted(nodes), key=lambda n: n.tree):
        tree = {n.node: n for n in tree}
        for leaf in (n for n in tree.values() if n.input is None):
            parts: dict[int, list] = {}
            at = leaf.node
            while at:
                above = tree[(at - 1) // 2]
                j = names.index(above.input)
                part = parts.setdefault(j, [1.0, []])
                part[0] *= tree[at].cover / above.cover
                split = every.setdefault((j, above.threshold, above.missing_left), len(every))
                part[1].append((split, at % 2 == 1))
                at = above.node
            found.append(_Path(leaf.value, list(parts), [p[0] for p in parts.values()], [p[1] for p in parts.values()]))
    return found, list(every)


def _pattern_contributions(path: _Path, patterns: np.ndarray) -> np.ndarray:
    """Shapley values of the path's inputs, one row each, for patterns whose bit i says that input i passes.

    What a leaf gives to a set of known inputs is a product over the inputs of its path:
    1 or 0 for a known one, its share for another. A polynomial in the number of known
    inputs therefore counts all sets at once.
    """
    m = len(path.inputs)
    passed = [(patterns >> i & 1).astype(float) for i in range(m)]
    weights = np.array([math.factorial(s) * math.factorial(m - 1 - s) / math.factorial(m) for s in range(m)])
    out = np.zeros((m, len(patterns)))
    for i in range(m):
        sets = np.zeros((m, len(patterns)))
        sets[0] = 1
        for k in range(m):
            if k != i:
                grown = sets * path.shares[k]
                grown[1:] += sets[:-1] * passed[k]
                sets = grown
        out[i] = path.value * (passed[i] - path.shares[i]) * (weights @ sets)
    return out


def _path_contributions(paths: list[_Path], splits: list[tuple], tables: list, rows: np.ndarray) -> np.ndarray:
    """Shapley values of each row's inputs.

    A leaf's part depends only on which of its inputs pass, so it is computed once for a
    pattern and taken from there for each row.
    """
    out = np.zeros(rows.shape[::-1])
    columns = np.ascontiguousarray(rows.T)
    missing = np.isnan(columns)
    left = [np.where(missing[j], missing_left, columns[j] <= threshold) for j, threshold, missing_left in splits]
    right = [~side for side in left]
    for path, table in zip(paths, tables):
        pattern = np.zeros(len(rows), np.int64)
        for i, own in enumerate(path.splits):
            good = np.logical_and.reduce([(left if goes_left else right)[at] for at, goes_left in own])
            pattern += good.astype(np.int64) << i
        if table is None:
            seen, pattern = np.unique(pattern, return_inverse=True)
            table = _pattern_contributions(path, seen)
        for j, worth in zip(path.inputs, table):
            out[j] += worth[pattern]
    return out.T


def contributions(model: DataFrame, features: DataFrame, inputs: dict[str, Column] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """What each input adds to each row's margin: ``keep``, ``base`` and ``contributions``, in the order of ``inputs``.

    Exact path-dependent Shapley values; ``base`` plus the contributions is the margin.
    """
    inputs = inputs or numeric_inputs(features)
    nodes = [Node(*r) for r in model.select(*Node._fields).collect()]  # as many as the trees have
    paths, splits = _paths(nodes, list(inputs))
    base = sum(path.value * math.prod(path.shares) for path in paths)
    rows = features.select(*keep, F.array(*[_known(c.cast("double")) for c in inputs.values()]).alias("x__"))
    width = len(inputs)

    def explain(batches):
        small = [len(p.inputs) <= _TABLED for p in paths]
        tables = [_pattern_contributions(p, np.arange(2 ** len(p.inputs))) if few else None for p, few in zip(paths, small)]
        for batch in batches:
            found = _path_contributions(paths, splits, tables, _matrix(batch.column(len(keep)), width).astype(float))
            columns = [batch.column(i) for i in range(len(keep))] + [pa.array(np.full(len(found), base)), _lists(found)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "base", "contributions"])

    schema = rows.select(*keep).schema.add("base", "double").add("contributions", T.ArrayType(T.DoubleType()))
    return rows.mapInArrow(explain, schema)


def global_attribution(model: DataFrame, features: DataFrame) -> DataFrame:
    """``feature`` and ``attribution``: the mean absolute contribution of each input over all rows."""
    names = list(numeric_inputs(features))
    each = contributions(model, features)
    means = each.agg(*[F.avg(F.abs(F.col("contributions")[j])).alias(name) for j, name in enumerate(names)])
    pairs = F.array(*[F.struct(F.lit(name).alias("feature"), F.col(name).alias("attribution")) for name in names])
    return means.select(F.explode(pairs).alias("pair")).select("pair.*").filter("attribution IS NOT NULL")
