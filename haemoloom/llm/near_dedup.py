"""Near duplicates by an LSH forest.

Documents are sets of word shingles. Classes of equal sets are represented once.
Each tree of the forest sorts the representatives by a MinHash signature of its own
and cuts the order into regions: where few documents share a prefix a short one is a
region, where many do it is followed to the depth at which few do. In a region the
neighbours with the longest common prefix and the first document of that prefix are
candidates; candidates are confirmed on the full sets and joined to components. Then
documents of a region are compared with the closest that are in other components.
Where a prefix is shared by more than a few documents, what is still in different
components is joined on the shingles that are rare among them, which is exact.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haemoloom.llm.common import byte_texts, stored, text_keys, text_or_empty
from haemoloom.llm.components import connected_components

SHINGLE_WORDS = 5

#: Percent of the union that the intersection of linked sets has at least.
THRESHOLD = 75

#: Trees, slots of a tree's signature, and slots that candidates share at least. At
#: the threshold a pair shares three slots in some tree with a probability above
#: 1 - 1e-5.
TREES = 24
DEPTH = 8
LEAST_DEPTH = 3

#: Documents of a region, about: a prefix that more share is followed deeper. At the
#: greatest depth documents are dealt to regions by their numbers.
REGION = 256

#: Documents of a region in which all pairs are candidates from the start.
SMALL = 8

#: Documents of a region that a document is compared with before the join on rare shingles.
CLOSEST = 3

#: Candidates that a mean is drawn towards the least with.
FEW = 10

#: Counters of shingles, by which those rare in crowds are told.
COUNTERS = 1 << 18

#: Documents that hold one rare shingle and are joined together in one task.
TOGETHER = 1024

#: Slots in a hundred that must agree before full sets are compared: four standard
#: deviations below the threshold.
LEAST_AGREEMENT = 0.62

#: Rows of regions that are sorted in one task at least.
SORTED_TOGETHER = 4096

_SLOTS = TREES * DEPTH
_SLOT_BYTES = 2
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    made = np.random.default_rng(20240229).integers(0, 1 << 32, (2, _SLOTS), np.uint64).astype(np.uint32)
    return (made[0] | np.uint32(1))[:, None], made[1][:, None]


_FACTOR, _SHIFT = _coefficients()


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit names of the shingles of ``text``; fewer words make one shingle, no word makes none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(SHINGLE_WORDS, len(words))
    names = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        names = (names ^ (names >> np.uint64(31))) * _ODD + hashes[i : i + len(names)]
    return np.unique(names ^ (names >> np.uint64(29)))


def signature(names: np.ndarray) -> np.ndarray:
    """16 bits for each slot: of the shingle that comes first in the slot's order."""
    low = (names >> np.uint64(32)).astype(np.uint32)
    least = np.full(_SLOTS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 1024):
        np.minimum(least, (low[None, at : at + 1024] * _FACTOR + _SHIFT).min(axis=1), out=least)
    return (least & np.uint32(0xFFFF)).astype(">u2")


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


_SIGNED = "doc_id long, h1 long, h2 long, n_shingles long, s1 long, s2 long, signature binary"


def _sign(batches):
    for batch in batches:
        sets = [shingles(t) for t in byte_texts(batch.column(3))]
        prints = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
        columns = [batch.column(i) for i in range(3)]
        columns += [pa.array([len(s) for s in sets], pa.int64())]
        columns += [pa.array([_signed(p >> 64) for p in prints], pa.int64())]
        columns += [pa.array([_signed(p & (1 << 64) - 1) for p in prints], pa.int64())]
        columns += [pa.array([signature(s).tobytes() if len(s) else b"" for s in sets], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "h1", "h2", "n_shingles", "s1", "s2", "signature"])


def _whole_regions(batches):
    """Arrays (region, tree, node, root, size, slots) of the rows of whole regions, whatever batches they come in."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
        new.append(np.frombuffer(b"".join(batch.column(5).to_pylist()), ">u2").astype(np.uint16).reshape(-1, _SLOTS))
        held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
        # The last region may go on in the next batch.
        end = int(np.searchsorted(held[0], held[0][-1]))
        if end:
            yield [x[:end] for x in held]
            held = [x[end:] for x in held]
    if held is not None:
        yield held


def _agreeing_rows(left, right, size, slots):
    """The pairs of rows that agree in enough slots and may be similar by their sizes, and how much they agree."""
    close = 100 * np.minimum(size[left], size[right]) >= THRESHOLD * np.maximum(size[left], size[right])
    left, right = left[close], right[close]
    agreement = np.zeros(len(left))
    for at in range(0, len(left), 4096):
        part = slice(at, at + 4096)
        agreement[part] = (slots[left[part]] == slots[right[part]]).mean(axis=1)
    good = agreement >= LEAST_AGREEMENT
    return left[good], right[good], agreement[good]


def _pair_batch(left, right, agreement, node) -> pa.RecordBatch:
    one, two = node[left], node[right]
    columns = [np.minimum(one, two), np.maximum(one, two), agreement]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "agreement"])


def _closest(row, agreement) -> np.ndarray:
    """Places of the pairs in which a row agrees most, ``CLOSEST`` for each row."""
    order = np.lexsort((-agreement, row))
    row = row[order]
    new = np.append(True, row[1:] != row[:-1])[: len(order)]
    places = np.arange(len(order))
    first = np.maximum.accumulate(np.where(new, places, 0))
    return order[places - first < CLOSEST]


def _first_candidates(batches):
    """Neighbours in the order of a region, and each row with the first of its longest shared prefix."""
    for region, tree, node, _, size, slots in _whole_regions(batches):
        n = len(region)
        rows = np.arange(n)
        keys = slots.reshape(n, TREES, DEPTH)[rows, tree]
        inside = np.concatenate([[False], region[1:] == region[:-1]])
        equal = np.concatenate([np.zeros((1, DEPTH), bool), keys[1:] == keys[:-1]])
        shared = np.cumprod(equal, axis=1).sum(axis=1) * inside  # with the row before
        deepest = np.maximum(shared, np.append(shared[1:], 0))
        start = np.maximum.accumulate(np.where(inside, 0, rows))
        many = np.diff(np.append(np.flatnonzero(~inside), n))
        many = np.repeat(many, many) > SMALL
        left, right = [], []
        for depth in range(1, DEPTH + 1):
            first = np.maximum.accumulate(np.where(shared < depth, rows, 0))
            led = rows[(deepest == depth) & (first < rows)]
            left.append(first[led])
            right.append(led)
        for step in range(1, SMALL):
            later = rows[step:]
            later = later[(start[later] <= later - step) & (~many[later] | (step == 1))]
            left.append(later - step)
            right.append(later)
        pairs = np.unique(np.concatenate(left) * n + np.concatenate(right))
        yield _pair_batch(*_agreeing_rows(pairs // n, pairs % n, size, slots), node)


def _second_candidates(batches):
    """Pairs of a region whose ends are in different components, and in which one agrees most.

    All others are left to the join on rare shingles.
    """
    for region, _, node, root, size, slots in _whole_regions(batches):
        starts = np.flatnonzero(np.append(True, region[1:] != region[:-1]))
        for start, end in zip(starts, np.append(starts[1:], len(region))):
            roots = root[start:end]
            left, right = np.nonzero(np.triu(roots[:, None] != roots[None, :]))
            left, right, agreement = _agreeing_rows(start + left, start + right, size, slots)
            best = np.unique(np.concatenate([_closest(left, agreement), _closest(right, agreement)]))
            left, right, agreement = left[best], right[best], agreement[best]
            yield _pair_batch(left, right, agreement, node)


def _representatives(signed: DataFrame) -> DataFrame:
    """One stored row per class of equal sets: ``node``, the keys of its first document, size and signature."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h1", "h2"))
    classes = signed.filter("n_shingles > 0").groupBy("s1", "s2").agg(
        first.alias("first"), F.first("n_shingles").alias("size"), F.first("signature").alias("signature")
    )
    return stored(classes.withColumn("node", F.monotonically_increasing_id()), "near-classes")


def _prefix(depth) -> Column:
    return F.substring(F.col("key"), F.lit(1), F.lit(_SLOT_BYTES) * depth)


def _regions(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The region of each node in each tree where it shares a prefix, and pairs of nodes that stand for regions, both stored.

    The first has ``node``, ``tree``, ``key``, ``region``, its size ``n``, and
    ``crowd``, which is set where the least prefix has more than one region.
    """
    tree_bytes = DEPTH * _SLOT_BYTES
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.substring(F.col("signature"), t * tree_bytes + 1, F.lit(tree_bytes))
    )
    places = classes.select("node", F.posexplode(keys).alias("tree", "key")).withColumn("prefix", _prefix(LEAST_DEPTH))
    shared = places.groupBy("tree", "prefix").agg(F.count("*").alias("n")).filter("n > 1")
    places = stored(places.join(shared, ["tree", "prefix"]).select("node", "tree", "key", "prefix", "n"), "near-places")
    crowded = places.filter(F.col("n") > REGION).select("node", "tree", "key")
    levels = crowded.withColumn("depth", F.explode(F.sequence(F.lit(LEAST_DEPTH), F.lit(DEPTH)))).withColumn("prefix", _prefix(F.col("depth")))
    groups = levels.groupBy("tree", "depth", "prefix").agg(F.count("*").alias("n"), F.min("node").alias("leader"))
    groups = stored(groups, "near-prefixes")
    large = F.col("n") > REGION
    # The shortest prefix that is no larger than a region, else the longest.
    choice = F.struct(large.alias("large"), F.when(large, -F.col("depth")).otherwise(F.col("depth")).alias("order"), "prefix", "n", "leader")
    chosen = levels.join(groups, ["tree", "depth", "prefix"]).groupBy("tree", "node", "key").agg(F.min(choice).alias("best"))
    part = F.when(F.col("large"), F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / REGION))).otherwise(0)
    deep = chosen.select("node", "tree", "key", "best.*").withColumn("region", F.xxhash64("tree", "prefix", part))
    deep = stored(deep.withColumn("crowd", F.xxhash64("tree", _prefix(LEAST_DEPTH))), "near-regions")
    plain = places.filter(F.col("n") <= REGION).withColumn("region", F.xxhash64("tree", "prefix", F.lit(0).cast("long")))
    columns = ["node", "tree", "key", "region", "n"]
    regions = plain.select(*columns, F.lit(None).cast("long").alias("crowd")).union(deep.select(*columns, "crowd"))
    above = groups.select("tree", (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("above"), F.col("leader").alias("two"))
    inner = groups.select("tree", "depth", F.substring("prefix", F.lit(1), (F.col("depth") - 1) * _SLOT_BYTES).alias("above"), F.col("leader").alias("one"))
    leaders = inner.join(above, ["tree", "depth", "above"]).select("one", "two")
    dealt = deep.filter("large").groupBy("region").agg(F.min("node").alias("one"), F.min("leader").alias("two")).select("one", "two")
    pairs = leaders.union(dealt).filter("one != two").select(F.least("one", "two").alias("a"), F.greatest("one", "two").alias("b"))
    return regions, stored(pairs.distinct(), "near-leaders")


def _in_regions(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows (node, tree, key, region, root) with size and signature, each region in order and in one task."""
    spark = classes.sparkSession
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // SORTED_TOGETHER))
    signed = rows.join(classes.select("node", "size", "signature"), "node")
    dealt = signed.repartition(parts, "region").sortWithinPartitions("region", "tree", "key", "node")
    return dealt.select("region", "tree", "node", "root", "size", "signature")


_PAIRS = "a long, b long, agreement double"


def _forest_pairs(classes: DataFrame, regions: DataFrame, leaders: DataFrame) -> DataFrame:
    """``a``, ``b`` and ``agreement`` of the first candidates, stored."""
    alone = regions.select("node", "tree", "key", "region", F.col("node").alias("root"))
    rows = _in_regions(alone, classes)
    pairs = rows.mapInArrow(_first_candidates, _PAIRS).union(_agreeing(leaders, classes))
    return stored(pairs.groupBy("a", "b").agg(F.max("agreement").alias("agreement")), "near-pairs")


def _pairs_apart(classes: DataFrame, regions: DataFrame, roots: DataFrame) -> DataFrame:
    """``a`` and ``b`` of the candidates of regions that are in different components."""
    rows = regions.filter(F.col("n") > SMALL).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = rows.groupBy("region").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high").select("region")
    rows = stored(rows.join(mixed, "region").select("node", "tree", "key", "region", "root"), "near-mixed")
    return _in_regions(rows, classes).mapInArrow(_second_candidates, _PAIRS).select("a", "b").distinct()


def _full_sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame, regions: DataFrame) -> DataFrame:
    """``node`` and its sorted shingle names, for all nodes of ``pairs`` and of regions that are not small, stored."""

    def make(batches):
        last = None
        for batch in batches:
            nodes, sets = [], []
            for node, text in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1))):
                if node != last:  # repeated rows of one document follow one another
                    nodes.append(node)
                    sets.append(shingles(text).tobytes())
                    last = node
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], ["node", "names"])

    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b"))
    wanted = wanted.union(regions.filter(F.col("n") > SMALL).select("node")).distinct()
    wanted = stored(wanted.join(classes.select("node", "first.*"), "node").select("node", F.col("doc_id").alias("id"), "h1", "h2"), "near-wanted")
    # A merge join at every size, because what is wanted grows with the documents.
    wanted = wanted.hint("merge")
    rows = docs.join(wanted, (docs["h1"] == wanted["h1"]) & (docs["h2"] == wanted["h2"]) & docs["doc_id"].eqNullSafe(wanted["id"]))
    return stored(rows.select("node", "text").mapInArrow(make, "node long, names binary"), "near-sets")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def compare(batches):
        for batch in batches:
            found = []
            for i, (one, two) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                one, two = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                both = len(np.intersect1d(one, two, assume_unique=True))
                if 100 * both >= THRESHOLD * (len(one) + len(two) - both):
                    found.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(found, pa.int64())) for k in (0, 1)], ["a", "b"])

    with_sets = pairs.join(sets.select(F.col("node").alias("a"), F.col("names").alias("one")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("names").alias("two")), "b"
    )
    return with_sets.select("a", "b", "one", "two").mapInArrow(compare, "a long, b long").distinct()


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The ``pairs`` whose ends are not yet in one component, with their components."""
    side = lambda end: roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
    known = pairs.select("a", "b").join(side("a"), "a", "left").join(side("b"), "b", "left")
    known = known.select("a", "b", F.coalesce("root_a", "a").alias("root_a"), F.coalesce("root_b", "b").alias("root_b"))
    return known.filter("root_a != root_b")


def _agreeing(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The ``pairs`` that agree in enough slots of their signatures, and may be similar by their sizes."""

    def compare(batches):
        for batch in batches:
            n = batch.num_rows
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            node, size = np.concatenate(columns[:2]), np.concatenate(columns[2:])
            slots = [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, _SLOTS) for i in (4, 5)]
            yield _pair_batch(*_agreeing_rows(np.arange(n), np.arange(n, 2 * n), size, np.concatenate(slots)), node)

    side = lambda end: classes.select(*(F.col(c).alias(f"{c}_{end}" if c != "node" else end) for c in ("node", "size", "signature")))
    signed = pairs.join(side("a"), "a").join(side("b"), "b")
    return signed.select("a", "b", "size_a", "size_b", "signature_a", "signature_b").mapInArrow(compare, _PAIRS)


def _both_ends(pairs: DataFrame) -> DataFrame:
    """``pairs`` once for each end, which is called ``node``."""
    return pairs.select(F.col("a").alias("node"), "*").union(pairs.select(F.col("b").alias("node"), "*"))


def _centrality(pairs: DataFrame) -> DataFrame:
    """``node`` and ``score``, its mean agreement with its candidates.

    Copies that were changed least agree most with all others. Means of few
    candidates are drawn towards the least.
    """
    score = (F.sum("agreement") + FEW * LEAST_AGREEMENT) / (F.count("*") + FEW)
    return stored(_both_ends(pairs).groupBy("node").agg(score.alias("score")), "near-scores")


def _first_pairs(pairs: DataFrame, scores: DataFrame) -> DataFrame:
    """Each node with the candidate that it agrees with most, and with its most central one."""
    side = lambda end: scores.select(F.col("node").alias(end), F.col("score").alias(f"score_{end}"))
    scored = pairs.join(side("a"), "a").join(side("b"), "b")
    ends = _both_ends(scored).withColumn("score", F.when(F.col("node") == F.col("a"), F.col("score_b")).otherwise(F.col("score_a")))
    pair = F.struct("a", "b")
    best = ends.groupBy("node").agg(
        F.max_by(pair, F.struct("agreement", "a", "b")).alias("closest"), F.max_by(pair, F.struct("score", "a", "b")).alias("central")
    )
    return best.select(F.explode(F.array("closest", "central")).alias("pair")).select("pair.*").distinct()


def _crowd_links(regions: DataFrame, sets: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    """All links between documents of crowds that are in different components, by the full sets.

    A crowd is a shared prefix in which not all pairs were candidates.

    Of two sets that are similar enough, the smaller has one of its rarest shingles,
    a seventh of all, among the rarest quarter of the other's, in any order that is
    the same for both. So documents meet on shingles that are rare in the crowds,
    where they are of different components and similar size, and where what either
    has after the shingle would be enough: at the first that they share it is. What a
    rare shingle's documents have to be compared with is dealt in blocks.
    """
    members = regions.filter(F.col("n") > SMALL).withColumn("crowd", F.coalesce("crowd", "region"))
    members = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = members.groupBy("crowd").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high").select("crowd")
    apart = stored(members.join(mixed, "crowd").select("node", "root").distinct(), "near-crowds")
    held = stored(apart.join(sets, "node"), "near-crowd-sets")
    rare = stored(held.mapInArrow(_rare_shingles(_counters(held)), "shingle long, node long, root long, size long, seventh boolean, rest long"), "near-rare")
    blocks = F.ceil(F.count_if("seventh") / TOGETHER)
    met = rare.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high"), blocks.alias("blocks"))
    rare = rare.join(met.filter("low != high AND blocks > 0").select("shingle", "blocks"), "shingle")
    small = rare.filter("seventh").select("shingle", F.pmod(F.xxhash64("node"), "blocks").alias("block"), F.struct("size", "node", "rest").alias("one"), F.col("root").alias("root_one"))
    large = rare.select("shingle", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.struct("size", "node", "rest").alias("two"), F.col("root").alias("root_two"))
    near = (F.col("one") < F.col("two")) & (100 * F.col("one.size") >= THRESHOLD * F.col("two.size")) & (F.col("root_one") != F.col("root_two"))
    enough = (THRESHOLD + 100) * F.least("one.rest", "two.rest") >= THRESHOLD * (F.col("one.size") + F.col("two.size"))
    pairs = small.join(large, ["shingle", "block"]).filter(near & enough)
    pairs = pairs.select(F.least("one.node", "two.node").alias("a"), F.greatest("one.node", "two.node").alias("b")).distinct()
    return _confirmed(_agreeing(pairs, classes).select("a", "b"), sets)


def _counter(names: np.ndarray) -> np.ndarray:
    return (names >> np.uint64(46)).astype(np.int64)


def _counters(held: DataFrame) -> np.ndarray:
    """How many shingles of all sets fall to each counter."""

    def count(batches):
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for names in batch.column(0).to_pylist():
                np.add.at(total, _counter(np.frombuffer(names, np.uint64)), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["counter", "n"])

    sums = held.select("names").mapInArrow(count, "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n"))
    out = np.zeros(COUNTERS, np.int64)
    for row in sums.toLocalIterator():  # a number for each counter
        out[row["counter"]] = row["n"]
    return out


def _rare_shingles(counters: np.ndarray):
    """The rarest quarter of each set's shingles, rarest first.

    ``seventh`` marks those of the rarest seventh, and ``rest`` counts a shingle and
    those after it.
    """

    def choose(batches):
        for batch in batches:
            rows = []
            for node, root, names in zip(*(batch.column(i).to_pylist() for i in range(3))):
                names = np.frombuffer(names, np.uint64)
                n = len(names)
                order = np.lexsort((names, counters[_counter(names)]))[: n - (THRESHOLD * n + 99) // 100 + 1]
                seventh = n - (2 * THRESHOLD * n + THRESHOLD + 99) // (THRESHOLD + 100) + 1
                rows.append((names[order].view(np.int64), node, root, n, np.arange(len(order)) < seventh, n - np.arange(len(order))))
            if rows:
                sizes = [len(r[0]) for r in rows]
                columns = [np.concatenate([r[0] for r in rows]), *(np.repeat([r[i] for r in rows], sizes) for i in (1, 2, 3))]
                columns += [np.concatenate([r[i] for r in rows]) for i in (4, 5)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["shingle", "node", "root", "size", "seventh", "rest"])

    return choose


def _linked(pairs: DataFrame, sets: DataFrame, classes: DataFrame, regions: DataFrame) -> DataFrame:
    """``node`` and ``root`` of all linked nodes.

    First each node's closest and most central candidates are confirmed, then the
    candidates that are not in one component by that, then the closest others of their
    regions that are not. What is still apart in a crowd is joined as a whole. Pairs
    inside a component are never needed, so leaving them out loses no link between
    components.
    """
    scores = _centrality(pairs)
    links = stored(_confirmed(_first_pairs(pairs, scores), sets), "near-links")
    roots = stored(connected_components(links), "near-roots")
    for candidates in (lambda: _apart(pairs, roots).select("a", "b"), lambda: _pairs_apart(classes, regions, roots)):
        more = stored(_confirmed(candidates(), sets), "near-links")
        if not more.isEmpty():
            links = links.union(more)
            roots = stored(connected_components(links), "near-roots")
    rest = stored(_crowd_links(regions, sets, classes, roots), "near-links")
    return roots if rest.isEmpty() else connected_components(links.union(rest))


def _decided(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Result columns, and ``h1`` and ``h2`` of the text, for each row."""
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *text_keys(text), text.alias("text"))
    signed = stored(rows.mapInArrow(_sign, _SIGNED), "near-signed")
    classes = _representatives(signed)
    regions, leaders = _regions(classes)
    pairs = _forest_pairs(classes, regions, leaders)
    roots = stored(_linked(pairs, _full_sets(rows, classes, pairs, regions), classes, regions), "near-roots")
    rooted = classes.select("s1", "s2", "node", F.col("first.doc_id").alias("first_id")).join(roots, "node", "left")
    rooted = rooted.select("s1", "s2", "first_id", F.coalesce("root", "node").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component"))
    of_class = rooted.join(least, "root").select("s1", "s2", "component")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return signed.join(of_class, ["s1", "s2"], "left").select("doc_id", "h1", "h2", "n_shingles", own.alias("component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    A document without words is linked with nothing. NULL texts are empty. The
    component's id is its least id that is not NULL, and NULL if there is none; a
    row is kept if its id is that one, so repeated rows are kept together. Other
    columns are not looked at. An empty table gives an empty result.
    """
    found = _decided(docs, id_col, text_col)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` of one document of each group, with all their columns."""
    found = _decided(docs, id_col, text_col)
    gone = found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    gone = stored(gone.select(F.col("doc_id").alias("gone_id"), F.col("h1").alias("gone_h1"), F.col("h2").alias("gone_h2")).distinct(), "near-gone")
    h1, h2 = text_keys(text_or_empty(text_col))
    same = (h1 == gone["gone_h1"]) & (h2 == gone["gone_h2"]) & docs[id_col].cast("long").eqNullSafe(gone["gone_id"])
    return docs.join(gone, same, "left_anti")
