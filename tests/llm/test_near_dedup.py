import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from haemoloom.llm import near_dedup
from haemoloom.llm.common import text_keys
from haemoloom.llm.components import connected_components
from haemoloom.llm.near_dedup import near_duplicates, without_near_duplicates
from rows import awkward, documents, plain, prose


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)])


def expected(rows):
    sets = [shingle_set(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, one in enumerate(sets):
        for j, two in enumerate(sets[:i]):
            if one and two and 100 * len(one & two) >= 75 * len(one | two):
                root[find(i)] = find(j)
    groups = {}
    for i, row in enumerate(rows):
        groups.setdefault(find(i), []).append(row[0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return sorted(((row[0], len(sets[i]), least[find(i)], row[0] == least[find(i)]) for i, row in enumerate(rows)), key=repr)


def edited(words, share, made):
    return [w if made.random() > share else f"{w}{made.randint(0, 10**6)}" for w in words]


def groups_of_copies():
    """A large group with all degrees of similarity, small groups, chains and a passage that many documents share."""
    made, rows = random.Random(9), []
    base = prose(1, 150).split(" ")
    for i in range(150):
        rows.append(" ".join(edited(base, made.choice([0.0, 0.005, 0.01, 0.02, 0.05, 0.1]), made)))
    for g in range(25):
        own = prose(100 + g, 80).split(" ")
        rows += [" ".join(edited(own, 0.012 * k, made)) for k in range(4)]
    chain = prose(900, 200).split(" ")
    for i in range(12):  # each link replaces words in a place of its own
        chain = chain[: 15 * i] + prose(1000 + i, 8).split(" ") + chain[15 * i + 8 :]
        rows.append(" ".join(chain))
    passage = prose(77, 60)
    rows += [passage + " " + prose(2000 + i, made.randint(10, 200)) for i in range(60)]
    made.shuffle(rows)
    return [(i, t, None, None, None) for i, t in enumerate(rows)]


def test_components_match_brute_force(spark):
    rows = groups_of_copies()
    assert plain(near_duplicates(documents(spark, rows))) == expected(rows)


def test_only_partner_in_a_crowd_is_found(spark):
    """A crowd of copies too far from one another to be linked, and pairs of them that share some of their edits."""
    made, base = random.Random(21), prose(5, 600).split(" ")

    def changed(words, n):
        places = set(made.sample(range(3, 597), n))
        return [f"{w}{made.randint(0, 10**6)}" if i in places else w for i, w in enumerate(words)]

    texts = [" ".join(changed(base, 12)) for _ in range(1000)]
    for _ in range(60):
        shared = changed(base, 3)
        texts += [" ".join(changed(shared, 9)), " ".join(changed(shared, 9))]
    made.shuffle(places := list(range(len(texts))))
    rows = [(i, text, None, None, None) for i, text in zip(places, texts)]
    sets = [shingle_set(t) for t in texts]
    linked = [i for i in range(1000, 1120, 2) if 100 * len(sets[i] & sets[i + 1]) >= 75 * len(sets[i] | sets[i + 1])]
    got = {r.doc_id: r.component_id for r in near_duplicates(documents(spark, rows)).collect()}
    assert len(linked) > 20
    assert [i for i in linked if got[places[i]] != got[places[i + 1]]] == []


def crowd(n, words=600, edits=12, seed=21):
    """Copies of one text with edits of their own: their signatures agree, but few or none are linked."""
    made, base = random.Random(seed), prose(5, words).split(" ")
    for i in range(n):
        places = set(made.sample(range(3, words - 3), edits))
        yield (i, " ".join(f"{w}{made.randint(0, 10**6)}" if j in places else w for j, w in enumerate(base)), None, None, None)


def steps(spark, rows):
    docs = documents(spark, rows).withColumn("text", F.coalesce("text", F.lit("")))
    signed = docs.select("doc_id", *text_keys(F.col("text")), "text").mapInArrow(near_dedup._sign, near_dedup._SIGNED)
    # Numbers of nodes that do not depend on partitions, so that runs can be compared.
    classes = near_dedup._representatives(signed).withColumn("node", F.col("first.doc_id"))
    return docs.select("doc_id", *text_keys(F.col("text")), "text"), classes, *near_dedup._regions(classes)


def test_candidates_do_not_depend_on_partitions_or_batches(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SORTED_TOGETHER", 16)
    monkeypatch.setattr(near_dedup, "REGION", 32)
    rows = groups_of_copies() + [(5000 + r[0], *r[1:]) for r in crowd(200, 200, 3)]
    found = []
    for parts, batch in ((2, 10_000), (7, 50), (64, 10_000), (7, 50)):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            _, classes, regions, leaders = steps(spark, rows)
            found.append(plain(near_dedup._forest_pairs(classes, regions, leaders)))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    assert len(found[0]) > 500
    assert found[1:] == found[:1] * 3


@pytest.mark.parametrize("region", [2, 8, 40])
def test_small_regions_lose_no_link(spark, monkeypatch, region):
    """Whatever is not compared in regions is found by the join on rare shingles."""
    monkeypatch.setattr(near_dedup, "REGION", region)
    monkeypatch.setattr(near_dedup, "SMALL", 2)
    monkeypatch.setattr(near_dedup, "TOGETHER", 3)
    rows = groups_of_copies()
    assert plain(near_duplicates(documents(spark, rows))) == expected(rows)


def test_crowd_without_links_has_few_candidates(spark):
    """One long text that stands whole in many documents, which all go on in their own words."""
    base = prose(5, 200)
    rows = [(i, f"{base} {prose(100 + i, 48)}", None, None, None) for i in range(1500)]
    docs, classes, regions, leaders = steps(spark, rows)
    sets = near_dedup._full_sets(docs, classes, near_dedup._forest_pairs(classes, regions, leaders), regions)
    apart = classes.select("node", F.col("node").alias("root"))
    seen = []
    agreeing = near_dedup._agreeing
    near_dedup._agreeing = lambda pairs, of: agreeing(seen.append(pairs.count()) or pairs, of)
    try:
        near_dedup._crowd_links(regions, sets, classes, apart).count()
    finally:
        near_dedup._agreeing = agreeing
    assert regions.filter("crowd IS NOT NULL").select("node").distinct().count() > 1000
    assert seen[0] < len(rows)


def test_rarest_shingles_of_similar_sets_meet():
    made = np.random.default_rng(2)
    for _ in range(300):
        n = int(made.integers(1, 60))
        one = made.integers(0, 1 << 63, n).astype(np.uint64)
        two = np.concatenate([one[: n - int(made.integers(0, n // 3 + 1))], made.integers(0, 1 << 63, int(made.integers(0, n // 4 + 1))).astype(np.uint64)])
        one, two = np.unique(one), np.unique(two)
        both = len(np.intersect1d(one, two))
        if 100 * both < 75 * (len(one) + len(two) - both):
            continue
        counters = made.integers(0, 3, near_dedup.COUNTERS)
        batch = pa.RecordBatch.from_pydict({"node": [1, 2], "root": [1, 2], "names": [one.tobytes(), two.tobytes()]})
        rows = pa.Table.from_batches(list(near_dedup._rare_shingles(counters)([batch]))).to_pylist()
        low, high = (1, 2) if (len(one), 1) < (len(two), 2) else (2, 1)
        small = {r["shingle"]: r["rest"] for r in rows if r["node"] == low and r["seventh"]}
        large = {r["shingle"]: r["rest"] for r in rows if r["node"] == high}
        assert any(175 * min(small[x], large[x]) >= 75 * (len(one) + len(two)) for x in small.keys() & large.keys())


@pytest.mark.parametrize("extra", [False, True])
def test_awkward_rows(spark, extra):
    assert plain(near_duplicates(documents(spark, extra=extra))) == expected(awkward())


def test_one_document_of_each_group_stays(spark):
    rows = groups_of_copies()
    docs = documents(spark, rows, extra=True)
    stay = without_near_duplicates(docs)
    assert stay.columns == docs.columns
    assert sorted(r.doc_id for r in stay.collect()) == sorted(r[0] for r in expected(rows) if r[3])


def test_empty_table(spark):
    assert near_duplicates(documents(spark, [])).collect() == []
    assert without_near_duplicates(documents(spark, [])).collect() == []


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, 200 + i) for i in range(30)]
    loops = [(50, 51), (51, 52), (52, 50), (51, 50), (50, 50)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(chain + star + loops, "a long, b long")).collect()))
    want = {i: 100 for i in range(100, 141)} | {200 + i: 7 for i in range(30)} | {7: 7, 50: 50, 51: 50, 52: 50}
    assert got == want


def test_components_of_random_links(spark):
    made = random.Random(3)
    links = [(made.randint(0, 300), made.randint(0, 300)) for _ in range(220)]
    links = [(a, b) for a, b in links if a != b]
    root = {x: x for pair in links for x in pair}
    for _ in range(len(root)):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long")).collect())) == root
