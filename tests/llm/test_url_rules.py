import random
import re

import pytest

from haemoloom.llm.url_rules import judge_urls

PAGES = "page_id long, url string, html string"
RULES = "host string, path string, verdict string"


def split(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda m: m[0].lower(), found[1]), found[2]) if found else ("", "")


def expected(pages, rules, default="allow"):
    clean = {}
    for host, path, verdict in rules:
        if host and verdict:
            key = (host.lower(), path or "")
            clean[key] = max(verdict, clean.get(key, ""))
    found = []
    for page_id, url, *_ in pages:
        host, path = split(url)
        fits = [(h.count("."), len(p), h + p, v) for (h, p), v in clean.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
        _, _, rule, verdict = max(fits) if host and fits else (0, 0, None, default)
        found.append((page_id, host, path, rule, verdict))
    return sorted(found, key=repr)


def random_case(seed, n_rules):
    made = random.Random(seed)
    hosts = ["org", "a.org", "b.a.org", "c.b.a.org", "com", "a.com", "aa.com", "x"]
    paths = ["", "/", "/a", "/a/", "/ab", "/a/b", "/a/b/c", "/b", "/é"]
    rules = [(made.choice(hosts), made.choice(paths), made.choice(["allow", "block"])) for _ in range(n_rules)]
    urls = [f"http://{made.choice(['', 'w.', 'W.v.'])}{made.choice(hosts)}{made.choice(paths)}{made.choice(['', '?q=/a', '#f', '1'])}" for _ in range(300)]
    return [(i, u, None) for i, u in enumerate(urls)], rules


@pytest.mark.parametrize(("seed", "n_rules"), [(1, 0), (2, 1), (3, 8), (4, 40)])
def test_verdicts_match_brute_force(spark, seed, n_rules):
    pages, rules = random_case(seed, n_rules)
    got = judge_urls(spark.createDataFrame(pages, PAGES), spark.createDataFrame(rules, RULES))
    assert sorted(map(tuple, got.collect()), key=repr) == expected(pages, rules)


def test_awkward_rows(spark):
    pages = [
        (1, None, None), (2, "", None), (3, "no scheme/here", None), (4, "http://", None), (5, "HTTP://A.Org/x://y", None),
        (None, "http://a.org/", None), (6, "http://a.org/\nb?c", None), (6, "http://a.org/\nb?c", None), (7, "x" * 50_000, None),
        (8, "http://" + "a." * 5_000 + "org/es/" + "p" * 50_000, None), (9, "http://.org/", None), (10, "http://org?/", None),
        (11, "http://org:80/", None), (12, "http://a.org/\U0010ffff", None),
    ]
    rules = [("org", "/", "allow"), ("ORG", "/", "block"), ("a.org", None, "block"), (None, "/", "block"), ("", "/", "block"), ("x.org", "/", None)]
    df = spark.createDataFrame(pages, PAGES).withColumns({c: "html" for c in ()})
    for name in ("host", "path", "rule", "key", "kind", "part", "depth"):
        df = df.withColumn(name, df["html"])
    got = judge_urls(df, spark.createDataFrame(rules, RULES), default="block")
    assert sorted(map(tuple, got.collect()), key=repr) == expected(pages, rules, "block")


def test_empty_tables(spark):
    pages, rules = spark.createDataFrame([], PAGES), spark.createDataFrame([("org", "/", "block")], RULES)
    assert judge_urls(pages, rules).collect() == []
    got = judge_urls(spark.createDataFrame([(1, "http://a.org/", None)], PAGES), spark.createDataFrame([], RULES))
    assert [tuple(r) for r in got.collect()] == [(1, "a.org", "/", None, "allow")]


def test_no_python_in_the_plan(spark):
    pages, rules = random_case(3, 8)
    got = judge_urls(spark.createDataFrame(pages, PAGES), spark.createDataFrame(rules, RULES))
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
