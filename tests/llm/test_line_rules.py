import random
import re

import pytest

from haemoloom.llm.line_rules import clean_documents, judge_lines, repeated_words
from rows import awkward, documents, plain, prose


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def repeated(words):
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    return len({i + k for places in windows.values() if len(places) > 1 for i in places for k in range(8)})


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def expected(rows, least_documents, host_share, least_left=30):
    texts, holders = {}, {}
    for _, text, _, host, _ in rows:
        texts.setdefault(host or "", set()).add(text or "")
        for line in (text or "").split("\n"):
            if norm := lower(" ".join(words_of(line))):
                holders.setdefault((host or "", norm), set()).add(text)
    found = []
    for doc_id, text, _, host, _ in rows:
        words, seen, again, gone = words_of(text), set(), 0, 0
        for line in (text or "").split("\n"):
            if held := words_of(line):
                again += line in seen
                seen.add(line)
                n = len(holders[host or "", lower(" ".join(held))])
                gone += len(held) * (n > least_documents and n > host_share * len(texts[host or ""]))
        n, twice = len(words), repeated(words)
        failed = n < 20 or 100 * twice > 30 * n
        symbols = sum((text or "").count(c) for c in "#*$%&|<>")
        kept = not failed and 100 * (n - gone) >= least_left * n
        found.append((doc_id, n, sum(map(len, words)), symbols, again, twice, failed, kept))
    return sorted(found, key=repr)


def boilerplate_rows():
    made = random.Random(2)
    rows = []
    for i in range(60):
        lines = [prose(100 * i + k, made.randint(5, 30)) for k in range(made.randint(1, 4))]
        lines.insert(made.randint(0, len(lines)), made.choice(["Subscribe  to our\tLetter", "subscribe to our letter ", "All rights"]))
        if i % 9 == 0:
            lines = ["subscribe to our letter"] * 9 + [prose(i, 14)]
        rows.append((i, "\n".join(lines), "en", "s" if i % 3 else "t", 1))
    return rows + [(100 + i, rows[1][1], "en", "s", 1) for i in range(40)]


@pytest.mark.parametrize(("least", "share"), [(20, 0.1), (3, 0.1), (3, 0.6)])
def test_verdicts_match_brute_force(spark, least, share):
    got = judge_lines(documents(spark, boilerplate_rows()), least_documents=least, host_share=share)
    assert plain(got) == expected(boilerplate_rows(), least, share)


def test_copies_of_a_text_are_one_document(spark):
    rows = [(i, prose(3, 40), "en", "s", 1) for i in range(50)]
    assert all(r.kept for r in judge_lines(documents(spark, rows), least_documents=1, host_share=0.0).collect())


@pytest.mark.parametrize("extra", [False, True])
def test_awkward_rows(spark, extra):
    assert plain(judge_lines(documents(spark, extra=extra))) == expected(awkward(), 20, 0.1)


def test_repeated_words_match_brute_force():
    made = random.Random(4)
    for _ in range(400):
        words = [made.choice([b"a", b"b"]) for _ in range(made.randint(0, 60))]
        assert repeated_words(words) == repeated(words)


def test_boilerplate_is_taken_out_of_texts(spark):
    docs = documents(spark, boilerplate_rows(), extra=True)
    kept = clean_documents(docs, least_documents=3, host_share=0.1)
    assert kept.columns == docs.columns
    want = {r[0] for r in expected(boilerplate_rows(), 3, 0.1) if r[-1]}
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert set(texts) == want
    assert not any("letter" in t.lower() for t in texts.values())
    before = {r[0]: r[1] for r in boilerplate_rows()}
    assert all(set(texts[i].split("\n")) <= set(before[i].split("\n")) for i in texts)


def test_one_copy_of_a_large_group_is_kept(spark):
    """Copies that differ in white space or in their last line make all their lines frequent; a line of all pages still goes."""
    lines = [prose(500 + k, 12) for k in range(6)]
    rows = [(i, "\n".join(["share this page", *lines]).replace(" ", " " * (i % 30 + 1), i // 30 + 1), "en", "s", 1) for i in range(60)]
    rows += [(100 + i, "\n".join([*lines, "share this page", prose(600 + i, 8)]), "en", "s", 1) for i in range(40)]
    rows += [(200 + i, prose(700 + i, 40) + "\nshare this page", "en", "s", 1) for i in range(50)]
    assert not any(r.kept for r in judge_lines(documents(spark, rows)).collect() if r.doc_id < 200)
    kept = {r.doc_id: r.text for r in clean_documents(documents(spark, rows)).collect()}
    assert [i for i in kept if i < 200] == [0]
    assert kept[0].split("\n") == rows[0][1].split("\n")[1:]
    assert {i for i in kept if i >= 200} == set(range(200, 250))
    assert not any("share this page" in text for text in kept.values())


def test_empty_table(spark):
    assert judge_lines(documents(spark, [])).collect() == []
    assert clean_documents(documents(spark, [])).collect() == []
