import hashlib
import random
import re

import pytest

from haemoloom.llm.personal_data import find_personal_data, redact, span_texts
from rows import awkward, documents, plain, prose

# The forms as they are asked for, without any help for long texts.
FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(value):
    digits = [int(c) for c in reversed(value) if c.isdigit()]
    return 13 <= len(digits) <= 19 and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


VALID = {
    "email": lambda v: True,
    "ip": lambda v: all(int(p) <= 255 for p in v.split(".")),
    "card": luhn,
    "phone": lambda v: 9 <= sum(c.isdigit() for c in v) <= 15,
}


def base(text):
    return {
        kind: [(m.start(), m.end()) for m in re.finditer(form, text or "") if VALID[kind](m.group())] for kind, form in FORMS.items()
    }


def expected(doc_id, text):
    found = base(text)
    shown = ",".join(f"{k}:{a}:{b}" for k, spans in found.items() for a, b in spans)
    return (doc_id, *[len(s) for s in found.values()], hashlib.sha256(shown.encode()).hexdigest(), shown)


def odd_texts():
    made = random.Random(11)
    parts = ["a", "b.c", "@", "@x.y", ".", "-", " ", "+", "1", "23", "4111", "(5)", "\n", "é", "\U0001f600", "_", "255", "256", "00", ".1.2.3"]
    parts += ["4111111111111111", "+1 (988) 555-2485", "me@mail.example.com"]
    return ["".join(made.choice(parts) for _ in range(made.randint(1, 40))) for _ in range(1500)]


def test_base_spans_match_the_plain_forms(spark):
    rows = [(i, t, None, None, None) for i, t in enumerate(odd_texts())]
    got = {r.doc_id: r for r in span_texts(find_personal_data(documents(spark, rows))).collect()}
    for i, text, *_ in rows:
        want = expected(i, text)
        assert tuple(got[i])[:6] == want[:6], text
        shown = got[i].spans.split(",") if got[i].spans else []
        assert ",".join(s for s in shown if not s.startswith("id:")) == want[6]


@pytest.mark.parametrize("extra", [False, True])
def test_awkward_rows(spark, extra):
    found = plain(span_texts(find_personal_data(documents(spark, extra=extra))))
    assert found == sorted((expected(i, t) for i, t, *_ in awkward()), key=repr)


def test_contexts_of_seeds_find_other_identifiers(spark):
    rows = [(i, f"{prose(i, 8)} contact: user{i}@mail.example.com {prose(i + 50, 8)}", None, None, None) for i in range(6)]
    rows += [(10, "words before contact: \"AB12-3456x\", and after", None, None, None)]
    rows += [(11, "version AB12-3456y is not preceded by the pattern", None, None, None)]
    rows += [(12, "member no AB12-3456x here", None, None, None)]
    got = {r.doc_id: r.spans for r in span_texts(find_personal_data(documents(spark, rows))).collect()}
    at = rows[6][1].index("AB12")
    assert got[10] == f"id:{at}:{at + 10}"
    assert got[11] == "" and got[12] == ""


def test_patterns_spread_over_rounds(spark):
    # "contact:" is learnt from seeds; what it finds teaches "badge", which finds one more.
    rows = [(i, f"x contact: user{i}@mail.example.com y", None, None, None) for i in range(6)]
    rows += [(10 + i, f"x contact: EMP-00{i}77 y", None, None, None) for i in range(3)]
    rows += [(20 + i, f"x badge EMP-00{i}77 y", None, None, None) for i in range(3)]
    rows += [(30, "x badge EMP-99999 y", None, None, None)]
    got = {r.doc_id: r.spans for r in span_texts(find_personal_data(documents(spark, rows))).collect()}
    assert got[10] == "id:11:20" and got[30] == "id:8:17"


def test_common_words_before_seeds_are_no_patterns(spark):
    rows = [(i, f"the mail of the user{i}@mail.example.com and the rest of the text", None, None, None) for i in range(6)]
    rows += [(9, "the 2024-11-05 edition", None, None, None)]
    assert {r.spans for r in span_texts(find_personal_data(documents(spark, rows))).collect() if r.doc_id == 9} == {""}


def test_two_words_are_counted_together(spark):
    rows = [(i, f"{prose(i, 8)} passport : user{i}@mail.example.com {prose(i + 50, 8)}", None, None, None) for i in range(6)]
    rows += [(10, "my Passport  : AB12-3456x is new", None, None, None), (11, "my ticket : AB12-3456y is new", None, None, None)]
    rows += [(20 + i, f"{prose(i, 3)} : {prose(i + 90, 3)}", None, None, None) for i in range(40)]
    got = {r.doc_id: r.spans for r in span_texts(find_personal_data(documents(spark, rows))).collect()}
    assert got[10] == "id:15:25" and got[11] == ""


def test_words_glued_to_others_are_counted(spark):
    rows = [(i, f"x ref:user{i}@mail.example.com y key:user{i}@mail.example.com", None, None, None) for i in range(3)]
    rows += [(10, "x ref: AB12-3456x y", None, None, None), (11, "x key: AB12-3456y y", None, None, None)]
    rows += [(20 + i, "x ref:none y", None, None, None) for i in range(20)]
    got = {r.doc_id: r.spans for r in span_texts(find_personal_data(documents(spark, rows))).collect()}
    assert got[10] == "" and got[11] == "id:7:17"


def test_chains_are_followed_to_their_end(spark):
    """Known entities alone make a context no pattern; with what the context before it finds, they do."""
    rows = [(1000 + i, f"x c0: user{i}@mail.example.com y", None, None, None) for i in range(6)]
    for level in range(6):
        rows += [(2000 + 10 * level + i, f"x c{level + 1}: user{i}@mail.example.com y", None, None, None) for i in range(5)]
        for i in range(4):
            value = f"ID-{level}-00{i}7"
            rows.append((100 * level + i, f"x c{level}: {value} y", None, None, None))
            rows.append((100 * level + 10 + i, f"x c{level + 1}: {value} y", None, None, None))
    got = {r.doc_id: r.spans for r in span_texts(find_personal_data(documents(spark, rows))).collect()}
    assert [d for d in got if d < 1000 and got[d] != "id:6:15"] == []


def test_long_identifiers_and_contexts_are_whole(spark):
    long, word = "AB1" + "c2" * 100, "w" * 200
    rows = [(i, f"x badge: user{i}@mail.example.com y {word}a: user{i}@mail.example.com", None, None, None) for i in range(6)]
    rows += [(10, f"x badge: {long} y", None, None, None), (11, f"x {word}a: AB12-3456 y", None, None, None)]
    rows += [(12, f"x v{word}a: AB12-3457 y", None, None, None)]
    got = {r.doc_id: r.spans for r in span_texts(find_personal_data(documents(spark, rows))).collect()}
    assert got[10] == f"id:9:{9 + len(long)}" and got[11] == f"id:{2 + len(word) + 3}:{2 + len(word) + 12}" and got[12] == ""


def test_instances_that_mostly_follow_other_words_are_rejected(spark):
    rows = [(i, f"x badge: user{i}@mail.example.com y", None, None, None) for i in range(6)]
    rows += [(10, "x badge: 2024-11-05 y", None, None, None), (11, "x badge: AB12-3456 y", None, None, None)]
    rows += [(20 + i, f"{prose(i, 3)} on 2024-11-05 y", None, None, None) for i in range(9)]
    got = {r.doc_id: r.spans for r in span_texts(find_personal_data(documents(spark, rows))).collect()}
    assert got[10] == "" and got[11] == "id:9:18"


def test_keys_are_seeds(spark):
    rows = [(i, f'x token = "{hashlib.sha1(bytes([i])).hexdigest()}" y', None, None, None) for i in range(4)]
    rows += [(10, 'x token = "AB12-3456" y', None, None, None)]
    got = {r.doc_id: r.spans for r in span_texts(find_personal_data(documents(spark, rows))).collect()}
    assert got[0] == "id:11:51" and got[10] == "id:11:20"
    none = span_texts(find_personal_data(documents(spark, rows), seed_forms=()))
    assert {r.spans for r in none.collect()} == {""}


def test_given_tables_hold_identifiers_after_learnt_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = [r for r in span_texts(find_personal_data(docs)).collect() if "id:" in r.spans]
    assert found


def test_very_many_matches(spark):
    text = " ".join(f"u{i}@mail.example.com {i}-555" for i in range(20_000))
    got = span_texts(find_personal_data(documents(spark, [(1, text, None, None, None)]))).first()
    assert got.n_email == 20_000 and got.base_sha256 == expected(1, text)[5]


def test_redaction(spark):
    docs = documents(spark, extra=True)
    clean = redact(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[12] == "mail <EMAIL>, ip 10.0.0.300 and <IP>.4 card <CARD> call <PHONE>."
    assert texts[3] is None and texts[4] == "" and texts[1] == "a b\tc"


def test_no_python_in_the_plan(spark):
    plan = find_personal_data(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert span_texts(find_personal_data(documents(spark, []))).collect() == []
    assert redact(documents(spark, [])).collect() == []
