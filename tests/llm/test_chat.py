import hashlib

from pyspark.sql import functions as F

from haemoloom.llm.chat import PARTS, format_conversations, read_back, read_turns

TURNS = "conv_id long, turn long, role string, text string"

ROWS = [
    (1, 0, "user", "hello"), (1, 1, "assistant", "</turn>\n<turn user>\nme: \\b \\l \\\\ <image 0>"), (1, 2, "user", None),
    (1, 3, "assistant", "\ufeffmark \U0001f600 é"), (2, None, None, None), (2, 0, "role >\n<x", "a"), (2, 0, "assistant", "tie b"),
    (2, 0, "assistant", "tie a"), (2, 0, "assistant", "tie a"), (None, 1, "assistant", "x" * 100_000 + "<"), (None, 0, "user", ""), (3, 0, "user", "no answer"),
]


def escaped(text):
    return text.replace("\\", "\\b").replace("<", "\\l").replace(">", "\\g")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    found = []
    for conv, turns in groups.items():
        turns.sort()
        loss = "".join(t for *_, role, t in turns if role == "assistant")
        said = "".join(f"{role}\n{t}\n" for *_, role, t in turns)
        shown = "".join(f"<turn {escaped(role)}>\n{escaped(t)}\n</turn>\n" for *_, role, t in turns)
        found.append((conv, len(turns), digest(said), len(loss), digest(loss), len(shown)))
    return sorted(found, key=repr)


def test_reading_back_gives_what_was_said(spark):
    turns = spark.createDataFrame(ROWS, TURNS)
    for name in ("place", "shown", "head", "body", "loss"):
        turns = turns.withColumn(name, F.lit("extra"))
    got = read_back(format_conversations(turns)).collect()
    assert sorted(map(tuple, got), key=repr) == expected(ROWS)


def test_typed_parts_become_placeholders(spark):
    rows = [
        (1, 0, "user", [("text", "see <this>", None, None), ("image", None, "s3://a", 100), ("text", "and", None, None), ("audio", None, "b", None)]),
        (1, 1, "assistant", [("text", "fine", None, None), ("document", None, "c", None), (None, "plain", None, None), ("odd>", None, None, None)]),
        (1, 2, "user", None),
        (1, 3, "user", []),
    ]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {PARTS}")
    formatted = format_conversations(turns, parts=F.col("parts"))
    got = formatted.collect()[0]
    assert got.formatted == (
        "<turn user>\nsee \\lthis\\g<image 1>and<audio 3>\n</turn>\n"
        "<turn assistant>\nfine<document 1>plain<odd\\g 3>\n</turn>\n"
        "<turn user>\n\n</turn>\n<turn user>\n\n</turn>\n"
    )
    assert [tuple(a) for a in got.attachments] == [
        (0, 1, "image", "s3://a", 100), (0, 3, "audio", "b", 128), (1, 1, "document", "c", 1024), (1, 3, "odd>", None, 1),
    ]
    assert got.attachment_tokens == 100 + 128 + 1024 + 1
    assert [got.formatted[s.start : s.end] for s in got.loss] == ["fine<document 1>plain<odd\\g 3>"]
    turns = formatted.select(read_turns(F.col("formatted")).alias("t")).collect()[0].t
    assert [t.text for t in turns] == ["see <this><image 1>and<audio 3>", "fine<document 1>plain<odd> 3>", "", ""]


def test_empty_table(spark):
    assert read_back(format_conversations(spark.createDataFrame([], TURNS))).collect() == []


def test_no_python_in_the_plan(spark):
    plan = read_back(format_conversations(spark.createDataFrame(ROWS, TURNS)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
