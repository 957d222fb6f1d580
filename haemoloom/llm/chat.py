"""Chat formatting with typed content parts.

A turn is a list of typed parts. Text is escaped, and each image, audio or
document part becomes an ordered placeholder whose reference and token count are
recorded. Escaped texts hold no angle bracket, so the template's marks cannot be
written by a text, and the output can be read back exactly.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tokens that a part stands for when it does not say so itself.
PART_TOKENS = {"image": 256, "audio": 128, "document": 1024}

PARTS = "array<struct<type: string, text: string, ref: string, tokens: long>>"

_ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))
_TURN_END = "</turn>\n"


def escape(text: Column) -> Column:
    for raw, code in _ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for raw, code in reversed(_ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def text_parts(text: Column) -> Column:
    """A turn that is one text; NULL is empty."""
    part = F.struct(
        F.lit("text").alias("type"),
        F.coalesce(text, F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("long").alias("tokens"),
    )
    return F.array(part)


def _visited(part: Column, index: Column) -> Column:
    """What a part becomes: its place in the body, and how many tokens it stands for."""
    known = F.create_map(*[F.lit(x) for pair in PART_TOKENS.items() for x in pair])
    kind = F.coalesce(part["type"], F.lit("text"))
    is_text = kind == "text"
    return F.struct(
        is_text.alias("is_text"),
        index.alias("index"),
        kind.alias("type"),
        part["ref"].alias("ref"),
        F.when(is_text, escape(F.coalesce(part["text"], F.lit(""))))
        .otherwise(F.concat(F.lit("<"), escape(kind), F.lit(" "), index.cast("string"), F.lit(">")))
        .alias("shown"),
        F.when(is_text, F.lit(0)).otherwise(F.coalesce(part["tokens"], known[kind], F.lit(1))).cast("long").alias("tokens"),
    )


def format_conversations(
    turns: DataFrame,
    parts: Column | None = None,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    trained_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``n_turns``, ``formatted``, ``loss``, ``attachments``, ``attachment_tokens``.

    ``parts`` has the type ``PARTS``; without it, each turn is its text. ``loss``
    lists the spans of what ``trained_role`` says, in code points of ``formatted``.
    An attachment tells its turn, index, type, reference and tokens. Turns are
    ordered by turn, role and content; a NULL turn comes first, NULL roles and
    texts are empty, repeated rows are turns of their own, and rows with NULL id
    are one conversation. Other columns are not looked at. An empty table gives an
    empty result. A conversation is one row of output, so its size bounds a task.
    """
    given = parts if parts is not None else text_parts(F.col(text_col))
    role = F.coalesce(F.col(role_col), F.lit(""))
    rows = turns.select(
        F.col(id_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        role.alias("role"),
        F.transform(F.coalesce(given, F.array().cast(PARTS)), _visited).alias("visited"),
    )
    head = F.concat(F.lit("<turn "), escape(F.col("role")), F.lit(">\n"))
    rows = rows.select(
        "conv_id", "turn", "role", "visited", head.alias("head"), F.array_join("visited.shown", "").alias("body")
    )
    rows = rows.withColumn("shown", F.concat("head", "body", F.lit("\n" + _TURN_END)))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    rows = rows.select(
        "conv_id",
        "shown",
        F.row_number().over(order).alias("place"),
        F.sum(F.length("shown").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("end"),
        F.length("shown").alias("length"),
        F.length("head").alias("skip"),
        F.length("body").alias("size"),
        (F.col("role") == trained_role).alias("trained"),
        F.filter("visited", lambda v: ~v["is_text"]).alias("others"),
    )
    body_start = F.col("end") - F.col("length") + F.col("skip")
    span = F.when(F.col("trained"), F.struct("place", body_start.alias("start"), (body_start + F.col("size")).alias("end")))
    attached = F.transform(
        "others",
        lambda v: F.struct(
            (F.col("place") - 1).alias("turn"), v["index"].alias("index"), v["type"].alias("type"), v["ref"].alias("ref"), v["tokens"].alias("tokens")
        ),
    )
    grouped = rows.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("place", "shown"))).alias("all"),
        F.array_sort(F.collect_list(span)).alias("loss"),
        F.array_sort(F.flatten(F.collect_list(F.when(F.size("others") > 0, attached)))).alias("attachments"),
    )
    return grouped.select(
        "conv_id",
        "n_turns",
        F.array_join("all.shown", "").alias("formatted"),
        F.transform("loss", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("loss"),
        "attachments",
        F.aggregate("attachments.tokens", F.lit(0).cast("long"), lambda a, t: a + t).alias("attachment_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """Role and text of each turn, as they were before formatting. Placeholders stay in the text."""
    shown = F.filter(F.split(formatted, _TURN_END), lambda t: t != "")

    def turn(t: Column) -> Column:
        cut = F.call_function("locate", F.lit(">"), t)
        name_from = len("<turn ")
        return F.struct(
            unescape(F.substring(t, F.lit(name_from + 1), cut - name_from - 1)).alias("role"),
            unescape(F.substring(t, cut + 2, F.length(t) - cut - 2)).alias("text"),
        )

    return F.transform(shown, turn)


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped. Four bytes a code point make each cut as long as its span."""
    # A blank before each cut, because a decoder drops a byte order mark that comes first.
    blank = F.encode(F.lit(" "), "UTF-32")

    def cut(held: Column, span: Column) -> Column:
        start, size = span["start"] * 4 + 1, (span["end"] - span["start"]) * 4
        return F.substring(F.decode(F.concat(blank, F.substring(held, start.cast("int"), size.cast("int"))), "UTF-32"), F.lit(2), F.lit(2**31 - 1))

    cuts = F.transform(F.array(F.encode(formatted, "UTF-32")), lambda held: F.transform(loss, lambda s: cut(held, s)))
    return unescape(F.array_join(cuts[0], ""))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what ``formatted`` says when it is read back."""
    said = F.transform(read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = loss_text(F.col("formatted"), F.col("loss"))
    return formatted.select(
        "conv_id",
        F.size(said).cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
