"""Personal data by bootstrapped contextual extraction.

Entities of known form (mail addresses, IP addresses, card and phone numbers, and
long keys) are the seeds. The words before them are lexical patterns. Patterns and
instances form a graph that is scored in rounds, until no pattern is added: a
pattern is as good as the share of its occurrences in the corpus that stand before a
known instance, and an instance as good as the patterns that it follows, unless it
mostly follows others. Good patterns make other identifiers known, whatever their
form.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haemoloom.llm.common import SPACE, stored, text_or_empty

# The forms of the base kinds. Possessive repeats and the looks at
# what stands before keep matching linear; they change no match.
_WORD = r"A-Za-z0-9._%+-"
FORMS = {
    "email": rf"(?:\G|(?<![{_WORD}]))[{_WORD}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: What the method adds.
DISCOVERED = "id"

#: A pattern is good if this share of its occurrences stands before known instances,
#: of which there are at least so many different ones.
PATTERN_SHARE = 0.5
PATTERN_SUPPORT = 3

#: An instance is known if this share of its occurrences follows good patterns.
INSTANCE_SHARE = 0.25

#: Identifiers of these forms are seeds besides the base kinds: keys and digests.
SEED_FORMS = (r"^[0-9A-Fa-f]{32,}+$", r"^[A-Za-z]{2,4}[_-][0-9A-Za-z_-]{24,}+$")

#: An identifier has this many characters and digits at least.
LEAST_CHARS = 6
LEAST_DIGITS = 3

#: Characters before an instance that mostly hold its context; if not, all are looked at.
CONTEXT_CHARS = 80

#: Matches whose places are added up together.
SPANS_TOGETHER = 256

_NOT_SPACE = r"[^\x20\x09-\x0D]"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: A whole token with a digit.
_TOKEN = rf"(?<!{_NOT_SPACE})(?=[^\x20\x09-\x0D0-9]*+[0-9]){_NOT_SPACE}++"

#: Places inside a word where a form can start.
_CUT = rf"(?<=[^{_WORD}])(?=[{_WORD}])|(?<=[^0-9])(?=[0-9])|(?<=[^+])(?=\+)"


def _bound(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), then)[0]


_SPAN = "array<struct<start: int, end: int, value: string, context: string>>"


_BLANK = r"[\x20\x09-\x0D]"
_BEGIN = rf"(?<!{_NOT_SPACE})"


def _last_words(before: Column) -> Column:
    """The last word of ``before``, and the one before too if it has no letter."""
    lower = F.translate(before, _CAPITALS, _CAPITALS.lower())
    last = F.regexp_extract(lower, rf"{_BEGIN}({_NOT_SPACE}++){_BLANK}*+$", 1)
    both = F.regexp_extract(lower, rf"{_BEGIN}({_NOT_SPACE}++{_BLANK}++{_NOT_SPACE}++){_BLANK}*+$", 1)
    return F.when(last.rlike(r"\p{L}"), last).otherwise(F.regexp_replace(both, _BLANK + "+", " "))


def _context(before: Column) -> Column:
    """The pattern that ``before`` ends with."""
    tail = F.right(before, F.lit(CONTEXT_CHARS))
    whole = tail.rlike(rf"{_BLANK}{_NOT_SPACE}++{_BLANK}++{_NOT_SPACE}++{_BLANK}*+$")
    return F.when((F.length(before) <= CONTEXT_CHARS) | whole, _last_words(tail)).otherwise(_last_words(before))


def _spans(text: Column, form: str) -> Column:
    """Start, end, value and context of all matches of ``form``; the text between matches tells their places.

    Lists grow in blocks, so that a text of very many matches is not copied for each.
    """

    def placed(found: Column) -> Column:
        def with_gaps(gaps: Column) -> Column:
            def before(i: Column) -> Column:
                # The last two words before a match may be, or be in, the two matches before.
                part = lambda held, k: F.coalesce(F.get(held, i - k), F.lit(""))
                return F.concat(part(found, 2), part(gaps, 1), part(found, 1), gaps[i])

            def step(state: Column, i: Column) -> Column:
                start = state["at"] + F.length(gaps[i])
                end = start + F.length(found[i])
                span = F.struct(start.alias("start"), end.alias("end"), found[i].alias("value"), _context(before(i)).alias("context"))
                return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

            def block(state: Column, b: Column) -> Column:
                first = F.struct(state["at"].alias("at"), F.array().cast(_SPAN).alias("spans"))
                last = F.least(b + SPANS_TOGETHER, F.size(found)) - 1
                done = F.aggregate(F.sequence(b, last), first, step)
                return _bound(done, lambda d: F.struct(d["at"].alias("at"), F.concat(state["blocks"], F.array(d["spans"])).alias("blocks")))

            first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("blocks"))
            return F.flatten(F.aggregate(F.sequence(F.lit(0), F.size(found) - 1, F.lit(SPANS_TOGETHER)), first, block)["blocks"])

        return F.when(F.size(found) == 0, F.array().cast(_SPAN)).otherwise(_bound(F.split(text, form, -1), with_gaps))

    return _bound(F.regexp_extract_all(text, F.lit(form), F.lit(0)), placed)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    def total(digits: Column) -> Column:
        def add(sum_, i):
            digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int") * (1 + i % 2)
            return sum_ + digit - F.when(digit > 9, 9).otherwise(0)

        return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0

    return _bound(_digits(value), total)


def _small_parts(value: Column) -> Column:
    """Whether all parts are at most 255, leading zeros aside."""
    parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


_VALID = {
    "email": None,
    "ip": _small_parts,
    "card": _luhn,
    "phone": lambda value: F.length(_digits(value)).between(9, 15),
}


def base_spans(text: Column) -> dict[str, Column]:
    """The valid spans of each base kind in ``text``."""

    def valid(kind: str) -> Column:
        spans, rule = _spans(text, FORMS[kind]), _VALID[kind]
        return F.filter(spans, lambda s: rule(s["value"])) if rule else spans

    return {kind: valid(kind) for kind in FORMS}


def _identifiers(text: Column) -> Column:
    """Tokens that look like identifiers, without the punctuation around them."""
    edge = r"[^\p{L}\p{N}]"

    def bare(s: Column) -> Column:
        lead = F.length(s["value"]) - F.length(F.regexp_replace(s["value"], rf"^{edge}++", ""))
        inner = F.regexp_replace(F.regexp_replace(s["value"], rf"^{edge}++", ""), rf"{edge}++$", "")
        start = s["start"] + lead
        return F.struct(
            start.alias("start"), (start + F.length(inner)).alias("end"), inner.alias("value"), s["context"].alias("context")
        )

    return F.filter(
        F.transform(_spans(text, _TOKEN), bare), lambda s: (F.length(s["value"]) >= LEAST_CHARS) & (F.length(_digits(s["value"])) >= LEAST_DIGITS)
    )


def _occurrences(base: DataFrame, seed_forms: tuple[str, ...]) -> DataFrame:
    """``row``, ``start``, ``end``, ``value``, ``context``, ``seed`` and ``base`` of each entity and each identifier beside them."""
    known = F.concat(*[F.col(f"spans.{kind}") for kind in FORMS])
    seeds = base.select("row", F.explode(known).alias("s")).select("row", "s.*")
    others = base.select("row", F.explode("identifiers").alias("s")).select("row", "s.*")
    others = others.join(seeds.select("value").distinct(), "value", "left_anti")
    seed = F.lit(False)
    for form in seed_forms:
        seed = seed | F.col("value").rlike(form)
    both = seeds.withColumns({"seed": F.lit(True), "base": F.lit(True)}).unionByName(others.withColumns({"seed": seed, "base": F.lit(False)}))
    return stored(both.filter("context != ''"), "pii-occurrences")


def _all_contexts(texts: DataFrame, longest: int) -> DataFrame:
    """``context`` at each place of the texts where one can end: after a word, and inside one where a form can start.

    Of longer words than ``longest`` characters only starts of about that length count.
    """
    words = texts.select(F.split(F.translate("text", _CAPITALS, _CAPITALS.lower()), SPACE + "+").alias("word"))
    both = words.select("word", F.concat(F.array(F.lit("")), "word").alias("before"))
    each = both.select(F.explode(F.arrays_zip("word", "before")).alias("held")).select("held.*").filter("word != ''")

    def starts(pieces: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(pieces)), lambda k: F.array_join(F.slice(pieces, 1, k), ""))

    word = F.left("word", F.lit(longest + 1))
    ends = F.when(word.rlike(_CUT), _bound(F.split(word, _CUT, -1), starts)).otherwise(F.array(word))
    ended = each.select("before", F.explode(ends).alias("end"))
    context = F.when(F.col("end").rlike(r"\p{L}"), F.col("end")).when(F.col("before") != "", F.concat_ws(" ", "before", "end"))
    return ended.select(context.alias("context"))


def _context_totals(texts: DataFrame, occurrences: DataFrame) -> DataFrame:
    """How often each context occurs in all texts, for contexts of enough different values.

    A context that starts inside a word, after another entity, counts where it stands
    before an entity or identifier.
    """
    contexts = occurrences.groupBy("context").agg(F.countDistinct("value").alias("values"), F.count("*").alias("places"))
    contexts = stored(contexts.filter(F.col("values") >= PATTERN_SUPPORT).select("context", "places"), "pii-contexts")
    longest = contexts.agg(F.coalesce(F.max(F.length("context")), F.lit(0))).first()[0]
    # Counted before they are joined, so that words are not shuffled one by one.
    totals = _all_contexts(texts, longest).groupBy("context").agg(F.count("*").alias("total"))
    total = F.greatest(F.coalesce("total", F.lit(0)), "places").alias("total")
    return stored(contexts.join(totals, "context", "left").select("context", total), "pii-totals")


def discover(texts: DataFrame, base: DataFrame, seed_forms: tuple[str, ...] = SEED_FORMS) -> DataFrame | None:
    """``row`` and ``found``, the spans of identifiers that good patterns make known; None if there is no good pattern.

    ``texts`` has the column ``text`` without NULLs. Identifiers that match one of
    ``seed_forms`` are known from the start. Patterns and instances only ever gain,
    so the rounds end.
    """
    occurrences = _occurrences(base, seed_forms)
    totals = _context_totals(texts, occurrences)
    seeds = occurrences.filter("seed").select("value", F.lit(1.0).alias("score")).distinct()
    followed = occurrences.filter("NOT seed").groupBy("value", "context").agg(F.count("*").alias("n"))
    known, patterns, before = seeds, None, 0
    while True:
        held = occurrences.join(known, "value").groupBy("context").agg(
            F.sum("score").alias("weight"), F.countDistinct("value").alias("support")
        )
        share = F.least(F.col("weight") / F.col("total"), F.lit(1.0))
        patterns = held.filter(F.col("support") >= PATTERN_SUPPORT).join(totals, "context").select("context", share.alias("share"))
        patterns = stored(patterns.filter(F.col("share") >= PATTERN_SHARE), "pii-patterns")
        n = patterns.count()
        if n == before:  # no pattern was added, so no instance would be
            break
        before = n
        doubt = F.sum(F.log(F.greatest(1 - F.col("share"), F.lit(1e-9))))
        good = F.sum(F.when(F.col("share").isNotNull(), F.col("n")).otherwise(0)) / F.sum("n")
        found = followed.join(patterns, "context", "left").groupBy("value").agg((1 - F.exp(doubt)).alias("score"), good.alias("good"))
        found = found.filter(F.col("good") >= INSTANCE_SHARE).select("value", "score")
        known = stored(seeds.unionByName(found), "pii-known")
    if not before:
        return None
    new = occurrences.filter("NOT base").join(patterns.select("context"), "context", "left_semi").join(known.select("value"), "value", "left_semi")
    return new.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("found"))


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False, seed_forms: tuple[str, ...] = SEED_FORMS
) -> DataFrame:
    """Each row of ``docs`` with its spans: ``doc_id`` and ``spans``, a struct with one sorted list for each kind.

    Spans count code points, and their end is exclusive. Base kinds are found by
    form; identifiers that context makes known are of the kind ``id`` and never
    touch a base span. ``seed_forms`` are more forms of what is known from the start. A NULL text is empty; NULL and repeated ids are kept, and
    other columns are not looked at unless ``carry`` keeps the whole row in the
    struct ``doc``. An empty table gives an empty result.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        text_or_empty(text_col).alias("text"),
        *([F.struct(*[F.col(c) for c in docs.columns]).alias("doc")] if carry else []),
    )
    text = F.col("text")
    spans = F.struct(*[c.alias(kind) for kind, c in base_spans(text).items()])
    base = stored(rows.select("row", "doc_id", spans.alias("spans"), _identifiers(text).alias("identifiers"), *(["doc"] if carry else [])), "pii-base")
    found = discover(docs.select(text_or_empty(text_col).alias("text")), base, seed_forms)
    base = base.drop("identifiers")
    nothing = F.array().cast("array<struct<start: int, end: int>>")
    whole = base.join(found, "row", "left") if found is not None else base.withColumn("found", F.lit(None).cast("array<struct<start: int, end: int>>"))
    plain = {k: F.transform(F.col(f"spans.{k}"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for k in FORMS}
    every = F.concat(*plain.values())
    added = F.filter(
        F.coalesce("found", nothing),
        lambda f: ~F.exists(every, lambda s: (s["start"] < f["end"]) & (s["end"] > f["start"])),
    )
    result = F.struct(*[c.alias(k) for k, c in plain.items()], added.alias(DISCOVERED))
    return whole.select("doc_id", result.alias("spans"), *(["doc"] if carry else []))


def span_texts(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of base spans and all spans as text."""

    def shown(kind: str) -> Column:
        each = F.transform(
            F.col(f"spans.{kind}"), lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string"))
        )
        return each

    base = F.concat(*[shown(k) for k in FORMS])
    return found.select(
        "doc_id",
        *[F.size(f"spans.{k}").cast("long").alias(f"n_{k}") for k in FORMS],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, shown(DISCOVERED)), ",").alias("spans"),
    )


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with each span of its texts replaced by its kind in angle brackets, such as ``<EMAIL>``.

    Of spans that overlap, the one that starts first is replaced, and with it what
    the others add.
    """
    found = find_personal_data(docs, id_col, text_col, carry=True)

    def tags(kind: str) -> Column:
        tag = F.lit(f"<{kind.upper()}>").alias("tag")
        return F.transform(F.col(f"spans.{kind}"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), tag))

    tagged = F.array_sort(F.concat(*[tags(kind) for kind in (*FORMS, DISCOVERED)]))
    text = F.col("doc")[text_col]

    def joined(spans: Column) -> Column:
        def step(state: Column, s: Column) -> Column:
            gap = F.substring(text, state["at"] + 1, s["start"] - state["at"])
            inside = s["start"] < state["at"]
            return F.struct(
                F.greatest(state["at"], s["end"]).alias("at"),
                F.when(inside, state["parts"]).otherwise(F.concat(state["parts"], F.array(gap, s["tag"]))).alias("parts"),
            )

        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
        done = F.aggregate(spans, first, step)
        return F.concat(F.array_join(done["parts"], ""), F.substring(text, done["at"] + 1, F.length(text)))

    clean = F.when(F.size(tagged) == 0, text).otherwise(_bound(tagged, joined))
    return found.select(*[clean.alias(c) if c == text_col else F.col("doc")[c].alias(c) for c in docs.columns])
