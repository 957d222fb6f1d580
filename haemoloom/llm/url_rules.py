"""URL rules by a sort-merge range join.

A rule's key is its host with the labels reversed, then its path; all keys that
start with it form an interval. URLs and the ends of intervals are sorted
together, and the sweep keeps the stack of active rules: the depth is the running
sum of openings less closings, and the top of the stack at a depth is the last
rule opened at that depth.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haemoloom.llm.common import stored

ALLOW, BLOCK = "allow", "block"

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_OPENS, _URL, _CLOSES = 0, 1, 2


def _host_and_path(url: Column) -> list[Column]:
    """After the first ``://``: up to ``/``, ``?`` or ``#``, and from there up to ``?`` or ``#``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), _CAPITALS, _CAPITALS.lower())
    found = [host, F.regexp_extract(url, pattern, 2)]
    return [F.coalesce(c, F.lit("")).alias(name) for c, name in zip(found, ("host", "path"))]


def _key(reversed_labels: Column, path: Column) -> Column:
    """Bytes that sort by host and path; a host holds no slash, so hosts never share an interval."""
    return F.concat(F.array_join(reversed_labels, "."), F.lit("/"), path).cast("binary")


def _reversed(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _running(df: DataFrame, part: str, value: str, name: str) -> DataFrame:
    """Sums of ``value`` before each part, from one row per part."""
    order = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return df.select(part, F.coalesce(F.sum(value).over(order), F.lit(0)).alias(name))


def _innermost(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """``key`` and the innermost of ``rules`` (key, rule) whose interval holds it; other keys are left out."""
    spark = keys.sparkSession
    empty = F.lit(None).cast(rules.schema["rule"].dataType)
    events = (
        keys.select("key", F.lit(_URL).alias("kind"), F.lit(0).alias("step"), empty.alias("rule"))
        .union(rules.select("key", F.lit(_OPENS), F.lit(1), "rule"))
        .union(rules.select(F.concat("key", F.unhex(F.lit("FF"))), F.lit(_CLOSES), F.lit(-1), empty))
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = events.repartitionByRange(parts, "key", "kind").withColumn("part", F.spark_partition_id())
    events = stored(dealt, "url-events")
    before = _running(events.groupBy("part").agg(F.sum("step").alias("steps")), "part", "steps", "before")
    local = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    deep = events.withColumn("depth", F.sum("step").over(local)).join(before, "part")
    deep = deep.withColumn("depth", F.col("depth") + F.col("before"))
    level = Window.partitionBy("part", "depth").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = deep.withColumn("top", F.last("rule", ignorenulls=True).over(level))
    # A rule still open from an earlier part: one row per part and depth.
    opened = deep.filter(F.col("kind") == _OPENS).groupBy("part", "depth").agg(F.max_by("rule", "key").alias("rule"))
    touched = swept.select("part", "depth").distinct().join(opened, ["part", "depth"], "left")
    earlier = Window.partitionBy("depth").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = touched.select("part", "depth", F.last("rule", ignorenulls=True).over(earlier).alias("carried"))
    urls = swept.filter((F.col("kind") == _URL) & (F.col("depth") > 0)).join(carried, ["part", "depth"], "left")
    return urls.select("key", F.coalesce("top", "carried").alias("rule"))


def judge_urls(
    pages: DataFrame, rules: DataFrame, default: str = ALLOW, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and all
    subdomains if the path starts with the rule's; the longest host wins, then the
    longest path, and of equal rules a blocking one. Rules without host or verdict
    are left out, and a NULL path is the empty prefix. URLs that no rule fits get
    ``default``. NULL URLs have empty host and path. Repeated pages are kept; other
    columns are not looked at. Either table may be empty.
    """
    clean = (
        rules.filter("host != '' AND verdict IS NOT NULL")
        .select(F.translate("host", _CAPITALS, _CAPITALS.lower()).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
    )
    deepest = clean.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    opened = clean.select(
        _key(_reversed(F.col("host")), F.col("path")).alias("key"),
        F.struct(F.length("path").alias("length"), F.concat("host", "path").alias("rule"), "verdict").alias("rule"),
    )
    judged = pages.select(F.col(id_col).alias("page_id"), *_host_and_path(F.col(url_col)))
    # One key for each suffix of the host that a rule may have.
    labels = _reversed(F.col("host"))
    levels = F.filter(F.sequence(F.lit(1), F.lit(max(deepest, 1))), lambda i: i <= F.size(labels))
    places = (
        judged.select("host", "path").filter("host != ''").distinct()
        .select("host", "path", labels.alias("labels"), F.explode(levels).alias("level"))
        .select("host", "path", "level", _key(F.slice("labels", F.lit(1), F.col("level")), F.col("path")).alias("key"))
    )
    places = stored(places, "url-keys")
    found = places.join(_innermost(places.select("key").distinct(), opened), "key")
    best = found.groupBy("host", "path").agg(F.max_by("rule", F.struct("level", "rule.length")).alias("won"))
    return judged.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("won.rule").alias("rule"), F.coalesce("won.verdict", F.lit(default)).alias("verdict")
    )
