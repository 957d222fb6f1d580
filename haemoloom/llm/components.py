"""Connected components by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haemoloom.llm.common import stored


def _with_least(edges: DataFrame) -> DataFrame:
    """``edges`` (node, other) with the least node among a node and its others in ``least``."""
    least = edges.groupBy("node").agg(F.min("other").alias("other"))
    return edges.join(least.select("node", F.least("node", "other").alias("least")), "node")


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has one other, and no other is a node itself."""
    sides = [F.struct(F.col(c).alias("end"), F.lit(up).alias("up")) for c, up in (("node", 1), ("other", 0))]
    ends = edges.select(F.explode(F.array(*sides)).alias("side")).select("side.*").groupBy("end").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return ends.filter((F.col("ups") > 1) | ((F.col("ups") > 0) & (F.col("least") == 0))).isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node that it is linked with, for each node of ``links`` (a, b).

    Each round only regroups links, so their number never grows, and it halves the
    depth of the trees; links stay distributed and each round is stored.
    """
    edges = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")).filter("node != other")
    while True:
        # Large star: the larger others of a node move to the least node it knows.
        both = edges.union(edges.select(F.col("other"), F.col("node")))
        large = _with_least(both).filter("other > node").select(F.col("other").alias("node"), F.col("least").alias("other"))
        # Small star: a node and its smaller others move to the least of them.
        small = _with_least(large.filter("node > other"))
        moved = small.select(F.explode(F.array("node", "other")).alias("node"), F.col("least").alias("other"))
        edges = stored(moved.filter("node != other").distinct(), "links")
        if _are_stars(edges):
            break
    roots = edges.select(F.col("other").alias("node")).distinct()
    return edges.select("node", F.col("other").alias("root")).union(roots.select("node", F.col("node").alias("root")))
