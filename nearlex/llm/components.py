"""Connected components of an edge table by alternating stars.

Every round points all larger neighbours of a node to its smallest neighbour,
then all smaller ones; the number of rounds grows with the logarithm of the
longest path.  Each round is a written table, so that lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearlex.session import stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with a link; ``edges`` has the integer columns u, v.

    The root is the smallest node of the component.  Loops, repeated edges and
    an empty table are allowed.
    """
    edges = stage(edges.filter("u <> v").select("u", "v").distinct(), "edges")
    before = None
    while (now := _state(edges)) != before and now[0]:
        before = now
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select("v", "m")
        down = large.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).filter("u <> v").distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u")
        edges = stage(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(small.select("u", F.col("m").alias("v")))
            .filter("u <> v")
            .distinct(),
            "stars",
        )
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
