"""Connected components of a graph given as an edge table, by DataFrame rounds.

Alternating large-star and small-star rounds over distinct edges. Each round
aggregates per node with a partial aggregate and joins the result back on the
node (a skewed node's partition is split by AQE), and is written to the shared
folder, so neither lineage nor any node's neighbours pile up in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged


def _smallest(pairs: DataFrame) -> DataFrame:
    """Per u the smallest of u and its neighbours."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``: root is the smallest
    node reachable. Self-loops and repeated edges are harmless; an empty edge
    table gives no rows. Raises if it has not settled after ``max_rounds``.
    """
    stars = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        # large star: every neighbour above u links to the smallest of u's neighbourhood
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_smallest(both), "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: u and its neighbours below link to the smallest of them
        small = large.join(_smallest(large), "u")
        stars = staged(small.select("u", F.col("m").alias("v"))
                       .unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
                       .where("u <> v").distinct(), "stars")
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            roots = stars.groupBy("v").agg(F.lit(1)).select(F.col("v").alias("node"), F.col("v").alias("root"))
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        before = now
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
