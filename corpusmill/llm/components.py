"""Connected components of a link table by alternating star contraction.

Each round joins the links with every node's least neighbour, an aggregate that
is combined before the shuffle, so a hub's neighbours never meet in one task; its
join side may be split by the adaptive skew join. Rounds end when the links form
stars. Every round is written to the shared folder, which keeps lineage short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.plans.lineage import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id) for each linked id; component_id is the least id reachable."""
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = cut(edges)
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = cut(small)
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id"))


def _stars(edges: DataFrame) -> bool:
    """Whether every u has one v and no v is a u."""
    ends = edges.select("u", F.lit(1).alias("n"), F.lit(0).alias("root")).unionByName(edges.select(F.col("v").alias("u"), F.lit(0).alias("n"), F.lit(1).alias("root")))
    return ends.groupBy("u").agg(F.sum("n").alias("n"), F.max("root").alias("root")).where("n > 1 OR (n = 1 AND root = 1)").isEmpty()
