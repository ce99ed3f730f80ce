"""Connected components of an edge table, by alternating star contractions.

Every round rewires each node to the smallest neighbour it knows (first among
larger neighbours, then among smaller ones), which ends in stars after a
number of rounds logarithmic in the longest chain. Nothing but counts reaches
the driver. The minimum of a hub is found with map-side partial aggregation
and written out before it is joined back, so adaptive execution may split the
hub's rows over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of canonical edges (u > v)."""
    flipped = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    around = edges.unionByName(flipped) if large else edges
    least = materialize(around.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
    joined = around.join(least, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select("v", "m").unionByName(least.select(F.col("u").alias("v"), "m")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    result = materialize(out.where("u <> v").distinct(), "star")
    discard(least)
    return result


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges``: two columns of longs, any order and repetition. Returns
    ``node, root`` for every node that has an edge to another one; the root is
    the smallest node of its component. Self-loops and nulls say nothing and
    are left out; an empty table gives an empty table."""
    a, b = (F.col(f"`{c}`") for c in edges.columns[:2])
    current = materialize(edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    for _ in range(max_rounds):
        if current.isEmpty():
            break
        wide = _star(current, large=True)
        narrow = _star(wide, large=False)
        discard(wide)
        same = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() == narrow.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(current)
        current = narrow
        if same:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
