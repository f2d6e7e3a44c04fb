"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.tables import store


def _stars(edges: DataFrame, by: str, to: str, name: str) -> DataFrame:
    """Each ``by`` with the least ``to``; stored, so that the join below can split a hub."""
    return store(edges.groupBy(by).agg(F.min(to).alias("low")), name)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` for each node of an undirected link table; component is the least id reachable.

    Large-star and small-star steps alternate until the links are stars; a
    step is one aggregation and one join, so neither a hub nor a component
    has to fit in a task.  Null ends and self links are ignored; nodes without
    a link don't appear.
    """
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where(F.col("u") > F.col("v")).distinct())
    e = store(e, "links")
    while True:
        both = store(e.union(e.select(F.col("v"), F.col("u"))), "both")
        low = _stars(both, "u", "v", "large")
        # large star: every larger neighbour moves to the least of the neighbourhood
        e = (both.join(low, "u").where(F.col("v") > F.col("u"))
             .select(F.col("v").alias("u"), F.least("u", "low").alias("v")).distinct())
        e = store(e, "large-star")
        low = _stars(e, "u", "v", "small")
        # small star: smaller neighbours and the node itself move to the least of them
        e = (e.join(low, "u").select(F.explode(F.array(
                F.struct(F.col("u"), F.col("low").alias("v")),
                F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("x"))
             .select("x.u", "x.v").where(F.col("u") > F.col("v")).distinct())
        e = store(e, "small-star")
        # done when every node has one lesser neighbour and that one has none
        rows, nodes = e.agg(F.count("*"), F.count_distinct("u")).first()
        if rows == nodes and e.join(e.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty():
            break
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
