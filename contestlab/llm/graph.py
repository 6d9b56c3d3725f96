"""Connected components of an undirected graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from contestlab.llm.common import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """Columns node and root, the smallest node of its component, for every node of an edge (columns a, b).

    Every round links each node's larger neighbours, and then its smaller ones, to the smallest node in
    sight, until the edges are stars. The rounds grow as the logarithm of the longest path; state is
    written to the shared folder after each. An empty table gives no rows.
    """
    state = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        # larger neighbours: each goes to the least node around u
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        large = stored(large, "edges-large")
        # smaller neighbours: all of them, and u, go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).distinct()
        new = stored(small, "edges")
        same = new.count() == state.count() and new.join(state, ["u", "v"], "left_anti").isEmpty()
        discard(state, large)
        state = new
        if same:
            break
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
