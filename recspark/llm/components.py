"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.llm.stages import cut, narrow


def components(edges: DataFrame) -> DataFrame:
    """Edges ``a, b`` of longs to one row ``node, component`` per node of an edge.

    component is the smallest node reachable. Loops, repeated edges and either
    direction are fine; rows with a null end are no edges; no edges give no rows.
    Each round hangs a node's larger neighbours on its smallest one, then does the same for
    its smaller neighbours; the number of rounds is logarithmic in the node count. The
    edges and each node's smallest neighbour are checkpointed as tables, so that the join of
    both may split a large hub (Spark splits no side that it has just aggregated). No table of
    a round has more rows than twice the edges, which are counted, so each is as many
    tasks wide as that needs.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = _state(e)
    few = lambda df: narrow(df, 2 * state[0], 16)
    e = few(e)
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(few(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))))
        large = few(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        large = cut(few(large))
        low = cut(few(large.groupBy("u").agg(F.min("v").alias("m"))))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        e = cut(few(few(small).distinct()))
        now = _state(e)
        if now == state:
            break
        state = now
    roots = few(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _state(e: DataFrame) -> tuple:
    row = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]
