"""Connected components by repeated joins: every node moves to the least root its neighbours know."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setstride.llm.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the ends of `edges` (a, b): root is the least node of the component.

    Alternates hooking onto the least neighbour with pointer jumping. Both are joins on node ids and minima that combine
    before the shuffle, so a node with very many edges is one of many rows; each round is a written table.
    Empty edges give an empty result; loops and repeated edges change nothing.
    """
    links = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a != b")
    both = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    state = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "roots")
    while True:
        # the least root among the neighbours, offered to the node and to its root
        seen = both.join(state.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        met = state.join(seen, "node").select("node", "root", F.least("root", "near").alias("best"))
        offers = met.select("node", "best").unionByName(met.select(F.col("root").alias("node"), "best"))
        hooked = stored(offers.groupBy("node").agg(F.min("best").alias("root")), "hooked")
        jumped = hooked.join(hooked.select(F.col("node").alias("root"), F.col("root").alias("next")), "root")
        following = stored(jumped.select("node", F.least("root", "next").alias("root")), "roots")
        changed = following.join(state.withColumnRenamed("root", "old"), "node").where("root != old").limit(1).count()
        state = following
        if not changed:
            return state
