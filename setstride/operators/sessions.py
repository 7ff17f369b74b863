"""Sessions of ordered events: bursts no more than a gap apart, for series of any length."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from setstride.operators.layout import SERIES, by_block, halo_window, spread


def block_sessions(events: DataFrame, size: int, gap: str = "1 day") -> DataFrame:
    """series_id, session_start, session_end, n from numbered events (series_id, ord, ts).

    Each row tells from its neighbour whether it opens a session; session numbers are running counts
    inside blocks on top of the counts of earlier blocks, so no task needs a whole series.
    """
    rows = by_block(spread(events.select(SERIES, "ord", "ts"), size, 1))
    before = F.lag("ts").over(halo_window())
    opens = F.coalesce(F.col("ts") >= before + F.expr(f"INTERVAL {gap}"), F.lit(True)).cast("long")
    marked = rows.select(SERIES, "block", "ord", "ts", "own", opens.alias("opens")).where("own").drop("own")
    earlier = Window.partitionBy(SERIES).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        marked.groupBy(SERIES, "block")
        .agg(F.sum("opens").alias("_n"))
        .select(SERIES, "block", F.lit(-1).cast("long").alias("ord"), F.sum("_n").over(earlier).alias("opens"))
        .where(F.col("opens").isNotNull())
    )
    upto = halo_window().rowsBetween(Window.unboundedPreceding, 0)
    numbered = marked.unionByName(carry, allowMissingColumns=True).withColumn("session", F.sum("opens").over(upto))
    return (
        numbered.where(F.col("ord") >= 0)
        .groupBy(SERIES, "session")
        .agg(F.min("ts").alias("session_start"), F.max("ts").alias("_last"), F.count("*").alias("n"))
        .select(SERIES, "session_start", (F.col("_last") + F.expr(f"INTERVAL {gap}")).alias("session_end"), "n")
    )
