"""Queries that run Structured Streaming to the end of the landed data."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from setstride.operators.layout import SERIES
from setstride.operators.sessions import block_sessions
from setstride.plans.common import numbered_events, query, table
from setstride.session import shared_folder
from setstride.streaming import incremental


def landed_events(spark, folder, parts: int = 4, in_order: bool = True) -> str:
    """The events table as a folder that grew part by part, in the order of time or against it; all tasks write each part."""
    path = f"{shared_folder(spark)}/landed-{uuid.uuid4().hex}"
    events = table(spark, folder, "events")
    seconds = F.col("ts").cast("timestamp").cast("long")
    lo, hi = events.agg(F.min(seconds), F.max(seconds)).first()
    part = F.least(F.floor((seconds - lo) * parts / (hi - lo + 1)), F.lit(parts - 1))
    for n in range(parts):
        events.where(part == (n if in_order else parts - 1 - n)).write.mode("append").parquet(path)
    return path


def run_by_parts(spark, folder, run, parts: int = 4, files_per_trigger: int | None = 1_000, close: bool = True) -> None:
    """Land the events part by part in the order of time and run the stream after each; a last row far ahead closes all windows.

    `run(stream)` starts from its checkpoint each time, so this is as many runs of the job as there are parts. The files of
    one part overlap in time; without a number of `files_per_trigger` they are one batch.
    """
    path = f"{shared_folder(spark)}/growing-{uuid.uuid4().hex}"
    events = table(spark, folder, "events")
    seconds = F.col("ts").cast("timestamp").cast("long")
    lo, hi = events.agg(F.min(seconds), F.max(seconds)).first()
    part = F.least(F.floor((seconds - lo) * parts / (hi - lo + 1)), F.lit(parts - 1))
    ahead = events.agg((F.max("ts") + F.expr("INTERVAL 60 DAYS")).alias("ts"))
    closing = events.limit(0).unionByName(ahead, allowMissingColumns=True).select(events.columns)
    for rows in [*[events.where(part == n) for n in range(parts)], *([closing] if close else [])]:
        rows.write.mode("append").parquet(path)
        run(incremental.event_stream(spark, path, files_per_trigger))


def place(spark, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@query("stream_load", "SELECT event_id, user_id, event_type, round(value, 6) AS value FROM events")
def _(spark, folder):
    """Files land against the order of time, and the job runs a second time with nothing new."""
    landed, path, checkpoint = landed_events(spark, folder, in_order=False), place(spark, "load"), place(spark, "load-checkpoint")
    for _ in range(2):
        incremental.run_incremental_load(incremental.event_stream(spark, landed), path, checkpoint)
    return incremental.current_rows(spark, path).select("event_id", "user_id", "event_type", "value")


@query("stream_state", """
WITH ev AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS ord FROM events),
gp AS (SELECT *, ord - lag(ord) OVER (PARTITION BY user_id, event_type ORDER BY ord) AS gap, max(ord) OVER (PARTITION BY user_id) + 1 AS n_steps FROM ev)
SELECT user_id, event_type, count(*) AS appearances, max(ord) AS last_ord, CAST(coalesce(sum(gap), 0) AS BIGINT) AS gap_sum, max(n_steps) AS n_steps
FROM gp GROUP BY ALL""")
def _(spark, folder):
    """Every part is one batch whatever its number of files, so the batches follow the order of time."""
    place_to, checkpoint = place(spark, "online"), place(spark, "online-checkpoint")

    def run(stream):
        steps = stream.select(F.col("user_id").alias(SERIES), "event_id", "ts", F.col("event_type").alias("item"))
        incremental.run_online_state(steps, place_to, checkpoint)

    run_by_parts(spark, folder, run, files_per_trigger=None, close=False)
    path = incremental.newest_state(spark, place_to)
    return spark.read.schema(incremental.STATE).parquet(path).withColumnsRenamed({SERIES: "user_id", "item": "event_type"})


ACTIVITY_SQL = """
WITH w AS (SELECT time_bucket(INTERVAL '7 days', ts, TIMESTAMP '1970-01-01') AS s, event_type, value FROM events)
SELECT strftime(s, '%Y-%m-%d') AS window_start, event_type AS item, count(*) AS n, round(sum(value), 4) AS total FROM w GROUP BY ALL"""


def activity(spark, folder, slide: str):
    place_to, checkpoint = place(spark, "activity"), place(spark, "activity-checkpoint")

    def run(stream):
        source = stream.select("ts", F.col("event_type").alias("item"), "value")
        incremental.run_to_table(incremental.rolling_activity(source, slide=slide), place_to, checkpoint)

    run_by_parts(spark, folder, run)
    rows = spark.read.parquet(place_to)
    return rows.select(F.date_format("window_start", "yyyy-MM-dd").alias("window_start"), "item", "n", F.round("total", 4).alias("total"))


@query("stream_activity", ACTIVITY_SQL)
def _(spark, folder):
    """Weekly activity in append mode, all windows closed."""
    return activity(spark, folder, "7 days")


@query("stream_sliding_activity", """
WITH w AS (SELECT time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01') - k * INTERVAL '1 day' AS s, event_type, value
           FROM events, (SELECT unnest(range(7)) AS k))
SELECT strftime(s, '%Y-%m-%d') AS window_start, event_type AS item, count(*) AS n, round(sum(value), 4) AS total FROM w GROUP BY ALL""")
def _(spark, folder):
    """Activity of the last seven days, every day."""
    return activity(spark, folder, "1 day")


SESSIONS_SQL = """
WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '1 day' THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM e),
w AS (SELECT user_id, min(ts) AS a, max(ts) + INTERVAL '1 day' AS b, count(*) AS n FROM s GROUP BY user_id, sid)
SELECT user_id, strftime(a, '%Y-%m-%d %H:%M:%S.%f') AS session_start, strftime(b, '%Y-%m-%d %H:%M:%S.%f') AS session_end, n FROM w"""


@query("event_sessions", SESSIONS_SQL)
def _(spark, folder):
    rows, size = numbered_events(spark, folder)
    return block_sessions(rows, size).withColumnRenamed(SERIES, "user_id")


@query("stream_sessions", SESSIONS_SQL)
def _(spark, folder):
    """All sessions, those open across parts and at the end included."""
    place_to, checkpoint = place(spark, "sessions"), place(spark, "sessions-checkpoint")

    def run(stream):
        incremental.run_to_table(incremental.sessions(stream.select("ts", F.col("user_id").alias(SERIES))), place_to, checkpoint)

    run_by_parts(spark, folder, run)
    return spark.read.parquet(place_to).withColumnRenamed(SERIES, "user_id")
