"""Structured Streaming forms of the incremental jobs."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from setstride.operators.layout import SERIES, block_size, ordinal
from setstride.operators.state import sparse_gaps
from setstride.session import materialise


#: Setting under which sessions are merged inside each task before the shuffle.
MERGE_SESSIONS = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def event_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = 1) -> DataFrame:
    """Parquet events as they land in `folder`, all that is new in one batch if `files_per_trigger` is None; `ts` becomes a timestamp so that watermarks accept it."""
    reader = spark.readStream.schema(spark.read.parquet(folder).schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    stream = reader.parquet(folder)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _version(folder: str, batch: int) -> str:
    return os.path.join(folder, f"batch-{batch:012d}")


def newest_version(spark: SparkSession, folder: str) -> int:
    """Number of the latest version in `folder`, -1 without any; read from the names of its files."""
    try:
        files = spark.read.parquet(os.path.join(folder, "batch-*"))
    except AnalysisException:  # nothing has been written yet
        return -1
    number = F.regexp_extract(F.col("_metadata.file_path"), r"batch-(\d+)", 1).cast("long")
    found = files.select(F.max(number)).first()[0]
    return -1 if found is None else found


def _previous(spark: SparkSession, folder: str, batch: int, schema) -> DataFrame:
    """The state that batch n starts from: empty for the first batch, else version n - 1, which must be there."""
    if batch == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_version(folder, batch - 1))


def run_incremental_load(stream: DataFrame, folder: str, checkpoint: str) -> None:
    """Land each micro-batch as one delta; `current_rows` resolves repeated keys when the table is read.

    A batch costs what it holds, not what is stored, and rows of any age are kept. A batch that is run again writes the
    same delta again, so a restart neither loses nor doubles rows.
    """

    def land(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(_version(folder, number))

    query = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def current_rows(spark: SparkSession, folder: str, key: str = "event_id", order: str = "ts") -> DataFrame:
    """The table behind the deltas: for each key the row of its latest batch, inside a batch the one with the latest `order`."""
    deltas = spark.read.parquet(os.path.join(folder, "batch-*"))
    batch = F.regexp_extract(F.input_file_name(), r"batch-(\d+)", 1).cast("long")
    rest = [c for c in deltas.columns if c != key]
    newest = deltas.withColumn("_seq", batch).groupBy(key).agg(F.max_by(F.struct(*rest), F.struct("_seq", order, *[c for c in rest if c != order])).alias("_row"))
    return newest.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])


STATE = f"{SERIES} long, item string, appearances long, last_ord long, gap_sum long, n_steps long"


def advance_state(state: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reveal one batch of one-item steps: (rows with the state they saw, new state).

    Ordinals continue from the stored length of each series. Stored sightings enter as the oldest
    occurrence of their item, so a series or item of any size is cut into blocks like in the batch job.
    """
    spark = batch.sparkSession
    lengths = state.groupBy(SERIES).agg(F.max("n_steps").alias("_base"))
    numbered = materialise(ordinal(batch.select(SERIES, "ts", "event_id", "item"), ["ts", "event_id"], name="_local"), "batch")
    rows = numbered.join(lengths, SERIES, "left").withColumn("ord", F.col("_local") + F.coalesce("_base", F.lit(0))).drop("_base")
    longest = numbered.agg(F.max("_local")).first()[0] or 0
    stored = state.select(SERIES, "item", F.col("last_ord").alias("ord"), F.lit(True).alias("_stored"))
    touched = stored.join(rows.select(SERIES, "item").distinct(), [SERIES, "item"])
    seen = sparse_gaps(rows.withColumn("_stored", F.lit(False)).unionByName(touched, allowMissingColumns=True), block_size(longest + 1))
    emitted = seen.where(~F.col("_stored")).select(SERIES, "event_id", "ts", "item", "ord", "seen_before", "gap")
    change = rows.groupBy(SERIES, "item").agg(F.count("*").alias("appearances"), F.max("ord").alias("last_ord"))
    gaps = emitted.groupBy(SERIES, "item").agg(F.coalesce(F.sum("gap"), F.lit(0)).alias("gap_sum"))
    grown = rows.groupBy(SERIES).agg((F.max("ord") + 1).alias("_n"))
    merged = (
        state.drop("n_steps")
        .unionByName(change.join(gaps, [SERIES, "item"]))
        .groupBy(SERIES, "item")
        .agg(F.sum("appearances").alias("appearances"), F.max("last_ord").alias("last_ord"), F.sum("gap_sum").alias("gap_sum"))
    )
    sizes = lengths.withColumnRenamed("_base", "_n").unionByName(grown).groupBy(SERIES).agg(F.max("_n").alias("n_steps"))
    return emitted, merged.join(sizes, SERIES).select(*[c.split()[0] for c in STATE.split(", ")])


def run_online_state(stream: DataFrame, folder: str, checkpoint: str) -> str:
    """Predict, reveal, update per micro-batch; returns the path of the final state version.

    The per-step rows of batch n are in `folder`/steps/batch-n. Batch n reads state version n-1 and writes version n, so a batch that is
    run again starts from the same state. A version has one row per (series, item), not per event. A run in which nothing new
    has landed returns the version of the last one. Inside a batch steps may come in any order; a later batch holds later steps of a series.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        state = _previous(spark, f"{folder}/state", number, STATE)
        emitted, after = advance_state(state, batch)
        emitted.write.mode("overwrite").parquet(_version(f"{folder}/steps", number))
        after.write.mode("overwrite").parquet(_version(f"{folder}/state", number))

    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return newest_state(stream.sparkSession, folder)


def newest_state(spark: SparkSession, folder: str) -> str:
    return _version(f"{folder}/state", max(newest_version(spark, f"{folder}/state"), 0))


def rolling_activity(events: DataFrame, size: str = "7 days", slide: str = "7 days", delay: str = "1 day") -> DataFrame:
    """Events and their value per item and event-time window; partial sums combine before the shuffle."""
    source = events.withWatermark("ts", delay) if events.isStreaming else events
    return source.groupBy(F.window("ts", size, slide), "item").agg(
        F.count("*").alias("n"), F.sum("value").alias("total")
    ).select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "item", "n", "total")


def sessions(events: DataFrame, gap: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Streaming sessions per series (batch: `block_sessions`); `MERGE_SESSIONS` in the session's settings merges them inside a task first."""
    source = events.withWatermark("ts", delay)
    return source.groupBy(F.session_window("ts", gap), SERIES).agg(F.count("*").alias("n")).select(
        SERIES, F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "n"
    )


def run_to_table(stream: DataFrame, folder: str, checkpoint: str) -> str:
    """Append-mode run over everything that has landed; only closed windows are written."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return folder
