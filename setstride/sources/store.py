"""Snapshots of keyed tables: upsert, incremental load, back-fill, constraint check, sinks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from setstride.operators.layout import SERIES, ordinal


def upsert(stored: DataFrame, batches: list[DataFrame], keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Whole-row replace by key, the last batch wins; columns a batch lacks become null.

    Of a key that a batch repeats, the row with the largest `order` wins (by default the largest of the other columns in turn), whatever
    task reads it. `max_by` combines before the shuffle, so a key rewritten many times costs one row per task.
    """
    versions = stored.withColumn("_seq", F.lit(0))
    for seq, batch in enumerate(batches, 1):
        versions = versions.unionByName(batch.withColumn("_seq", F.lit(seq)), allowMissingColumns=True)
    rest = [c for c in stored.columns if c not in keys]
    newest = versions.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("_seq", *(order or rest))).alias("_row"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in stored.columns])


def latest_key(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.coalesce(F.max(key), F.lit(0)).alias("latest"), F.count("*").alias("n_rows"))


def newer_than(incoming: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows beyond the largest stored key; the bound is one number, so it is pushed into the scan."""
    bound = latest_key(stored, key).first()["latest"]
    return incoming.where(F.col(key) > F.lit(bound))


def before_old_page(incoming: DataFrame, stored: DataFrame, key: str, page: str) -> DataFrame:
    """New rows of a paged load, newest page first, that stops with the first page that holds a known row.

    Rows beyond the stored bound on that page and the pages before it; later pages are not asked for, whatever they hold.
    """
    bound = latest_key(stored, key).first()["latest"]
    old = incoming.where(F.col(key) <= F.lit(bound)).agg(F.min(page)).first()[0]
    read = incoming if old is None else incoming.where(F.col(page) <= F.lit(old))
    return read.where(F.col(key) > F.lit(bound))


def backfill(stored: DataFrame, scraped: DataFrame, key: str = "step_id", date: str = "ts") -> DataFrame:
    """Rows of dates not stored yet under provisional ids below every known one, the newest highest."""
    missing = scraped.join(stored.select(date).distinct(), date, "left_anti")
    bound = stored.agg(F.least(F.coalesce(F.min(key), F.lit(0)), F.lit(0))).first()[0]
    numbered = ordinal(
        missing.withColumn(SERIES, F.lit(0))
        .withColumn("_day", -F.unix_date(date))
        .withColumn("_tie", -F.col("_source_id")),
        ["_day", "_tie"],
    )
    return numbered.withColumn(key, F.lit(bound) - 1 - F.col("ord")).drop("_day", "_tie", "ord", SERIES)


def prefer_official(df: DataFrame, key: str = "step_id", date: str = "ts") -> DataFrame:
    """One row per date: an official (positive) id before a provisional one, then the larger id."""
    rest = [c for c in df.columns if c != date]
    best = df.groupBy(date).agg(F.max_by(F.struct(*rest), F.struct(F.col(key) > 0, F.col(key))).alias("_row"))
    return best.select(*[F.col(c) if c == date else F.col(f"_row.{c}").alias(c) for c in df.columns])


@dataclass(frozen=True)
class Rules:
    not_null: tuple[str, ...] = ()
    checks: tuple[tuple[str, Column], ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    foreign: tuple[tuple[str, DataFrame, str], ...] = ()


def violations(df: DataFrame, rules: Rules) -> DataFrame:
    """rule, violations: row rules in one scan, unique keys by count, foreign keys by anti join."""
    spark = df.sparkSession
    counts = [F.count_if(F.col(c).isNull()).alias(f"not null {c}") for c in rules.not_null]
    counts += [F.count_if(~c).alias(f"check {name}") for name, c in rules.checks]
    parts = []
    if counts:
        row = df.agg(*counts)
        parts.append(row.unpivot([], row.columns, "rule", "violations"))
    for keys in rules.unique:
        repeated = df.groupBy(*keys).count().where("count > 1")
        parts.append(repeated.agg(F.lit(f"unique {', '.join(keys)}").alias("rule"), F.count("*").alias("violations")))
    for column, parent, key in rules.foreign:
        known = parent.select(F.col(key).alias(column)).distinct()
        orphans = df.where(F.col(column).isNotNull()).join(known, column, "left_anti")
        parts.append(orphans.agg(F.lit(f"foreign {column}").alias("rule"), F.count("*").alias("violations")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def append_table(df: DataFrame, path: str, fmt: str = "csv", run: str | None = None) -> None:
    """Append a result; with `run`, under its own partition folder so that a re-run is easy to find."""
    out = df if run is None else df.withColumn("run", F.lit(run))
    writer = out.write.mode("append").format(fmt)
    if run is not None:
        writer = writer.partitionBy("run")
    (writer.option("header", True) if fmt == "csv" else writer).save(path)


def read_table(spark: SparkSession, path: str, schema: str, fmt: str = "csv") -> DataFrame:
    reader = spark.read.schema(schema).format(fmt)
    return (reader.option("header", True) if fmt == "csv" else reader).load(path)


def append_summary(report: DataFrame, path: str, run_time: str, elapsed: dict[str, float]) -> None:
    """Append one row per model of a walk report to a CSV table: run time, model, metrics, elapsed seconds and the ticket returns, 25 columns."""
    seconds = F.create_map(*[F.lit(v) for pair in elapsed.items() for v in pair]) if elapsed else None
    took = F.lit(None).cast("double") if seconds is None else F.try_element_at(seconds, F.col("model"))
    base = [F.round(c, d).alias(c) for c, d in (("avg_hits", 4), ("prec_at5", 4), ("vs_random", 4), ("ev_per_draw", 4), ("net_ev", 4), ("roi_pct", 2))]
    buys = [F.round(f"buy{k}_{c}", d).alias(f"buy{k}_{c}") for k in range(1, 6) for c, d in (("ev", 4), ("net_ev", 4), ("roi", 2))]
    row = report.select(F.lit(run_time).alias("run_time"), "model", "n_draws", *base, F.round(took, 1).alias("elapsed_sec"), *buys)
    append_table(row, path)


def write_document(document: DataFrame, path: str) -> None:
    """JSON documents as lines of text, one per series; a second run replaces the first."""
    document.select(F.col("document").alias("value")).write.mode("overwrite").text(path)
