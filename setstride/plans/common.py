"""Shared inputs and output form of the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setstride.functions.arrays import joined
from setstride.operators.layout import SERIES, StepTable, block_size, build_steps, ordinal
from setstride.session import materialise
from setstride.sources.draws import draws_from_orders, user_events

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
_BUILT: dict[tuple, object] = {}


def query(name: str, sql: str | None = None):
    """Register a query, and the SQL that must give the same rows."""

    def add(f: Query) -> Query:
        QUERIES[name] = lambda spark, folder: plain(f(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def plain(df: DataFrame, digits: int = 6) -> DataFrame:
    """Comparable output: long integers, doubles rounded, arrays as text."""
    out = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType)):
            c = c.cast("int").cast("long")
        elif isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)
        elif isinstance(kind, T.ArrayType):
            c = joined(c)
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.DateType):
            c = c.cast("string")
        out.append(c.alias(field.name))
    return df.select(*out)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _once(spark: SparkSession, folder: str, what: str, build: Callable[[], object]):
    """Laid-out tables are written once per session and input folder, then shared by all queries."""
    key = (spark.sparkContext.applicationId, folder, what)
    if key not in _BUILT:
        _BUILT[key] = build()
    return _BUILT[key]


def draws(spark: SparkSession, folder: str) -> StepTable:
    return _once(spark, folder, "draws", lambda: build_steps(draws_from_orders(spark, folder)))


def numbered_events(spark: SparkSession, folder: str) -> tuple[DataFrame, int]:
    """Events with their ordinal within the user's series, and the block size for them."""

    def build():
        rows = materialise(ordinal(user_events(spark, folder), ["ts", "event_id"]), "events")
        longest = (rows.agg(F.max("ord")).first()[0] or 0) + 1
        return rows, block_size(longest)

    return _once(spark, folder, "events", build)


def without_series(df: DataFrame) -> DataFrame:
    return df.drop(SERIES)
