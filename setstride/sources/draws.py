"""Raw steps derived from the analytic tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from setstride.operators.layout import SERIES


def draws_from_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Five distinct numbers of 1..47 and a special of 1..27 per order (a progression modulo the prime 47)."""
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"
    )
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    start, stride = F.col("o_custkey") % 47, F.lit(1) + F.col("_cents") % 46
    return orders.withColumn("_cents", cents).select(
        F.lit(0).alias(SERIES),
        F.col("o_orderkey").alias("step_id"),
        F.col("o_orderdate").cast("date").alias("ts"),
        F.array_sort(
            F.array(*[(F.lit(1) + (start + j * stride) % 47).cast("int") for j in range(5)])
        ).alias("items"),
        (F.lit(1) + F.expr("_cents div 46") % 27).cast("int").alias("special"),
        F.col("o_totalprice").alias("amount"),
    )


def user_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as one series per user."""
    return spark.read.parquet(f"{folder}/events.parquet").select(
        F.col("user_id").alias(SERIES), "event_id", F.col("ts"), F.col("event_type").alias("item"), "value"
    )


def draws_columns(steps: DataFrame) -> DataFrame:
    """The flat draws table: number, date, n1..n5, special, amount."""
    return steps.select(
        F.col("step_id").alias("draw_number"),
        F.col("ts").alias("draw_date"),
        *[F.get("items", F.lit(j)).alias(f"n{j + 1}") for j in range(5)],
        F.col("special").alias("mega_number"),
        F.col("amount").alias("jackpot_amount"),
    )
