"""Inputs, written intermediate tables and small column helpers of the llm operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setstride.session import shared_folder

#: Fixed value: what separates words in every operator (space and the control characters 09 to 0D).
BLANKS = " \t\n\x0b\x0c\r"
_BLANK_CLASS = r"[\x20\x09-\x0D]+"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def folder_for(spark: SparkSession, label: str) -> str:
    """A new place in the folder that all executors share."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: `df` written to the shared folder and read back.

    The shuffle files of the write go as soon as it has ended, so that the steps of a long operator don't
    add up on disk; a lost executor only repeats the running step.
    """
    spark = df.sparkSession
    path = folder_for(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    back = spark.read.schema(T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])).parquet(path)
    back._stored_at = path
    return back


def discard(df: DataFrame) -> None:
    """Delete the files of a `stored` table that no later step reads; what was made from it must be written already."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def words_of(text: Column) -> Column:
    """Words between blanks; empty for null or blank text."""
    parts = F.split(F.coalesce(text, F.lit("")), _BLANK_CLASS)
    return F.filter(parts, lambda w: w != "")


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
