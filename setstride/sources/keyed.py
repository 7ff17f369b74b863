"""A keyed table on files: hash buckets, and a manifest per version that names each bucket's files.

An upsert reads and rewrites only the buckets that its keys fall into; the other buckets' files are carried over by
name. Version n is written from version n - 1, so a batch that is run again gives the same version, and readers of an older version
are not disturbed. Everything is read and written by Spark, so any store that Spark reaches will do.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from setstride.sources.store import upsert

_BUCKET = "_bucket"


@dataclass(frozen=True)
class KeyedTable:
    """Rows of `schema`, unique by `keys`, under `path` in `buckets` hash buckets."""

    spark: SparkSession
    path: str
    schema: StructType
    keys: tuple[str, ...]
    buckets: int = 64

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def version(self) -> int:
        """Number of the latest version, -1 without any."""
        try:
            names = self.spark.read.schema("bucket int, part string").parquet(f"{self.path}/manifest-*")
        except AnalysisException:  # nothing has been written yet
            return -1
        number = F.regexp_extract(F.col("_metadata.file_path"), r"manifest-(\d+)", 1).cast("long")
        found = names.select(F.max(number)).first()[0]
        return -1 if found is None else found

    def manifest(self, version: int | None = None) -> dict[int, str]:
        """Folder of every bucket that holds rows (one entry per bucket at most)."""
        version = self.version() if version is None else version
        if version < 0:
            return {}
        rows = self.spark.read.schema("bucket int, part string").parquet(f"{self.path}/manifest-{version:012d}")
        return {r["bucket"]: r["part"] for r in rows.where("bucket is not null").collect()}

    def read(self, version: int | None = None, only: set[int] | None = None) -> DataFrame:
        """The rows of a version (by default the latest), or of some of its buckets."""
        parts = [f"{self.path}/{p}" for b, p in sorted(self.manifest(version).items()) if only is None or b in only]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*parts)

    def lookup(self, wanted: DataFrame) -> DataFrame:
        """Rows of the wanted keys; reads only their buckets."""
        keys = wanted.select(*self.keys).distinct()
        return self.read(only=self._touched(keys)).join(keys, list(self.keys), "left_semi")

    def _touched(self, rows: DataFrame) -> set[int]:
        return {r[_BUCKET] for r in rows.select(self._bucket().alias(_BUCKET)).distinct().collect()}  # at most `buckets` numbers

    def upsert(self, batch: DataFrame, order: list[str] | None = None, version: int | None = None) -> int:
        """Whole-row replace by key; columns the batch lacks become null, of a key it repeats the row with the largest `order` wins.

        `version` is the number to write (by default the next); writing a number again replaces it. Returns the number.
        """
        number = self.version() + 1 if version is None else version
        held = self.manifest(number - 1)
        touched = self._touched(batch)
        merged = upsert(self.read(number - 1, touched), [batch], list(self.keys), order)
        data = f"data-{number:012d}"
        dealt = merged.withColumn(_BUCKET, self._bucket()).repartition(max(len(touched), 1), _BUCKET)
        dealt.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.path}/{data}")
        now = held | {b: f"{data}/{_BUCKET}={b}" for b in touched}
        rows = self.spark.createDataFrame(sorted(now.items()), "bucket int, part string")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest-{number:012d}")
        return number
