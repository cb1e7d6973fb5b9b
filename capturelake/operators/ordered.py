"""Tables in the order of canonical URLs: dealt to buckets by URL and sorted in them, so that joins by URL need no shuffle.

Spark keeps a table's buckets in its catalogue. Two tables with as many buckets of the same key meet bucket by bucket: each task
reads one sorted file of both. The URLs' least and largest values in the files let a range of URLs, as a page of keys, leave out
what it doesn't touch.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capturelake.scratch import Scratch

BUCKETS = 32


class Ordered:
    """A stored table; drop() forgets it, its files are those of the folder."""

    def __init__(self, spark: SparkSession, name: str, key: str, buckets: int):
        self.spark, self.name, self.key, self.buckets = spark, name, key, buckets

    @classmethod
    def write(cls, df: DataFrame, key: str, folder: str | None = None, buckets: int = BUCKETS) -> Ordered:
        """Stores df by key; without a folder in the shared work folder."""
        spark = df.sparkSession
        name = f"ordered_{uuid.uuid4().hex}"
        folder = folder or Scratch(spark, "ordered").path(name)
        # dealt as the buckets are, so each has one file
        dealt = df.repartition(buckets, key)
        dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", folder).saveAsTable(name)
        return cls(spark, name, key, buckets)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def between(self, first: str | None, last: str | None) -> DataFrame:
        """Rows with first <= key < last, in order."""
        out = self.table()
        out = out if first is None else out.where(F.col(self.key) >= F.lit(first))
        return (out if last is None else out.where(F.col(self.key) < F.lit(last))).orderBy(self.key)

    def page(self, after: str | None, rows: int) -> DataFrame:
        """The rows rows after a key; of each bucket at most as many are kept before they meet."""
        out = self.table() if after is None else self.table().where(F.col(self.key) > F.lit(after))
        return out.orderBy(self.key).limit(rows)

    def join(self, other: Ordered, how: str = "inner") -> DataFrame:
        """Merges two tables of one key and as many buckets, without a shuffle."""
        if (self.key, self.buckets) != (other.key, other.buckets):
            raise ValueError("tables of other keys or buckets don't meet")
        return self.table().hint("merge").join(other.table(), self.key, how)

    def drop(self) -> None:
        self.spark.sql(f"drop table if exists {self.name}")
