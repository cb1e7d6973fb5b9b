"""Terms of an index in order: front-coded blocks with document counts for each part, merged across parts.

A block holds up to ``BLOCK`` terms of one part, each as the length of the prefix that it shares with the one before and the
rest of it. Blocks are sorted, with their first and last term as columns, so a page of terms after a key reads the blocks
that it lies in: other ones are left out by their last term before they are read.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from capturelake.scratch import ship

BLOCK = 256
STORED = "part string, first string, last string, n int, shared array<int>, rest string, sizes array<int>, counts array<long>"


def _shared(a: str, b: str) -> int:
    return len(os.path.commonprefix([a, b]))


def _packed(size: int):
    def run(batches):
        """Blocks of sorted (part, term, n); a block ends with its part, its size or its batch."""
        for b in batches:
            part, term, n = (b.column(c).to_pylist() for c in ("part", "term", "n"))
            at = 0
            out: dict[str, list] = {c.split(" ")[0]: [] for c in STORED.split(", ")}
            while at < len(term):
                end = at + 1
                while end < len(term) and end - at < size and part[end] == part[at]:
                    end += 1
                own = term[at:end]
                shared = [0, *(_shared(x, y) for x, y in zip(own, own[1:], strict=False))]
                rest = [t[s:] for t, s in zip(own, shared, strict=True)]
                row = (part[at], own[0], own[-1], len(own), shared, "".join(rest), [len(r) for r in rest], n[at:end])
                for column, value in zip(out.values(), row, strict=True):
                    column.append(value)
                at = end
            kinds = (pa.string(), pa.string(), pa.string(), pa.int32(), pa.list_(pa.int32()), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out))

    return run


def _unpacked(batches):
    for b in batches:
        for r in b.to_pylist():
            terms, before, at = [], "", 0
            for shared, size in zip(r["shared"], r["sizes"], strict=True):
                before = before[:shared] + r["rest"][at : at + size]
                at += size
                terms.append(before)
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(np.array(r["counts"], np.int64))], ["term", "n"])


class Dictionary:
    """A written dictionary."""

    def __init__(self, spark: SparkSession, folder: str):
        ship(spark)
        self.spark, self.folder = spark, folder
        self.blocks = spark.read.schema(STORED).parquet(folder)
        #: blocks that the last page() read
        self.read = 0

    @classmethod
    def write(cls, docs: DataFrame, terms: Column, folder: str, part: Column | None = None, block: int = BLOCK) -> Dictionary:
        """Writes the distinct terms (an array a row) of docs, with the number of rows that have each, for each part."""
        ship(docs.sparkSession)
        rows = docs.select((F.lit("") if part is None else part).alias("part"), F.explode(F.array_distinct(terms)).alias("term"))
        counted = rows.where("term is not null").groupBy("part", "term").agg(F.count("*").alias("n"))
        order = ["part", "term"]
        counted.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_packed(block), STORED).write.mode("append").parquet(folder)
        return cls(docs.sparkSession, folder)

    def terms(self) -> DataFrame:
        """(term, n) of all terms, in order; the parts' counts are added."""
        return self.blocks.mapInArrow(_unpacked, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).orderBy("term")

    def page(self, after: str | None, rows: int) -> DataFrame:
        """The next rows terms after a key, over all parts."""
        later = self.blocks if after is None else self.blocks.where(F.col("last") > F.lit(after))
        heads = later.select("part", "first", "last", "n")
        before = F.sum("n").over(Window.partitionBy("part").orderBy("first").rowsBetween(Window.unboundedPreceding, -1))
        # of a part's first block an unknown number of terms lies before the key
        place = F.row_number().over(Window.partitionBy("part").orderBy("first"))
        wanted = heads.withColumns({"before": F.coalesce(before, F.lit(0)), "place": place, "n1": F.first("n").over(Window.partitionBy("part").orderBy("first"))})
        inside = F.col("first") <= F.lit(after) if after is not None else F.lit(False)
        skipped = F.max(F.when((F.col("place") == 1) & inside, F.col("n1")).otherwise(0)).over(Window.partitionBy("part"))
        wanted = wanted.withColumn("skipped", skipped).where((F.col("place") == 1) | (F.col("before") - F.col("skipped") < rows))
        # a row for each block that is read
        found = wanted.select("part", "first", "last", "place", "n").collect()
        first = self._read([r for r in found if r["place"] == 1 or after is None], after)
        if after is not None and len(found) > len({r["part"] for r in found}):
            # the first blocks may do: what they have after the key is counted first
            got = first.limit(rows).collect()
            last = got[-1]["term"] if len(got) == rows else None
            more = [r for r in found if r["place"] > 1 and (last is None or r["first"] <= last)]
            if more:
                first = self._read([*[r for r in found if r["place"] == 1], *more], after)
        return first.limit(rows)

    def _read(self, heads: list, after: str | None) -> DataFrame:
        self.read = len(heads)
        keep = F.lit(False)
        for r in heads:
            keep = keep | (F.col("part") == r["part"]) & (F.col("first") == r["first"])
        found = self.blocks.where(keep).mapInArrow(_unpacked, "term string, n long")
        found = found if after is None else found.where(F.col("term") > F.lit(after))
        return found.groupBy("term").agg(F.sum("n").alias("n")).orderBy("term")
