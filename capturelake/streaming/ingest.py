"""Incremental ingest as a Structured Streaming query: an extension, with the same results as the batch calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from capturelake.api import Archive
from capturelake.sources.webarchive import name_of


def watch(spark: SparkSession, archive: Archive, lists: str, checkpoint: str, extra_id: str = "") -> StreamingQuery:
    """Parses and indexes the archives named in list files as those arrive in a folder.

    A batch that runs again does nothing twice: parsed archives are skipped and indexed ones add nothing. Archives
    that can't be read are in the log and not indexed, so they don't hold up the others.
    """

    def batch(names: DataFrame, _: int) -> None:
        paths = sorted({r["value"].strip() for r in names.collect() if r["value"].strip()})
        if paths:
            archive.parse(paths)
            archive.index([n for n in map(name_of, paths) if archive.is_readable(n)], extra_id)

    return spark.readStream.text(lists).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def distinct_captures(stream: DataFrame, time_col: str = "date", late: str = "1 day") -> DataFrame:
    """A stream of documents with the repeats of (id, arcname) within the watermark left out."""
    return stream.withWatermark(time_col, late).dropDuplicatesWithinWatermark(["id", "arcname"])
