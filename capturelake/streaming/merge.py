"""The merge of captures as a stream: state by id instead of a pass over all documents.

State of an id is the first document in the order of (ingest_seq, arcname, rec_seq), the first content that isn't empty, and a map
from archive to its first occurrence, which the state store keeps by key, so an id in a million archives is no large value. A batch
of the stream gives the documents that it changed and the occurrences that it added or moved, as rows of two tables; written by batch
number, so that a batch that runs again replaces itself. Whatever way the input is split into batches and wherever the query starts
again, ``merged`` gives the rows of ``operators.captures.merge`` over all of it. With ``idle`` an id that had no capture for so long
is forgotten, which bounds the state; a later capture of it begins a new document that replaces the old one only if it comes first.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from capturelake.operators import captures
from capturelake.scratch import ship

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ORDER = "ingest_seq long, arcname string, rec_seq long"
CHANGES = f"id string, kind string, {ORDER}, doc string, content string, date_us long, job string"


class _Merge(StatefulProcessor):
    def __init__(self, idle_ms: int | None):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", f"{ORDER}, doc string")
        self.content = handle.getValueState("content", f"{ORDER}, content string")
        self.seen = handle.getMapState("seen", "arcname string", "ingest_seq long, rec_seq long, date_us long, job string")
        self.timer = handle.getValueState("timer", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        first = self.first.get() if self.first.exists() else None
        content = self.content.get() if self.content.exists() else None
        was, moved = (first, content), {}
        for pdf in rows:
            for seq, arc, rec, doc, text, date, job in pdf[["ingest_seq", "arcname", "rec_seq", "doc", "content", "date_us", "job"]].itertuples(index=False, name=None):
                at = (int(seq), arc, int(rec))
                if first is None or at < tuple(first[:3]):
                    first = (*at, doc)
                if text and (content is None or at < tuple(content[:3])):
                    content = (*at, text)
                old = moved.get(arc)
                if old is None and self.seen.containsKey((arc,)):
                    old = self.seen.getValue((arc,))
                if old is None or (at[0], at[2]) < (old[0], old[1]):
                    moved[arc] = (at[0], at[2], None if pd.isna(date) else int(date), None if pd.isna(job) else job)
        out = []
        if (first, content) != was:
            self.first.update(tuple(first))
            if content is not None:
                self.content.update(tuple(content))
            out.append((key[0], "doc", *first[:3], first[3], content[3] if content is not None else None, None, None))
        for arc, (seq, rec, date, job) in moved.items():
            self.seen.updateValue((arc,), (seq, rec, date, job))
            out.append((key[0], "occurrence", seq, arc, rec, None, None, date, job))
        if self.idle_ms is not None:
            if self.timer.exists():
                self.handle.deleteTimer(self.timer.get()[0])
            at = timerValues.getCurrentProcessingTimeInMs() + self.idle_ms
            self.handle.registerTimer(at)
            self.timer.update((at,))
        if out:
            yield pd.DataFrame(out, columns=[c.split(" ")[0] for c in CHANGES.split(", ")]).astype({"date_us": "Int64"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        for state in (self.first, self.content, self.seen, self.timer):
            state.clear()
        return iter(())

    def close(self) -> None:
        pass


def _single(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c not in (*captures.MERGED, "id", "content", "rec_seq", "ingest_seq")]


def watch(docs: DataFrame, folder: str, checkpoint: str, idle_ms: int | None = None) -> StreamingQuery:
    """Merges a stream of documents (as of captures.project, with rec_seq and ingest_seq) into tables under a folder."""
    spark = docs.sparkSession
    ship(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    rows = docs.select("id", "ingest_seq", "arcname", "rec_seq", F.to_json(F.struct(*_single(docs))).alias("doc"), "content", F.unix_micros("date").alias("date_us"), "job")
    changes = rows.groupBy("id").transformWithStateInPandas(_Merge(idle_ms), CHANGES, "Update", "None" if idle_ms is None else "ProcessingTime")

    def batch(found: DataFrame, number: int) -> None:
        found.write.mode("overwrite").partitionBy("kind").parquet(f"{folder}/batch={number}")

    return changes.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merged(spark: SparkSession, folder: str, like: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(docs, occurrences) of what a stream of documents like these has written so far."""
    rows = spark.read.schema(CHANGES.replace("kind string, ", "") + ", batch long, kind string").parquet(folder).withColumn("age", -F.col("batch"))
    single = _single(like)
    kind = like.select(*single).schema.simpleString()
    docs = captures.first_by(rows.where("kind = 'doc'").select("id", "doc", "content", "age"), ["id"], ["age"])
    docs = docs.select("id", F.from_json("doc", kind).alias("x"), "content").select("id", *[F.col(f"x.{c}").alias(c) for c in single], "content")
    occurrences = captures.first_by(rows.where("kind = 'occurrence'").select("id", "arcname", "date_us", "job", "ingest_seq", "age"), ["id", "arcname"], ["age"])
    return docs, occurrences.select("id", "arcname", F.timestamp_micros("date_us").alias("date"), "job", "ingest_seq")
