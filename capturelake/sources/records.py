"""Parsed records as JSON files: one compressed array for each archive, and JSON lines."""

from __future__ import annotations

import bz2
import gzip
import json
import uuid
import zlib

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capturelake.schema import JSON_RECORD
from capturelake.scratch import qualified


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """Parsed records of JSON arrays (gzip by suffix); a missing key is null, dates are epoch milliseconds."""
    rows = spark.read.schema(JSON_RECORD).option("multiLine", True).json(path)
    return rows.withColumn("date", F.timestamp_millis("date"))


def as_json(record_columns=None):
    """A record as a JSON object without its null fields."""
    names = record_columns or ["filename", "digest", "url", "date", "title", "length", "content", "suppliedContentType", "detectedContentType", "isRevisit", "outlinks"]
    return F.to_json(F.struct(*[F.unix_millis("date").alias("date") if n == "date" else F.col(n) for n in names]))


def write_json_arrays(records: DataFrame, folder: str, empty: list[str] = (), suffix: str = ".json.gz") -> DataFrame:
    """Writes ``<folder>/<filename><suffix>`` for each archive, and ``[]`` for archives without records.

    The suffix tells the compression: ``.gz``, ``.bz2`` or none.

    Rows of an archive meet in one task and are streamed to its file, so memory doesn't grow with it. Files lie in a
    staging folder until all tasks have ended well and are moved then; a job that fails leaves none.
    Gives (filename, n_records).
    """
    lines = records.select("filename", as_json().alias("line")).repartition("filename").sortWithinPartitions("filename")

    folder = qualified(records.sparkSession, folder)
    staging = f"_staging-{uuid.uuid4().hex}"

    def opened(draft: str):
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(f"{root}/{staging}", recursive=True)
        raw = fs.open_output_stream(f"{root}/{staging}/{draft}", compression=None)
        if suffix.endswith(".gz"):
            return _Out(raw, gzip.GzipFile(fileobj=raw, mode="wb", mtime=0))
        return _Out(raw, bz2.BZ2File(raw, "wb") if suffix.endswith(".bz2") else raw)

    def run(batches):
        name, out, n, draft = None, None, 0, ""
        for pdf in batches:
            for filename, line in zip(pdf["filename"], pdf["line"], strict=True):
                if filename != name:
                    if out is not None:
                        out.write(b"]")
                        out.close()
                        yield _row(name, n, draft)
                    # another attempt has names of its own
                    draft = uuid.uuid4().hex
                    name, out, n = filename, opened(draft), 0
                out.write((b"," if n else b"[") + line.encode())
                n += 1
        if out is not None:
            out.write(b"]")
            out.close()
            yield _row(name, n, draft)

    fs, root = pafs.FileSystem.from_uri(folder)
    try:
        # a row for each archive
        written = [tuple(r) for r in lines.mapInPandas(run, "filename string, n_records long, draft string").collect()]
        for name in sorted(set(empty) - {w[0] for w in written}):
            f = opened(draft := uuid.uuid4().hex)
            f.write(json.dumps([]).encode())
            f.close()
            written.append((name, 0, draft))
        for name, _, draft in written:
            target = f"{root}/{name}{suffix}"
            if fs.get_file_info(target).type != pafs.FileType.NotFound:
                fs.delete_file(target)
            fs.move(f"{root}/{staging}/{draft}", target)
    finally:
        if fs.get_file_info(f"{root}/{staging}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/{staging}")
    return records.sparkSession.createDataFrame([w[:2] for w in written], "filename string, n_records long")


class _Out:
    """A stream and the compressor over it, closed together."""

    def __init__(self, raw, over):
        self.raw, self.over, self.write = raw, over, over.write

    def close(self) -> None:
        self.over.close()
        if self.raw is not self.over:
            self.raw.close()


def decompress(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``x.json.gz`` of a folder as ``x.json``, a task each; gives (name, status).

    Where ``x.json`` is there already the file is ``skipped``; one that is no gzip is renamed to ``x.json.gz.bad``.
    A result is written under another name first, and only then the source goes.
    """
    folder = qualified(spark, folder)
    fs, root = pafs.FileSystem.from_uri(folder)
    names = sorted(i.base_name for i in fs.get_file_info(pafs.FileSelector(root)) if i.base_name.endswith(".json.gz"))

    def run(batches):
        fs, root = pafs.FileSystem.from_uri(folder)
        for pdf in batches:
            for name in pdf["name"]:
                source, target, draft = f"{root}/{name}", f"{root}/{name[:-3]}", f"{root}/.{uuid.uuid4().hex}"
                if fs.get_file_info(target).type != pafs.FileType.NotFound:
                    yield _status(name, "skipped")
                    continue
                try:
                    with fs.open_input_stream(source, compression=None) as raw, gzip.GzipFile(fileobj=raw) as f, fs.open_output_stream(draft, compression=None) as out:
                        while block := f.read(1 << 20):
                            out.write(block)
                except (EOFError, gzip.BadGzipFile, zlib.error):
                    fs.delete_file(draft)
                    fs.move(source, f"{source}.bad")
                    yield _status(name, "bad")
                    continue
                fs.move(draft, target)
                fs.delete_file(source)
                yield _status(name, "done")

    listed = spark.createDataFrame([(n,) for n in names], "name string").repartition(max(1, len(names)))
    return spark.createDataFrame(listed.mapInPandas(run, "name string, status string").collect(), "name string, status string")


def _status(name: str, status: str):
    import pandas as pd

    return pd.DataFrame({"name": [name], "status": [status]})


def _row(name: str, n: int, draft: str):
    import pandas as pd

    return pd.DataFrame({"filename": [name], "n_records": [n], "draft": [draft]})
