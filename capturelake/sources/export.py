"""Captures as WARC files, one gzip member a record."""

from __future__ import annotations

import gzip
import uuid

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def record(url: str, date: str, message: bytes, digest: str | None = None) -> bytes:
    """A response record of a WARC file."""
    mark = f"WARC-Payload-Digest: sha1:{digest}\r\n" if digest else ""
    head = (
        f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{date} {url}')}>\r\nWARC-Target-URI: {url}\r\n"
        f"WARC-Date: {date}\r\n{mark}Content-Type: application/http; msgtype=response\r\nContent-Length: {len(message)}\r\n\r\n"
    )
    return gzip.compress(head.encode() + message + b"\r\n\r\n", mtime=0)


def write_warcs(captures: DataFrame, folder: str, sizes: bool = False) -> DataFrame:
    """Writes (filename, url, date, status, content_type, payload, rec_seq) as ``<folder>/<filename>``; gives (filename, n_records), with sizes n_bytes too.

    folder is a whole URI. Rows of a file meet in one task, sorted by rec_seq, and are streamed to it under a
    temporary name, so memory doesn't grow with a file and a task that runs again leaves the same one.
    """
    shown = F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date")
    rows = captures.select("filename", "rec_seq", "url", shown, "status", "content_type", F.col("payload").cast("binary").alias("payload"))

    def run(batches):
        name, out, draft, n = None, None, None, 0
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)

        def done():
            size = out.tell()
            out.close()
            target = f"{root}/{name}"
            # a task that runs again finds its file there, and not every store replaces it
            if fs.get_file_info(target).type != pafs.FileType.NotFound:
                fs.delete_file(target)
            fs.move(draft, target)
            return pd.DataFrame({"filename": [name], "n_records": [n]} | ({"n_bytes": [size]} if sizes else {}))

        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if r.filename != name:
                    if out is not None:
                        yield done()
                    name, draft, n = r.filename, f"{root}/.{uuid.uuid4().hex}", 0
                    out = fs.open_output_stream(draft, compression=None)
                head = f"HTTP/1.1 {r.status} -\r\nContent-Type: {r.content_type}\r\nContent-Length: {len(r.payload or b'')}\r\n\r\n"
                out.write(record(r.url, r.date, head.encode() + (r.payload or b"")))
                n += 1
        if out is not None:
            yield done()

    return rows.repartition("filename").sortWithinPartitions("filename", "rec_seq").mapInPandas(run, "filename string, n_records long" + ", n_bytes long" * sizes)
