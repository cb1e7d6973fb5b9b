"""Charsets of texts: a byte order mark, what header and markup declare, UTF-8, then the likeliest by pairs of bytes.

A declared charset holds if the bytes can be read in it. Where nothing tells, a model of pairs of bytes decides by maximum
likelihood among the charsets that it was trained for and that can read the bytes; without a model windows-1252 is taken, and
ISO-8859-1 where that has no character. Training encodes known texts in each charset and counts pairs, 131,072 numbers a
charset whatever the size of the corpus.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capturelake.scratch import ship

# fixed values: marks, and names that browsers read as others
MARKS = ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF32_LE, "utf-32-le"), (codecs.BOM_UTF32_BE, "utf-32-be"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"))
READ_AS = {"iso-8859-1": "windows-1252", "latin1": "windows-1252", "latin-1": "windows-1252", "us-ascii": "windows-1252", "ascii": "windows-1252", "macintosh": "mac-roman", "x-mac-roman": "mac-roman", "x-sjis": "shift_jis", "gb2312": "gb18030", "gbk": "gb18030", "ks_c_5601-1987": "euc-kr", "windows-31j": "cp932", "unicode": "utf-16-le"}
#: trained unless told otherwise
CHARSETS = ("windows-1252", "windows-1250", "windows-1251", "windows-1253", "koi8-r", "ibm850", "ibm866", "mac-roman", "shift_jis", "euc-jp", "euc-kr", "big5", "gb18030", "utf-16-le", "utf-16-be")
META = re.compile(rb"<meta[^>]{0,300}?charset\s*=\s*[\"']?\s*([A-Za-z0-9_.:-]+)|<\?xml[^>]{0,200}?encoding\s*=\s*[\"']([A-Za-z0-9_.:-]+)", re.I)
HEAD = 4096
SMOOTH = 0.01
PAIRS = 1 << 16


def codec(name: str | None) -> str | None:
    """The codec of a charset's name, None if there is none for texts."""
    name = (name or "").strip().strip("\"'").lower()
    try:
        found = codecs.lookup(READ_AS.get(name, name))
    except (LookupError, ValueError):
        return None
    return found.name if found._is_text_encoding else None


def decoded(data: bytes, name: str) -> str | None:
    try:
        return data.decode(name)
    except (UnicodeDecodeError, ValueError):
        return None


def pairs(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of neighbouring bytes that tell of a charset, one of them beyond ASCII or zero, with their counts.

    Those with a zero tell the order of bytes by where they begin, so at odd places they are other pairs.
    """
    b = np.frombuffer(data, np.uint8).astype(np.int32)
    if len(b) < 2:
        b = np.concatenate([b, np.full(2, 0x20, np.int32)])
    own, zero = (b[:-1] << 8) | b[1:], b == 0
    own[1::2] += (zero[:-1] | zero[1:])[1::2] * PAIRS
    odd = (b >= 0x80) | zero
    return np.unique(own[odd[:-1] | odd[1:]], return_counts=True)


class Model:
    """Log-probabilities of pairs of bytes by charset; picklable."""

    def __init__(self, names: Sequence[str], counts: np.ndarray, totals: np.ndarray):
        """totals: all pairs of the texts in each charset, those of ASCII alone too, so that what a charset cannot write counts against it."""
        self.names = list(names)
        self.log = np.log((counts + SMOOTH) / (np.asarray(totals, float)[:, None] + SMOOTH * counts.shape[1])).astype(np.float32)

    def ranked(self, data: bytes) -> list[str]:
        """The charsets, the likeliest first."""
        key, _ = pairs(data)
        # each pair once: a line that a text repeats a hundred times tells no more than one
        score = self.log[:, key].sum(axis=1, dtype=float)
        # of equal ones the one that was named first
        return [self.names[i] for i in np.argsort(-score, kind="stable")]


def train(texts: DataFrame, column: str = "text", charsets: Sequence[str] = CHARSETS) -> Model:
    """Counts the pairs of all texts in each charset; a character that it cannot write is a question mark."""
    names = [c for c in charsets if codec(c)]
    ship(texts.sparkSession)

    def run(batches):
        # the last number of a charset is that of all pairs
        counts = np.zeros((len(names), 2 * PAIRS + 1), np.int64)
        for b in batches:
            for value in b.column(0):
                for i, c in enumerate(names if value.is_valid else ()):
                    data = value.as_py().encode(codec(c), "replace")
                    key, n = pairs(data)
                    counts[i][key] += n
                    counts[i][-1] += len(data)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts.ravel()[at])], ["at", "n"])

    out = np.zeros(len(names) * (2 * PAIRS + 1))
    # at most 131,073 numbers a charset
    for r in texts.select(F.col(column).cast("string")).mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r["n"]
    out = out.reshape(len(names), 2 * PAIRS + 1)
    return Model(names, out[:, :-1], out[:, -1])


def read(data: bytes, declared: str | None = None, model: Model | None = None) -> tuple[str, str]:
    """(charset, text) of bytes."""
    for mark, name in MARKS:
        if data.startswith(mark) and (text := decoded(data[len(mark) :], name)) is not None:
            return name, text
    found = META.search(data, 0, HEAD)
    for name in (declared, *((g.decode() for g in found.groups() if g) if found else ())):
        name = codec(name)
        if name and (text := decoded(data, name)) is not None and (name != "utf-8" or b"\0" not in data):
            return name, text
    if b"\0" not in data and (text := decoded(data, "utf-8")) is not None:
        return "utf-8", text
    for name in model.ranked(data) if model else ():
        if (text := decoded(data, codec(name))) is not None:
            return codec(name), text
    text = decoded(data, "windows-1252")
    return ("windows-1252", text) if text is not None else ("iso-8859-1", data.decode("iso-8859-1"))


def reader(model: Model | None = None):
    """A function of (bytes, declared charset) columns that gives struct<charset, text>."""

    @F.pandas_udf("charset string, text string")
    def run(data: pd.Series, declared: pd.Series) -> pd.DataFrame:
        rows = [(None, None) if d is None else read(bytes(d), c, model) for d, c in zip(data, declared, strict=True)]
        return pd.DataFrame(rows, columns=["charset", "text"])

    return run


def written(text: Column, charset: str, mark: bytes = b"") -> Column:
    """Text as bytes of a charset, after a mark; null where it has none for a character."""
    name = codec(charset)

    @F.pandas_udf("binary")
    def run(texts: pd.Series) -> pd.Series:
        def one(t):
            try:
                return None if t is None else mark + t.encode(name)
            except UnicodeEncodeError:
                return None

        return texts.map(one)

    return run(text)
