"""Text, title and links of PDF files and of zipped office files, as one pandas UDF over Arrow batches.

PDF: content streams that are plain or Flate-compressed, with strings in a Latin encoding; fonts with codes of their own
are left out. Office: the XML of word processing, presentation and spreadsheet files (OOXML and OpenDocument).
"""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
import zlib

import pandas as pd
from pyspark.sql import functions as F

from capturelake.operators.html import EXTRACTED

_STREAM = re.compile(rb"<<((?:[^<>]|<<.*?>>|<[0-9A-Fa-f\s]*>)*)>>\s*stream\r?\n", re.S)
# a string, an array of strings, or an operator that shows text or moves to another line
_TOKEN = re.compile(rb"\((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|T[jJdDm*]\b|['\"](?=\s)|\bET\b|-?\d*\.?\d+", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
#: paths of text in zipped office files; fixed values
OFFICE = r"^(word/document\.xml|ppt/slides/slide\d+\.xml|xl/sharedStrings\.xml|xl/worksheets/sheet\d+\.xml|content\.xml)$"
#: a file's unpacked XML or stream beyond this is left out, so that small files can't fill a task's memory
MOST_BYTES = 50_000_000


def _literal(raw: bytes) -> bytes:
    """The bytes of a PDF string, either form."""
    if raw.startswith(b"<"):
        digits = re.sub(rb"\s", b"", raw[1:-1])
        return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())

    def one(m: re.Match) -> bytes:
        x = m[1]
        if x[:1].isdigit():
            return bytes([int(x, 8) & 255])
        return b"" if x in (b"\n", b"\r\n") else _ESCAPES.get(x, x)

    return re.sub(rb"\\([0-7]{1,3}|\r\n|.)", one, raw[1:-1], flags=re.S)


def _decoded(raw: bytes) -> str:
    return raw[2:].decode("utf-16-be", "replace") if raw.startswith(b"\xfe\xff") else raw.decode("cp1252", "replace")


def _shown(stream: bytes) -> str:
    """The text that a content stream shows."""
    out, held, spread = [], [], False
    for m in _TOKEN.finditer(stream):
        token = m[0]
        if token[:1] in b"(<":
            held.append(_decoded(_literal(token)))
        elif token in b"[]":
            spread = token == b"["
        elif token in (b"Tj", b"TJ", b"'", b'"'):
            out.append((" " if token in b"'\"" else "") + "".join(held))
            held = []
        elif token[:1] == b"T" or token == b"ET":
            out.append(" ")
            held = []
        elif spread and held and float(token) < -200:
            held.append(" ")
    return "".join(out)


def pdf(data: bytes) -> tuple:
    """(title, text, links, error) of a PDF file."""
    streams, text, error = [], [], None
    for m in _STREAM.finditer(data):
        end = data.find(b"endstream", m.end())
        raw = data[m.end() : end if end >= 0 else None]
        if b"FlateDecode" in m[1]:
            try:
                raw = zlib.decompressobj().decompress(raw, MOST_BYTES)
            except zlib.error as e:
                error = f"{type(e).__name__}: {e}"[:200]
                continue
        elif b"/Filter" in m[1]:
            continue
        streams.append(raw)
        if b"/Subtype/Image" not in m[1].replace(b" ", b"") and re.search(rb"\bBT\b", raw):
            text.append(_shown(raw))
    if b"/Encrypt" in data:
        return None, None, [], "the file is encrypted"
    # objects may be in streams themselves
    every = data + b"\n".join(streams)
    title = re.search(rb"/Title\s*(\((?:[^()\\]|\\.)*\)|<[0-9A-Fa-f\s]*>)", every, re.S)
    links = [_decoded(_literal(x)) for x in re.findall(rb"/URI\s*(\((?:[^()\\]|\\.)*\))", every, re.S)]
    return title and _decoded(_literal(title[1])), re.sub(r"[ \t\n\x0b\f\r\x00]+", " ", " ".join(text)).strip(), [(x, "") for x in dict.fromkeys(links)], error


def office(data: bytes) -> tuple:
    """(title, text, links, error) of a zipped office file; no text if the zip holds none."""
    parts, title, links = [], None, []
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for info in z.infolist():
            if info.file_size > MOST_BYTES:
                continue
            if re.match(OFFICE, info.filename):
                root = ET.fromstring(z.read(info))
                # a paragraph, cell or line ends a word
                parts.append(" ".join("".join(p.itertext()) for p in root.iter() if p.tag.rpartition("}")[2] in ("p", "si", "h", "v")))
            elif info.filename in ("docProps/core.xml", "meta.xml"):
                found = next((e.text for e in ET.fromstring(z.read(info)).iter() if e.tag.endswith("}title")), None)
                title = found or title
            elif info.filename.endswith(".rels"):
                links += [e.get("Target") for e in ET.fromstring(z.read(info)).iter() if e.get("TargetMode") == "External" and (e.get("Type") or "").endswith("/hyperlink")]
    text = re.sub(r"[ \t\n\x0b\f\r]+", " ", " ".join(parts)).strip() if parts else None
    return title, text, [(x, "") for x in dict.fromkeys(links) if x], None


def document(data: bytes | None) -> tuple:
    """(title, text, links, error) by the first bytes; nothing for other files."""
    try:
        if data is not None and data[:4] == b"%PDF":
            return pdf(data)
        if data is not None and data[:4] == b"PK\x03\x04":
            return office(data)
    except (ValueError, KeyError, RecursionError, zipfile.BadZipFile, zlib.error, ET.ParseError, NotImplementedError, RuntimeError) as e:
        return None, None, [], f"{type(e).__name__}: {e}"[:200]
    return None, None, [], None


@F.pandas_udf(EXTRACTED)
def extract(payload: pd.Series) -> pd.DataFrame:
    rows = [document(None if p is None else bytes(p)) for p in payload]
    return pd.DataFrame({"title": [r[0] for r in rows], "text": [r[1] for r in rows], "links": [[{"to": a, "text": t} for a, t in r[2]] for r in rows], "error": [r[3] for r in rows]})
