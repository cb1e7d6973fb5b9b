"""Small ARC and WARC files for tests, one gzip member a record."""

from __future__ import annotations

import gzip


def http(status: int, kind: str, body: bytes, more: str = "") -> bytes:
    return f"HTTP/1.1 {status} X\r\nContent-Type: {kind}\r\n{more}\r\n".encode() + body


def warc(records: list[tuple[str, str, bytes]], digest: dict[str, str] | None = None, kind: str = "response") -> bytes:
    """records: url, 14-digit date, HTTP message (an empty one makes a metadata record)."""
    out = b""
    for url, date, message in records:
        d = f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:]}Z"
        type_, mime = (kind, "application/http; msgtype=response") if message else ("metadata", "text/plain")
        body = message or b"note"
        mark = f"WARC-Payload-Digest: sha1:{digest[url]}\r\n" if digest and url in digest else ""
        head = f"WARC/1.0\r\nWARC-Type: {type_}\r\nWARC-Target-URI: {url}\r\nWARC-Date: {d}\r\n{mark}Content-Type: {mime}\r\nContent-Length: {len(body)}\r\n\r\n"
        out += gzip.compress(head.encode() + body + b"\r\n\r\n")
    return out


def arc(records: list[tuple[str, str, bytes]]) -> bytes:
    out = gzip.compress(b"filedesc://x.arc 0.0.0.0 20080101000000 text/plain 4\n1 0\n\n")
    for url, date, message in records:
        body = message or b"note"
        out += gzip.compress(f"{url} 1.2.3.4 {date} text/html {len(body)}\n".encode() + body + b"\n")
    return out
