"""URL functions as column expressions: canonical form, host, fingerprint and its encodings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonicalize(url: Column, strip_sessions: bool = False) -> Column:
    """Trimmed, without fragment, lower case, without a www prefix or default port, with a path, query parts sorted.

    A value that is no http(s) URL comes back as it is. With strip_sessions, session ids go too.
    """
    u = F.lower(F.regexp_replace(F.trim(url), "#.*$", ""))
    u = F.regexp_replace(u, r"^(https?://)www\d*\.", "$1")
    u = F.regexp_replace(u, r"^(http://[^/?]*):80(?=[/?]|$)", "$1")
    u = F.regexp_replace(u, r"^(https://[^/?]*):443(?=[/?]|$)", "$1")
    if strip_sessions:
        u = F.regexp_replace(u, r";jsessionid=[0-9a-z.!-]+", "")
        u = F.regexp_replace(u, r"([?&])(?:phpsessid|sid|sessionid|aspsessionid[a-z]*)=[0-9a-z]+(?=&|$)&?", "$1")
        u = F.regexp_replace(u, r"[?&]$", "")
    base = F.regexp_replace(F.regexp_extract(u, r"^([^?]*)", 1), r"^(https?://[^/]+)$", "$1/")
    query = F.regexp_extract(u, r"^[^?]*\?(.*)$", 1)
    joined = F.when(query == "", base).otherwise(F.concat(base, F.lit("?"), F.array_join(F.array_sort(F.split(query, "&")), "&")))
    return F.when(u.rlike("^https?://[^/?]"), joined).otherwise(url)


def host(canonical: Column) -> Column:
    """The host of a canonical URL, null if there is none."""
    return F.nullif(F.regexp_extract(canonical, r"^[a-z][a-z0-9+.-]*://(?:[^/?@]*@)?([^/?:]+)", 1), F.lit(""))


def fingerprint(canonical: Column) -> Column:
    """A non-negative 60-bit number of a URL."""
    return F.conv(F.substring(F.md5(canonical), 1, 15), 16, 10).cast("bigint")


def hex16(x: Column) -> Column:
    return F.lower(F.lpad(F.hex(x.cast("bigint")), 16, "0"))


def long_to_bytes(x: Column) -> Column:
    """Eight bytes, the highest first."""
    return F.unhex(hex16(x))


def bytes_to_long(b: Column) -> Column:
    h = F.hex(b)
    return F.shiftleft(F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint"), 32).bitwiseOR(F.conv(F.substring(h, 9, 8), 16, 10).cast("bigint"))


def int_to_bytes(x: Column) -> Column:
    """Four bytes, the highest first."""
    return F.unhex(F.lpad(F.hex(x.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))


def bytes_to_int(b: Column) -> Column:
    x = F.conv(F.hex(b), 16, 10).cast("bigint")
    return F.when(x >= 1 << 31, x - (1 << 32)).otherwise(x).cast("int")


def fp_to_string(fp: Column) -> Column:
    return F.base64(long_to_bytes(fp))


def string_to_fp(s: Column) -> Column:
    return bytes_to_long(F.unbase64(s))


def encode_date(ts: Column) -> Column:
    """Seconds of the epoch as four bytes."""
    return int_to_bytes(F.unix_seconds(ts))


def decode_date(b: Column) -> Column:
    return F.timestamp_seconds(bytes_to_int(b))


def encode_fp_date(fp: Column, ts: Column) -> Column:
    """Fingerprint and date as Base64 of twelve bytes."""
    return F.base64(F.concat(long_to_bytes(fp), encode_date(ts)))


def decode_fp_date(s: Column) -> Column:
    """struct<fp, date>."""
    b = F.unbase64(s)
    return F.struct(bytes_to_long(F.substring(b, 1, 8)).alias("fp"), decode_date(F.substring(b, 9, 4)).alias("date"))


def base32(hex_digits: Column) -> Column:
    """Base32 of 40 hexadecimal digits, such as a SHA-1: each five digits are four letters."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")

    def four(i: Column) -> Column:
        n = F.conv(F.substr(hex_digits, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(*[F.substr(letters, F.shiftright(n, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)])

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), four), "")


def payload_digest(payload: Column) -> Column:
    return base32(F.sha1(payload))


def extract_arcname(path: Column) -> Column:
    """The archive's file name in a path, null if there is none. An underscore ends the name."""
    # the pattern is a fixed value of the interface
    return F.nullif(F.regexp_extract(path, r"^.*?([A-Za-z0-9\.-]+arc\.gz)(?:\.open|\.gz)?$", 1), F.lit(""))


def strip_json_suffix(name: Column) -> Column:
    return F.regexp_replace(name, r"\.json(\.gz)?$", "")
