"""Media types as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values of the interface
TYPES = "application|audio|image|text|video"
DEFAULT_TOP, DEFAULT_SUB = "application", "octet-string"


def parse(line: Column, strict: bool = True) -> Column:
    """struct<top, sub, charset> of a Content-Type header, null without a media type.

    Only the first element of the header counts. strict keeps to lower case and to letters, digits,
    dots and hyphens; else case is folded and ``+`` and ``_`` are letters of a subtype too.
    """
    first = F.trim(F.regexp_extract(line, r'^((?:[^,"]|"[^"]*")*)', 1))
    name = F.trim(F.regexp_extract(first, r"^([^;]*)", 1))
    if not strict:
        name = F.lower(name)
    form = rf"^({TYPES})/([a-zA-Z0-9.\-{'' if strict else '+_'}]+)$"
    charset = F.regexp_extract(first, r'(?i);\s*charset\s*=\s*"?([^";\s]+)"?', 1)
    made = F.struct(F.regexp_extract(name, form, 1).alias("top"), F.regexp_extract(name, form, 2).alias("sub"), F.nullif(charset, F.lit("")).alias("charset"))
    return F.when(name.rlike(form), made)


def default() -> Column:
    return F.struct(F.lit(DEFAULT_TOP).alias("top"), F.lit(DEFAULT_SUB).alias("sub"), F.lit(None).cast("string").alias("charset"))


def force_parse(line: Column, strict: bool = True) -> Column:
    return F.coalesce(parse(line, strict), default())


def media_type(t: Column) -> Column:
    return F.concat(t["top"], F.lit("/"), t["sub"])


def shown(t: Column) -> Column:
    return F.concat(media_type(t), F.coalesce(F.concat(F.lit("; charset="), t["charset"]), F.lit("")))


def group(t: Column) -> Column:
    """html, image, video, audio, pdf, compressed, office or null."""
    top, sub = t["top"], t["sub"]
    return (
        F.when(top.isin("audio", "video", "image"), top)
        .when((top == "text") & (sub == "html"), "html")
        .when(top != "application", None)
        .when(sub == "pdf", "pdf")
        .when(sub.isin("zip", "x-gzip"), "compressed")
        .when(sub.startswith("ms") | sub.startswith("vnd.ms"), "office")
    )


def indexable(t: Column) -> Column:
    """Whether a type's text belongs in the index: not media, scripts, style sheets or zip files."""
    top, sub = t["top"], t["sub"]
    out = top.isin("audio", "video", "image") | ((top == "text") & sub.isin("javascript", "css")) | ((top == "application") & (sub == "zip"))
    return ~out


def suppress(content: Column, supplied: Column, detected: Column) -> Column:
    """content if either type is indexable; no detected type counts as the default one."""
    return F.when(indexable(F.coalesce(supplied, default())) | indexable(F.coalesce(detected, default())), content)


def sniff(payload: Column) -> Column:
    """The media type that the first bytes of a payload show, null where they show none."""
    start = F.hex(F.substring(payload, 1, 16))
    text = F.lower(F.ltrim(F.decode(F.substring(payload, 1, 512), "ISO-8859-1")))

    def of(top: str, sub: str) -> Column:
        return F.struct(F.lit(top).alias("top"), F.lit(sub).alias("sub"), F.lit(None).cast("string").alias("charset"))

    magic = [
        ("25504446", "application", "pdf"),
        ("89504E47", "image", "png"),
        ("FFD8FF", "image", "jpeg"),
        ("47494638", "image", "gif"),
        ("504B0304", "application", "zip"),
        ("1F8B", "application", "x-gzip"),
        ("D0CF11E0", "application", "msword"),
        ("494433", "audio", "mpeg"),
        ("52494646", "video", "x-msvideo"),
    ]
    out = F.when(F.length(payload) == 0, None)
    for prefix, top, sub in magic:
        out = out.when(start.startswith(prefix), of(top, sub))
    out = out.when(text.rlike(r"^(<\?xml[^>]*>\s*)?(<!--.*?-->\s*)*<(!doctype html|html|head|body|title)"), of("text", "html"))
    out = out.when(text.startswith("<?xml"), of("application", "xml"))
    return out.when(~text.rlike(r"[\x00-\x08\x0e-\x1f]"), of("text", "plain"))
