"""Title, text and links of HTML, as UDFs over Arrow batches."""

from __future__ import annotations

import re
import urllib.parse
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from capturelake.functions import urls
from capturelake.scratch import ship

# fixed values: elements at whose start the text gets a space
BLOCKS = frozenset(
    "address blockquote br center dir div dl fieldset form h1 h2 h3 h4 h5 h6 hr isindex menu noframes noscript ol p pre table ul "
    "dd dt frameset li tbody td tfoot th thead tr".split()
)
SILENT = frozenset({"script", "style", "template", "head", "title"})
SKIPPED = ("javascript", "mailto")
MOST_BYTES = 5_000_000
REFERENCE = re.compile(r"&(#[0-9]+;|#[xX][0-9a-fA-F]+;|[A-Za-z][A-Za-z0-9]*;)?")
# types, not DDL: workers import this module, and DDL needs a session
_STRING = T.StringType()
LINK = T.StructType([T.StructField("to", _STRING), T.StructField("text", _STRING)])
EXTRACTED = T.StructType([T.StructField("title", _STRING), T.StructField("text", _STRING), T.StructField("links", T.ArrayType(LINK)), T.StructField("error", _STRING)])


class Page(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.title: list[str] | None = None
        self.in_title = False
        self.silent: list[str] = []
        self.links: list[tuple[str, str]] = []
        self.anchor: tuple[str, list[str]] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "body":
            self.silent.clear()
        if tag == "title" and self.title is None:
            self.title, self.in_title = [], True
        if tag in SILENT:
            self.silent.append(tag)
        elif tag in BLOCKS and not self.silent:
            self.out.append(" ")
        if tag == "a":
            href = dict(attrs).get("href")
            if href is not None and not href.startswith(SKIPPED):
                self._end_anchor()
                self.anchor = (href, [])

    def handle_endtag(self, tag):
        if tag == "title":
            self.in_title = False
        if tag in self.silent:
            while self.silent.pop() != tag:
                pass
        if tag == "a":
            self._end_anchor()

    def _end_anchor(self):
        if self.anchor:
            self.links.append((self.anchor[0], "".join(self.anchor[1])))
            self.anchor = None

    def handle_data(self, data):
        if self.in_title:
            self.title.append(data)
        if not self.silent:
            self.out.append(data)
            if self.anchor:
                self.anchor[1].append(data)


def _open(html: str) -> tuple[str, str | None]:
    """A page in which each ampersand that begins no known reference closed by a semicolon is another character, and that character."""
    mark = next((c for c in map(chr, (*range(0xFDD0, 0xFDF0), *range(0xE000, 0xF900))) if c not in html), None)
    if mark is None:
        return html, None
    return REFERENCE.sub(lambda m: m[0] if m[1] and (m[1][0] == "#" or m[1] in html5) else mark + (m[1] or ""), html), mark


def page(html: str | None, closed: bool = False) -> tuple:
    """(title, text, links, error) of a page; what was read before an error is kept.

    As browsers do, old names such as &amp are read without their semicolon, too; with ``closed`` only references that end with one are.
    """
    if html is None:
        return None, None, [], None
    p, error = Page(), None
    html, mark = _open(html) if closed and "&" in html else (html, None)
    try:
        p.feed(html)
        p.close()
    except (ValueError, AssertionError, RecursionError) as e:
        error = f"{type(e).__name__}: {e}"[:200]
    back = (lambda t: t.replace(mark, "&")) if mark else (lambda t: t)
    title = None if p.title is None else back("".join(p.title))
    return title, re.sub(r"[ \t\n\x0b\f\r]+", " ", back("".join(p.out))), [(back(a), back(t)) for a, t in p.links], error


def _extractor(closed: bool):
    # Arrow arrays are built at once: as pandas objects, a batch's texts and links are held several times over
    @F.arrow_udf(EXTRACTED)
    def run(html: pa.Array) -> pa.Array:
        rows = ({"title": t, "text": x, "links": [{"to": a, "text": b} for a, b in links], "error": e} for t, x, links, e in (page(h.as_py(), closed) for h in html))
        return pa.array(rows, to_arrow_type(EXTRACTED))

    return run


_EXTRACT = {closed: _extractor(closed) for closed in (False, True)}


def extract(html: Column | str, closed: bool = False) -> Column:
    """struct<title, text, links, error> of pages, see page()."""
    ship(SparkSession.active())
    return _EXTRACT[closed](html)


def absolute(base: str | None, to: str) -> str:
    """The absolute form of a link's target; one that can't be read stays as it is."""
    try:
        return urllib.parse.urljoin(base or "", to)
    except ValueError:
        return to


@F.arrow_udf(T.ArrayType(_STRING))
def _targets(base: pa.Array, html: pa.Array) -> pa.Array:
    return pa.array(([absolute(b.as_py(), to) for to, _ in page(h.as_py())[2]] for b, h in zip(base, html, strict=True)), pa.list_(pa.string()))


def targets(base: Column | str, html: Column | str) -> Column:
    """Absolute forms of a page's link targets. One worker reads a page for it, and neither texts nor anchors leave that worker."""
    ship(SparkSession.active())
    return _targets(base, html)


@F.pandas_udf(T.ArrayType(_STRING))
def resolve(base: pd.Series, to: pd.Series) -> pd.Series:
    """Absolute forms of link targets; a target that can't be read stays as it is."""
    return pd.Series([None if ts is None else [absolute(b, t) for t in ts] for b, ts in zip(base, to, strict=True)])


def outlinks(targets: Column) -> Column:
    """Distinct ascending fingerprints of the canonical targets."""
    return F.array_sort(F.array_distinct(F.transform(targets, lambda u: urls.fingerprint(urls.canonicalize(u)))))
