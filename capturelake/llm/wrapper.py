"""Main text of HTML pages by wrappers: union-free regular expressions inferred from the pages of a host.

A page becomes a balanced stream of structural tokens and text slots: comments, scripts and styles are skipped, inline
markup is part of its text, end tags that HTML implies are added. Its regular expression folds runs of elements with one
label into a repeated group, and so sequences of labels that follow each other again. A host's wrapper begins as the
expression of one page and is aligned with one page after another, element by element: what both have is matched and
its inside aligned in turn, a single element matches a repeated one, and what only one side has becomes optional.
Texts become slots, with what the pages tell of them: characters, characters in links, whether they ever differ.

Then slots are chosen. Slots within menus, headers, footers, sidebars, notices, adverts, forms and comments, told by
element names and the words of class, id and role, are out. Of what is left those within articles count, if the host
has such elements with text, else those within the main part or an element whose words name one; if a host marks
nothing, those within the element that holds most of the texts that differ from page to page and are no links, and of
these only texts that differ. A page is read by following its host's wrapper and taking the chosen slots in order;
what the wrapper doesn't know is judged by the place that it was found in.

Pages are not shuffled to be learnt from: each task aligns those it reads, and only wrappers meet by host, first by
host and task, then by host, so a host with a third of all pages is no hot task. A wrapper is as large as a template
and its options. The wrappers are sent to all tasks while they have at most ``BROADCAST_BYTES`` in all; beyond that
pages meet them in a join that deals each host's pages out to ``SALTS`` keys.

Null and empty pages, and pages without main text, give an empty text. Pages with a null or odd url form one host.
Rows of a repeated page_id are read each on its own. Elements deeper than ``DEEPEST`` are part of the text around.
"""

from __future__ import annotations

import functools
import html as references
import json
import re
import zlib
from collections import Counter
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capturelake.llm.text import released
from capturelake.scratch import Scratch

DEEPEST = 150
#: hosts whose wrappers a task holds before it hands them on
HELD = 2000
#: labels of a repeated sequence
LONGEST = 6
BROADCAST_BYTES = 16 << 20
SALTS = 64

# fixed values: elements of HTML and words that sites use for the parts of a page
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rb rp rt ruby s samp small span strike strong sub sup time tt u var".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUT = frozenset("head title nav footer aside form script style noscript template iframe object svg canvas math button select textarea menu dialog audio video map fieldset".split())
OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner menu nav navbar navigation navigations breadcrumb breadcrumbs footer sidebar sidebars aside "
    "widget widgets related recommended share sharing social cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription comment comments commentlist "
    "discussion replies reply disqus login signup signin search searchbox toolbar masthead pagination pager copyright legal disclaimer contentinfo complementary tooltip skip".split()
)
#: only outside of an article, whose own heading they may hold
HEAD_WORDS = frozenset("header heading topbar".split())
#: beside them, a part's word tells of a page's state, as in has-sidebar
STATE_WORDS = frozenset("with has no open layout".split())
ARTICLE_WORDS = frozenset("articlebody".split())
MAIN_WORDS = frozenset("article post entry story content main body text".split())
CLOSES = {"li": {"p", "li"}, "dt": {"p", "dt", "dd"}, "dd": {"p", "dt", "dd"}, "tr": {"p", "td", "th", "tr"}, "td": {"p", "td", "th"}, "th": {"p", "td", "th"}, "option": {"option"}}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|xmp)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+)>|<(/?)([a-z][^\s/>]*)([^>]*)>|<[!?][^>]*>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@functools.lru_cache(8192)
def label_of(name: str, attributes: str) -> str:
    """An element's name and the words of its class, id, role and itemprop; digits are no part of them."""
    values = [value.strip("\"'") for _, value in ATTRIBUTE.findall(attributes)]
    words = sorted({w.lower() for v in values for w in [*WORD.findall(v), *([v] if v.isalpha() else [])]})
    return f"{name} {' '.join(words)}" if words else name


@functools.lru_cache(65536)
def mark_of(label: str) -> str:
    """out, head, article, main or nothing."""
    name, *words = label.split(" ")
    own = set(words)
    if name in ("html", "body"):
        return ""
    if name in OUT or own & OUT_WORDS and not own & STATE_WORDS:
        return "out"
    if name == "article" or own & ARTICLE_WORDS:
        return "article"
    if name == "header" or own & HEAD_WORDS:
        return "head"
    if name == "main" or own & MAIN_WORDS and name not in ("html", "body"):
        return "main"
    return ""


# pages: an element is [label, children], a text ["#", pieces, characters in links]


def page(html: str) -> list:
    """The children of a page's root."""
    root: list = ["", []]
    stack: list[tuple[str, list]] = [("", root)]
    inline: dict[str, list[bool]] = {}
    # open elements that are too deep
    skipped: Counter[str] = Counter()
    links, at = 0, 0

    def text(piece: str) -> None:
        into = stack[-1][1][1]
        if into and into[-1][0] == "#":
            into[-1][1].append(piece)
        elif piece.isspace():
            return
        else:
            into.append(["#", [piece], 0])
        if links:
            into[-1][2] += len(piece)

    def close(name: str) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] == name:
                del stack[i:]
                return

    for m in TOKEN.finditer(html):
        begin = m.start()
        if begin > at:
            text(html[at:begin])
        at = m.end()
        raw, slash, name, attributes, slash_, name_, attributes_ = m.groups()
        if name is None:
            slash, name, attributes = slash_, name_, attributes_
        if name is None:
            continue
        name = name.lower()
        if name in VOID:
            if name == "br":
                text(" ")
            elif name == "hr":
                stack[-1][1][1].append(["hr", []])
            continue
        label = label_of(name, attributes) if attributes and not slash else name
        if name in INLINE:
            if name == "a":
                links = max(0, links - 1) if slash else links + 1
            if slash:
                if inline.get(name) and inline[name].pop():
                    close(name)
                continue
            structural = label != name and mark_of(label) == "out"
            inline.setdefault(name, []).append(structural)
            if not structural:
                continue
        elif slash:
            if skipped[name]:
                skipped[name] -= 1
            else:
                close(name)
            continue
        closed = CLOSES.get(name, ("p",))
        while stack[-1][0] in closed:
            stack.pop()
        if len(stack) > DEEPEST:
            skipped[name] += 1
            continue
        node = [label, []]
        stack[-1][1][1].append(node)
        stack.append((name, node))
    if at < len(html):
        text(html[at:])
    return root[1]


# wrappers: an element is [label, optional, repeated, children], a sequence that repeats ["(", optional, 1, children],
# a slot ["#", optional, characters, those in links, texts, checksum or -1 where they differ]


def _key(node: list) -> str:
    return f"({' | '.join(_key(x) for x in node[3])}" if node[0] == "(" else node[0]


def _one(a: list, b: list, repeated: int = 0) -> list:
    if a[0] == "#":
        return ["#", a[1] | b[1], a[2] + b[2], a[3] + b[3], a[4] + b[4], a[5] if a[5] == b[5] else -1]
    return [a[0], a[1] | b[1], a[2] | b[2] | repeated, align(a[3], b[3])]


def _optional(node: list) -> list:
    return [node[0], 1, *node[2:]]


def _fold(nodes: list[list]) -> list[list]:
    """Repeated elements, then repeated sequences of elements, as groups."""
    out: list[list] = []
    for x in nodes:
        if out and x[0] == out[-1][0] and x[0] != "#":
            out[-1] = _one(out[-1], x, 1)
        else:
            out.append(x)
    for n in range(2, LONGEST + 1):
        keys, i, folded = [_key(x) for x in out], 0, []
        while i < len(out):
            body, j = None, i + n
            while keys[i : i + n] == keys[j : j + n] and len(keys[i : i + n]) == n:
                again = out[j : j + n]
                body = [_one(x, y) for x, y in zip(body or out[i : i + n], again, strict=True)]
                j += n
            folded.append(["(", 0, 1, body] if body else out[i])
            i = j if body else i + 1
        out = folded
    return out


def expression(nodes: list) -> list[list]:
    """The wrapper of one page."""
    out = []
    for x in nodes:
        if x[0] == "#":
            size = sum(map(len, x[1]))
            out.append(["#", 0, size, min(x[2], size), 1, zlib.crc32("".join(x[1]).strip().encode("utf-8", "surrogatepass"))])
        else:
            out.append([x[0], 0, 0, expression(x[1])])
    return _fold(out)


def _grouped(nodes: list[list], like: list[list]) -> list[list]:
    """nodes, where single runs of what ``like`` repeats are groups too."""
    for group in (g for g in like if g[0] == "("):
        keys, want = [_key(x) for x in nodes], [_key(x) for x in group[3]]
        out, i = [], 0
        while i < len(nodes):
            if keys[i : i + len(want)] == want:
                out.append(["(", 0, 1, nodes[i : i + len(want)]])
                i += len(want)
            else:
                out.append(nodes[i])
                i += 1
        nodes = out
    return nodes


def align(a: list[list], b: list[list]) -> list[list]:
    """The wrapper of what two wrappers cover."""
    one, two = [_key(x) for x in a], [_key(x) for x in b]
    if one == two:
        return [_one(x, y) for x, y in zip(a, b, strict=True)]
    if not a or not b:
        return [_optional(x) for x in a or b]
    a, b = _grouped(a, b), _grouped(b, a)
    one, two = [_key(x) for x in a], [_key(x) for x in b]
    out = []
    for kind, i, j, k, m in SequenceMatcher(None, one, two, autojunk=False).get_opcodes():
        if kind == "equal":
            out += [_one(x, y) for x, y in zip(a[i:j], b[k:m], strict=True)]
        else:
            out += [_optional(x) for x in [*a[i:j], *b[k:m]]]
    return out


# the choice of slots


def _texts(nodes: list[list], mark: str, inside: bool = False) -> int:
    """Characters of slots within elements of a mark that aren't out, without those in links."""
    total = 0
    for x in nodes:
        if x[0] == "#":
            total += (x[2] - x[3]) * inside
        elif x[0] == "(":
            total += _texts(x[3], mark, inside)
        elif mark_of(x[0]) != "out":
            total += _texts(x[3], mark, inside or mark_of(x[0]) == mark)
    return total


def _differs(slot: list) -> bool:
    """Whether a slot's texts differ; one text alone may."""
    return slot[5] == -1 or slot[4] == 1


def _mass(nodes: list[list]) -> tuple[float, list | None]:
    """The node whose own slots, and half of those one level down, have most characters that differ and are no links."""
    own = sum(x[2] - x[3] for x in nodes if x[0] == "#" and _differs(x))
    best: tuple[float, list | None] = (0.0, None)
    for x in nodes:
        if x[0] == "(" or x[0] != "#" and mark_of(x[0]) not in ("out", "head"):
            mass, found = _mass(x[3])
            if found is None or mass <= 0:
                continue
            best = max(best, (mass, found), key=lambda t: t[0])
    near = sum(sum(y[2] - y[3] for y in x[3] if y[0] == "#" and _differs(y)) for x in nodes if x[0] != "#" and (x[0] == "(" or mark_of(x[0]) not in ("out", "head")))
    here = own + near
    return (here, nodes) if here >= best[0] and here > 0 else best


def chosen(nodes: list[list]) -> list:
    """[kind, slots]: the wrapper with a choice in place of what pages told. An element is [label, inside, children], a slot ["#", taken]."""
    total = max(1, _texts(nodes, "", True))
    kind = next((m for m in ("article", "main") if 20 * _texts(nodes, m) >= total), "")
    place = None if kind else _mass(nodes)[1]

    def walk(level: list[list], inside: bool, out: bool) -> list:
        inside = inside or level is place
        made = []
        for x in level:
            if x[0] == "#":
                # where nothing is marked, a text that never differs is part of the template
                made.append(["#", int(inside and not out and (bool(kind) or _differs(x)))])
            elif x[0] == "(":
                made += walk(x[3], inside, out)
            else:
                mark = mark_of(x[0])
                now = inside or bool(kind) and mark == kind
                gone = out or mark == "out" or mark == "head" and not inside
                made.append([x[0], int(now and not gone), walk(x[3], now, gone)])
        return made

    return [kind, walk(nodes, False, False)]


def taken(kind: str, slots: list | None, nodes: list, inside: bool, out: list[str]) -> None:
    """Appends the texts of a page's nodes that the chosen wrapper takes."""
    places: dict[str, list[int]] = {}
    for i, s in enumerate(slots or ()):
        places.setdefault(s[0], []).append(i)
    at = 0
    for x in nodes:
        own = places.get(x[0])
        found = None
        if own:
            # the next of its label, or the last one again where a group repeats
            i = next((i for i in own if i >= at), own[-1])
            at, found = i, slots[i]
        if x[0] == "#":
            if found[1] if found else inside:
                text = " ".join("".join(references.unescape(p) if "&" in p else p for p in x[1]).split())
                if text:
                    out.append(text)
            if found:
                at += 1
        elif found:
            taken(kind, found[2], x[1], bool(found[1]), out)
        else:
            mark = mark_of(x[0])
            now = (inside or bool(kind) and mark == kind) and mark != "out" and not (mark == "head" and not inside)
            if mark != "out":
                taken(kind, None, x[1], now, out)


# Spark


HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def _wrappers(held: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"host": pa.array(list(held), pa.string()), "wrapper": pa.array([json.dumps(w, separators=(",", ":")) for w in held.values()], pa.string())})


@released
def _learn(batches):
    held: dict[str, list] = {}
    for b in batches:
        for host, html in zip(b.column("host").to_pylist(), b.column("html"), strict=True):
            own = expression(page(html.as_py() or ""))
            held[host] = align(held[host], own) if host in held else own
        if len(held) > HELD:
            yield _wrappers(held)
            held = {}
    yield _wrappers(held)


def _meet(table: pa.Table, finish) -> pa.Table:
    texts = sorted(table.column("wrapper").to_pylist())
    out = json.loads(texts[0])
    for t in texts[1:]:
        out = align(out, json.loads(t))
    return pa.table({"host": pa.array([table.column("host")[0].as_py()], pa.string()), "wrapper": [json.dumps(finish(out), separators=(",", ":"))]})


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper): of each host's pages (host, html) the chosen wrapper, as JSON."""

    def some(table: pa.Table) -> pa.Table:
        return _meet(table, lambda w: w)

    def all_(table: pa.Table) -> pa.Table:
        return _meet(table, chosen)

    kind = "host string, wrapper string"
    parts = pages.select("host", "html").mapInArrow(_learn, kind)
    # a host has at most one wrapper a task and hand-over
    parts = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(16)))
    parts = parts.groupBy("host", "salt").applyInArrow(lambda t: some(t), kind)
    return parts.groupBy("host").applyInArrow(lambda t: all_(t), kind)


@functools.lru_cache(256)
def _loaded(wrapper: str) -> list:
    return json.loads(wrapper)


def _text(html: str, wrapper: str) -> str:
    kind, slots = _loaded(wrapper)
    out: list[str] = []
    taken(kind, slots, page(html), False, out)
    return " ".join(out)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page."""
    spark = pages.sparkSession
    work = Scratch(spark, "wrappers")
    host = F.coalesce(F.lower(F.regexp_extract(url_col, HOST, 1)), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host"))
    known = work.save(wrappers(rows), "hosts")
    size = known.agg(F.sum(F.length("wrapper") + F.length("host"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        joined = rows.join(F.broadcast(known), "host", "left")
    else:
        salted = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("id", "html"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")

    @released
    def run(batches):
        for b in batches:
            texts = [_text(h.as_py() or "", w.as_py()) for h, w in zip(b.column("html"), b.column("wrapper"), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    kind = pages.schema[id_col].dataType.simpleString()
    return joined.select("id", "url", "html", "wrapper").mapInArrow(run, f"id {kind}, url string, text string, n_chars long")


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet")).withColumnRenamed("id", "page_id")


#: the text of the pages' own template, without wrappers
OP11_SQL = r"""
with a as (
  select page_id, url, regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's'),
         '</?(h1|p|br)>', ' ', 'g'), '</?[a-z][^>]*>', '', 'g') as t from pages
), d as (
  select page_id, url, replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;', '&') as t from a
), c as (select page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) as text from d)
select page_id, url, text, length(text) as n_chars from c
"""
