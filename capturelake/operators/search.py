"""Query strings as predicates, and paging.

Grammar: ``*:*``, ``field:value``, ``field:"value"``, ``field:[a TO b]`` with ``*`` and ``{}`` bounds, bare terms
on the default field, ``AND``, ``OR`` (default), ``NOT``, ``+``, ``-`` and parentheses. Exact fields compare whole values,
array fields any of them, analysed fields the stemmed terms of the value: any of them for a word, all of them in
their places for a phrase. Catalyst sees plain predicates, so those on stored columns reach the scan.

With an inverted index (field, term, id, positions), sorted by field and term, text clauses read its matching rows
alone; without one, every text is analysed.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capturelake.functions import text

_TOKEN = re.compile(r'\s*(?:(\()|(\))|([+-])(?=\S)|((?:[\w.*]+:)?[\[{][^\]}]*[\]}])|((?:[\w.]+:)?"(?:[^"\\]|\\.)*")|([^\s()"]+))')
TEXTS = ("content", "title")
ADDRESSES = ("hostt", "urlt")
COPIED = {"hostt": "host", "urlt": "url"}


_WHOLE, _NUMBER = r"[+-]?\d{1,18}", r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
_DAY = r"\d{4}(-\d{1,2}(-\d{1,2}([T ]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?)?)?"
#: what values of a type look like; other types take every text
_FORMS = {T.LongType: _WHOLE, T.IntegerType: _WHOLE, T.ShortType: _WHOLE, T.ByteType: _WHOLE, T.DoubleType: _NUMBER, T.FloatType: _NUMBER, T.DecimalType: _NUMBER, T.TimestampType: _DAY, T.TimestampNTZType: _DAY, T.DateType: _DAY, T.BooleanType: "(?i:true|false)"}


class QueryError(ValueError):
    pass


class Search:
    """compile() makes a predicate of a query string for the columns of a DataFrame."""

    def __init__(self, df: DataFrame, default_field: str = "content", indexed: bool = False):
        self.types, self.default = dict(zip(df.columns, (f.dataType for f in df.schema.fields), strict=True)), default_field
        # text clauses to look up: field, value, whether it is a phrase
        self.indexed, self.clauses = indexed, []
        # fields that a compiled query reads
        self.used: set[str] = set()

    def compile(self, query: str) -> Column:
        self.tokens = self._split(query)
        self.at = 0
        out = self._any()
        if self.at != len(self.tokens):
            raise QueryError(f"unexpected {self.tokens[self.at][1]!r}")
        return out

    def _split(self, query: str) -> list[tuple[str, str]]:
        out, at = [], 0
        while query[at:].strip():
            m = _TOKEN.match(query, at)
            if not m:
                raise QueryError(f"cannot read {query[at:]!r}")
            kind = ("(", ")", "sign", "range", "phrase", "word")[m.lastindex - 1]
            value = m[m.lastindex]
            out.append((value if value in ("AND", "OR", "NOT") else kind, value))
            at = m.end()
        return out

    def _peek(self) -> str:
        return self.tokens[self.at][0] if self.at < len(self.tokens) else ""

    def _any(self) -> Column:
        """A run of clauses: required ones all hold, prohibited ones none, else any of the optional ones."""
        must, never, may = [], [], []
        clause, sign = self._all(), self.sign
        while True:
            (must if sign == "+" else never if sign == "-" else may).append(clause)
            if self._peek() == "OR":
                self.at += 1
            elif self._peek() in ("", ")"):
                break
            clause, sign = self._all(), self.sign
        parts = [*must, *[~F.coalesce(x, F.lit(False)) for x in never]]
        if may and not must:
            one = may[0]
            for x in may[1:]:
                one = one | x
            parts.append(one)
        out = parts[0]
        for x in parts[1:]:
            out = out & x
        return out

    def _all(self) -> Column:
        self.sign = ""
        if self._peek() == "sign":
            self.sign = self.tokens[self.at][1]
            self.at += 1
        sign, out = self.sign, self._one()
        while self._peek() == "AND":
            self.at += 1
            out = out & self._one()
        self.sign = sign
        return out

    def _one(self) -> Column:
        kind = self._peek()
        if not kind or kind in (")", "AND", "OR"):
            raise QueryError("a clause is missing")
        value = self.tokens[self.at][1]
        self.at += 1
        if kind == "NOT":
            return ~F.coalesce(self._one(), F.lit(False))
        if kind == "(":
            out = self._any()
            if self._peek() != ")":
                raise QueryError("a parenthesis is open")
            self.at += 1
            return out
        if kind == "sign":
            raise QueryError(f"unexpected {value!r}")
        if value == "*:*":
            return F.lit(True)
        if kind == "range":
            field, _, body = value.rpartition(":") if re.match(r"[\w.]+:", value) else ("", "", value)
            if not field:
                m = re.match(r"([\w.]+):(.*)$", value, re.S)
                field, body = (m[1], m[2]) if m else (self.default, value)
            else:
                field, body = value.split(":", 1)
            return self._range(field, body)
        m = re.match(r"([\w.]+):(.+)$", value, re.S)
        field, body = (m[1], m[2]) if m and m[1] in {*self.types, *COPIED} else (self.default, value)
        phrase = body.startswith('"')
        body = re.sub(r"\\(.)", r"\1", body[1:-1]) if phrase else body.replace("\\:", ":")
        return self.term(field, body, phrase)

    def _column(self, field: str) -> tuple[Column, T.DataType]:
        name = COPIED.get(field, field)
        if name not in self.types:
            raise QueryError(f"no field {field!r}")
        self.used.add(name)
        return F.col(f"`{name}`"), self.types[name]

    def term(self, field: str, value: str, phrase: bool = False) -> Column:
        column, kind = self._column(field)
        if field in ADDRESSES:
            words = F.filter(F.split(F.lower(column), "[^a-z0-9]+"), lambda x: x != "")
            wanted = [w for w in re.split("[^a-z0-9]+", value.lower()) if w]
            if phrase:
                return F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")).contains(f" {' '.join(wanted)} ")
            return F.arrays_overlap(words, F.array(*map(F.lit, wanted)))
        if field in TEXTS and value != "*":
            if self.indexed:
                self.clauses.append((field, value, phrase))
                return F.array_contains(F.coalesce("__clauses", F.array().cast("array<int>")), len(self.clauses) - 1)
            return text.matches(value, phrase)(column)
        if value == "*":
            return column.isNotNull()
        if isinstance(kind, T.ArrayType):
            return F.array_contains(column, self._value(field, value, kind.elementType))
        return column == self._value(field, value, kind)

    def _value(self, field: str, value: str, kind: T.DataType) -> Column:
        """A value as a field's type has it; one that it hasn't is an error of the query."""
        form = _FORMS.get(type(kind))
        if form and not re.fullmatch(form, value.strip()):
            raise QueryError(f"{field} has no value {value!r}")
        return F.lit(value).cast(kind)

    def _range(self, field: str, body: str) -> Column:
        m = re.match(r"([\[{])\s*(\S+)\s+TO\s+(\S+?)\s*([\]}])$", body)
        if not m:
            raise QueryError(f"no range: {body!r}")
        column, kind = self._column(field)
        element = kind.elementType if isinstance(kind, T.ArrayType) else kind

        def inside(x: Column) -> Column:
            out = x.isNotNull()
            if m[2] != "*":
                low = self._value(field, m[2].strip('"'), element)
                out = out & (x >= low if m[1] == "[" else x > low)
            if m[3] != "*":
                high = self._value(field, m[3].strip('"'), element)
                out = out & (x <= high if m[4] == "]" else x < high)
            return out

        return F.exists(column, inside) if isinstance(kind, T.ArrayType) else inside(column)


def search(df: DataFrame, query: str, default_field: str = "content") -> DataFrame:
    return df.where(Search(df, default_field).compile(query))


def inverted(docs: DataFrame) -> DataFrame:
    """(field, term, id, positions) of the texts of documents, dealt and sorted by term so that a lookup reads few rows."""
    rows = None
    for field in (f for f in TEXTS if f in docs.columns):
        own = docs.where(F.col(field).isNotNull()).select(F.lit(field).alias("field"), "id", F.explode(text.postings(field)).alias("x"))
        rows = own if rows is None else rows.union(own)
    rows = rows.select("field", "x.term", "id", "x.positions")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the id splits terms that most documents have
    return rows.repartitionByRange(n, "field", "term", "id").sortWithinPartitions("field", "term", "id")


def clause_hits(terms: DataFrame, field: str, value: str, phrase: bool) -> DataFrame:
    """(id) of the documents that a text clause matches."""
    wanted = text.query_terms(value)
    every = sorted({t for _, ts in wanted for t in ts})
    rows = terms.where((F.col("field") == field) & F.col("term").isin(*every)) if every else terms.where("false")
    if not phrase or not wanted:
        return rows.select("id").distinct()
    held = rows.groupBy("id").agg(F.collect_list(F.struct("term", "positions")).alias("found"))

    def places(ts: list[str]) -> Column:
        return F.flatten(F.transform(F.filter("found", lambda x: x["term"].isin(*ts)), lambda x: x["positions"]))

    held = held.select("id", *[places(ts).alias(f"p{i}") for i, (_, ts) in enumerate(wanted)])

    def follows(at: Column) -> Column:
        out = F.lit(True)
        for i, (d, _) in enumerate(wanted):
            out = out & F.array_contains(f"p{i}", at + d)
        return out

    return held.where(F.exists("p0", follows)).select("id")


def fields_of(df: DataFrame, query: str, default_field: str = "content") -> set[str]:
    """The fields of df that a query reads."""
    s = Search(df, default_field, indexed=True)
    s.compile(query)
    return s.used


def search_indexed(df: DataFrame, terms: DataFrame, query: str, default_field: str = "content") -> DataFrame:
    """search(), with the text clauses looked up in an inverted index of df's documents."""
    s = Search(df, default_field, indexed=True)
    predicate = s.compile(query)
    if not s.clauses:
        return df.where(predicate)
    hits = None
    for k, clause in enumerate(s.clauses):
        own = clause_hits(terms, *clause).select("id", F.lit(k).alias("k"))
        hits = own if hits is None else hits.union(own)
    hits = hits.groupBy("id").agg(F.collect_set("k").alias("__clauses"))
    return df.join(hits, "id", "left").where(predicate).drop("__clauses")


def by_ids(df: DataFrame, ids: Iterable[str] | DataFrame) -> DataFrame:
    """The rows of some ids: a predicate for a list, a semi join for a table."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select("id"), "id", "left_semi")
    return df.where(F.col("id").isin(*ids))


def missing_last(field: str, descending: bool = False) -> Column:
    """An order in which documents without the field come last, whatever the direction."""
    return F.desc_nulls_last(field) if descending else F.asc_nulls_last(field)


def page(df: DataFrame, order: list, start: int, rows: int) -> DataFrame:
    """rows rows from start on, in an order (names have missing values last); a feature of the interface, not a cap."""
    return df.orderBy(*[missing_last(x) if isinstance(x, str) else x for x in order]).offset(start).limit(rows)


def page_after(df: DataFrame, field: str, last, rows: int) -> DataFrame:
    """The rows rows after a key; the filter reaches the scan, so later pages cost no more than first ones."""
    return (df if last is None else df.where(F.col(field) > F.lit(last))).orderBy(field).limit(rows)


class Cursor:
    """The rows of a result in the order of a unique field, page by page; its length is the number of all rows."""

    def __init__(self, df: DataFrame, field: str = "id", rows: int = 10_000):
        self.df, self.field, self.rows = df, field, rows

    def __len__(self) -> int:
        return self.df.count()

    def __iter__(self):
        last = None
        while True:
            found = page_after(self.df, self.field, last, self.rows).collect()
            yield from found
            if len(found) < self.rows:
                return
            last = found[-1][self.field]


def terms(df: DataFrame, field: str) -> DataFrame:
    """The distinct values of a field in order, of an array field those of its elements."""
    values = df.select(F.explode(field).alias(field)) if isinstance(df.schema[field].dataType, T.ArrayType) else df.select(field)
    return values.where(F.col(field).isNotNull()).distinct().orderBy(field)


def pages_of(total: int, rows: int, start: int = 0) -> dict[str, int | None]:
    """Page numbers of a result, from 1: current, count, previous and next."""
    count, current = -(-total // rows), start // rows + 1
    return {"current": current, "count": count, "previous": current - 1 if current > 1 else None, "next": current + 1 if current < count else None}
