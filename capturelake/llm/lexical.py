"""Ranked lexical search over dual-sorted wavelet trees, one tree for each shard of documents.

Terms are runs of ASCII letters, ASCII digits and all characters beyond ASCII; A-Z are lower-cased. A shard holds at
most ``SHARD_DOCS`` documents or about ``SHARD_BYTES`` of text, numbered by ascending doc_id. Its postings are one
sequence of document numbers: the lists of all terms after each other, each in the order of falling impact. A wavelet
tree over that sequence halves the range of document numbers at each level and keeps the order, so in every node a
term's postings are again a run that begins with the one of the largest impact, and the leaves are in the order of
doc_id. The postings are thus sorted both ways without being stored twice.

A query is answered best first: a node is a range of documents, its bound the sum over the query's terms of weight
times the first impact of the term's run there. The nodes with the largest bounds are split until the k best
documents found (a leaf's bound is its exact score) are at least as good as every node left. Nodes are split
``BATCH`` at a time, which changes the work but not the result, and a bound from shards that the same task has
searched before prunes from the start.

The index is written: for each shard the terms, their counts, the impacts in the order of the root and a bitmap for
each level, about two bits a level and posting less than the levels' own impacts, which a task makes again when it
loads a shard. Two numbers of the whole table (documents with a term, terms) are needed before impacts are known, so
texts are read twice; nothing is shuffled but one row a shard's best documents.

Every row is a document: rows of a repeated doc_id are ranked each by its own text, a null doc_id comes after all
others of the same score. Null and empty texts and texts without terms are never found. Queries without terms find
nothing. Items with a repeated item_id are answered each on its own, under the same id.
"""

from __future__ import annotations

import bisect
import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from capturelake.llm.text import release, released
from capturelake.scratch import Scratch

SHARD_DOCS = 4096
SHARD_BYTES = 16 << 20
#: nodes that are split at once
BATCH = 48
#: items that a pass over the shards answers
ITEMS = 5000
#: bits of a posting's sort key that hold the document and the impact, which is below 1,000,000
DOC_BITS, IMPACT_BITS = 16, 20
NO_ID = np.iinfo(np.int64).max

_PLAIN = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_FOLD = bytes((c + 32 if 0x41 <= c <= 0x5A else c) if c in _PLAIN else 0x20 for c in range(256))
_IN_TERM = np.array([c in _PLAIN for c in range(256)])


def terms_of(text: bytes) -> list[bytes]:
    """The terms of UTF-8 bytes, in order."""
    return text.translate(_FOLD).split()


def _utf8(column: pa.Array) -> pa.Array:
    return column.cast(pa.large_binary())


@released
def _lengths(batches):
    """(documents with a term, terms) of the batches, by where runs of term bytes begin."""
    docs = total = 0
    for b in batches:
        for value in _utf8(b.column("text")):
            if value.is_valid:
                inside = _IN_TERM[np.frombuffer(value.as_buffer(), np.uint8)]
                n = int(np.count_nonzero(inside[1:] & ~inside[:-1])) + int(inside[:1].sum())
                docs, total = docs + (n > 0), total + n
    yield pa.RecordBatch.from_pydict({"docs": [docs], "terms": [total]})


class Shard:
    """A loaded tree. Level l is the sequence in the order of the documents' first l bits."""

    def __init__(self, ids: np.ndarray, terms: list[bytes], counts: np.ndarray, impacts: np.ndarray, bits: list[np.ndarray]):
        self.ids, self.terms, self.levels = ids, terms, len(bits)
        self.ends = np.cumsum(counts, dtype=np.int64)
        n = len(impacts)
        self.zeros = np.zeros((self.levels, n + 1), np.int32)
        self.impacts = np.zeros((self.levels + 1, n + 1), np.int32)
        self.first: list[np.ndarray] = []
        self.impacts[0, :n] = impacts
        node = np.zeros(n, np.int64)
        for level, bit in enumerate(bits):
            self.first.append(np.searchsorted(node, np.arange((1 << level) + 1)))
            np.cumsum(bit == 0, out=self.zeros[level, 1:])
            node = node << 1 | bit
            order = np.argsort(node.astype(np.uint16), kind="stable")
            node = node[order]
            self.impacts[level + 1, :n] = self.impacts[level, :n][order]
        # where a level's nodes begin, all levels in one array
        self.base = np.cumsum([0, *(len(f) for f in self.first)])
        self.starts = np.concatenate(self.first) if self.first else np.zeros(2, np.int64)

    def runs(self, wanted: list[bytes]) -> dict[bytes, tuple[int, int]]:
        out = {}
        for t in wanted:
            i = bisect.bisect_left(self.terms, t)
            if i < len(self.terms) and self.terms[i] == t:
                out[t] = (int(self.ends[i - 1]) if i else 0, int(self.ends[i]))
        return out

    def best(self, runs: list[tuple[int, int]], weights: np.ndarray, k: int, floor: int) -> list[tuple[int, int]]:
        """The k best (score, document number) above 0 and not below floor; all that tie with the last are considered."""
        lo = np.array([[a for a, _ in runs]], np.int64)
        hi = np.array([[b for _, b in runs]], np.int64)
        level, node = np.zeros(1, np.int64), np.zeros(1, np.int64)
        bound = self._bounds(level, lo, hi, weights)
        # (score, -document): the root is the worst
        found: list[tuple[int, int]] = []
        least = max(1, floor)
        while len(bound):
            if self.levels == 0 or len(bound) > BATCH:
                pick = np.argpartition(-bound, min(BATCH, len(bound)) - 1)[:BATCH]
            else:
                pick = np.arange(len(bound))
            rest = np.ones(len(bound), bool)
            rest[pick] = False
            at, v, a, b = level[pick], node[pick], lo[pick], hi[pick]
            leaf = at == self.levels
            for score, doc in zip(bound[pick][leaf].tolist(), v[leaf].tolist(), strict=True):
                heapq.heappush(found, (score, -doc))
                if len(found) > k:
                    heapq.heappop(found)
            at, v, a, b = at[~leaf], v[~leaf], a[~leaf], b[~leaf]
            if len(found) == k:
                least = max(least, found[0][0])
            parts = [(level[rest], node[rest], lo[rest], hi[rest], bound[rest])]
            if len(at):
                begin = self.starts[self.base[at] + v]
                zero = self.zeros[at, begin]
                split = begin + self.zeros[at, self.starts[self.base[at] + v + 1]] - zero
                za, zb = self.zeros[at[:, None], a] - zero[:, None], self.zeros[at[:, None], b] - zero[:, None]
                sides = ((v << 1, begin[:, None] + za, begin[:, None] + zb), (v << 1 | 1, split[:, None] + (a - begin[:, None] - za), split[:, None] + (b - begin[:, None] - zb)))
                for child, x, y in sides:
                    parts.append((at + 1, child, x, y, self._bounds(at + 1, x, y, weights)))
            keep = [p[4] >= least for p in parts]
            level, node, lo, hi, bound = (np.concatenate([p[i][m] for p, m in zip(parts, keep, strict=True)]) for i in range(5))
        return [(score, -doc) for score, doc in found]

    def _bounds(self, level: np.ndarray, lo: np.ndarray, hi: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return np.where(lo < hi, self.impacts[level[:, None], lo], 0) @ weights


def build(ids: list[int | None], texts: list[bytes | None], n_docs: int, n_terms: int) -> dict:
    """The stored form of a shard."""
    order = sorted(range(len(ids)), key=lambda i: NO_ID if ids[i] is None else ids[i])
    numbers: dict[bytes, int] = {}
    term, doc, tf, m = [], [], [], np.ones(len(ids), np.int64)
    for at, i in enumerate(order):
        words = terms_of(texts[i] or b"")
        counts = Counter(words)
        m[at] = 75 + 25 * len(words) * n_docs // max(1, n_terms)
        term.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in counts), np.int64, len(counts)))
        tf.append(np.fromiter(counts.values(), np.int64, len(counts)))
        doc.append(np.full(len(counts), at, np.int64))
    term, doc, tf = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (term, doc, tf))
    names = sorted(numbers)
    place = np.zeros(len(names), np.int64)
    place[[numbers[w] for w in names]] = np.arange(len(names))
    term = place[term]
    impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[doc])
    keys = np.sort(term << (DOC_BITS + IMPACT_BITS) | ((1 << IMPACT_BITS) - 1 - impact) << DOC_BITS | doc)
    doc = keys & ((1 << DOC_BITS) - 1)
    impact = (1 << IMPACT_BITS) - 1 - (keys >> DOC_BITS & ((1 << IMPACT_BITS) - 1))
    levels = max(0, len(ids) - 1).bit_length()
    bits = []
    row = doc.astype(np.uint16)
    for level in range(levels):
        row = row[np.argsort(row >> np.uint16(levels - level), kind="stable")]
        bits.append(np.packbits(row >> np.uint16(levels - 1 - level) & np.uint16(1)).tobytes())
    pack = zstandard.ZstdCompressor(level=1).compress
    return {
        "n_docs": len(ids),
        "ids": pack(np.array([NO_ID if ids[i] is None else ids[i] for i in order], "<i8").tobytes()),
        "terms": pack(b"\n".join(names)),
        "counts": pack(np.bincount(term, minlength=len(names)).astype("<u4").tobytes()),
        "impacts": pack(impact.astype("<u4").tobytes()),
        "bits": pack(b"".join(bits)),
    }


def _open(value) -> bytes:
    return zstandard.ZstdDecompressor().decompress(value)


def _dictionary(row: dict) -> tuple[list[bytes], np.ndarray]:
    terms = _open(row["terms"])
    return terms.split(b"\n") if terms else [], np.frombuffer(_open(row["counts"]), "<u4")


def load(row: dict) -> Shard:
    terms, counts = _dictionary(row)
    impacts = np.frombuffer(_open(row["impacts"]), "<u4").astype(np.int32)
    packed, n = np.frombuffer(_open(row["bits"]), np.uint8), len(impacts)
    size = -(-n // 8)
    levels = max(0, row["n_docs"] - 1).bit_length()
    bits = [np.unpackbits(packed[i * size : (i + 1) * size], count=n) for i in range(levels)]
    return Shard(np.frombuffer(_open(row["ids"]), "<i8"), terms, counts, impacts, bits)


STORED = "shard long, n_docs long, ids binary, terms binary, counts binary, impacts binary, bits binary"


def _builder(n_docs: int, n_terms: int, most_docs: int, most_bytes: int):
    @released
    def run(batches):
        ids, texts, size = [], [], 0
        # shards of a task have numbers of their own
        number = TaskContext.get().partitionId() << 32

        def shard():
            nonlocal ids, texts, size, number
            row = {"shard": number} | build(ids, texts, n_docs, n_terms)
            ids, texts, size, number = [], [], 0, number + 1
            release()
            return pa.RecordBatch.from_pydict({c: pa.array([row[c]], pa.binary() if kind == "binary" else pa.int64()) for c, kind in (x.split(" ") for x in STORED.split(", "))})

        for b in batches:
            for i, value in zip(b.column("id").to_pylist(), _utf8(b.column("text")), strict=True):
                text = value.as_py()
                ids.append(i)
                texts.append(text)
                size += len(text or b"")
                if len(ids) >= most_docs or size >= most_bytes:
                    yield shard()
        if ids:
            yield shard()

    return run


class Index:
    """A written index: a row for each shard, and the numbers of the whole table that scores need."""

    def __init__(self, shards: DataFrame, n_docs: int, n_terms: int):
        self.shards, self.n_docs, self.n_terms = shards, n_docs, n_terms

    @classmethod
    def write(cls, docs: DataFrame, work: Scratch, id_col: str = "doc_id", text_col: str = "text", most_docs: int = SHARD_DOCS, most_bytes: int = SHARD_BYTES) -> Index:
        if not 0 < most_docs <= 1 << DOC_BITS:
            raise ValueError("a shard has 1 to 65,536 documents")
        rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        # two numbers
        n = rows.select("text").mapInArrow(_lengths, "docs long, terms long").agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).first()
        n_docs, n_terms = n["docs"] or 0, n["terms"] or 0
        return cls(work.save(rows.mapInArrow(_builder(n_docs, n_terms, most_docs, most_bytes), STORED), "shards"), n_docs, n_terms)

    def frequencies(self, wanted: list[bytes]) -> dict[bytes, int]:
        """Of each wanted term the documents that hold it."""
        if not wanted:
            return {}

        @released
        def run(batches):
            for b in batches:
                for row in b.to_pylist():
                    terms, counts = _dictionary(row)
                    at = [bisect.bisect_left(terms, t) for t in wanted]
                    held = [(k, int(counts[i])) for k, i in enumerate(at) if i < len(terms) and terms[i] == wanted[k]]
                    yield pa.RecordBatch.from_pydict({"k": pa.array([k for k, _ in held], pa.int64()), "n": pa.array([n for _, n in held], pa.int64())})

        found = self.shards.select("terms", "counts").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
        # one number for each term of a block of items
        return {wanted[r["k"]]: r["n"] for r in found.collect()}

    def search(self, items: list[tuple], k: int = 20) -> DataFrame:
        """(item, rank, doc_id, score): the k best documents of each of some items, (number, text); a block of ``ITEMS`` or so."""
        counted = [(i, Counter(terms_of((text or "").encode("utf-8", "surrogatepass")))) for i, text in items]
        wanted = sorted({t for _, c in counted for t in c})
        df = self.frequencies(wanted)
        weight = {t: int(np.floor(1000 * np.log((2 * self.n_docs + 2) / (2 * n + 1)))) for t, n in df.items()}
        asked = [(i, {t: n * weight[t] for t, n in c.items() if weight.get(t, 0) > 0}) for i, c in counted]

        @released
        def run(batches):
            best: dict[int, list[tuple[int, int]]] = {}
            for b in batches:
                for row in b.to_pylist():
                    shard = load(row)
                    runs = shard.runs(wanted)
                    for item, weights in asked:
                        own = [(runs[t], w) for t, w in weights.items() if t in runs]
                        if own:
                            kept = best.get(item, [])
                            floor = kept[-1][1] if len(kept) == k else 0
                            new = shard.best([r for r, _ in own], np.array([w for _, w in own], np.int64), k, floor)
                            # by falling score, then ascending doc_id
                            best[item] = sorted([*kept, *((int(shard.ids[d]), s) for s, d in new)], key=lambda x: (-x[1], x[0]))[:k]
                    del shard
                    release()
            flat = [(item, d, s) for item, rows in best.items() for d, s in rows]
            yield pa.RecordBatch.from_pydict({"item": pa.array([x[0] for x in flat], pa.int64()), "doc_id": pa.array([None if x[1] == NO_ID else x[1] for x in flat], pa.int64()), "score": pa.array([x[2] for x in flat], pa.int64())})

        local = self.shards.mapInArrow(run, "item long, doc_id long, score long")
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        return local.withColumn("rank", rank).where(F.col("rank") <= k).select("item", "rank", "doc_id", "score")


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list]:
    """The items in blocks of ``ITEMS``, which is all of them that the driver holds."""
    block: list = []
    for r in items.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).toLocalIterator():
        block.append((r["id"], r["text"]))
        if len(block) == ITEMS:
            yield block
            block = []
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", **shards) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents for each item, in passes over the index of ``ITEMS`` items each."""
    spark = docs.sparkSession
    work = Scratch(spark, "lexical")
    index = Index.write(docs, work, id_col, text_col, **shards)
    kind = items.schema[item_col].dataType.simpleString()
    out = None
    for block in _blocks(items, item_col, item_text):
        found = index.search([(n, text) for n, (_, text) in enumerate(block)], k)
        # at most ITEMS rows
        names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(block)], f"item long, item_id {kind}")
        own = found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = own if out is None else out.unionByName(own)
    return out if out is not None else spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP13_SQL = r"""
with t as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents
), d as (select doc_id, count(*) as n from t group by doc_id
), g as (select count(*) as docs, sum(n)::bigint as terms from d
), p as (select doc_id, term, count(*) as tf from t group by all
), w as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from p, g group by term, docs
), q as (
  select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark
), s as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::bigint as score
  from q join p using (term) join w using (term) join d using (doc_id), g group by item_id, doc_id
)
select item_id, rank::int as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from s where score > 0)
where rank <= 20
"""
