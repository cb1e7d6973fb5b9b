"""Benchmark decontamination by SimHash of item-sized windows.

Method. Texts are read as words without ASCII punctuation and without case. An item
of n words is compared with windows of n words of every document (with its whole text
where it is shorter), by the weighted k-word shingles of both: a shingle weighs its
occurrences times its rarity over the items. A window's SimHash is the sign of the
weighted sum of its shingles' bits. Fingerprints of the items are cut into ``BLOCKS``
blocks; by the pigeonhole principle a fingerprint within ``RADIUS`` bits agrees with
an item's in some block up to RADIUS // BLOCKS bits, and the block tables list for
every value all items that near, so no fingerprint within the radius is missed.
Candidates within the radius are verified by the exact weighted Jaccard similarity of
their shingles.

At this radius blocks alone hardly tell items apart, so the tables of a slice of text hold
only the items that it can match: a similarity of t needs shared shingles of t times the
item's weight, so a window must have one of the item's rarest shingles, those left when
the others weigh less than that. Only windows that reach such a shingle are fingerprinted.
That drops no match.

Bounds. Items go to every task in blocks of ``MOST_ITEMS`` (about 10 KB an item); each
block is one pass over the documents, without a shuffle, and the rarity of shingles is
counted over all items. Of several blocks, one is made, sent, used and given back before
the next: its matches, or the documents that it leaves, are written in between. So memory
is bounded by one block of items, a slice of text and ``PAIRS`` candidates.

Cases. Null and empty texts match nothing; items without words are no items; an item of
fewer than k words has one shingle, its whole sequence, found at windows of its length.
Repeated items and rows each give their own matches. A null id stays null. Of equally
similar windows the first counts. Extra columns are ignored; empty tables give an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capturelake.llm import split
from capturelake.llm import text as tx
from capturelake.scratch import Scratch, ship

BITS, BLOCKS, RADIUS = 64, 8, 19
MOST_ITEMS = 20_000
PAIRS = 1 << 20
_SHIFT = np.arange(BITS, dtype=np.uint64)


def simhash(sums: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of 64 weighted sums."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64)[:, 0]


def signs(hashes: np.ndarray) -> np.ndarray:
    """The 64 bits of each hash as -1 or 1."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.float32) * 2 - 1


def words_of(column) -> tuple[tx.Words, int]:
    buf, offs = tx.plain(*tx.string_bytes(column))
    return tx.Words(buf, offs, lower=False), len(offs) - 1


def item_shingles(texts: list, k: int) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(place, words, shingles, their counts) of every text that has words."""
    words, rows = words_of(pa.array(texts, pa.large_string()))
    bounds, out = words.bounds(rows), []
    for row in range(rows):
        h = words.hash[bounds[row] : bounds[row + 1]]
        if len(h):
            out.append((row, len(h), *np.unique(tx.windows(h, min(k, len(h))), return_counts=True)))
    return out


class Items:
    """A block of the benchmark as arrays: shingles, weights, fingerprints. Picklable."""

    def __init__(self, ids: list, texts: list, k: int, least: float, spread: tuple[np.ndarray, np.ndarray] | None = None, total: int | None = None):
        """spread: shingles in order and the items that have them, total: all items; by default those of this block."""
        found = item_shingles(texts, k)
        self.k, self.ids = k, [ids[row] for row, *_ in found]
        self.size = np.array([n for _, n, *_ in found], np.int64)
        self.grams, self.gram_counts = [x[2] for x in found], [x[3] for x in found]
        if spread is None:
            spread = np.unique(np.concatenate(self.grams), return_counts=True) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        total = len(found) if total is None else total
        self.known, count = spread
        self.rarity = (1 + np.log((1 + total) / (1 + count))).astype(np.float32)
        self.other = np.float32(1 + np.log(1 + total))  # of shingles that no item has
        self.at_known = tx.Table(self.known)
        self.weight = [n * self.rarity[self.at_known.find(g)] for g, n in zip(self.grams, self.gram_counts, strict=True)]
        self.print = simhash(np.stack([w @ signs(g) for g, w in zip(self.grams, self.weight, strict=True)])) if found else np.zeros(0, np.uint64)
        self.width = BITS // BLOCKS
        near = [sum(1 << b for b in bits) for r in range(RADIUS // BLOCKS + 1) for bits in combinations(range(self.width), r)]
        self.near = np.array(near, np.uint64)
        # the rarest shingles of each item, by the length of its shingles
        lists: dict[int, list[tuple[np.ndarray, int]]] = {}
        for i, (g, w) in enumerate(zip(self.grams, self.weight, strict=True)):
            order = np.lexsort((g, -self.rarity[self.at_known.find(g)]))
            rest = w.sum() - np.cumsum(w[order])
            # a little less, so that rounding drops nothing
            prefix = g[order][: int(np.argmax(rest < least * w.sum() * (1 - 1e-4))) + 1]
            lists.setdefault(min(k, int(self.size[i])), []).append((prefix, i))
        self.rare = {}
        for length, some in lists.items():
            g = np.concatenate([x for x, _ in some])
            who = np.repeat([i for _, i in some], [len(x) for x, _ in some])
            order = np.lexsort((who, g))
            u, first, n = np.unique(g[order], return_index=True, return_counts=True)
            self.rare[length] = (tx.Table(u), first, n, who[order])

    def tables(self, items: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each block, sorted (value, item) of all values near enough to an item's."""
        out = []
        for b in range(BLOCKS):
            value = (self.print[items] >> np.uint64(b * self.width)) & np.uint64((1 << self.width) - 1)
            values = (value[:, None] ^ self.near[None, :]).ravel()
            who = np.repeat(items, len(self.near))
            order = np.argsort(values, kind="stable")
            out.append((values[order], who[order]))
        return out

    def candidates(self, prints: np.ndarray, tables: list) -> tuple[np.ndarray, np.ndarray]:
        """All (window, item) within RADIUS, by the block tables."""
        pairs = []
        for b, (values, who) in enumerate(tables):
            value = (prints >> np.uint64(b * self.width)) & np.uint64((1 << self.width) - 1)
            lo, hi = np.searchsorted(values, value, "left"), np.searchsorted(values, value, "right")
            item, _ = split.gather(who, lo, hi - lo)
            window = np.repeat(np.arange(len(prints)), hi - lo)
            close = np.bitwise_count(prints[window] ^ self.print[item]) <= RADIUS
            pairs.append(window[close].astype(np.int64) * len(self.ids) + item[close])
        found = np.unique(np.concatenate(pairs))
        return found // len(self.ids), found % len(self.ids)

    def similarity(self, grams: np.ndarray, item: int) -> float:
        """Exact weighted Jaccard similarity of a window's shingles and an item's."""
        g, n = np.unique(grams, return_counts=True)
        at = self.at_known.find(g)
        w = n * np.where(at >= 0, self.rarity[at], self.other)
        mine, own = self.grams[item], self.weight[item]
        here = tx.lookup(mine, g)
        both = here >= 0
        low = np.minimum(w[both], own[here[both]]).sum()
        total = w.sum() + own.sum() - low
        return float(low / total) if total else 0.0


def _search(items, least: float, text: str = "text", at_column: int = 1, only: bool = False):
    """Matches of the text column; with ``only`` instead the rows that have none."""

    def run(batches):
        it = items.value
        for batch in batches:
            for part in tx.slices(batch, text):
                words, rows = words_of(part.column(at_column))
                found = [f for length in sorted(it.rare) for f in _found(it, words, words.bounds(rows), length, least)]
                if found and only:
                    yield part.filter(pa.array(~np.isin(np.arange(rows), [f[0] for f in found])))
                elif only:
                    yield part
                elif found:
                    ids = part.column(0).to_pylist()
                    yield pa.RecordBatch.from_pylist(
                        [{"id": ids[d], "item": it.ids[i], "first_word": int(a), "n_words": int(n), "distance": int(r), "similarity": s} for d, i, a, n, r, s in found],
                        pa.schema([("id", pa.int64()), ("item", pa.int64()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("distance", pa.int32()), ("similarity", pa.float64())]),
                    )

    return tx.released(run)


def _found(it: Items, words: tx.Words, first: np.ndarray, length: int, least: float):
    """Matches of items whose shingles have this length."""
    grams = tx.windows(words.hash, length)
    table, where, count, who = it.rare[length]
    hit = table.find(grams)
    at = np.flatnonzero(hit >= 0)
    at = at[words.doc[at] == words.doc[at + length - 1]]
    if not len(at):
        return
    item, _ = split.gather(who, where[hit[at]], count[hit[at]])
    at = np.repeat(at, count[hit[at]])
    size = it.size[item]
    for n in np.unique(size).tolist():
        here, own = at[size == n], np.unique(item[size == n])
        # first words of the windows that reach a rare shingle, as few runs
        lo, hi = first[words.doc[here]], first[words.doc[here] + 1]
        a = np.where(hi - lo <= n, lo, np.maximum(lo, here + length - n))
        b = np.where(hi - lo <= n, lo, np.minimum(here, hi - n))
        order = np.argsort(a, kind="stable")
        a, b = a[order], np.maximum.accumulate(b[order])
        cuts = np.flatnonzero(a[1:] > b[:-1] + 1) + 1
        a, b = a[np.append(0, cuts)], b[np.append(cuts, len(b)) - 1]
        begin, _ = split.gather(np.arange(len(words)), a, b - a + 1)
        doc = words.doc[begin]
        end = np.minimum(begin + n, first[doc + 1])
        yield from _windows(it, grams, begin, end - length + 1, n, own, doc, first, least)


def _windows(it, grams, begin, end, size, items, doc, first, least):
    """Matches of windows grams[begin:end] with some items of this size: the best window of each document and item."""
    best: dict[tuple[int, int], tuple] = {}
    tables, step = it.tables(items), max(1, min(4096, PAIRS // len(items)))
    for at in range(0, len(begin), step):
        b, e = begin[at : at + step], end[at : at + step]
        # sums over each run of overlapping windows, so that a long text costs what its windows cost
        cuts = np.flatnonzero(b[1:] > np.maximum.accumulate(e)[:-1]) + 1
        prints = np.empty(len(b), np.uint64)
        for lo, hi in zip(np.append(0, cuts), np.append(cuts, len(b)), strict=True):
            g = grams[b[lo] : e[lo:hi].max()]
            known = it.at_known.find(g)
            w = np.where(known >= 0, it.rarity[known], it.other)
            sums = np.concatenate([np.zeros((1, BITS), np.float64), np.cumsum(signs(g) * w[:, None], axis=0, dtype=np.float64)])
            prints[lo:hi] = simhash(sums[e[lo:hi] - b[lo]] - sums[b[lo:hi] - b[lo]])
        for w, i in zip(*it.candidates(prints, tables), strict=True):
            s = it.similarity(grams[b[w] : e[w]], int(i))
            if s >= least:
                d = int(doc[at + w])
                match = (-s, int(b[w] - first[d]))
                if (d, int(i)) not in best or match < best[d, int(i)][:2]:
                    best[d, int(i)] = (*match, int(e[w] - b[w]) + min(it.k, size) - 1, int(np.bitwise_count(prints[w] ^ it.print[i])))
    return [(d, i, m[1], m[2], m[3], -m[0]) for (d, i), m in best.items()]


def _spread(k: int):
    """The different shingles of every item, and an empty one for the item itself: g."""

    def run(batches):
        for batch in batches:
            found = item_shingles(batch.column(0).to_pylist(), k)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[2] for x in found]).view(np.int64)), pa.array(np.full(sum(len(x[2]) for x in found), 0, np.int32))], ["g", "items"])
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(1, np.int64)), pa.array(np.array([len(found)], np.int32))], ["g", "items"])

    return tx.released(run)


def sent_items(benchmark: DataFrame, shingle_words: int, least: float, item_col: str, item_text: str) -> Iterator[tuple[Broadcast, int]]:
    """The items as one broadcast for each block, and the number of blocks. A block is made when it is asked for."""
    spark = benchmark.sparkSession
    ship(spark)
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text).cast("string").alias("text")).where("text is not null")
    n = items.count()
    if n <= MOST_ITEMS:
        got = items.toArrow()
        yield spark.sparkContext.broadcast(Items(got["item"].to_pylist(), got["text"].to_pylist(), shingle_words, least)), 1
        return
    work = Scratch(spark, "decontam")
    items = work.save(items.withColumn("row", F.monotonically_increasing_id()), "items")
    counts = work.save(items.select("text").mapInArrow(_spread(shingle_words), "g long, items int").groupBy("g").agg(F.sum("items").alias("items"), F.count_if(F.col("items") == 0).alias("n")), "spread")
    total = counts.agg(F.sum("items")).first()[0] or 0
    blocks = -(-2 * n // MOST_ITEMS)
    # by a digest, with room for uneven blocks
    block = F.pmod(F.xxhash64("row"), F.lit(blocks))
    for b in range(blocks):
        some = items.where(block == b)
        got = some.toArrow()
        own = some.select("text").mapInArrow(_spread(shingle_words), "g long, items int").where("items = 0").select("g").distinct()
        spread = counts.join(F.broadcast(own), "g").where("n > 0").select("g", "n").toArrow()
        g, count = spread["g"].to_numpy().view(np.uint64), spread["n"].to_numpy()
        order = np.argsort(g)
        yield spark.sparkContext.broadcast(Items(got["item"].to_pylist(), got["text"].to_pylist(), shingle_words, least, (g[order], count[order]), total)), blocks


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, shingle_words: int = 5, id_col="doc_id", text_col="text", item_col="item_id", item_text="text") -> DataFrame:
    """(id, item, first_word, n_words, distance, similarity): the best window of each document for each item it holds."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    work, out = Scratch(docs.sparkSession, "matches"), None
    for i, (items, blocks) in enumerate(sent_items(benchmark, shingle_words, similarity, item_col, item_text)):
        found = texts.mapInArrow(_search(items, similarity), "id long, item long, first_word long, n_words long, distance int, similarity double")
        if blocks > 1:
            found = work.save(found, f"block{i}")
            items.destroy()
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, shingle_words: int = 5, text_col="text", item_col="item_id", item_text="text") -> DataFrame:
    """The rows of docs that hold no item, unchanged; in one pass without a shuffle for each block of items."""
    work = Scratch(docs.sparkSession, "clean")
    for i, (items, blocks) in enumerate(sent_items(benchmark, shingle_words, similarity, item_col, item_text)):
        docs = docs.mapInArrow(_search(items, similarity, text_col, docs.columns.index(text_col), only=True), docs.schema)
        if blocks > 1:
            docs = work.save(docs, f"block{i}")
            items.destroy()
            if i:
                work.drop(f"block{i - 1}")
    return docs


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    out = contaminated(docs, bench)
    return out.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "first_word", "n_words", "distance", "similarity")
