"""Clusters of documents by the phrases they share, labelled by phrase: suffix-tree clustering as joins and counts.

A phrase is up to ``most_words`` words in a row within a sentence. All phrases that occur in exactly the same documents
are one base, named by the longest of them; in a suffix tree these are the phrases along one edge. Of several longest ones
that with most telling words names it, then the first; a word of more than ``common_percent`` of the documents tells
nothing. A base's score is its documents by its weight: 1 for one telling word, twice their number for more. Of the bases
the ``most_bases`` with the highest scores are taken, as the method has it. Two of them belong together if each shares more
than half of its documents with the other, and what hangs together is a cluster. A document may be in several clusters or
in none.

Null texts and texts without words have no phrases. Rows of one id are one document, null ids too. Phrases are counted by
their number of words and a 64-bit hash, sets of documents are compared by their number and two 64-bit sums of hashes.
"""

from __future__ import annotations

import re
from functools import reduce
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capturelake.scratch import Scratch, freed, ship

MARKS = ".!?\n"
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[.!?\n]")
PIECE = 100_000  # words and marks that are held at once, of one long text or of many short ones
MOST_BASES = 4096  # the counts of two bases are a matrix in each task
MOST_WORDS = 4_000_000  # a sieve of hashes has at most as many 64-bit words, 32 MB
BLOCK = 1_000_000  # hashes of phrases whose words one pass looks up
SHARES = 2  # phrases of a length are shuffled in as many shares of their hashes, one after another
SMALL = 1_000_000  # all lengths are counted at once for fewer words
DICTIONARY = 16 << 20  # bytes of the Parquet dictionary of a file's hashes, so that a hash that repeats takes few bytes
BASE = "base int, phrase string, n_words int, n_docs long, score long"


def hashes(words: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(words, object)) if words else np.zeros(0, np.uint64)


def _longer(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase and one word more."""
    return (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + word


def phrase_hash(phrase: str) -> int:
    h = hashes(phrase.split(" "))
    out = h[:1]
    for w in h[1:]:
        out = _longer(out, np.array([w]))
    return int(out.view(np.int64)[0])


def _within(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which hashes are among sorted ones."""
    return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h if len(known) else np.zeros(len(h), bool)


def _sieve(rows: DataFrame):
    """A broadcast of bits, one in 16 set by the hashes g of rows, or more if they are many: a hash whose bit is unset is not among them."""
    size = 64 * min(MOST_WORDS, rows.count() // 4 + 1)
    at = F.pmod("g", F.lit(size))
    bits = np.zeros(size // 64, np.int64)
    found = rows.select(F.shiftright(at, 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(pmod(g, {size}L), 64) as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    bits[found["word"].to_numpy()] = found["bit"].to_numpy()
    return rows.sparkSession.sparkContext.broadcast(bits)


def _sieved(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which hashes have their bit set."""
    at = h.view(np.int64) % (64 * len(bits))
    return (bits[at >> 6] >> (at & 63)) & 1 == 1


def _held(batches, most_words: int):
    """(ids, row of each token, tokens) in pieces of about PIECE tokens; what a piece ends with begins the next one of its text."""
    rows, tokens, ids = [], [], []
    for batch in batches:
        for i, text in enumerate(batch.column(1)):
            text = text.as_py() or ""
            found, tail = iter(TOKEN.findall(text)) if len(text) <= PIECE else (m.group() for m in TOKEN.finditer(text)), []
            while some := list(islice(found, PIECE)):
                tokens += [*tail, *some, "."]
                rows.append(len(tail) + len(some) + 1)
                ids.append(batch.column(0).slice(i, 1))
                tail = [*tail, *some][len(tail) + len(some) - most_words + 1 :] if most_words > 1 else []
                if len(tokens) >= PIECE:
                    yield pa.concat_arrays(ids), np.repeat(np.arange(len(ids)), rows), tokens
                    rows, tokens, ids = [], [], []
    if tokens:
        yield pa.concat_arrays(ids), np.repeat(np.arange(len(ids)), rows), tokens


def _phrases(most_words: int, common: np.ndarray, wanted=None, words=None, pairs=None, least: int = 1):
    """(id, n, e, g) of all phrases: words, telling words, hash; with ``wanted``, a broadcast of sorted hashes, only those, and their words.

    ``words`` and ``pairs`` are sieves: a phrase with a word or with two words in a row that are not among them is left out.
    ``least`` is the least number of words. Of a piece, each phrase of a document is given once.
    """
    marks = hashes(list(MARKS))

    def run(batches):
        for ids, row, tokens in _held(batches, most_words):
            word = hashes(tokens)
            mark = np.isin(word, marks)
            if words is not None:
                mark |= ~_sieved(word, words.value)
                mark[-1] = True
            at = np.arange(len(word))
            left = np.flatnonzero(mark)[np.cumsum(mark) - mark] - at  # words up to the next mark; the last token is one
            if pairs is not None:
                # words up to the end of the first pair that is not among them, but for its last word
                gap = np.append(~_sieved(_longer(word[:-1], word[1:]), pairs.value), True)
                left = np.minimum(left, np.flatnonzero(gap)[np.cumsum(gap) - gap] - at + 1)
            telling = np.append(0, np.cumsum(~np.isin(word, common) & ~mark))
            h = word
            for n in range(1, most_words + 1):
                if n > 1:
                    h = _longer(h[: len(word) - n + 1], word[n - 1 :])
                if n < least:
                    continue
                here = np.flatnonzero(left[: len(h)] >= n)
                g = h[here].view(np.int64)
                names = []
                if wanted is not None:
                    hit = _within(h[here], wanted.value)
                    here, g = here[hit], g[hit]
                    names = [pa.array([" ".join(tokens[i : i + n]) for i in here], pa.string())]
                else:
                    # rows ascend with places, so equal phrases of a row are neighbours in a stable order
                    order = np.argsort(g, kind="stable")
                    same = (g[order][1:] == g[order][:-1]) & (row[here[order]][1:] == row[here[order]][:-1])
                    first = order[np.append(True, ~same)] if len(order) else order
                    here, g = here[first], g[first]
                if len(here):
                    e = (telling[here + n] - telling[here]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(row[here])), pa.array(np.full(len(here), n, np.int32)), pa.array(e), pa.array(g), *names], ["id", "n", "e", "g", "phrase"][: 4 + len(names)])

    return run


def _hashed(most_words: int, words):
    """(id, words) of pieces of texts: hashes of the words that a sieve lets through, 0 for whatever lies between them, and at the end."""
    marks = hashes(list(MARKS))

    def run(batches):
        for ids, row, tokens in _held(batches, most_words):
            word = hashes(tokens)
            word[np.isin(word, marks) | ~_sieved(word, words.value)] = 0
            last = np.append(row[1:] != row[:-1], True)
            word[last] = 0
            # one 0 for several; a text without words that count gives no row
            keep = (word != 0) | np.append(False, word[:-1] != 0)
            word, row = word[keep], row[keep]
            at = np.append(np.flatnonzero(np.diff(row, prepend=-1)), len(row)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(row[at[:-1]])), pa.ListArray.from_arrays(pa.array(at), pa.array(word.view(np.int64)))], ["id", "words"])

    return run


def _of_lengths(lengths: list[int], common: np.ndarray, parts=None, share: int = 0, shares: int = 1):
    """(id, n, e, g) of the phrases of these lengths in rows of ``_hashed``, of the hashes of one share.

    With one length and a sieve ``parts``, a phrase with a part of one word less that is not among them is left out. Of a piece, each
    phrase of a document is given once.
    """

    def run(batches):
        for batch in batches:
            lists, at = batch.column(1), 0
            bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            every = lists.flatten().to_numpy().view(np.uint64)
            while at < len(lists):
                to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + PIECE, "right")) - 1)
                word, row = every[bounds[at] : bounds[to]], np.repeat(np.arange(at, to), np.diff(bounds[at : to + 1]))
                at, h = to, word
                gaps, telling = (np.append(0, np.cumsum(x)) for x in (word == 0, ~np.isin(word, common)))
                for n in range(2, min(lengths[-1], len(word)) + 1):
                    known = _sieved(h, parts.value) if parts is not None and n == lengths[-1] else None
                    h = _longer(h[:-1], word[n - 1 :])
                    if n not in lengths:
                        continue
                    here = gaps[n:] == gaps[:-n]
                    here = np.flatnonzero(here if known is None else here & known[:-1] & known[1:])
                    here = here[h[here] % np.uint64(shares) == share]
                    g = h[here].view(np.int64)
                    # rows ascend with places, so equal phrases of a row are neighbours in a stable order
                    order = np.argsort(g, kind="stable")
                    g, here = g[order], here[order]
                    first = np.append(True, (g[1:] != g[:-1]) | (row[here[1:]] != row[here[:-1]]))[: len(g)]
                    g, here = g[first], here[first]
                    e = (telling[here + n] - telling[here]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row[here])), pa.array(np.full(len(here), n, np.int32)), pa.array(e), pa.array(g)], ["id", "n", "e", "g"])

    return run


def _texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.lower(F.col(text_col).cast("string")).alias("text")).where("text is not null")
    return rows, f"id {rows.schema['id'].dataType.simpleString()}, n int, e int, g long"


def counted(docs: DataFrame, id_col: str, text_col: str, most_words: int = 6, least_docs: int = 3, common: np.ndarray | None = None, words=None, pairs=None, least: int = 1) -> DataFrame:
    """(n, e, g, n_docs, x, y) of the phrases of least_docs documents or more; x and y stand for the set of documents.

    Phrases are shuffled once, by their hash, and a document counts once by (phrase, id). A phrase has at most as many rows as there
    are documents, of a piece one for each, while a task gets all phrases of its hashes, so a frequent phrase is no hot key.
    """
    rows, schema = _texts(docs, id_col, text_col)
    found = rows.mapInArrow(_phrases(most_words, np.zeros(0, np.uint64) if common is None else common, words=words, pairs=pairs, least=least), schema)
    return _counted(found, most_words, least_docs)


def _counted(found: DataFrame, most_words: int, least_docs: int) -> DataFrame:
    # n and e in one number, as each has eight bytes in a shuffled row
    once = found.select("id", (F.col("n") * (most_words + 1) + F.col("e")).alias("ne"), "g").repartition("g").distinct()
    n = once.groupBy("g", "ne").agg(F.count("*").alias("n_docs"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("y"))
    ne = F.floor(F.col("ne") / (most_words + 1)).cast("int").alias("n"), (F.col("ne") % (most_words + 1)).cast("int").alias("e")
    return n.where(F.col("n_docs") >= least_docs).select(*ne, "g", "n_docs", "x", "y")


def looked_up(docs: DataFrame, id_col: str, text_col: str, most_words: int, wanted: np.ndarray) -> DataFrame:
    """(id, phrase) of the phrases with these unsigned hashes, perhaps more than once for a document."""
    rows, schema = _texts(docs, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(np.sort(wanted))
    return rows.mapInArrow(_phrases(most_words, np.zeros(0, np.uint64), sent), f"{schema}, phrase string").drop("e")


def _column(rows: DataFrame) -> np.ndarray:
    return rows.select("g").toArrow()["g"].to_numpy().view(np.uint64)


def bases(docs: DataFrame, id_col: str, text_col: str, most_words: int = 6, least_docs: int = 3, common_percent: int = 40, most_bases: int = 500) -> DataFrame:
    """(base, phrase, n_words, n_docs, score) of the best bases, numbered from 1 by falling score, ties by phrase.

    Words are counted first. The hashes of those of enough documents are written in the order of the texts, and from them pairs are
    counted, then one length after another, of which each phrase is made of two of enough documents: a phrase has at most the
    documents of its parts. A length is counted in SHARES of its hashes; what a share shuffled is deleted before the next.
    Of fewer than SMALL words all lengths are counted at once.

    The driver gets the hashes of common words, which are at most 100 / common_percent times the mean number of different words
    of a document, a sieve of each length of up to 32 MB, the hashes of the phrases that can be among the best, BLOCK at a time, and most_bases rows.
    """
    if not 0 < most_bases <= MOST_BASES:
        raise ValueError(f"most_bases is {most_bases}, not 1 to {MOST_BASES}")
    with freed(docs.sparkSession):
        return _bases(docs, id_col, text_col, most_words, least_docs, common_percent, most_bases)


def _bases(docs: DataFrame, id_col: str, text_col: str, most_words: int, least_docs: int, common_percent: int, most_bases: int) -> DataFrame:
    spark, work = docs.sparkSession, Scratch(docs.sparkSession, "phrases")
    total = docs.select(id_col).distinct().count()
    words = work.save(counted(docs, id_col, text_col, 1, least_docs), "words")
    is_common = F.col("n_docs") * 100 > F.lit(total) * common_percent
    common = _column(words.where(is_common))
    found, sieve, names = words.withColumn("e", F.when(is_common, 0).otherwise(1)), _sieve(words), ["words"]
    if most_words > 1:
        rows, schema = _texts(docs, id_col, text_col)
        hashed = rows.mapInArrow(_hashed(most_words, sieve), f"id {rows.schema['id'].dataType.simpleString()}, words array<long>")
        texts = work.save(hashed, "texts", **{"parquet.dictionary.page.size": DICTIONARY})
        small = (texts.agg(F.sum(F.size("words"))).first()[0] or 0) < SMALL
        for lengths in [[*range(2, most_words + 1)]] if small else [[n] for n in range(2, most_words + 1)]:
            parts, shares = [], 1 if small else SHARES
            for i in range(shares):
                some = texts.mapInArrow(_of_lengths(lengths, common, sieve if lengths[0] > 2 else None, i, shares), schema)
                names.append(f"length{lengths[0]}_{i}")
                parts.append(work.save(_counted(some, most_words, least_docs), names[-1]))
            part = reduce(DataFrame.unionByName, parts)
            found = found.unionByName(part)
            if lengths[-1] < most_words:
                sieve.destroy()
                sieve = _sieve(part)
        work.drop("texts")
    sieve.destroy()
    sets = found.groupBy("n_docs", "x", "y").agg(F.max(F.struct("n", "e")).alias("top")).select("n_docs", "x", "y", "top.n", "top.e")
    sets = sets.withColumn("score", F.col("n_docs") * F.when(F.col("e") > 1, F.col("e") * 2).otherwise(F.col("e"))).where("score > 0")
    least = sets.select("score").orderBy(F.desc("score")).limit(most_bases).agg(F.min("score")).first()[0]
    if least is None:
        return spark.createDataFrame([], BASE)
    kept = work.save(found.join(sets.where(F.col("score") >= least), ["n_docs", "x", "y", "n", "e"]), "kept")
    blocks, best = -(-kept.count() // BLOCK), None
    for b in range(blocks):
        some = kept.where(F.pmod(F.xxhash64("g"), F.lit(blocks)) == b)
        met = looked_up(docs, id_col, text_col, most_words, _column(some)).select("n", "g", "phrase").distinct()
        met = work.save(met, f"names{b}")
        best = met if best is None else best.unionByName(met)
    named = kept.join(best, ["n", "g"]).groupBy("n_docs", "x", "y", "n", "score").agg(F.min("phrase").alias("phrase"))
    rows = named.orderBy(F.desc("score"), "phrase").limit(most_bases).select("phrase", "n", "n_docs", "score").collect()
    work.drop(*names, "kept", *(f"names{b}" for b in range(blocks)))
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows, 1)], BASE)


def members(docs: DataFrame, found: DataFrame, id_col: str, text_col: str, most_words: int = 6) -> DataFrame:
    """(id, base) once for each document that has a base's phrase; bases are at most MOST_BASES rows and broadcast."""
    wanted = np.array([phrase_hash(r["phrase"]) for r in found.select("phrase").collect()], np.int64).view(np.uint64)
    if not len(wanted):
        return docs.select(F.col(id_col).alias("id"), F.lit(0).alias("base")).limit(0)
    met = looked_up(docs, id_col, text_col, most_words, wanted).join(F.broadcast(found.select("base", "phrase")), "phrase")
    return met.select("id", "base").distinct()


def _together(size: int):
    """Counts of the documents that two bases share, added up in a task as one matrix."""

    def run(batches):
        both = np.zeros((size, size), np.int64)
        for batch in batches:
            lists = batch.column(0)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            has = np.zeros((len(lists), size), np.float32)
            has[np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())), flat - 1] = 1
            both += np.rint(has.T @ has).astype(np.int64)
        a, b = np.nonzero(np.triu(both, 1))
        for at in range(0, len(a), 50_000):
            i, j = a[at : at + 50_000], b[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(i + 1, pa.int32()), pa.array(j + 1, pa.int32()), pa.array(both[i, j])], ["a", "b", "n"])

    return run


def merged(belongs: DataFrame, found: DataFrame) -> DataFrame:
    """(base, cluster): the least base of those that hang together by shares of more than half. Both sides are at most MOST_BASES rows."""
    sizes = {r["base"]: r["n_docs"] for r in found.select("base", "n_docs").collect()}
    of = {b: b for b in sizes}

    def root(b: int) -> int:
        while of[b] != b:
            of[b] = of[of[b]]
            b = of[b]
        return b

    if sizes:
        lists = belongs.groupBy("id").agg(F.collect_list("base").alias("bases")).select("bases")
        n = lists.mapInArrow(_together(max(sizes)), "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
        side = lambda c: F.broadcast(found.select(F.col("base").alias(c), F.col("n_docs").alias(f"of_{c}")))
        for r in n.join(side("a"), "a").join(side("b"), "b").where("2 * n > of_a and 2 * n > of_b").select("a", "b").collect():
            a, b = root(r["a"]), root(r["b"])
            of[max(a, b)] = min(a, b)
    return found.sparkSession.createDataFrame([(b, root(b)) for b in sizes], "base int, cluster int")


def clusters(docs: DataFrame, id_col: str, text_col: str, most_words: int = 6, **more) -> DataFrame:
    """(id, cluster, label, n_bases): a document's clusters with the phrase of the best base, and how many of its bases the document has.

    ``more`` are the parameters of ``bases``. Besides what that reads, texts are read once more for the members.
    """
    found = bases(docs, id_col, text_col, most_words, **more)
    work = Scratch(docs.sparkSession, "clusters")
    with freed(docs.sparkSession):
        belongs = work.save(members(docs, found, id_col, text_col, most_words), "members")
        of = merged(belongs, found)
    names = found.select(F.col("base").alias("cluster"), F.col("phrase").alias("label"))
    n = belongs.join(F.broadcast(of), "base").groupBy("id", "cluster").agg(F.count("*").alias("n_bases"))
    return n.join(F.broadcast(names), "cluster").select("id", "cluster", "label", "n_bases")
