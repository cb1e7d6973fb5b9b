"""Scores from stored postings: blocks in the order of impact, of which a query reads those that can matter.

A posting's impact is the part of its BM25 score that doesn't depend on the query: tf (k1 + 1) / (tf + k1 (1 - b + b dl / mean)).
The postings of a term lie in blocks of ``BLOCK`` by falling impact, each with its largest one, in a table that is dealt and
sorted by term and level of impact, so the filters below reach row groups. What is shuffled are short lists: some batches of
documents give one for each term, and for each level of a frequent term. A term that every document has is dealt to many tasks:
tasks are ranges of (first bytes of the term, level, digest of the first id) with about as many postings each, as told by the
postings of a few documents, and no task holds a term. Lists of one term that meet in a batch are sorted together by impact.

A query for the k best first reads what it needs to know a score that k documents reach: the first blocks of each term. A
document that reaches it has, for each of its terms, a share of at least that score less the largest shares of all other terms,
so a block whose largest impact is below that is not read, and the sums over the blocks that are read are whole for all
documents that can be among the best. Ties go to the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from capturelake.scratch import Scratch, freed, ship

BLOCK = 128
LEVELS = 8  # of impacts, which are between 0 and k1 + 1
FREQUENT = 16  # postings in some batches from which on a term has a list for each level
JOINED = 1 << 21  # words whose postings are joined to lists at once
STEP = 32  # postings of the sample for each point that goes to the driver
LISTS = "term string, ids array<long>, impacts array<double>"
STORED = "term string, most double, n int, ids array<long>, impacts array<double>"


def _joined(batches):
    """Words and ids of consecutive batches with about ``JOINED`` words in all."""
    held, size = [], 0

    def taken():
        whole = tuple(map(pa.concat_arrays, zip(*held, strict=True)))
        held.clear()
        return whole

    for batch in batches:
        if batch.num_rows:
            held.append((batch.column("words"), batch.column("id")))
            size += len(held[-1][0].values)
        if size >= JOINED:
            yield taken()
            size = 0
    if held:
        yield taken()


def _lists(k1: float, b: float, mean: float):
    def run(batches):
        """Of some batches of documents a list for each term, or for each level of a frequent one, by falling impact and rising id."""
        for words, ids in _joined(batches):
            ids = ids.to_numpy()
            dl, flat, by_id = np.diff(words.offsets.to_numpy()), words.flatten(), np.argsort(ids, kind="stable")
            # rows are numbered by rising id
            row = np.empty(len(words), np.int64)
            row[by_id] = np.arange(len(words))
            row, ids, sizes = np.repeat(row, dl), ids[by_id], dl[by_id]
            if flat.null_count:
                row, flat = row[flat.is_valid().to_numpy(zero_copy_only=False)], flat.drop_null()
            if not len(flat):
                continue
            coded = flat.dictionary_encode()
            bits = len(words).bit_length()
            both, tf = np.unique(coded.indices.to_numpy().astype(np.int64) << bits | row, return_counts=True)
            term, row = both >> bits, both & (1 << bits) - 1
            impact = tf * (k1 + 1) / (tf + (k1 * (1 - b + b * sizes / mean))[row])
            # term, place of the impact and row are one number: numbers alone are sorted fast
            values = np.unique(-impact)
            deep = len(values).bit_length()
            both = (term << deep | np.searchsorted(values, -impact)) << bits | row
            both.sort()
            term, impact, own = both >> bits + deep, -values[both >> bits & (1 << deep) - 1], ids[both & (1 << bits) - 1]
            level = (impact * LEVELS / (k1 + 1)).astype(np.int32)
            begins = np.flatnonzero(np.diff(term, prepend=-1))
            frequent = np.repeat(np.diff(begins, append=len(term)) >= FREQUENT, np.diff(begins, append=len(term)))
            at = np.flatnonzero((np.diff(term, prepend=-1) != 0) | frequent & (np.diff(level, prepend=-1) != 0))
            offsets = pa.array(np.append(at, len(term)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [coded.dictionary.take(pa.array(term[at])), pa.ListArray.from_arrays(offsets, pa.array(own)), pa.ListArray.from_arrays(offsets, pa.array(impact))],
                ["term", "ids", "impacts"],
            )

    return run


def _places(lists: pa.RecordBatch, k1: float) -> np.ndarray:
    """A number for each list that grows with the first bytes of its term and with falling level; lists of one level differ by id."""
    term, first = lists.column("term").cast(pa.large_binary()), lists.column("ids").offsets.to_numpy()[:-1]
    _, offsets, raw = term.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(term) + 1, 8 * term.offset)
    raw = np.append(np.frombuffer(raw or b"", np.uint8), np.zeros(1, np.uint8))
    out = np.zeros(len(term), np.uint64)
    for k in range(6):
        at = offsets[:-1] + k
        out = out << np.uint64(8) | np.where(at < offsets[1:], raw[np.minimum(at, len(raw) - 1)], 0).astype(np.uint64)
    ids, impact = (lists.column(c).values.to_numpy()[first] for c in ("ids", "impacts"))
    level = np.minimum(impact * LEVELS / (k1 + 1), 15).astype(np.uint64)
    return out << np.uint64(16) | (np.uint64(15) - level) << np.uint64(12) | ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(52)


def _points(k1: float, b: float, mean: float):
    def run(batches):
        """The places of every ``STEP``-th posting."""
        for lists in _lists(k1, b, mean)(batches):
            place, held = _places(lists, k1), np.diff(lists.column("ids").offsets.to_numpy())
            order = np.argsort(place)
            last = np.cumsum(held[order])
            yield pa.RecordBatch.from_arrays([pa.array(place[order][np.searchsorted(last, np.arange(STEP // 2, last[-1], STEP), "right")].view(np.int64))], ["place"])

    return run


def _dealt(k1: float, b: float, mean: float, bounds: np.ndarray):
    def run(batches):
        """Lists with their task."""
        for lists in _lists(k1, b, mean)(batches):
            task = np.searchsorted(bounds, _places(lists, k1), "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([*lists.columns, pa.array(task)], [*lists.schema.names, "task"])

    return run


def _blocks(size: int):
    def run(batches):
        """Blocks of lists that are sorted by term; a block ends with its term, with its size or with its batch."""
        for b in batches:
            if not b.num_rows:
                continue
            coded = b.column("term").dictionary_encode()
            # terms are numbered as they come
            term = np.repeat(coded.indices.to_numpy(), np.diff(b.column("ids").offsets.to_numpy()))
            ids, impact = (b.column(c).flatten().to_numpy() for c in ("ids", "impacts"))
            order = np.argsort(-impact)
            # a number of two bytes is sorted in one pass
            order = order[np.argsort(term[order].astype(np.int16 if len(coded.dictionary) < 1 << 15 else np.int32), kind="stable")]
            begins = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
            place = np.arange(len(term)) - np.repeat(begins, np.diff(np.append(begins, len(term))))
            cuts = np.flatnonzero(place % size == 0)
            ids, impact, offsets = ids[order], impact[order], pa.array(np.append(cuts, len(term)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [coded.dictionary.take(pa.array(term[cuts])), pa.array(impact[cuts]), pa.array(np.diff(offsets).astype(np.int32)), pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.ListArray.from_arrays(offsets, pa.array(impact))],
                ["term", "most", "n", "ids", "impacts"],
            )

    return run


def _reaching(first: Sequence, k: int) -> float:
    """The impact down to which blocks (most, n), the largest first, hold k postings."""
    held = np.cumsum([x["n"] for x in first])
    return first[min(int(np.searchsorted(held, k)), len(first) - 1)]["most"]


class Postings:
    """Written postings; n and mean are the number of documents and their mean length."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.blocks = spark.read.schema(STORED).parquet(f"{folder}/blocks")
        self.frequencies = spark.read.schema("term string, df long").parquet(f"{folder}/terms")
        known = spark.read.schema("n long, mean double, k1 double, b double").parquet(f"{folder}/known").first()
        self.n, self.mean = known["n"], known["mean"]
        #: blocks that the last top() read, and those of its terms
        self.read, self.all = 0, 0

    @classmethod
    def write(cls, docs: DataFrame, id_col: str, words: Column, folder: str, k1: float = 1.2, b: float = 0.75, block: int = BLOCK) -> Postings:
        """Writes the postings of docs with their words (an array) to a folder; a repeated id is several documents of one number."""
        spark = docs.sparkSession
        ship(spark)
        rows = docs.select(F.col(id_col).cast("long").alias("id"), words.alias("words"))
        # two numbers
        n, mean = rows.agg(F.count("*"), F.avg(F.size("words"))).first()
        spark.createDataFrame([(n, float(mean or 1.0), k1, b)], "n long, mean double, k1 double, b double").write.parquet(f"{folder}/known")
        parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        known = k1, b, float(mean or 1.0)
        # the bounds of tasks are places of a few documents' postings, so that no other document is read for them
        share = min(1.0, (2000 + 20 * parts) / max(n, 1))
        some = docs.sample(False, share, 7).select(F.col(id_col).cast("long").alias("id"), words.alias("words")).where("id is not null")
        points = np.sort(some.mapInArrow(_points(*known), "place long").toArrow()["place"].to_numpy().view(np.uint64))
        bounds = points[len(points) * np.arange(1, parts) // parts] if len(points) else points
        # terms are counted and joined to lists before anything is shuffled
        found = rows.where("id is not null").mapInArrow(_dealt(*known, bounds), f"{LISTS}, task int")
        order = [F.asc("term"), F.desc(F.element_at("impacts", 1)), F.asc(F.element_at("ids", 1))]
        with freed(spark):
            found.repartitionById(parts, "task").select("term", "ids", "impacts").sortWithinPartitions(*order).mapInArrow(_blocks(block), STORED).write.parquet(f"{folder}/blocks")
        blocks = spark.read.schema(STORED).parquet(f"{folder}/blocks")
        frequencies = blocks.groupBy("term").agg(F.sum("n").cast("long").alias("df"))
        frequencies.repartitionByRange(parts, "term").sortWithinPartitions("term").write.parquet(f"{folder}/terms")
        return cls(spark, folder)

    def _weights(self, query: Sequence[str]) -> dict[str, float]:
        wanted = list(dict.fromkeys(query))
        found = self.frequencies.where(F.col("term").isin(wanted)).collect() if wanted else []
        return {r["term"]: math.log(1 + (self.n - r["df"] + 0.5) / (r["df"] + 0.5)) for r in found}

    def _summed(self, blocks: DataFrame, weights: dict[str, float]) -> DataFrame:
        """(id, score) from the postings of some blocks."""
        weight = F.lit(0.0)
        for t, w in weights.items():
            weight = F.when(F.col("term") == t, F.lit(w)).otherwise(weight)
        rows = blocks.select("term", weight.alias("w"), F.explode(F.arrays_zip("ids", "impacts")).alias("x"))
        return rows.select(F.col("x.ids").alias("id"), (F.col("w") * F.col("x.impacts")).alias("share")).groupBy("id").agg(F.sum("share").alias("score"))

    def score(self, query: Sequence[str]) -> DataFrame:
        """(id, score) of every document with a query term."""
        weights = self._weights(query)
        return self._summed(self.blocks.where(F.col("term").isin(*weights)) if weights else self.blocks.where("false"), weights)

    def top(self, query: Sequence[str], k: int) -> DataFrame:
        """(id, score) of the k best, by falling score and rising id."""
        weights = self._weights(query)
        own = self.blocks.where(F.col("term").isin(*weights)) if weights else self.blocks.where("false")
        # a row for each query term: the largest impact, the blocks, and the first ones, of which k hold k postings at least
        heads = own.groupBy("term").agg(F.max("most").alias("most"), F.count("*").alias("blocks"), F.slice(F.sort_array(F.collect_list(F.struct("most", "n")), False), 1, k).alias("first")).collect() if weights and k else []
        if not heads:
            self.read = self.all = 0
            return self._summed(own, weights).limit(0)
        largest = {r["term"]: weights[r["term"]] * r["most"] for r in heads}
        first = self._chosen({r["term"]: _reaching(r["first"], k) for r in heads})
        reached = self._summed(first, weights).orderBy(F.desc("score")).limit(k).agg(F.min("score"), F.count("*")).first()
        # sums of shares in another order may differ in the last digits
        least = reached[0] * (1 - 1e-9) if reached[1] == k else 0.0
        total = sum(largest.values())
        chosen = self._chosen({t: (least - (total - m)) / weights[t] * (1 - 1e-9) for t, m in largest.items()})
        self.all = sum(r["blocks"] for r in heads)
        self.read = chosen.count()
        return self._summed(chosen, weights).orderBy(F.desc("score"), "id").limit(k)

    def _chosen(self, least: dict[str, float]) -> DataFrame:
        """The blocks of terms with a largest impact of at least so much: a filter that reaches the scan."""
        keep = F.lit(False)
        for t, x in least.items():
            keep = keep | (F.col("term") == t) & (F.col("most") >= x)
        return self.blocks.where(keep)


def write_scratch(docs: DataFrame, id_col: str, words: Column) -> Postings:
    return Postings.write(docs, id_col, words, Scratch(docs.sparkSession, "postings").path("index"))
