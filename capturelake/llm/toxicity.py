"""Toxicity by class-conditional Kneser-Ney models.

Method. Words (folded, without ASCII punctuation) of labelled documents give one
interpolated Kneser-Ney bigram model for each class:

    P(w | u) = max(N(u, w) - d2, 0) / N(u) + back(u) P(w)
    P(w)     = max(M(w) - d1, 0) / M + back P_shared(w)
    P_shared = max(S(w) - 3/4, 0) / S, the rest dealt evenly to all words and one unknown

N(u, w) counts the different words left of a pair, M(w) those left of a word in the class,
and S(w) those in both classes together, so copies of a passage count once. Each back is
the mass that the discounts leave, so every P sums to 1. A rare expression has no mass
above the discount in either class and backs off to counts that both share: it tells
nothing but the two weights. The discounts are the pair of ``DISCOUNTS`` with the least
log-loss on labelled rows that the models have not seen.

A text's evidence is the difference of the two log-likelihoods, normalised by length, over
the whole text and over its most toxic run of each length in ``RUNS``. A logistic map fitted
on the unseen rows makes it a probability. The share of a word in P_shared cancels in the
difference where neither class has mass of its own, so only words and pairs above the least
discount are kept.

Bounds. The models learn from about ``per_class`` labelled toxic rows and ``ORDINARY`` times
as many ordinary ones as toxic ones (those of least hash of the id); the rest of the labels
are not read for learning. Tables sent to workers are bounded by that sample. Scoring covers
every row and whole texts.

Cases. Null and empty texts have no evidence and get the score of that. Labels that
are null, of absent ids or outside 0/1 teach nothing; of repeated labels the largest
counts, of repeated ids the least text. A null id has no label. Without labelled rows of
both classes every score is 0. Extra columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capturelake.llm import text as tx
from capturelake.scratch import Scratch

RUNS = (1, 3, 12)
PER_CLASS = 5000
ORDINARY = 3
#: of words and of pairs
DISCOUNTS = ((2.0, 2.0), (3.0, 10.0), (5.0, 10.0), (8.0, 10.0), (12.0, 15.0), (20.0, 20.0))
LEAST = 2
SHARED = 0.75
START = np.uint64(0x1F83D9ABFB41BD6B)


def tokens(batch: pa.RecordBatch, column: int):
    """Hashes, previous hashes and row bounds of a slice's words."""
    buf, offs = tx.plain(*tx.string_bytes(batch.column(column)))
    words = tx.Words(buf, offs, lower=False)
    bounds = words.bounds(batch.num_rows)
    before = np.empty_like(words.hash)
    before[1:] = words.hash[:-1]
    before[bounds[:-1][bounds[:-1] < len(words)]] = START
    return words.hash, before, bounds


def pair_key(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return tx.mix(before * np.uint64(0x9E3779B97F4A7C15) + word)


@tx.released
def _count(batches):
    """The different trigrams of labelled texts: label, their first word, before, word."""
    for batch in batches:
        for part in tx.slices(batch, "text"):
            word, before, bounds = tokens(part, 1)
            label = np.repeat(part.column(2).to_numpy(), np.diff(bounds)).astype(np.uint64)
            left = np.full_like(before, START)
            left[1:] = np.where(before[1:] == START, START, before[:-1])
            _, first = np.unique(tx.mix(pair_key(pair_key(left, before), word) + label), return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(x[first].view(np.int64)) for x in (label, left, before, word)], ["y", "t", "u", "w"])


def _u64(column) -> np.ndarray:
    return column.to_numpy().view(np.uint64) if len(column) else np.zeros(0, np.uint64)


def _pair(table: pa.Table, names: tuple[str, str], order) -> np.ndarray:
    return np.stack([table[c].to_numpy().astype(float)[order] for c in names]) if len(table) else np.zeros((2, 0))


class Counts:
    """The counts of both classes as arrays; picklable. model() applies discounts."""

    def __init__(self, words: pa.Table, pairs: pa.Table, contexts: pa.Table, size: int, totals: list[int]):
        """Words and pairs above LEAST and the words of such pairs, their contexts, the number of all words and the sums of M."""
        at = np.argsort(_u64(words["w"]))
        self.word, self.m = _u64(words["w"])[at], _pair(words, ("m0", "m1"), at)
        at = np.argsort(_u64(contexts["u"]))
        self.context, self.n_context = _u64(contexts["u"])[at], _pair(contexts, ("c0", "c1"), at)
        key = pair_key(_u64(pairs["u"]), _u64(pairs["w"]))
        at = np.argsort(key)
        self.pair, self.n_pair = key[at], _pair(pairs, ("n0", "n1"), at)
        self.second = tx.lookup(self.word, _u64(pairs["w"])[at])
        self.of_pair = tx.lookup(self.context, _u64(pairs["u"])[at])
        self.size, self.totals = size, np.maximum(np.array(totals, float), 1)

    def model(self, d_word: float, d_pair: float) -> Model:
        return Model(self, d_word, d_pair)


class Model:
    """The probabilities of both classes under one pair of discounts; picklable."""

    def __init__(self, c: Counts, d_word: float, d_pair: float):
        total = c.totals[:, None]
        own = np.maximum(c.m - d_word, 0) / total
        self.back_word = 1 - own.sum(1)
        # all words are in the sum of the shared level; those that occur once leave SHARED each
        shared = np.maximum(c.m.sum(0) - SHARED, 0) / total.sum()
        rest = SHARED * c.size / total.sum() / (c.size + 1)
        over = np.maximum(c.n_pair - d_pair, 0)
        # next to the mass of a pair the shared level of its word doesn't cancel
        needed = own.max(0, initial=0) > 0
        needed[c.second[over.max(0, initial=0) > 0]] = True
        at = np.flatnonzero(needed)
        self.word = tx.Table(c.word[at])
        self.p_word = (own[:, at] + self.back_word[:, None] * (shared[at] + rest)).astype(np.float32)
        kept = np.stack([np.bincount(c.of_pair, over[y], len(c.context)) for y in (0, 1)]) if len(c.pair) else np.zeros((2, 0))
        n = np.maximum(c.n_context, 1)
        at = np.flatnonzero(kept.max(0, initial=0) > 0)
        self.context, self.back = tx.Table(c.context[at]), (1 - kept[:, at] / n[:, at]).astype(np.float32)
        at = np.flatnonzero(over.max(0, initial=0) > 0)
        self.pair = tx.Table(c.pair[at])
        self.p_pair = (over[:, at] / n[:, c.of_pair[at]]).astype(np.float32)

    def ratios(self, word, before) -> np.ndarray:
        """log P(word | before, toxic) - log P(word | before, ordinary)."""
        at = self.word.find(word)
        # what a word without mass of its own has in the shared level cancels
        p = np.repeat(self.back_word[:, None].astype(np.float32), len(word), 1)
        known = np.flatnonzero(at >= 0)
        p[:, known] = self.p_word[:, at[known]]
        at = self.context.find(before)
        have = np.flatnonzero(at >= 0)
        if len(have):
            p[:, have] *= self.back[:, at[have]]
            pair = self.pair.find(pair_key(before[have], word[have]))
            p[:, have[pair >= 0]] += self.p_pair[:, pair[pair >= 0]]
        return (np.log(p[1]) - np.log(p[0])).astype(np.float64)

    def features(self, part: pa.RecordBatch, column: int) -> np.ndarray:
        """Per row: the mean ratio of its most toxic run of each length, and of the whole text."""
        return run_means(self, *tokens(part, column))


def run_means(model: Model, word, before, bounds) -> np.ndarray:
    out = np.zeros((len(bounds) - 1, len(RUNS) + 1))
    full = np.flatnonzero(np.diff(bounds) > 0)
    if not len(full):
        return out
    ratio = model.ratios(word, before)
    sizes = np.diff(bounds)[full]
    sums = np.concatenate([[0], np.cumsum(ratio)])
    out[full, -1] = (sums[bounds[full + 1]] - sums[bounds[full]]) / sizes
    last = np.repeat(bounds[full + 1], sizes)
    for i, run in enumerate(RUNS):
        ends = np.minimum(np.arange(len(ratio)) + run, last)
        out[full, i] = np.maximum.reduceat((sums[ends] - sums[:-1]) / run, bounds[full])
    return out


def _features(counts):
    """Features of labelled rows under every pair of discounts."""

    def run(batches):
        # the words of a part of the sample are held, so that only one model is there at a time
        held = [(part.column(0), part.column(2), tokens(part, 1)) for batch in batches for part in tx.slices(batch, "text")]
        found = [[] for _ in held]
        for d in DISCOUNTS if held else ():
            model = counts.value.model(*d)
            for features, (_, _, words) in zip(found, held, strict=True):
                features.append(run_means(model, *words))
            del model
        for features, (ids, y, _) in zip(found, held, strict=True):
            f = np.column_stack(features)
            yield pa.RecordBatch.from_arrays([ids, y, pa.FixedSizeListArray.from_arrays(pa.array(f.ravel()), f.shape[1]).cast(pa.list_(pa.float64()))], ["id", "y", "f"])

    return tx.released(run)


def _probabilities(model, weights, part: pa.RecordBatch, column: int) -> np.ndarray:
    if model is None:
        return np.zeros(part.num_rows)
    return probability(weights, model.value.features(part, column))


def probability(weights: np.ndarray, f: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(weights[0] + f @ weights[1:], -40, 40)))


def _scores(model, weights):
    def run(batches):
        for batch in batches:
            for part in tx.slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_probabilities(model, weights, part, 1))], ["id", "score"])

    return tx.released(run)


def logistic(f: np.ndarray, y: np.ndarray, penalty: float = 0.05, steps: int = 60) -> np.ndarray:
    """Bias and weights of a ridge-penalised logistic regression, by damped Newton steps."""
    x = np.column_stack([np.ones(len(f)), f])
    ridge = np.diag([1e-6] + [penalty] * f.shape[1])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step * min(1, 4 / max(np.abs(step).max(), 1e-9))
    return w


class Toxicity:
    """fit() learns from a labelled sample; score() gives (id, score) for every row."""

    def __init__(self, spark: SparkSession, per_class: int = PER_CLASS):
        self.spark, self.per_class = spark, per_class
        self.model, self.weights = None, None

    def fit(self, docs: DataFrame, labels: DataFrame, teach, id_col="doc_id", text_col="text", label_col="toxic") -> Toxicity:
        """teach: a condition on the column ``id`` for rows whose labels may be learnt."""
        work = Scratch(self.spark, "toxicity")
        marks = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
        marks = marks.where("id is not null and y in (0, 1)").where(teach).groupBy("id").agg(F.max("y").alias("y"))
        sizes = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count("*").alias("n")).collect()}
        if len(sizes) < 2:
            return self
        wanted = {1: self.per_class, 0: ORDINARY * min(self.per_class, sizes[1])}
        # those of least hash, as far as the share that is wanted
        share = {y: min(1.0, wanted[y] / sizes[y]) for y in sizes}
        place = F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / float(1 << 40)
        marks = marks.where(place < F.when(F.col("y") == 1, share[1]).otherwise(share[0]))
        texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        # about (1 + ORDINARY) * per_class rows of two numbers
        sample = texts.join(F.broadcast(marks), "id").groupBy("id", "y").agg(F.min("text").alias("text"))
        sample = work.save(sample.select("id", "text", "y"), "sample")
        unseen = F.pmod(F.xxhash64("id", F.lit("calibrate")), F.lit(4)) == 0
        kinds = {r["y"]: r["n"] for r in sample.where(~unseen).groupBy("y").agg(F.count("*").alias("n")).collect()}
        if len(kinds) < 2:
            return self
        pairs = sample.where(~unseen).mapInArrow(_count, "y long, t long, u long, w long").distinct().groupBy("y", "u", "w").agg(F.count("*").alias("n"))
        pairs = work.save(pairs, "pairs")

        def of(y, value):
            return F.sum(F.when(F.col("y") == y, value).otherwise(F.lit(0)))

        words = work.save(pairs.groupBy("w").agg(of(0, F.lit(1)).alias("m0"), of(1, F.lit(1)).alias("m1")), "words")
        size, *totals = words.agg(F.count("*"), F.coalesce(F.sum("m0"), F.lit(0)), F.coalesce(F.sum("m1"), F.lit(0))).first()
        often = work.save(pairs.groupBy("u", "w").agg(of(0, F.col("n")).alias("n0"), of(1, F.col("n")).alias("n1")).where(f"greatest(n0, n1) > {LEAST}"), "often")
        seconds = often.select("w").distinct().withColumn("second", F.lit(True))
        held = words.join(seconds, "w", "left").where(f"second or greatest(m0, m1) > {LEAST}").select("w", "m0", "m1").toArrow()
        kept = often.toArrow()
        contexts = pairs.groupBy("u").agg(of(0, F.col("n")).alias("c0"), of(1, F.col("n")).alias("c1"), F.max("n").alias("most")).where(f"most > {LEAST}").toArrow()
        counts = Counts(held, kept, contexts, size, totals)
        sent = self.spark.sparkContext.broadcast(counts)
        kind = "id long, y int, f array<double>"
        seen = sample.where(unseen).mapInArrow(_features(sent), kind).toArrow()
        if len(seen) < 2 or len(set(seen["y"].to_pylist())) < 2:
            seen = sample.mapInArrow(_features(sent), kind).toArrow()
        # in one order, so that sums are the same
        seen = seen.sort_by([("id", "ascending")])
        y = seen["y"].to_numpy().astype(float)
        every = np.array(seen["f"].to_pylist()).reshape(len(y), len(DISCOUNTS), len(RUNS) + 1)
        best = np.inf
        for k, discounts in enumerate(DISCOUNTS):
            weights = logistic(every[:, k], y)
            p = probability(weights, every[:, k])
            loss = -np.log(np.where(y == 1, p, 1 - p) + 1e-12).mean()
            if loss < best:
                best, self.discounts, self.weights = loss, discounts, weights
        self.model = counts.model(*self.discounts)
        self.sent = self.spark.sparkContext.broadcast(self.model)
        sent.unpersist()
        # the driver needs the model's broadcast only
        del counts, held, kept, contexts, seen, every
        tx.release()
        work.drop("sample", "pairs", "words", "often")
        return self

    def score(self, docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
        texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        return texts.mapInArrow(_scores(self.sent if self.model else None, self.weights), "id long, score double")

    def keep(self, docs: DataFrame, least: float = 0.5, text_col="text") -> DataFrame:
        """The rows of docs that score less, unchanged; in one pass without a shuffle."""
        model, weights = self.sent if self.model else None, self.weights
        at = docs.columns.index(text_col)

        def run(batches):
            for batch in batches:
                for part in tx.slices(batch, text_col):
                    yield part.filter(pa.array(_probabilities(model, weights, part, at) < least))

        return docs.mapInArrow(tx.released(run), docs.schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = Toxicity(spark).fit(docs, labels, F.expr("crc32(cast(id as string)) % 5 <> 0")).score(docs)
    held = F.coalesce(F.expr("crc32(cast(id as string)) % 5 = 0"), F.lit(False))
    return out.select(F.col("id").alias("doc_id"), held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
