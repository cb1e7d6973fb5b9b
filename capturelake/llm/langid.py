"""Language identification by sparse multinomial logistic regression on TF-IDF n-grams.

Method. A text is case-folded; runs of other characters than letters are one space. Its
features are hashed character 1- to 3-grams by relative frequency times inverse document
frequency. Weights of a multinomial logistic regression are trained by follow-the-
regularised-leader (proximal, per-coordinate rates) with L1 and L2 penalties, so that most
are exactly zero. One temperature, fitted on a part of the sample that training has not
seen, calibrates the softmax; the score is the probability of the predicted language.

Bounds. Training uses about ``per_lang`` rows a language (those whose hash of the id is
below the share that is wanted) and their features, at most 2^18 a row; every language with
a labelled row is learnt. The model is one float32 table of 2^18 rows by languages, 1 MB a
language and three times that while it is trained on the driver. Prediction covers every row
and whole texts, folded in pieces of ``PIECE`` characters that share their edges, so that
memory doesn't grow with a text and no n-gram is lost.

Cases. Null texts and those without a letter get ``und`` and score 0. Rows without a
language teach nothing. Without any labelled row all are ``und``. Ties go to the language
that sorts first. Null ids never teach; of repeated rows of an id and language the least text
does. Extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capturelake.llm import text as tx
from capturelake.scratch import Scratch, ship

BITS = 18
ORDERS = 3
PIECE = 1 << 19
PER_LANG = 800
_MULT = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def _letters() -> np.ndarray:
    """For each code point of the first planes its folded letter, or a space."""
    size = 0x3400
    out = np.full(size, 32, np.uint32)
    for c in range(size):
        if chr(c).isalpha():
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


_LETTER = _letters()


def _folded(text: str) -> np.ndarray:
    """The folded letter or a space for each character."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    small = points < len(_LETTER)
    out = _LETTER[np.where(small, points, 0)]
    if not small.all():
        for at in np.flatnonzero(~small):
            out[at] = points[at] if chr(points[at]).isalpha() else 32
    return out


def grams(points: np.ndarray, after: int = 0) -> np.ndarray:
    """Hashed 1- to 3-grams that end at place ``after`` or later, without the space alone."""
    parts = []
    for n in range(1, ORDERS + 1):
        some = points[max(0, after - n + 1) :]
        m = len(some) - n + 1
        if m > 0:
            h = np.full(m, n * 0x27D4EB2F & 0xFFFFFFFF, np.uint32)
            for i in range(n):
                h = (h ^ some[i : i + m]) * np.uint32(_MULT[i])
                h ^= h >> np.uint32(15)
            parts.append((h[some != 32] if n == 1 else h) & np.uint32((1 << BITS) - 1))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def features(text: str | None):
    """The n-grams of a text, whose letters have single spaces between runs and at both ends, piece by piece; nothing without letters."""
    text = text or ""
    # the last places of the piece before, of which the first is the space at the start
    tail, blank = np.full(1, 32, np.uint32), True
    for at in range(0, len(text), PIECE):
        new = _folded(text[at : at + PIECE])
        space = new == 32
        keep = ~space
        keep[1:] |= ~space[:-1]
        keep[0] |= not blank
        blank = bool(space[-1])
        new = new[keep]
        if len(new):
            every = np.concatenate([tail, new])
            yield grams(every, len(tail))
            tail = every[-(ORDERS - 1) :]
    if not blank:
        yield grams(np.append(tail, np.uint32(32)), len(tail))


@tx.released
def _counted(batches):
    """id, lang, and the sparse counts of the features of labelled texts."""
    for batch in batches:
        ids, langs, texts = (batch.column(i).to_pylist() for i in range(3))
        for i, lang, text in zip(ids, langs, texts, strict=True):
            n = np.zeros(1 << BITS, np.int32)
            for g in features(text):
                n += np.bincount(g, minlength=1 << BITS).astype(np.int32)
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int64()), pa.array([lang]), pa.array([at.astype(np.int32)], pa.list_(pa.int32())), pa.array([n[at]], pa.list_(pa.int32()))], ["id", "lang", "at", "n"]
            )


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class Ftrl:
    """Multinomial FTRL-proximal with elastic net over a table of features by classes."""

    def __init__(self, features: int, classes: int, alpha=2.0, beta=1.0, l1=0.02, l2=0.02):
        self.z = np.zeros((features, classes), np.float32)
        self.n = np.zeros((features, classes), np.float32)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(at)
        p = softmax(x @ w)
        p[y] -= 1
        g = x[:, None] * p[None, :]
        n = self.n[at]
        rate = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[at] += g - rate * w
        self.n[at] = n + g * g


class Model:
    """Languages and the table of weights with the inverse document frequencies and the temperature folded in."""

    def __init__(self, langs: list[str], rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = 3, seed: int = 7):
        self.langs = langs
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(rows))
        cut = max(1, len(rows) // 5) if len(rows) >= 10 else 0
        held, taught = order[:cut], order[cut:]
        df = np.zeros(1 << BITS)
        for i in taught:
            df[rows[i][1]] += 1
        idf = np.log((1 + len(taught)) / (1 + df)) + 1
        scale = 10.0  # relative frequencies are small

        def vector(i):
            _, at, n = rows[i]
            return at, (scale * n / n.sum() * idf[at]).astype(np.float32)

        ftrl = Ftrl(1 << BITS, len(langs))
        for _ in range(epochs):
            for i in rng.permutation(taught):
                if len(rows[i][1]):
                    ftrl.learn(*vector(i), rows[i][0])
        w = ftrl.weights()
        self.sparsity = float((w == 0).mean())
        logits = np.array([vector(i)[1] @ w[rows[i][1]] for i in (held if cut else taught) if len(rows[i][1])])
        truth = np.array([rows[i][0] for i in (held if cut else taught) if len(rows[i][1])])
        best = (np.inf, 1.0)
        for t in np.geomspace(0.05, 8, 60):
            loss = -np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() if len(truth) else 0
            best = min(best, (loss, t))
        self.temperature = best[1]
        self.table = (w * idf[:, None] * scale / self.temperature).astype(np.float32)

    def predict(self, text: str | None) -> tuple[str, float]:
        total, n = np.zeros(len(self.langs)), 0
        for g in features(text):
            total += self.table[g].sum(0, dtype=np.float64)
            n += len(g)
        if not n:
            return "und", 0.0
        p = softmax(total / n)
        at = int(np.argmax(p))
        return self.langs[at], float(p[at])


def _predicted(model):
    def run(batches):
        for batch in batches:
            for part in tx.slices(batch, "text"):
                found = [model.value.predict(t) if model else ("und", 0.0) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["id", "lang_pred", "score"])

    return tx.released(run)


class LanguageId:
    """fit() learns from a labelled sample; predict() gives (id, lang_pred, score) for every row."""

    def __init__(self, spark: SparkSession, per_lang: int = PER_LANG):
        self.spark, self.per_lang, self.model = spark, per_lang, None
        ship(spark)

    def fit(self, docs: DataFrame, teach, id_col="doc_id", text_col="text", lang_col="lang") -> LanguageId:
        """teach: a condition on the column ``id`` for rows that may be learnt from."""
        work = Scratch(self.spark, "langid")
        rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
        taught = rows.where("id is not null and lang is not null and text is not null").where(teach)
        # one row for each language
        sizes = taught.groupBy("lang").agg(F.count_distinct("id").alias("n"))
        share = F.lit(self.per_lang) / F.col("n")
        place = F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / float(1 << 40)
        marks = taught.select("id", "lang").join(F.broadcast(sizes), "lang").where(place < share).select("id", "lang").distinct()
        # about per_lang rows a language
        sample = taught.join(F.broadcast(marks), ["id", "lang"]).groupBy("id", "lang").agg(F.min("text").alias("text"))
        got = work.save(sample.mapInArrow(_counted, "id long, lang string, at array<int>, n array<int>"), "sample").toArrow().sort_by([("id", "ascending"), ("lang", "ascending")])
        work.drop("sample")
        langs = sorted(set(got["lang"].to_pylist()))
        if langs:
            number = {x: i for i, x in enumerate(langs)}
            data = [(number[x.as_py()], np.asarray(a.values), np.asarray(n.values)) for x, a, n in zip(got["lang"], got["at"], got["n"], strict=True)]
            self.model = self.spark.sparkContext.broadcast(Model(langs, data))
        return self

    def predict(self, docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
        texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        return texts.mapInArrow(_predicted(self.model), "id long, lang_pred string, score double")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = LanguageId(spark).fit(docs, F.expr("crc32(cast(id as string)) % 4 <> 2")).predict(docs)
    held = F.coalesce(F.expr("crc32(cast(id as string)) % 4 = 2"), F.lit(False))
    return out.select(F.col("id").alias("doc_id"), held.alias("held_out"), "lang_pred", "score")
