"""Language detection by naive Bayes over character 1- to 3-grams, with profiles trained from labelled text.

An n-gram is one number, 21 bits for each character, so counting and scoring are array operations over whole texts.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capturelake.scratch import Scratch

_OTHER = re.compile(r"[^\w]|[\d_]")
_BITS = 21
CELLS = 8_000_000  # 64 MB of profiles in a task
HOT = 100_000


def grams(text: str) -> np.ndarray:
    """All 1- to 3-grams of the letters of a text, with single spaces between words and at the ends; none without letters."""
    words = " ".join(_OTHER.sub(" ", text.lower()).split())
    if not words:
        return np.zeros(0, np.int64)
    c = np.frombuffer(f" {words} ".encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    two = (c[:-1] << _BITS) | c[1:]
    return np.concatenate([c[c != 32], two, (two[:-1] << _BITS) | c[2:]])


def number(gram: str) -> int:
    """The number of an n-gram."""
    out = 0
    for c in gram:
        out = (out << _BITS) | ord(c)
    return out


def shown(code: int) -> str:
    """The n-gram of a number."""
    out = ""
    while code:
        out, code = chr(code & ((1 << _BITS) - 1)) + out, code >> _BITS
    return out


def _counts(batches):
    """Partial counts of a task's n-grams: lang, g, n."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def merged(parts):
        g, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        u, at = np.unique(g, return_inverse=True)
        return u, np.bincount(at, n, len(u)).astype(np.int64)

    def sent():
        for lang, parts in held.items():
            g, n = merged(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(n)], ["lang", "g", "n"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = grams(text or "")
            if len(found):
                held.setdefault(lang, []).append(np.unique(found, return_counts=True))
                size += len(held[lang][-1][0])
        if size > 1_000_000:
            held = {lang: [merged(parts)] for lang, parts in held.items()}
            size = sum(len(parts[0][0]) for parts in held.values())
            if size > 500_000:
                yield from sent()
                held, size = {}, 0
    yield from sent()


def counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, g, n) of all n-grams of each language, counted over all labelled documents."""
    labelled = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    return labelled.mapInArrow(_counts, "lang string, g long, n long").groupBy("lang", "g").agg(F.sum("n").alias("n"))


def profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, dict[str, float]]:
    """Log-probabilities of all n-grams of each language, as dicts of the driver."""
    return _profiles(counts(docs, text_col, lang_col))


def _profiles(counted: DataFrame) -> dict[str, dict[str, float]]:
    out: dict[str, dict[str, float]] = {}
    for r in counted.collect():
        out.setdefault(r["lang"], {})[shown(r["g"])] = r["n"]
    for lang, own in out.items():
        total = sum(own.values())
        out[lang] = {g: float(np.log(n / total)) for g, n in own.items()}
    return out


def detector(known: dict[str, dict[str, float]]):
    """A UDF: the language of a text; null for null, empty for text without letters. Ties go to the first language."""
    langs = sorted(known)
    codes = np.array(sorted({number(g) for p in known.values() for g in p}), np.int64)
    # an n-gram that a language doesn't have is rarer than any that it has
    unseen = min([-16.0, *(v - np.log(2) for p in known.values() for v in p.values())])
    table = np.full((len(codes), len(langs)), unseen)
    for j, lang in enumerate(langs):
        own = known[lang]
        table[np.searchsorted(codes, [number(g) for g in own]), j] = list(own.values())

    @F.pandas_udf("string")
    def detect(texts: pd.Series) -> pd.Series:
        def one(t):
            if t is None:
                return None
            found = grams(t)
            if not len(found) or not langs:
                return ""
            at = np.minimum(np.searchsorted(codes, found), len(codes) - 1)
            at = at[codes[at] == found]
            return langs[int(np.argmax(table[at].sum(0)))] if len(at) else ""

        return texts.map(one)

    return detect


def _own(batches):
    """The n-grams of each text: key, g, n."""
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            g, n = np.unique(grams(text), return_counts=True)
            if len(g):
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(g), pa.string()), pa.array(g), pa.array(n.astype(np.int64))], ["key", "g", "n"])


def _joined(docs: DataFrame, counted: DataFrame, text_col: str, hot: int) -> DataFrame:
    """(key, detected) of each different text by its digest: n-grams meet the profiles by a join.

    The ``hot`` most frequent n-grams are broadcast, so that none of the others is met by so many texts.
    """
    total = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    v = counted.join(F.broadcast(total), "lang").select("lang", "g", "n", F.log(F.col("n") / F.col("total")).alias("v"))
    unseen = v.agg(F.least(F.lit(-16.0), F.min("v") - F.log(F.lit(2.0)))).first()[0]
    if unseen is None:
        return docs.select(F.lit("").alias("key"), F.lit("").alias("detected")).limit(0)
    by_gram = v.groupBy("g").agg(F.sum("n").alias("times"), F.collect_list(F.struct("lang", (F.col("v") - unseen).alias("more"))).alias("langs"))
    by_gram = Scratch(docs.sparkSession, "lang").save(by_gram, "profiles")
    often = by_gram.orderBy(F.desc("times"), "g").limit(hot).select("g")
    texts = docs.select(F.sha2(text_col, 256).alias("key"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    own = texts.mapInArrow(_own, "key string, g long, n long").groupBy("key", "g").agg(F.any_value("n").alias("n"))
    own = Scratch(docs.sparkSession, "lang").save(own, "own")
    first = own.join(F.broadcast(by_gram.join(F.broadcast(often), "g", "left_semi")), "g")
    rest = own.join(F.broadcast(often), "g", "left_anti").join(by_gram.join(F.broadcast(often), "g", "left_anti"), "g")
    met = first.unionByName(rest).select("key", "n", "langs")
    # a language's score above that of one that has none of the n-grams; that of a language without any is 0
    score = met.select("key", F.col("n"), F.explode("langs").alias("x")).groupBy("key", "x.lang").agg(F.sum(F.col("n") * F.col("x.more")).alias("score"))
    return score.groupBy("key").agg(F.min(F.struct((-F.col("score")).alias("s"), "lang")).alias("best")).select("key", F.col("best.lang").alias("detected"))


def with_language(docs: DataFrame, labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", name: str = "detected", cells: int = CELLS, hot: int = HOT) -> DataFrame:
    """docs with the language of each text, learned from all rows of ``labelled`` that have one; null for null, empty where nothing tells.

    Up to ``cells`` numbers (n-grams times languages) the profiles are sent to all tasks as a table; beyond, the n-grams of each
    different text are joined with them. Both ways give the same languages, but for scores that are equal up to rounding.
    """
    counted = Scratch(docs.sparkSession, "lang").save(counts(labelled, text_col, lang_col), "counts")
    size, langs = counted.agg(F.count("*"), F.count_distinct("lang")).first()
    if size * langs <= cells:
        return docs.withColumn(name, detector(_profiles(counted))(F.col(text_col).cast("string")))
    found = _joined(docs, counted, text_col, hot).select(F.col("key").alias("__key"), F.col("detected").alias("__detected"))
    out = docs.withColumn("__key", F.sha2(F.col(text_col).cast("string"), 256)).join(found, "__key", "left")
    return out.withColumn(name, F.when(F.col(text_col).isNotNull(), F.coalesce("__detected", F.lit("")))).drop("__key", "__detected")
