"""Smaller operations of a search interface: pinned results, clusters, related documents, boxes on the map, folding."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def peek(df: DataFrame):
    """The first row, or None; reads no more than it needs."""
    return df.first()


def elevate(scored: DataFrame, pinned: Sequence[str] = (), excluded: Sequence[str] = ()) -> DataFrame:
    """(id, score, place) of scored documents: pinned ids first in their order, excluded ones not at all, the rest as they were."""
    place = F.lit(len(pinned))
    for i, x in enumerate(pinned):
        place = F.when(F.col("id") == F.lit(x), i).otherwise(place)
    rows = scored.where(~F.col("id").isin(*excluded)) if excluded else scored
    return rows.withColumn("place", place.cast("int"))


def ranked(elevated: DataFrame, rows: int) -> DataFrame:
    """The first rows of elevated documents, a feature of the interface."""
    return elevated.orderBy("place", F.desc("score"), "id").limit(rows)


def related(df: DataFrame, hits: DataFrame, from_col: str, to_col: str) -> DataFrame:
    """The rows of df whose to_col is the from_col of some hit."""
    return df.join(hits.select(F.col(from_col).alias(to_col)), to_col, "left_semi").select(*df.columns)


def within(lat: Column, lon: Column, at: tuple[float, float], km: float) -> Column:
    """Whether a place lies in the box that holds the circle of that radius; boxes may cross the date line."""
    degree = 111.195
    high = F.lit(km / degree)
    # meridians are closest at the edge of the box that is nearer to a pole
    edge = min(abs(at[0]) + km / degree, 90.0)
    wide = F.lit(180.0) if edge >= 90 else F.least(F.lit(180.0), high / F.cos(F.radians(F.lit(edge))))
    apart = F.abs(F.pmod(lon - F.lit(at[1]) + 180, F.lit(360.0)) - 180)
    return (F.abs(lat - F.lit(at[0])) <= high) & (apart <= wide)


@F.pandas_udf(T.StringType())
def fold_accents(texts: pd.Series) -> pd.Series:
    """Letters without their marks, and ligatures as letters."""

    def one(t):
        return None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))

    return texts.map(one)


def with_synonyms(terms: Column, groups: Mapping[str, Sequence[str]]) -> Column:
    """Distinct terms, each followed by its synonyms."""
    if not groups:
        return F.array_distinct(terms)
    known = F.create_map(*[x for k, v in groups.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return F.array_distinct(F.flatten(F.transform(terms, lambda t: F.concat(F.array(t), F.coalesce(F.element_at(known, t), F.array().cast("array<string>"))))))


def clusters(df: DataFrame, id_col: str, terms: Column, k: int, features: int = 1 << 14, seed: int = 1) -> DataFrame:
    """(id, cluster): k-means over hashed TF-IDF vectors of unit length; documents without terms have none."""
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import IDF, HashingTF, Normalizer

    rows = df.select(F.col(id_col).alias("id"), terms.alias("terms")).where("size(terms) > 0")
    stages = [
        HashingTF(inputCol="terms", outputCol="tf", numFeatures=features),
        IDF(inputCol="tf", outputCol="idf"),
        Normalizer(inputCol="idf", outputCol="unit"),
        KMeans(featuresCol="unit", predictionCol="cluster", k=k, seed=seed),
    ]
    return Pipeline(stages=stages).fit(rows).transform(rows).select("id", "cluster")
