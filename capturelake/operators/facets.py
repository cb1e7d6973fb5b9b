"""Facets and grouped results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def field(df: DataFrame, name: str) -> DataFrame:
    """(value, n); array fields count each element."""
    rows = df.select(F.explode(name).alias("value")) if isinstance(df.schema[name].dataType, T.ArrayType) else df.select(F.col(name).alias("value"))
    return rows.where("value is not null").groupBy("value").agg(F.count("*").alias("n"))


def queries(df: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """One row with a count for each predicate, in one pass."""
    return df.agg(*[F.count_if(p).alias(k) for k, p in predicates.items()])


def ranges(df: DataFrame, name: str, start: float, end: float, gap: float) -> DataFrame:
    """(bucket, n) of the half-open [bucket, bucket + gap), and of ``before`` and ``after``; empty buckets are left out."""
    x = F.col(name)
    label = F.when(x < start, "before").when(x >= end, "after").otherwise((start + F.floor((x - start) / gap) * gap).cast("string"))
    return df.where(x.isNotNull()).groupBy(label.alias("bucket")).agg(F.count("*").alias("n"))


def dates(df: DataFrame, name: str, gap: str = "day") -> DataFrame:
    """(bucket, n) of the calendar's years, months, days or hours; empty ones are left out."""
    forms = {"year": "yyyy", "month": "yyyy-MM", "day": "yyyy-MM-dd", "hour": "yyyy-MM-dd'T'HH"}
    if gap not in forms:
        raise ValueError(f"gap is one of {', '.join(forms)}")
    return df.where(F.col(name).isNotNull()).groupBy(F.date_format(name, forms[gap]).alias("bucket")).agg(F.count("*").alias("n"))


def pivot(df: DataFrame, first: str, second: str) -> DataFrame:
    """(first, second, n) with totals of first where second is null."""
    return df.rollup(first, second).agg(F.count("*").alias("n"), F.grouping_id().alias("level")).where("level < 3").select(first, second, "n", "level")


def group_top(df: DataFrame, by: str, order: list, rows: int) -> DataFrame:
    """The first rows of each group with the group's size, rank and size; each task keeps that many before the shuffle."""
    sizes = df.groupBy(by).agg(F.count("*").alias("num_found"))
    place = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    top = df.withColumn("rank", place).where(F.col("rank") <= rows)
    return top.join(sizes, by)
