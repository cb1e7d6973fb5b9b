"""Documents of an index: projection, dedupe, merge, un-merge and field updates.

An index is two tables. ``docs`` has a row for each id with its single-valued fields; ``occurrences``
has a row for each (id, archive) with date and job. The arrays of the document view are made from
occurrences, so they stay aligned. All picks are minima over an explicit order, which Spark combines
before it shuffles, so an id with a third of all rows is no hot task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capturelake.functions import mime, urls

MERGED = ("arcname", "date", "job")


def document_id(canonical: Column, digest: Column, extra_id: str = "") -> Column:
    """``canonical.digest.extra``; ``-`` stands for a missing digest, and an empty extra id leaves the dot."""
    return F.concat(canonical, F.lit("."), F.coalesce(digest, F.lit("-")), F.lit("."), F.lit(extra_id))


def project(records: DataFrame, extra_id: str = "", extra_fields: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Index documents of parsed records; keeps filename, rec_seq and ingest_seq where they are."""
    canonical = urls.canonicalize(F.col("url"))
    supplied, detected = F.col("suppliedContentType"), F.col("detectedContentType")
    columns = {
        "id": document_id(canonical, F.col("digest"), extra_id),
        "digest": F.col("digest"),
        "host": urls.host(canonical),
        "url": F.col("url"),
        "canonicalurl": canonical,
        "urlfp": urls.fingerprint(canonical),
        "title": F.col("title"),
        "content": mime.suppress(F.col("content"), supplied, detected),
        "contentlength": F.col("length"),
        "mediatypesup": mime.media_type(supplied),
        "charsetsup": supplied["charset"],
        "mediatypedet": mime.media_type(detected),
        "charsetdet": detected["charset"],
        "mediatypegroupdet": mime.group(detected),
        "boost": F.lit(1.0).cast("float"),
        "outlinks": F.col("outlinks"),
        "arcname": F.col("filename"),
        "date": F.col("date"),
    }
    more = {k: F.array(*map(F.lit, v)) for k, v in (extra_fields or {}).items()}
    kept = [c for c in ("rec_seq", "ingest_seq") if c in records.columns]
    out = records.select(*[c.alias(k) for k, c in columns.items()], *kept, *[c.alias(k) for k, c in more.items() if k != "job"])
    return out.withColumn("job", F.element_at(more["job"], 1) if "job" in more else F.lit(None).cast("string"))


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """For each key the row that comes first in the order; ties go to the least of the other columns' hash."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    best = F.min_by(F.struct(*rest), F.struct(*order, F.xxhash64(*rest)))
    return df.groupBy(*keys).agg(best.alias("__row")).select(*[F.col(k) for k in keys], *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*df.columns)


def dedupe_in_archive(docs: DataFrame) -> DataFrame:
    """The first document of each id in each archive, by rec_seq."""
    return first_by(docs, ["arcname", "id"], ["rec_seq"])


def merge(docs: DataFrame, order: Sequence[str] = ("ingest_seq", "arcname", "rec_seq")) -> tuple[DataFrame, DataFrame]:
    """(docs, occurrences): repeats in other archives add an occurrence, repeats in one archive add nothing.

    Single-valued fields are those of the first document; content is the first that is not empty.
    """
    keys = [c for c in order if c in docs.columns]
    single = [c for c in docs.columns if c not in (*MERGED, "id", "content", "rec_seq", "ingest_seq")]
    at = F.struct(*keys)
    aggregates = [F.min_by(F.struct(*single), at).alias("__row")] if single else []
    if "content" in docs.columns:
        aggregates.append(F.min_by("content", F.when(F.col("content") != "", at)).alias("content"))
    else:
        aggregates.append(F.count("*").alias("__n"))
    merged = docs.groupBy("id").agg(*aggregates).drop("__n")
    merged = merged.select("id", *[F.col(f"__row.{c}").alias(c) for c in single], *[c for c in ("content",) if c in docs.columns])
    held = [c for c in (*MERGED, "ingest_seq") if c in docs.columns]
    occurrences = first_by(docs.select("id", *held, *[c for c in keys if c not in held]), ["id", "arcname"], keys).select("id", *held)
    return merged, occurrences


def add(docs: DataFrame, occurrences: DataFrame, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """An index with the documents of further archives; what it has stays first, archives it has add nothing."""
    new_docs, new_occurrences = merge(more)
    old = docs.withColumn("__age", F.lit(0))
    both = old.unionByName(new_docs.withColumn("__age", F.lit(1)), allowMissingColumns=True)
    single = [c for c in docs.columns if c not in ("id", "content")]
    at = F.col("__age")
    aggregates = [F.min_by(F.struct(*single), at).alias("__row")] if single else []
    if "content" in docs.columns:
        aggregates.append(F.min_by("content", F.when(F.col("content") != "", at)).alias("content"))
    out = both.groupBy("id").agg(*aggregates)
    out = out.select("id", *[F.col(f"__row.{c}").alias(c) for c in single], *[c for c in ("content",) if c in docs.columns]).select(*docs.columns)
    fresh = new_occurrences.join(occurrences.select("id", "arcname"), ["id", "arcname"], "left_anti")
    return out, occurrences.unionByName(fresh, allowMissingColumns=True)


def remove(docs: DataFrame, occurrences: DataFrame, arcs: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """An index without some archives; documents that occur nowhere else go."""
    left = occurrences.where(~F.col("arcname").isin(*arcs)) if arcs else occurrences
    return docs.join(left.select("id"), "id", "left_semi"), left


def view(docs: DataFrame, occurrences: DataFrame) -> DataFrame:
    """Documents with their aligned arrays arcname, date and job."""
    order = [c for c in ("ingest_seq", "arcname") if c in occurrences.columns]
    fields = [c for c in MERGED if c in occurrences.columns]
    listed = occurrences.groupBy("id").agg(F.array_sort(F.collect_list(F.struct(*order, *[c for c in fields if c not in order]))).alias("__all"))
    out = docs.join(listed, "id", "left")
    return out.select(*docs.columns, *[F.col(f"__all.{c}").alias(c) for c in fields])


def set_fields(docs: DataFrame, predicate: Column, fields: Mapping[str, Sequence[str]]) -> DataFrame:
    """docs with fields set to arrays of values where the predicate holds; new fields are null elsewhere."""
    hit = F.coalesce(predicate, F.lit(False))
    return docs.withColumns({k: F.when(hit, F.array(*map(F.lit, v))).otherwise(F.col(k) if k in docs.columns else F.lit(None).cast("array<string>")) for k, v in fields.items()})


def add_values(docs: DataFrame, predicate: Column, field: str, values: Sequence[str]) -> DataFrame:
    """docs with values appended to an array field where the predicate holds."""
    old = F.coalesce(F.col(field), F.array().cast("array<string>")) if field in docs.columns else F.array().cast("array<string>")
    grown = F.concat(old, F.array(*map(F.lit, values)))
    return docs.withColumn(field, F.when(F.coalesce(predicate, F.lit(False)), grown).otherwise(F.col(field) if field in docs.columns else F.lit(None).cast("array<string>")))


def delete(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.join(ids.select("id"), "id", "left_anti")
