"""From archive records to parsed records: the parse pipeline and its log."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capturelake.functions import charset, dates, mime, urls
from capturelake.operators import documents
from capturelake.operators import html as page
from capturelake.sources.webarchive import SPLIT_BYTES, WebArchive


def read_archives(spark: SparkSession, path: str | Sequence[str], mode: str = "PERMISSIVE", status: int | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of archives, with a status only those that have it and the rows of damage; larger files are read by several tasks."""
    spark.dataSource.register(WebArchive)
    # the source takes filters on file names and statuses
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("webarchive").option("mode", mode).option("maxBytes", page.MOST_BYTES).option("splitBytes", split_bytes)
    reader = reader if status is None else reader.option("status", status)
    return reader.load(path) if isinstance(path, str) else reader.option("locations", json.dumps(list(path))).load()


def parse(raw: DataFrame, strict_mime: bool = True, damage: bool = False, charsets: charset.Model | None = None, closed: bool = False) -> DataFrame:
    """PARSED_RECORD, rec_seq and error of the HTTP responses with status 200.

    Bodies over 5,000,000 bytes and those that can't be read keep their row without text; error says why HTML
    could not be read. Texts are read by their mark, their header, their markup or as UTF-8; where none of these can read them
    by the model of charsets, if there is one. A missing digest is computed. Revisits of WARC files are marked, the mark of ARC records
    is null. With ``damage`` the rows that stand for damaged archives stay too, without a url. ``closed`` is that of ``html.page``.
    """
    rows = raw.where("is_http and status = 200 or error is not null" if damage else "is_http and status = 200")
    # the record's own length guards the text, as a body is part of it
    small = F.when(F.col("length") <= page.MOST_BYTES, F.col("payload"))
    supplied = mime.force_parse(F.col("headers")["content-type"], strict_mime)
    rows = rows.withColumns({"supplied": supplied, "detected": F.coalesce(mime.sniff(small), F.when(small.isNotNull(), mime.parse(F.col("headers")["content-type"], strict_mime)))})
    is_text = F.coalesce(F.col("detected.top") == "text", F.lit(False)) | F.coalesce(F.col("detected.sub").contains("html"), F.lit(False))
    valid = F.try_validate_utf8(small.cast("string"))
    named = F.lower(F.coalesce(F.col("supplied.charset"), F.lit("utf-8")))
    # UTF-8 that says so stays in the JVM; marks and zero bytes are no part of it
    plain = named.isin("utf-8", "utf8") & valid.isNotNull() & ~F.coalesce(valid.rlike("^\uFEFF|\x00"), F.lit(False))
    other = charset.reader(charsets)(F.when(is_text & ~F.coalesce(plain, F.lit(False)), small), F.col("supplied.charset"))
    rows = rows.withColumn("read", other).withColumn("body", F.when(is_text, F.when(plain, valid).otherwise(F.col("read.text"))))
    is_html = F.coalesce(F.col("detected.sub").contains("html"), F.lit(False))
    is_file = F.coalesce(F.col("detected.sub").isin("pdf", "zip"), F.lit(False))
    rows = rows.withColumn("page", page.extract(F.when(is_html, F.col("body")), closed)).withColumn("file", documents.extract(F.when(is_file, small)))
    links = F.transform(F.concat("page.links", "file.links"), lambda x: x["to"])
    rows = rows.withColumn("targets", page.resolve(F.col("url"), links))
    return rows.select(
        "filename",
        F.coalesce("payload_digest", urls.payload_digest(F.col("payload"))).alias("digest"),
        "url",
        F.coalesce("date", dates.parse(F.col("date_str"))).alias("date"),
        F.coalesce("page.title", "file.title").alias("title"),
        "length",
        F.when(is_html, F.col("page.text")).when(is_file, F.col("file.text")).otherwise(F.regexp_replace("body", r"[ \t\n\x0B\f\r]+", " ")).alias("content"),
        F.col("supplied").alias("suppliedContentType"),
        F.col("detected").alias("detectedContentType"),
        F.when(F.col("format") == "arc", None).otherwise(F.col("warc_type") == "revisit").alias("isRevisit"),
        page.outlinks(F.col("targets")).alias("outlinks"),
        "rec_seq",
        F.coalesce("error", "page.error", "file.error").alias("error"),
    )


def parse_log(requested: DataFrame, parsed: DataFrame) -> DataFrame:
    """PARSE_LOG of the requested (arcname, path): ok, empty, truncated or failed; parsed has the rows of damage."""
    damaged = F.col("url").isNull() & F.col("error").isNotNull()
    found = parsed.groupBy(F.col("filename").alias("arcname")).agg(
        F.count_if(~damaged).alias("n"), F.max(F.when(damaged, F.col("error"))).alias("error"), F.max(F.when(damaged, F.col("rec_seq"))).alias("last")
    )
    rows = requested.join(found, "arcname", "left")
    n = F.coalesce("n", F.lit(0))
    status = F.when(F.col("error").isNotNull(), F.when(F.coalesce("last", F.lit(0)) > 0, "truncated").otherwise("failed")).when(n > 0, "ok").otherwise("empty")
    return rows.select("arcname", "path", status.alias("status"), n.alias("n_records"), "error")


def unparsed(requested: DataFrame, log: DataFrame) -> DataFrame:
    """Requested archives that the log doesn't have as parsed."""
    return requested.join(log.where("status in ('ok', 'empty')").select("arcname"), "arcname", "left_anti")


def without_records(requested: DataFrame, parsed: DataFrame) -> DataFrame:
    """Requested archives that gave no record."""
    return requested.join(parsed.select(F.col("filename").alias("arcname")).distinct(), "arcname", "left_anti")
