"""Indexing finds what is known by filters, and reads the parts that may hold it alone."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from capturelake import api
from capturelake.api import Archive
from capturelake.config import Config
from capturelake.operators import captures
from tests import archives


def put(tmp_path, name, pages):
    (tmp_path / name).write_bytes(archives.warc([(f"http://example.org/{p}", "20080430204825", archives.http(200, "text/html", f"<body>{text}".encode())) for p, text in pages]))
    return str(tmp_path / name)


def test_only_parts_whose_filter_hits_are_opened(spark, tmp_path):
    archive = Archive(spark, Config(str(tmp_path / "base"), buckets=4))
    files = {
        "a.warc.gz": [(f"a{i}", "text") for i in range(6)],
        "b.warc.gz": [(f"b{i}", "text") for i in range(6)],
        "c.warc.gz": [("b3", "text"), ("c1", "text")],
        "d.warc.gz": [(f"a{i}x", "other") for i in range(4)],
    }
    archive.parse([put(tmp_path, n, p) for n, p in files.items()])
    archive.index(["a.warc.gz"])
    archive.index(["b.warc.gz"])
    first, second = (p["name"] for p in archive._parts())
    archive.index(["c.warc.gz"])
    assert [p for p, _ in archive.opened] == [second] and len({b for _, b in archive.opened}) == 1
    assert [p["name"] for p in archive._parts()][:2] == [first, second]
    # ids between those of the first part, none of them known
    archive.index(["d.warc.gz"])
    assert len(archive.opened) <= 1
    archive.index(["a.warc.gz"])
    assert {p for p, _ in archive.opened} >= {first} and second not in {p for p, _ in archive.opened}
    got = {r["url"][19:]: sorted(r["arcname"]) for r in archive.documents().collect()}
    want = {}
    for n, pages in files.items():
        for p, _ in pages:
            want.setdefault(p, []).append(n)
    assert got == want


DOC = "id string, arcname string, date timestamp, job string, content string, url string, rec_seq long, ingest_seq long"


def test_many_calls_give_the_rows_of_one_merge(spark, tmp_path, monkeypatch):
    """Random documents in five calls, some without content first; as captures.merge over all at once."""
    rng = random.Random(6)
    when = datetime.datetime(2020, 1, 1)
    calls = [[(f"id{rng.randint(0, 30)}", f"arc{c}", when, None, rng.choice(["", None, f"text {c} {k}"]), f"u{c}-{k}", k, c) for k in range(20)] for c in range(5)]
    archive = Archive(spark, Config(str(tmp_path / "base"), buckets=3))
    log = {f"arc{c}": ("ok", 1) for c in range(5)}
    monkeypatch.setattr(archive, "_log", lambda: spark.createDataFrame([(a, a, *x, None) for a, x in log.items()], "arcname string, path string, status string, n_records long, error string"))
    for c, rows in enumerate(calls):
        df = spark.createDataFrame(rows, DOC)
        with monkeypatch.context() as m:
            m.setattr(archive, "_parsed", lambda names, df=df: df.withColumn("filename", F.col("arcname")).drop("ingest_seq"))
            m.setattr(captures, "project", lambda records, *a: records.drop("filename"))
            archive.index([f"arc{c}"])
    docs, occurrences = captures.merge(spark.createDataFrame([r for rows in calls for r in rows], DOC))
    want = {r["id"]: (r["url"], r["content"] or "", sorted(r["arcname"])) for r in captures.view(docs, occurrences).collect()}
    got = {r["id"]: (r["url"], r["content"] or "", sorted(r["arcname"])) for r in archive.documents().collect()}
    assert got == want


def test_filters_miss_nothing_and_pass_few(spark):
    ids = spark.range(20_000).select(F.concat(F.lit("id"), F.col("id")).alias("id"))
    words = 1 << (20_000 * api.FILTER_BITS // 64).bit_length()
    word, mask = api.probe(words)
    held = ids.select(word.alias("word"), mask.alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("bits"))
    assert held.count() <= words and held.agg(F.max("word")).first()[0] < words
    own = ids.select("id", word.alias("word"), mask.alias("mask")).join(held, "word").where("bits & mask = mask")
    assert own.count() == 20_000
    other = ids.select(F.concat(F.lit("x"), "id").alias("id"))
    assert other.select("id", word.alias("word"), mask.alias("mask")).join(held, "word").where("bits & mask = mask").count() < 600


def test_search_errors_are_the_services(spark, tmp_path):
    archive = Archive(spark, str(tmp_path / "base"))
    archive.parse([put(tmp_path, "a.warc.gz", [("a", "text")])])
    archive.index(["a.warc.gz"])
    with pytest.raises(ValueError, match="contentlength"):
        archive.search("contentlength:abc")
