from __future__ import annotations

import base64
import datetime
import gzip
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from capturelake.api import Archive, IndexError_, UnparsedError
from capturelake.config import Config, fields
from capturelake.functions import dates, mime, text, urls
from capturelake import schema
from capturelake.operators import captures, documents, extras, graph, html, parse, relevance, search
from capturelake.sources import export, records, webarchive
from tests import archives


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "line, want",
    [("text/plain; charset=utf-8", ("text", "plain", "utf-8")), ("xxx", None), ("application/xhtml+xml", None), ("Text/HTML", None), ("text/html, text/plain", ("text", "html", None)), (None, None)],
)
def test_mime_parse(spark, line, want):
    got = one(spark, mime.parse(F.lit(line).cast("string")))
    assert (None if got is None else tuple(got)) == want


def test_mime_groups(spark):
    want = {"text/html": "html", "image/png": "image", "video/x": "video", "audio/x": "audio", "application/pdf": "pdf", "application/zip": "compressed", "application/vnd.ms-excel": "office", "application/XXXX": None}
    assert {k: one(spark, mime.group(mime.parse(F.lit(k)))) for k in want} == want
    assert one(spark, mime.shown(mime.force_parse(F.lit("xxx")))) == "application/octet-string"
    assert one(spark, mime.shown(mime.parse(F.lit("application/xhtml+xml"), strict=False))) == "application/xhtml+xml"


def test_urls(spark):
    pairs = [("http://www.example.org", "http://example.org/"), ("http://example.org/PATH", "http://example.org/path"), ("http://example.org/?y=2&x=1", "http://example.org/?x=1&y=2"), ("http://example.org:80/a#b", "http://example.org/a"), ("nothing", "nothing")]
    for a, b in pairs:
        assert one(spark, urls.canonicalize(F.lit(a))) == b
    assert one(spark, urls.host(F.lit("http://example.org:81/"))) == "example.org"
    data = b"hello"
    assert one(spark, urls.payload_digest(F.lit(bytearray(data)))) == base64.b32encode(hashlib.sha1(data).digest()).decode()
    fp = 6656094076900584517
    assert one(spark, urls.string_to_fp(urls.fp_to_string(F.lit(fp)))) == fp
    back = one(spark, urls.decode_fp_date(urls.encode_fp_date(F.lit(fp), F.timestamp_seconds(F.lit(1368725942)))))
    assert back["fp"] == fp and back["date"] == datetime.datetime(2013, 5, 16, 17, 39, 2)
    assert one(spark, urls.bytes_to_int(urls.int_to_bytes(F.lit(-2)))) == -2


def test_dates(spark):
    for s in ("20130516173902", "2013-05-16T17:39:02Z"):
        assert one(spark, dates.millis(dates.parse(F.lit(s)))) == 1368725942000
    assert one(spark, dates.parse(F.lit("2013"))) is None
    assert one(spark, dates.shown(dates.parse(F.lit("20130516173902")))) == "2013-05-16T17:39:02Z"


def test_stemmer_and_analysis(spark):
    want = {"running": "run", "flies": "fli", "ponies": "poni", "hoping": "hope", "relational": "relat", "generously": "generous", "dontstems": "dontstems", "skies": "sky", "by": "by"}
    assert {w: text.stem(w) for w in want} == want
    assert one(spark, text.analyze(F.lit("Wi-Fi PowerShot500 stopworda Wi-Fi"))) == ["wi", "fi", "wifi", "power", "shot", "500", "powershot"]
    assert one(spark, text.analyze_url(F.lit("http://A.org/b-c"))) == ["http", "a", "org", "b", "c"]


def test_words_are_analysed_once_a_worker(monkeypatch):
    calls, stem = [], text.stem
    monkeypatch.setattr(text, "stem", lambda w: calls.append(w) or stem(w))
    text._known.cache_clear()
    long = "x" * (text.LONG + 1)
    assert text.positions(f"Wi-Fi stopworda {long} " * 2 + "...") == [("wi", 0), ("fi", 1), ("wifi", 1), (long, 3), ("wi", 4), ("fi", 5), ("wifi", 5), (long, 7)]
    assert sorted(calls) == sorted(["wi", "fi", "wifi", long, long])
    text._known.cache_clear()


def test_html():
    title, body, links, error = html.page('<html><head><title>A &amp; B</title><style>x</style></head><body>One<p>two\n three<a href="/x">li<b>nk</b></a><a href="mailto:q">m</a><a>n</a><script>s</script>')
    assert (title, body, links, error) == ("A & B", "One two threelinkmn", [("/x", "link")], None)
    assert html.page(None) == (None, None, [], None)


def test_html_references_without_their_semicolon():
    """Browsers read some of them; a cut title that ends in one is read as its SQL reads it with closed."""
    page = "<title>A &amp; B&&amp</title><body>x &amp &lt;&#65;&#66 &ampfoo; &unknown; \ufdd0<a href='?a=1&amp;b=2'>&amp</a><script>&amp</script>"
    assert html.page(page)[:3] == ("A & B&&", "x & <AB &foo; &unknown; \ufdd0&", [("?a=1&b=2", "&")])
    assert html.page(page, closed=True)[:3] == ("A & B&&amp", "x &amp <A&#66 &ampfoo; &unknown; \ufdd0&amp", [("?a=1&b=2", "&amp")])
    assert html.page("<p>no & marks&amp;", closed=True)[1] == " no & marks&"


def test_html_columns_agree_with_pages(spark):
    rows = spark.createDataFrame([(1, "http://a.org/x/", "<title>T &amp</title><a href='b'>l</a><a href='http://[bad'>m</a>"), (2, None, None)], "k int, url string, html string")
    for closed in (False, True):
        got = {r["k"]: r["p"] for r in rows.select("k", html.extract("html", closed).alias("p")).collect()}
        for k, _, h in rows.collect():
            title, body, links, error = html.page(h, closed)
            assert (got[k]["title"], got[k]["text"], [tuple(x) for x in got[k]["links"]], got[k]["error"]) == (title, body, links, error)
    found = rows.select("k", html.targets("url", "html").alias("a"), html.resolve("url", F.transform(html.extract("html")["links"], lambda x: x["to"])).alias("b")).collect()
    assert [r["a"] for r in found] == [r["b"] for r in found] == [["http://a.org/x/b", "http://[bad"], []]


RECORDS = [
    ("http://www.Example.org/a", "20080430204825", archives.http(200, "text/html; charset=utf-8", b"<html><title>T</title><body>hello <a href='/b'>b</a></body></html>")),
    ("http://example.org/missing", "20080430204826", archives.http(404, "text/html", b"<html>no</html>")),
    ("dns:example.org", "20080430204827", b""),
    ("http://example.org/p.png", "20080430204828", archives.http(200, "image/png", b"\x89PNG\r\n\x1a\n0000")),
    ("http://example.org/t", "20080430204829", archives.http(200, "text/x; q=1", b"plain  text", "content-type: text/plain\r\n  ; charset=utf-8\r\n")),
]


def test_arc_and_warc_agree(spark, tmp_path):
    (tmp_path / "a.arc.gz").write_bytes(archives.arc(RECORDS))
    (tmp_path / "a.warc.gz").write_bytes(archives.warc(RECORDS))
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    (tmp_path / "cut.warc.gz").write_bytes(archives.warc(RECORDS)[:-30])
    (tmp_path / "not.warc.gz").write_bytes(b"something else")
    raw = parse.read_archives(spark, str(tmp_path)).cache()
    assert raw.where("filename = 'a.warc.gz'").count() == 5
    got = parse.parse(raw).drop("rec_seq", "isRevisit", "error")
    a, w = (sorted(map(tuple, got.where(F.col("filename") == n).drop("filename", "length").collect()), key=str) for n in ("a.arc.gz", "a.warc.gz"))
    assert a == w and len(a) == 3
    first = got.where("filename = 'a.arc.gz' and title = 'T'").first()
    assert first["content"] == "hello b" and len(first["outlinks"]) == 1
    requested = spark.createDataFrame([(n, n) for n in ("a.arc.gz", "a.warc.gz", "empty.warc.gz", "cut.warc.gz", "not.warc.gz")], "arcname string, path string")
    log = {r["arcname"]: (r["status"], r["n_records"]) for r in parse.parse_log(requested, parse.parse(raw, damage=True)).collect()}
    assert log == {"a.arc.gz": ("ok", 3), "a.warc.gz": ("ok", 3), "empty.warc.gz": ("empty", 0), "cut.warc.gz": ("truncated", 2), "not.warc.gz": ("failed", 0)}
    with pytest.raises(Exception, match="."):
        parse.read_archives(spark, str(tmp_path / "not.warc.gz"), "FAILFAST").count()
    assert {r["filename"] for r in parse.read_archives(spark, str(tmp_path)).where("filename = 'a.arc.gz' and status = 404").collect()} == {"a.arc.gz"}


def a_pdf() -> bytes:
    import zlib

    shown = zlib.compress(b"BT /F1 12 Tf (Hello \\(PDF\\) ) Tj 0 -14 Td [(wor) 20 (ld) -300 (again)] TJ <414243> Tj ET")
    return (
        b"%%PDF-1.4\n1 0 obj << /Title (A \\351t\\351) /Author (x) >> endobj\n"
        b"2 0 obj << /Type /Annot /A << /S /URI /URI (http://example.org/from-pdf) >> >> endobj\n"
        b"3 0 obj << /Length %d /Filter /FlateDecode >>\nstream\n" % len(shown) + shown + b"\nendstream endobj\n"
        b"4 0 obj << /Length 30 >>\nstream\nBT (plain stream) Tj ET\nendstream endobj\n%%EOF"
    )


def a_docx() -> bytes:
    import io
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="w"><w:body><w:p><w:r><w:t>Hel</w:t></w:r><w:r><w:t>lo</w:t></w:r></w:p><w:p><w:t>office</w:t></w:p></w:body></w:document>')
        z.writestr("docProps/core.xml", '<c:p xmlns:c="c" xmlns:dc="d"><dc:title>T</dc:title></c:p>')
        z.writestr("word/_rels/document.xml.rels", '<R xmlns="r"><Relationship Type="x/hyperlink" Target="http://example.org/from-docx" TargetMode="External"/></R>')
    return out.getvalue()


def test_files_of_documents():
    assert documents.document(a_pdf()) == ("A été", "Hello (PDF) world againABC plain stream", [("http://example.org/from-pdf", "")], None)
    assert documents.document(a_docx()) == ("T", "Hello office", [("http://example.org/from-docx", "")], None)
    assert documents.document(b"PK\x03\x04 broken")[3].startswith("BadZipFile") and documents.document(None) == documents.document(b"other") == (None, None, [], None)
    assert documents.document(b"%PDF-1.4 << /Encrypt 3 0 R >>")[3] == "the file is encrypted"


def test_documents_in_archives(spark, tmp_path):
    (tmp_path / "d.warc.gz").write_bytes(archives.warc([(f"http://h/{n}", "20080430204825", archives.http(200, t, b)) for n, t, b in (("p", "application/pdf", a_pdf()), ("o", "application/zip", a_docx()), ("bad", "application/zip", b"PK\x03\x04 broken"))]))
    got = {r["url"][-1]: r for r in parse.parse(parse.read_archives(spark, f"{tmp_path}/d.warc.gz")).collect()}
    assert (got["p"]["title"], got["p"]["content"][:11], len(got["p"]["outlinks"])) == ("A été", "Hello (PDF)", 1)
    assert (got["o"]["content"], len(got["o"]["outlinks"])) == ("Hello office", 1)
    assert got["d"]["content"] is None and got["d"]["error"].startswith("BadZipFile")


def test_json_files(spark, tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(archives.warc(RECORDS))
    got = parse.parse(parse.read_archives(spark, str(tmp_path / "a.warc.gz")))
    n = {r["filename"]: r["n_records"] for r in records.write_json_arrays(got, str(tmp_path / "json"), ["none.warc.gz"]).collect()}
    assert n == {"a.warc.gz": 3, "none.warc.gz": 0}
    with gzip.open(tmp_path / "json/a.warc.gz.json.gz") as f:
        items = json.load(f)
    assert items[0]["date"] == 1209588505000 and "isRevisit" in items[0]
    back = records.read_json(spark, str(tmp_path / "json/a.warc.gz.json.gz"))
    assert sorted(r["url"] for r in back.collect()) == sorted(r["url"] for r in got.collect())


def test_json_compressions_and_decompression(spark, tmp_path):
    import bz2

    df = spark.createDataFrame([("a.warc.gz", "http://h/")], "filename string, url string")
    for c, kind in zip(schema.PARSED_RECORD.split(", ")[1:], range(9), strict=False):
        del kind
        name = c.split(" ")[0]
        if name not in df.columns and name.isalpha():
            df = df.withColumn(name, F.lit(None).cast({"date": "timestamp", "length": "bigint", "outlinks": "array<bigint>", "isRevisit": "boolean"}.get(name, "string")))
    for name in ("suppliedContentType", "detectedContentType", "isRevisit", "outlinks"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    for suffix, opened in ((".json.bz2", bz2.open), (".json", open), (".json.gz", gzip.open)):
        records.write_json_arrays(df, str(tmp_path / "j"), suffix=suffix)
        with opened(tmp_path / f"j/a.warc.gz{suffix}", "rb") as f:
            assert json.load(f) == [{"filename": "a.warc.gz", "url": "http://h/"}]
    (tmp_path / "j/b.warc.gz.json.gz").write_bytes(gzip.compress(b"[1]"))
    (tmp_path / "j/c.warc.gz.json.gz").write_bytes(b"no gzip")
    got = {r["name"]: r["status"] for r in records.decompress(spark, str(tmp_path / "j")).collect()}
    assert got == {"a.warc.gz.json.gz": "skipped", "b.warc.gz.json.gz": "done", "c.warc.gz.json.gz": "bad"}
    assert (tmp_path / "j/b.warc.gz.json").read_bytes() == b"[1]" and (tmp_path / "j/c.warc.gz.json.gz.bad").exists() and not (tmp_path / "j/b.warc.gz.json.gz").exists()


def test_scratch_folders(spark, tmp_path):
    from capturelake import scratch

    assert scratch.qualified(spark, "/a/b/") == "file:///a/b" and scratch.shared_dir(spark).startswith("file:///")
    work = scratch.Scratch(spark, "t")
    assert work.save(spark.range(3), "x").count() == 3 and os.path.isdir(work.path("x").removeprefix("file://"))
    kept, scratch._ROOTS[:] = list(scratch._ROOTS), [(spark, work.root)]
    scratch._clear()
    scratch._ROOTS[:] = kept
    assert not os.path.isdir(work.path("x").removeprefix("file://"))


def test_extras(spark):
    df = spark.createDataFrame([("a", 1.0, 52.5, 13.4, "Crème brûlée ﬁn"), ("b", 2.0, 52.6, 13.5, None), ("c", 3.0, -52.5, 179.9, "x")], "id string, score double, lat double, lon double, t string")
    top = extras.ranked(extras.elevate(df.select("id", "score"), ["a"], ["c"]), 5).collect()
    assert [(r["id"], r["place"]) for r in top] == [("a", 0), ("b", 1)]
    assert extras.peek(df.orderBy("id"))["id"] == "a" and extras.peek(df.limit(0)) is None
    near = lambda at, km: {r["id"] for r in df.where(extras.within(F.col("lat"), F.col("lon"), at, km)).collect()}
    assert near((52.5, 13.4), 5) == {"a"} and near((52.5, 13.4), 20) == {"a", "b"} and near((-52.5, -179.9), 30) == {"c"} and near((89.9, 0.0), 20_000) == {"a", "b", "c"}
    assert [r["x"] for r in df.select(extras.fold_accents("t").alias("x")).collect()] == ["Creme brulee fin", None, "x"]
    assert one(spark, extras.with_synonyms(F.array(F.lit("tv"), F.lit("x")), {"tv": ["television", "x"]})) == ["tv", "television", "x"]
    assert {r["id"] for r in extras.related(df, spark.createDataFrame([("b",), ("b",)], "other string"), "other", "id").collect()} == {"b"}
    docs = spark.createDataFrame([(i, ["red", "apple", "fruit"] if i % 2 else ["fast", "car", "road"]) for i in range(20)] + [(99, [])], "id long, w array<string>")
    got = {r["id"]: r["cluster"] for r in extras.clusters(docs, "id", F.col("w"), 2).collect()}
    assert len(got) == 20 and len({(i % 2, c) for i, c in got.items()}) == 2


def test_merge_and_unmerge(spark, tmp_path):
    """The sizes and dates of three crawls that share pages, and of taking them out again."""
    def crawl(name, pages):
        (tmp_path / name).write_bytes(archives.warc([(f"http://example.org/{u}", f"200804302048{i:02d}", archives.http(200, "text/html", body.encode())) for i, (u, body) in enumerate(pages)]))

    crawl("A.warc.gz", [("robots.txt", "r"), ("", "one"), ("x.jpeg", "j"), ("x.jpeg", "j")])
    crawl("B.warc.gz", [("", "two"), ("x.jpeg", "j")])
    crawl("C.warc.gz", [("", "two"), ("x.jpeg", "j")])
    archive = Archive(spark, str(tmp_path / "base"))
    with pytest.raises(UnparsedError):
        archive.index(["A.warc.gz"])
    archive.parse([str(tmp_path / "A.warc.gz"), str(tmp_path / "B.warc.gz"), str(tmp_path / "C.warc.gz")])
    assert archive.is_parsed("A.warc.gz") and not archive.is_parsed("Z.warc.gz")

    def sizes():
        return sorted(len(r["date"]) for r in archive.documents().collect())

    archive.index(["A.warc.gz"], "x")
    assert sizes() == [1, 1, 1]
    archive.index(["B.warc.gz"], "x")
    assert sizes() == [1, 1, 1, 2]
    archive.index(["C.warc.gz"], "x")
    archive.index(["C.warc.gz"], "x")
    assert sizes() == [1, 1, 2, 3]
    archive.set_fields("arcname:B.warc.gz", {"tag": ["hello world", "b"]})
    assert archive.search('tag:"hello world"').count() == 2
    with archive.lock(), pytest.raises(IndexError_):
        archive.remove(["C.warc.gz"])
    archive.remove(["C.warc.gz"])
    assert sizes() == [1, 1, 1, 2]
    archive.remove(["B.warc.gz"])
    assert sizes() == [1, 1, 1]
    archive.remove(["A.warc.gz"])
    assert sizes() == []
    archive.delete_parse("A.warc.gz")
    archive.delete_parse("A.warc.gz")
    assert not archive.is_parsed("A.warc.gz")


@pytest.fixture
def crawls(spark, tmp_path):
    """An archive service with two parsed crawls that share a page."""
    for name, pages in (("A.warc.gz", ["one", "shared"]), ("B.warc.gz", ["shared", "two"])):
        (tmp_path / name).write_bytes(archives.warc([(f"http://example.org/{p}", "20080430204825", archives.http(200, "text/html", f"<body>{p} text".encode())) for p in pages]))
    archive = Archive(spark, Config(str(tmp_path / "base"), retry_seconds=0.0, archives_per_job=1))
    archive.parse([str(tmp_path / "A.warc.gz"), str(tmp_path / "B.warc.gz")])
    return archive


def urls_of(archive):
    return sorted(r["url"].rpartition("/")[2] for r in archive.documents().collect())


def test_a_failure_before_the_manifest_changes_nothing(crawls, monkeypatch):
    crawls.index(["A.warc.gz"])
    with monkeypatch.context() as m:
        m.setattr(Archive, "_commit", lambda self, parts: (_ for _ in ()).throw(OSError("the driver dies here")))
        for change in (lambda: crawls.index(["B.warc.gz"]), lambda: crawls.remove(["A.warc.gz"]), lambda: crawls.set_fields("*:*", {"tag": ["x"]})):
            with pytest.raises(IndexError_, match="dies"):
                change()
            assert urls_of(crawls) == ["one", "shared"]
    opened = crawls.documents()
    crawls.index(["B.warc.gz"])
    assert urls_of(crawls) == ["one", "shared", "two"] and opened.count() == 2


def test_commits_are_tried_again_and_java_errors_are_wrapped(crawls, monkeypatch):
    failed = []
    write = Archive._write_text

    def flaky(self, name, text, overwrite=True):
        if name.startswith("_versions") and len(failed) < 3:
            failed.append(name)
            self._fs().open(self.fs_path(f"{self.base}/nowhere"))  # an error of the store
        write(self, name, text, overwrite)

    monkeypatch.setattr(Archive, "_write_text", flaky)
    crawls.index(["A.warc.gz"])
    assert len(failed) == 3 and urls_of(crawls) == ["one", "shared"]
    monkeypatch.setattr(Archive, "_write_text", lambda self, name, *a, **k: self._fs().open(self.fs_path(f"{self.base}/nowhere")) if "draft" in name else write(self, name, *a, **k))
    with pytest.raises(IndexError_):
        crawls.index(["B.warc.gz"])


def test_an_old_lock_is_taken_over(crawls, spark):
    crawls._write_text("_lock", "of a dead writer")
    with pytest.raises(IndexError_, match="lock"):
        crawls.index(["A.warc.gz"])
    Archive(spark, Config(crawls.base, lock_seconds=0.0)).index(["A.warc.gz"])
    assert urls_of(crawls) == ["one", "shared"] and not crawls._exists("_lock")


def test_changes_write_only_the_parts_they_touch(crawls):
    crawls.index(["A.warc.gz"])
    crawls.index(["B.warc.gz"])
    first, second = (p["name"] for p in crawls._parts())
    crawls.set_fields('url:"http://example.org/two"', {"tag": ["t"]})
    assert crawls._parts()[0]["name"] == first and crawls._parts()[1]["name"] != second
    assert crawls.search("tag:t").count() == 1
    assert sorted(len(r["arcname"]) for r in crawls.search("text").collect()) == [1, 1, 2]
    assert crawls.search("text AND arcname:B.warc.gz").count() == 2
    with pytest.raises(search.QueryError):
        crawls.search("nofield2:[1 TO 2]")
    assert {r["url"][-3:] for r in crawls.search('"two texts"').collect()} == {"two"} and crawls.search('content:"text two"').count() == 0
    crawls.remove(["B.warc.gz"])
    assert [p["name"] for p in crawls._parts()] == [first] and urls_of(crawls) == ["one", "shared"]
    crawls.index(["B.warc.gz"])
    crawls.compact()
    assert len(crawls._parts()) == 1 and urls_of(crawls) == ["one", "shared", "two"]
    assert sorted(len(r["arcname"]) for r in crawls.documents().collect()) == [1, 1, 2]
    crawls.remove(["A.warc.gz", "B.warc.gz"])
    assert crawls.documents().count() == 0
    crawls.index(["A.warc.gz"])
    assert urls_of(crawls) == ["one", "shared"]


def test_long_bodies_are_read_through(tmp_path):
    big = b"x" * 3_000_000
    page = archives.http(200, "text/plain", big)
    (tmp_path / "a.warc.gz").write_bytes(archives.warc([("http://h/big", "20080430204825", page), ("http://h/small", "20080430204826", archives.http(200, "text/plain", b"s"))]))
    rows = list(webarchive.records(str(tmp_path / "a.warc.gz"), most=1_000_000))
    want = base64.b32encode(hashlib.sha1(big).digest()).decode()
    assert [(r[3], r[10], r[12], r[13]) for r in rows] == [("http://h/big", 200, want, None), ("http://h/small", 200, None, b"s")]
    (tmp_path / "b.warc.gz").write_bytes(archives.warc([("http://h/a", "20080430204825", archives.http(200, "text/html", b"x"))], digest={"http://h/a": "not a digest"}))
    assert next(webarchive.records(str(tmp_path / "b.warc.gz")))[12] is None


def test_checked_mode_tells_wrong_content_from_broken_files(tmp_path):
    data = archives.warc(RECORDS)
    (tmp_path / "cut.warc.gz").write_bytes(data[:-30])
    (tmp_path / "wrong.warc.gz").write_bytes(data + gzip.compress(b"WARC/1.0\r\nContent-Length: 99\r\n\r\nshort"))
    (tmp_path / "plain.warc").write_bytes(b"nothing")
    assert list(webarchive.records(str(tmp_path / "cut.warc.gz"), "CHECKED"))[-1][-1].startswith("EOFError")
    assert list(webarchive.records(str(tmp_path / "plain.warc"), "CHECKED"))[-1][-1].startswith("Damaged")
    with pytest.raises(webarchive.Damaged):
        list(webarchive.records(str(tmp_path / "wrong.warc.gz"), "CHECKED"))


def test_cursor(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(23)], "id long, v string")
    cursor = search.Cursor(df, rows=5)
    assert len(cursor) == 23 and [r["id"] for r in cursor] == list(range(23)) and list(search.Cursor(df.limit(0))) == []


def test_other_stores_and_zip_entries(tmp_path):
    import zipfile

    data = archives.warc(RECORDS)
    (tmp_path / "a.warc.gz").write_bytes(data)
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("in/a.warc.gz", data)
    for place in (f"file://{tmp_path}/a.warc.gz", f"jar:file://{tmp_path}/z.zip!/in/a.warc.gz"):
        assert webarchive.locations(place)[0].endswith("a.warc.gz") and len(list(webarchive.records(webarchive.locations(place)[0]))) == 5
    assert list(webarchive.records("mock://nowhere/a.warc.gz"))[0][-1]


def test_exported_captures_are_read_back(spark, tmp_path):
    rows = [(f"f{i % 3}.warc.gz", f"http://h/{i}", datetime.datetime(2020, 1, 1, 0, 0, i), 200, "text/plain", b"p%d" % i if i else None, i) for i in range(20)]
    df = spark.createDataFrame(rows, "filename string, url string, date timestamp, status int, content_type string, payload binary, rec_seq long")
    n = {r["filename"]: r["n_records"] for r in export.write_warcs(df, f"file://{tmp_path}/out").collect()}
    assert n == {"f0.warc.gz": 7, "f1.warc.gz": 7, "f2.warc.gz": 6}
    back = parse.read_archives(spark, f"{tmp_path}/out", "FAILFAST").collect()
    assert sorted((r["filename"], r["url"], r["date"], bytes(r["payload"]), r["rec_seq"]) for r in back) == sorted((f, u, d, p or b"", i // 3) for f, u, d, _, _, p, i in rows)


def test_command_line(spark, tmp_path, capsys):
    from capturelake.__main__ import main

    (tmp_path / "A.warc.gz").write_bytes(archives.warc(RECORDS))
    (tmp_path / "list").write_text(f"{tmp_path}/A.warc.gz\n")
    base = str(tmp_path / "base")
    assert main([base, "parse", str(tmp_path / "list")]) == 0 and "A.warc.gz\tok\t3" in capsys.readouterr().out
    assert main([base, "isparsed", "A.warc.gz"]) == 0 and main([base, "isparsed", "B.warc.gz"]) == 1
    assert main([base, "index", "-i", "x", "-f", "job=j1", "A.warc.gz"]) == 0
    assert main([base, "set-fields", "job:j1", "tag=a,b"]) == 0
    found = Archive(spark, base).search("tag:b")
    assert found.count() == 3 and all(r["id"].endswith(".x") for r in found.collect())
    assert main([base, "remove", "A.warc.gz"]) == 0 and main([base, "deleteparse", "A.warc.gz"]) == 0
    assert main([base, "isparsed", "A.warc.gz"]) == 1


def test_streaming_ingest_goes_on_after_a_bad_archive(spark, tmp_path):
    from capturelake.streaming import ingest

    (tmp_path / "A.warc.gz").write_bytes(archives.warc(RECORDS))
    (tmp_path / "bad.warc.gz").write_bytes(b"something else")
    (tmp_path / "lists").mkdir()
    archive = Archive(spark, str(tmp_path / "base"))

    def arrive(name, lines):
        (tmp_path / "lists" / name).write_text("\n".join(str(tmp_path / x) for x in lines))
        ingest.watch(spark, archive, str(tmp_path / "lists"), str(tmp_path / "checkpoint")).awaitTermination()

    arrive("1.txt", ["A.warc.gz", "bad.warc.gz"])
    assert archive.documents().count() == 3
    (tmp_path / "B.warc.gz").write_bytes(archives.warc(RECORDS[:1]))
    arrive("2.txt", ["B.warc.gz", "A.warc.gz"])
    assert sorted(len(r["arcname"]) for r in archive.documents().collect()) == [1, 1, 2]


def test_streamed_repeats_are_left_out(spark, tmp_path):
    from capturelake.streaming import ingest

    rows = [("i", "A", datetime.datetime(2020, 1, 1)), ("i", "A", datetime.datetime(2020, 1, 1, 1)), ("i", "B", datetime.datetime(2020, 1, 1)), ("j", "A", datetime.datetime(2020, 1, 1))]
    spark.createDataFrame(rows, "id string, arcname string, date timestamp").write.parquet(f"{tmp_path}/in")
    stream = ingest.distinct_captures(spark.readStream.schema("id string, arcname string, date timestamp").parquet(f"{tmp_path}/in"))
    q = stream.writeStream.format("memory").queryName("distinct_captures").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start()
    q.awaitTermination()
    assert sorted(tuple(r)[:2] for r in spark.table("distinct_captures").collect()) == [("i", "A"), ("i", "B"), ("j", "A")]


def test_graphs_are_kept_and_checked(spark, tmp_path):
    rows = [("http://a/", datetime.datetime(2020, 1, 1), [{"to": "/b", "text": "B"}, {"to": "http://c/", "text": "C"}, {"to": "/b", "text": "again"}]), ("http://c/", None, [{"to": "http://A", "text": ""}])]
    pages = spark.createDataFrame(rows, "url string, date timestamp, links array<struct<to:string,text:string>>")
    found = graph.links(pages)
    assert sorted((r["src"], r["dst"], r["text"]) for r in found.collect()) == [("http://a/", "http://a/b", "B"), ("http://a/", "http://a/b", "again"), ("http://a/", "http://c/", "C"), ("http://c/", "http://a/", "")]
    edges = found.select("src", "dst").distinct()
    graph.save(edges, graph.nodes(edges), f"{tmp_path}/g")
    nodes, followed = graph.load(spark, f"{tmp_path}/g")
    assert graph.check(nodes, followed) == [] and {tuple(r["successors"]) for r in followed.collect()} == {(1, 2), (0,)}
    assert graph.check(nodes.where("node_id > 0"), followed) == ["nodes are not numbered from 0 without gaps", "range: 1 rows", "node: 1 rows"]
    assert graph.check(nodes, spark.createDataFrame([(9, [1, 0])], "node_id long, successors array<long>")) == ["sorted: 1 rows", "node: 1 rows"]


def test_scores_are_explained_and_boosted(spark):
    df = spark.createDataFrame([(1, "a b a", 0.5), (2, "b", 2.0), (3, "c", 9.0), (4, None, 1.0)], "id long, t string, w double")
    words = F.split("t", " ")
    plain = {r["id"]: r["score"] for r in relevance.score(df, "id", words, ["a", "b"], "bm25").collect()}
    told = {r["id"]: r for r in relevance.score(df, "id", words, ["a", "b"], "bm25", boost=F.col("w"), explain=True).collect()}
    assert set(plain) == set(told) == {1, 2}
    for i, r in told.items():
        assert sum(x["share"] for x in r["explain"]) == pytest.approx(plain[i]) == r["score"] - {1: 0.5, 2: 2.0}[i]
    assert [(x["term"], x["tf"], x["df"]) for x in told[1]["explain"]] == [("a", 2, 1), ("b", 1, 2)]
    like = {r["id"]: r["score"] for r in relevance.more_like(df, "id", words, 1).collect()}
    assert like == {2: pytest.approx(1.0)}
    assert relevance.more_like(df, "id", words, 99).count() == 0


def test_missing_values_sort_last(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a")], "id long, k string")
    assert [r["id"] for r in search.page(df, ["k"], 0, 9).collect()] == [3, 1, 2]
    assert [r["id"] for r in search.page(df, [search.missing_last("k", descending=True)], 0, 9).collect()] == [1, 3, 2]


def test_content_is_the_first_that_is_not_empty(spark):
    rows = [("i", "A", 0, None), ("i", "B", 0, ""), ("i", "C", 0, "text"), ("i", "C", 1, "later"), ("j", "A", 1, None)]
    docs, occurrences = captures.merge(spark.createDataFrame(rows, "id string, arcname string, rec_seq long, content string"))
    assert {r["id"]: r["content"] for r in docs.collect()} == {"i": "text", "j": None}
    assert occurrences.count() == 4


@pytest.mark.parametrize(
    "query, want",
    [("*:*", {1, 2, 3}), ("k:a", {1, 3}), ("n:[1 TO 2}", {1}), ("n:[* TO 2]", {1, 2}), ("t:x", {1, 2}), ('t:"y z"', {2}), ("+k:a -t:x", {3}), ("k:b OR n:3", {2, 3}), ("k:a AND n:3", {3}), ("(k:a OR k:b) AND NOT n:3", {1, 2}), ("Hello", {1, 2})],
)
def test_search(spark, query, want):
    rows = [(1, "a", 1, ["x"], "hello there"), (2, "b", 2, ["x", "y z"], "say Hello"), (3, "a", 3, None, None)]
    df = spark.createDataFrame(rows, "id long, k string, n int, t array<string>, content string")
    assert {r["id"] for r in search.search(df, query).collect()} == want


TEXTS = [
    (1, "Hello big world", "The running dogs"),
    (2, "world, hello!", None),
    (3, "hello stopworda world", "run"),
    (4, "Wi-Fi PowerShot500", "x"),
    (5, None, "ran"),
    (6, "", "runs by"),
]


@pytest.mark.parametrize(
    "query, want",
    [
        ('content:"hello world"', set()),
        ('"hello big world"', {1}),
        ('"world hello"', {2}),
        ('"hello stopworda world"', {1, 3}),
        ("hello", {1, 2, 3}),
        ("title:run", {1, 3, 6}),
        ('title:"runs by"', {6}),
        ("content:wifi", {4}),
        ('content:"wi fi power shot 500"', {4}),
        ('content:"wifi power"', {4}),
        ("+hello -title:dog", {2, 3}),
        ("content:nothing OR title:x", {4}),
        ("content:stopworda", set()),
        ("content:*", {1, 2, 3, 4, 6}),
        ("NOT hello", {4, 5, 6}),
    ],
)
def test_text_search_with_and_without_index(spark, query, want):
    df = spark.createDataFrame(TEXTS, "id long, content string, title string")
    assert {r["id"] for r in search.search(df, query).collect()} == want
    assert {r["id"] for r in search.search_indexed(df, search.inverted(df), query).collect()} == want


def test_positions_agree_with_the_expressions(spark):
    values = ["Wi-Fi PowerShot500 stopworda Wi-Fi", "a1b2 C3PO", "éÉa x-1-2 -- _u_", "", "one  two\tthree", "iPhone4S's"]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = [r["x"] for r in df.select(text.analyze(F.col("t")).alias("x")).collect()]
    assert got == [list(dict.fromkeys(t for t, _ in text.positions(v, stemmed=False))) for v in values]


def test_address_search(spark):
    df = spark.createDataFrame([(1, "www.example.org", "http://www.example.org/a/b"), (2, "example.com", "http://example.com/b/a")], "id long, host string, url string")
    for query, want in (("hostt:example", {1, 2}), ('hostt:"example org"', {1}), ('urlt:"b a"', {2}), ('urlt:"a b"', {1}), ("urlt:org", {1})):
        assert {r["id"] for r in search.search(df, query).collect()} == want


def test_search_errors(spark):
    df = spark.createDataFrame([(1, "a")], "id long, k string")
    for bad in ("(k:a", "k:a AND", "k:[1 2]"):
        with pytest.raises(search.QueryError):
            search.search(df, bad, "k")
    assert search.pages_of(95, 10, 40) == {"current": 5, "count": 10, "previous": 4, "next": 6}


def test_config():
    c = Config.read(["base=/x", "commit_retries = 3", "# a=b", "strict_mime=false"], docs_per_page=5)
    assert (c.base, c.commit_retries, c.strict_mime, c.docs_per_page) == ("/x", 3, False, 5)
    assert fields(["a=1,2", "b=x"]) == {"a": ["1", "2"], "b": ["x"]}
    with pytest.raises(ValueError):
        Config.read(["unknown=1"])


def test_locations(tmp_path):
    (tmp_path / "l.txt").write_text("http://h/a.warc.gz\n\n/b.arc.gz\n")
    assert webarchive.locations(str(tmp_path / "l.txt")) == ["http://h/a.warc.gz", "/b.arc.gz"]
    assert webarchive.name_of("http://h/p/a.warc.gz?x=1") == "a.warc.gz"


def test_links_of_pages_are_read_by_one_worker_a_task(spark):
    """Two workers a task, with all texts between them, took the memory of several times the batch."""
    from capturelake.plans import catalogue

    plan = catalogue._links(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("EvalPython") == 1
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 2000
