"""Charsets told by marks, headers, markup and pairs of bytes."""

from __future__ import annotations

import pytest

from capturelake.functions import charset
from capturelake.operators import parse
from tests import archives

TEXTS = {
    "windows-1251": "Съешь же ещё этих мягких французских булок, да выпей чаю. Широкая электрификация южных губерний.",
    "koi8-r": "Съешь же ещё этих мягких французских булок, да выпей чаю. Широкая электрификация южных губерний.",
    "shift_jis": "いろはにほへと ちりぬるを わかよたれそ つねならむ。色は匂へど散りぬるを",
    "euc-jp": "いろはにほへと ちりぬるを わかよたれそ つねならむ。色は匂へど散りぬるを",
    "euc-kr": "키스의 고유조건은 입술끼리 만나야 하고 특별한 기술은 필요치 않다.",
    "windows-1252": "Le cœur déçu mais l'âme plutôt naïve, Louÿs rêva de crapaüter en canoë. Zwölf Boxkämpfer jagen Eva.",
    "ibm850": "Portez ce vieux whisky au juge blond qui fume; déçu, naïve, être, à là où élève. Zwölf Boxkämpfer.",
    "utf-16-le": "plain and zwölf",
    "utf-16-be": "plain and zwölf",
}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(t,) for t in dict.fromkeys(TEXTS.values())] + [(None,), ("",), ("plain words only",)]
    return charset.train(spark.createDataFrame(rows, "text string").repartition(2))


@pytest.mark.parametrize("name", sorted(TEXTS))
def test_likeliest_charset(model, name):
    own = TEXTS[name]
    for text in (own, own[: len(own) // 2], own[len(own) // 3 :]):
        assert charset.read(text.encode(name), None, model)[1] == text


def test_marks_headers_and_markup():
    assert charset.read(b"\xef\xbb\xbfabc")[1] == "abc"
    assert charset.read(b"\xff\xfea\0b\0") == ("utf-16-le", "ab")
    assert charset.read("aé".encode("utf-16-be"), "UTF-16BE")[1] == "aé"
    assert charset.read(b'<meta http-equiv="Content-Type" content="text/html; charset=koi8-r">' + "булок".encode("koi8-r"))[1].endswith("булок")
    assert charset.read(b"<?xml version='1.0' encoding='Shift_JIS'?>" + "いろは".encode("shift_jis"))[1].endswith("いろは")
    # what is declared must be able to read the bytes
    assert charset.read(b'<meta charset="utf-8">d\xe9j\xe0')[1].endswith("déjà")
    assert charset.read(b"d\xe9j\xe0", "no-such-charset") == ("windows-1252", "déjà")
    assert charset.read(b"\x81\x8d", "iso-8859-1") == ("iso-8859-1", "\x81\x8d")
    assert charset.read("é".encode(), None) == ("utf-8", "é") and charset.read(b"") == ("utf-8", "")
    assert charset.codec("base64") is None


def test_parsing_reads_other_charsets(spark, tmp_path, model):
    russian = TEXTS["windows-1251"]
    page = "<html><head><title>%s</title></head><body>%s</body></html>" % (russian[:10], russian)
    rows = [
        ("http://h/header", "text/html; charset=windows-1251", page.encode("windows-1251")),
        ("http://h/meta", "text/html", page.replace("<title>", '<meta charset="koi8-r"><title>').encode("koi8-r")),
        ("http://h/model", "text/html", page.encode("windows-1251")),
        ("http://h/mark", "text/html", b"\xff\xfe" + page.encode("utf-16-le")),
        ("http://h/utf8", "text/html; charset=utf-8", page.encode()),
        ("http://h/latin", "text/html; charset=iso-8859-1", "<title>déjà vu</title>".encode("latin-1")),
    ]
    (tmp_path / "a.warc.gz").write_bytes(archives.warc([(u, "20080430204825", archives.http(200, kind, body)) for u, kind, body in rows]))
    got = {r["url"]: r["title"] for r in parse.parse(parse.read_archives(spark, str(tmp_path / "a.warc.gz")), charsets=model).collect()}
    assert got == {u: russian[:10].strip() if u != "http://h/latin" else "déjà vu" for u, _, _ in rows}


def test_a_repeated_line_does_not_outweigh_the_rest_of_a_text(spark):
    texts = ["Ein ö ö ist ein ö. Die schöne Größe für Mädchen, Übermut und Äpfel, grüßt heiß."] * 20 + ["L'été à côté, ça va. Señor, está aquí.", "Übung. Ü"]
    model = charset.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    text = "Die schöne Größe für Mädchen, Übermut und Äpfel. " + "Ü Ü " * 200
    data = text.encode("ibm850")
    assert charset.read(data, None, model)[1] == text
    key, n = charset.pairs(data)
    # by the number of times that pairs occur it would be another charset
    assert model.names[int((model.log[:, key] @ n).argmax())] != "ibm850"
