from __future__ import annotations

import json
import os
import random

import pytest

from capturelake.llm import wrapper

KIND = "page_id long, url string, html string, host string, wrapper string"


def marked(rng, i, article):
    menu = "".join(f'<li><a href="/{rng.random()}">Menu {rng.randint(0, 99)}</a>' for _ in range(rng.randint(1, 6)))
    extra = rng.choice(["", '<div class="cookie-notice">We use cookies</div>', "<form><label>Mail</label><input name=m><button>Send</button></form>"])
    comments = "".join(f'<article class="comment"><p>Reader {rng.random()} says</p></article>' for _ in range(rng.randint(0, 3)))
    body = "".join(f"<p>{b}" if rng.random() < 0.5 else f"<p>{b}</p>" for b in article[1:])
    return (
        f"<!DOCTYPE html><html><head><title>{article[0]}</title><style>p {{}}</style><script>var a = '<p>no</p>';</script></head><body class='has-sidebar'>"
        f"<header><h2>Site</h2></header><nav><ul>{menu}</ul></nav>{extra}<!-- <p>note</p> --><main><article><h1>{article[0]}</h1>{body}"
        f'<div class="ad">Buy {rng.random()}</div></article><section id="comments">{comments}</section></main>'
        f'<aside><p>More {rng.random()}</p></aside><footer>&copy; us {i}</footer>' + rng.choice(["</body></html>", ""])
    )


def unmarked(rng, i, article):
    links = "".join(f'<div class="x"><a href="#">Link {rng.random()}</a></div>' for _ in range(rng.randint(2, 5)))
    body = "<br>".join(article[1:])
    return f"<body><div class='top'>Our paper</div><div>{links}</div><table><tr><td><div class='q'><h2>{article[0]}</h2><div>{body}</div><div class='s'>Subscribe now</div></div></table><div>Imprint</div></body>"


def article(rng):
    words = [f"w{rng.randint(0, 500)}" for _ in range(300)]
    return [f"Title {rng.random()}", *(f"{' '.join(rng.sample(words, 12))} &amp; <b>b</b>o<i>l</i>d &eacute;&#33;" for _ in range(rng.randint(1, 6)))]


def shown(parts):
    return " ".join(" ".join(p.replace("&amp;", "&").replace("&eacute;", "é").replace("&#33;", "!").replace("<b>", "").replace("</b>", "").replace("<i>", "").replace("</i>", "").split()) for p in parts)


@pytest.mark.parametrize("limit", [16 << 20, 0])
def test_main_text_of_marked_and_unmarked_hosts(spark, monkeypatch, limit):
    """With limit 0 pages meet wrappers in the salted join."""
    monkeypatch.setattr(wrapper, "BROADCAST_BYTES", limit)
    rng = random.Random(4)
    rows, want = [], {}
    for i in range(60):
        a = article(rng)
        host, make = ("marked.example", marked) if i % 2 else ("plain.example", unmarked)
        rows.append((i, f"http://{host}/{i}", make(rng, i, a), "h", "w"))
        want[i] = shown(a)
    got = {r["id"]: r for r in wrapper.main_text(spark.createDataFrame(rows, KIND).repartition(5)).collect()}
    assert {i: r["text"] for i, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def covers(nodes, own, i=0):
    """Whether a wrapper's expression accepts a page's, both as sequences of elements."""
    labels = [x[0] for x in own]

    def match(k, at):
        # the positions in own that nodes[k:] can end at
        if k == len(nodes):
            return at == len(own)
        x = nodes[k]
        if x[1] and match(k + 1, at):
            return True
        if x[0] == "(":
            end = at
            while (step := ends(x[3], end)) is not None:
                end = step
                if match(k + 1, end):
                    return True
            return False
        end = at
        while end < len(own) and labels[end] == x[0] and (x[0] == "#" or covers(x[3], own[end][1])):
            end += 1
            if match(k + 1, end):
                return True
            if x[0] == "#" or not x[2]:
                break
        return False

    def ends(body, at):
        for end in range(at + 1, len(own) + 1):
            if covers(body, own[at:end]):
                return end
        return None

    return match(0, i)


def random_page(rng, depth=0):
    out = []
    for _ in range(rng.randint(0, 4)):
        kind = rng.choice(["#", "p", "div", "div a", "ul", "dl"])
        if kind == "#" and (not out or out[-1][0] != "#"):
            out.append(["#", ["text"], 0])
        elif kind == "dl":
            out.append(["dl", [x for _ in range(rng.randint(1, 3)) for x in (["dt", [["#", ["t"], 0]]], ["dd", [["#", ["d"], 0]]])]])
        elif kind == "ul":
            out.append(["ul", [["li", [["#", ["t"], 0]]] for _ in range(rng.randint(1, 4))]])
        elif kind != "#" and depth < 3:
            out.append([kind, random_page(rng, depth + 1)])
    return out


def test_wrappers_accept_every_page_they_were_made_of():
    rng = random.Random(9)
    for _ in range(150):
        pages = [random_page(rng) for _ in range(rng.randint(1, 6))]
        made = [wrapper.expression(p) for p in pages]
        whole = made[0]
        for w in made[1:]:
            whole = wrapper.align(whole, w)
        half = wrapper.align(made[-1], made[0])
        assert all(covers(whole, p) for p in pages), json.dumps(whole)
        assert covers(half, pages[0]) and covers(half, pages[-1])


def test_groups_and_options():
    a = wrapper.expression(wrapper.page("<ul><li>a<li>b</ul><dl><dt>x<dd>y<dt>z<dd>w</dl>"))
    assert [x[0] for x in a] == ["ul", "dl"] and a[0][3][0][2] == 1 and a[1][3][0][0] == "("
    b = wrapper.align(a, wrapper.expression(wrapper.page("<p>new</p><ul><li>a</ul><dl><dt>x<dd>y</dl>")))
    assert [(x[0], x[1]) for x in b] == [("p", 1), ("ul", 0), ("dl", 0)]
    assert b[1][3][0][2] == 1 and b[2][3][0][0] == "("


def test_odd_pages(spark):
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    odd = [None, "", "plain text < 3", "<article>a&nbsp;b\n\t c<script>x", "<p title='a > b'>ok</p><a href=\"unclosed>", "<article></article>", deep, "<article><p>" + "long " * 200_000 + "</article>", "<article>one<br>two<hr>three</article>"]
    rows = [(i if i else None, f"http://h{i}.example/" if i not in (0, 3) else None, h, "h", "w") for i, h in enumerate(odd)] + [(1, "http://h1.example/", "", "h", "w")]
    got = sorted(((r["id"], r["text"]) for r in wrapper.main_text(spark.createDataFrame(rows, KIND)).collect()), key=repr)
    found = dict(got)
    assert len(got) == 10 and found[None] == "" and found[5] == "" and found[8] == "one two three"
    assert found[7] == ("long " * 200_000).strip() and found[6] == "deep"
    assert wrapper.main_text(spark.createDataFrame([], KIND)).count() == 0


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_query_gives_the_rows_of_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    c.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    want = c.execute(wrapper.OP11_SQL)
    names = [d[0] for d in want.description]
    assert sorted(map(tuple, wrapper.op11_html_extraction(spark, SF).select(*names).collect())) == sorted(want.fetchall())
