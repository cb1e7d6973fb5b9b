from __future__ import annotations

import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest

from capturelake.llm import lexical

KIND = "doc_id long, text string, item string, score string, shard string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    own = [(i, Counter(terms(t))) for i, t in docs]
    own = [(i, c) for i, c in own if c]
    n, total = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in items:
        scored = []
        for i, c in own:
            m = 100 - 25 + (25 * sum(c.values()) * n) // total
            s = sum(weight[t] * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if s > 0:
                scored.append((-s, i is None, i, s))
        out += [(item, r, x[2], x[3]) for r, x in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return out


def corpus(rng, n):
    words = [f"w{i}" for i in range(80)] + ["É", "é", "日本", "🙂", "A1", "a1"]
    texts = [rng.choice([" ", "-", "\n"]).join(rng.choice(words[: rng.randint(2, len(words))]) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    texts[3], texts[4], texts[5], texts[6] = None, "", "!?", texts[7]
    return [(None if i == 8 else i * 7 % 97 + (i // 97) * 97, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("most_docs", "partitions"), [(1, 2), (7, 3), (4096, 1)])
def test_top_documents_match_brute_force(spark, monkeypatch, most_docs, partitions):
    monkeypatch.setattr(lexical, "BATCH", 3 if most_docs == 7 else 48)
    monkeypatch.setattr(lexical, "ITEMS", 4)
    rng = random.Random(most_docs)
    docs = corpus(rng, 200)
    items = [(f"q{i}", " ".join(rng.choice(["w1", "w2", "w70", "é", "A1", "日本", "none"]) for _ in range(rng.randint(0, 9)))) for i in range(9)] + [("null", None), ("whole", docs[20][1])]
    d = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in docs], KIND).repartition(partitions)
    q = spark.createDataFrame(items, "item_id string, text string")
    got = [tuple(r) for r in lexical.search(d, q, 5, most_docs=most_docs).collect()]
    assert sorted(got, key=repr) == sorted(brute(docs, items, 5), key=repr)


def test_ties_and_repeated_rows(spark):
    docs = [(9 - i, "same words here") for i in range(8)] + [(3, "same words here"), (100, "other")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame([(1, "words"), (1, "words words")], "item_id long, text string")
    got = sorted(tuple(r) for r in lexical.search(d, q, 4, most_docs=3).collect())
    assert got == sorted(brute(docs, [(1, "words"), (1, "words words")], 4))
    assert [r[2] for r in got if r[3] == got[0][3]] == [2, 3, 3, 4]


def test_empty_tables_and_a_long_text(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    q = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(d, q).count() == 0
    full = spark.createDataFrame([(1, "a " * 500_000 + "b"), (2, "a")], "doc_id long, text string")
    assert lexical.search(full, q.where("false")).count() == 0
    docs = [(1, "a " * 500_000 + "b"), (2, "a"), (3, "c")]
    got = lexical.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string"))
    assert sorted(map(tuple, got.collect())) == sorted(brute(docs, [(1, "a b")]))


def test_levels_keep_impact_order_in_every_node():
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randint(0, 12)}" for _ in range(rng.randint(1, 40))).encode() for _ in range(37)]
    row = lexical.build(list(range(37)), texts, 37, sum(len(t.split()) for t in texts))
    shard = lexical.load(row)
    for t, (a, b) in shard.runs(shard.terms).items():
        assert (np.diff(shard.impacts[0, a:b]) <= 0).all()
        docs = {i for i, x in enumerate(texts) if t in x.split()}
        # one query term: the order of its postings
        ranked = shard.best([(a, b)], np.array([1]), 100, 0)
        assert {d for _, d in ranked} == docs
        assert sorted((-s for s, _ in ranked)) == [-int(x) for x in shard.impacts[0, a:b]]


def test_best_first_leaves_most_nodes_alone(monkeypatch):
    """A rare long match, one node at a time: only its path is split."""
    monkeypatch.setattr(lexical, "BATCH", 1)
    texts = [f"common filler words {i % 10}".encode() for i in range(4096)]
    texts[1234] = b"the planted passage of rare words common"
    shard = lexical.load(lexical.build(list(range(4096)), texts, 4096, 4 * 4096))
    seen, inner = [], shard._bounds
    shard._bounds = lambda level, *a: seen.append(len(level)) or inner(level, *a)
    runs = shard.runs([b"planted", b"passage", b"rare", b"common"])
    assert shard.best(list(runs.values()), np.array([9000] * 4), 1, 0)[0][1] == 1234
    assert sum(seen) == 1 + 2 * 12


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_query_gives_the_rows_of_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = c.execute(lexical.OP13_SQL)
    names = [d[0] for d in want.description]
    assert sorted(map(tuple, lexical.op13_lexical_search(spark, SF).select(*names).collect())) == sorted(want.fetchall())
