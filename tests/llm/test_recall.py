"""Recall against brute force on the synthetic tables; RECALL_SF names another folder than the small one."""

from __future__ import annotations

import os
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from capturelake.llm import decontam, neardup

SF = os.environ.get("RECALL_SF", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def table(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


@pytest.mark.parametrize("percent", [80, 85])
def test_links_of_every_twentieth_document(spark, percent):
    """Rows whose id is divisible by 20 against all rows: every link lies within one component."""
    sets = {}
    for r in table("documents"):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))
        sets[r["doc_id"]] = frozenset(map(hash, (tuple(w[k : k + 5]) for k in range(len(w) - 4)))) if len(w) >= 5 else frozenset([hash(tuple(w))] if w else [])
    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    links = set()
    for i in (i for i in sets if i % 20 == 0):
        shared = Counter(j for x in sets[i] for j in where[x])
        links |= {(i, j) for j, n in shared.items() if i != j and 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n)}
    df = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["id"]: r["component"] for r in neardup.near_duplicates(df, percent).collect()}
    found = sum(got[i] == got[j] for i, j in links)
    print(f"recall {percent}: {found} of {len(links)} links")
    assert len(links) > 5 and found >= 0.99 * len(links)


def test_benchmark_windows(spark):
    """All windows of all documents that share a shingle with an item, by exact similarity."""
    bench, docs = table("benchmark"), table("documents")
    items = decontam.Items([r["item_id"] for r in bench], [r["text"] for r in bench], 5, 0.8)
    plain = lambda t: "".join(c for c in (t or "") if c not in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~").lower().split()
    grams = lambda w: [tuple(w[k : k + 5]) for k in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)]
    own = {r["item_id"]: grams(plain(r["text"])) for r in bench if plain(r["text"])}
    size = {r["item_id"]: len(plain(r["text"])) for r in bench}
    spread = Counter(g for gs in own.values() for g in set(gs))
    weight = lambda g: 1 + np.log((1 + len(own)) / (1 + spread[g]))
    having = defaultdict(set)
    for i, gs in own.items():
        for g in gs:
            having[g].add(i)
    want = {}
    for r in docs:
        w = plain(r["text"])
        every = grams(w) if len(w) >= 5 else []
        spots = defaultdict(list)
        for k, g in enumerate(every):
            for i in having.get(g, ()):
                spots[i].append(k)
        for i, at in spots.items():
            n = min(size[i], len(w))
            m = n - 4
            total = Counter(own[i])
            for begin in sorted({b for k in at for b in range(max(0, k - m + 1), min(k, len(every) - m) + 1)}):
                here = Counter(every[begin : begin + m])
                low = sum(min(c, total[g]) * weight(g) for g, c in here.items() if g in total)
                s = low / (sum(c * weight(g) for g, c in here.items()) + sum(c * weight(g) for g, c in total.items()) - low)
                if s >= 0.8 + 1e-9:
                    want[r["doc_id"], i] = max(s, want.get((r["doc_id"], i), 0))
    df, b = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r["id"], r["item"]) for r in decontam.contaminated(df, b).collect()}
    print(f"recall of windows: {len(got & set(want))} of {len(want)}, {len(got - set(want))} more; {len(items.ids)} items")
    assert len(want) > 10 and len(got & set(want)) >= 0.99 * len(want) and not got - set(want)
