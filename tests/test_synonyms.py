"""Synonyms of several words, against trying every way to read a text."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from capturelake.functions import synonyms


def readings(rules, terms):
    """All word sequences that a text stands for: longest matches from the left, each in every side."""
    left = {}
    for line in rules:
        a, arrow, b = line.partition("=>")
        froms = [tuple(x.split()) for x in a.split(",")]
        for f in froms:
            left.setdefault(f, []).extend(x for x in ([tuple(x.split()) for x in b.split(",")] if arrow else froms) if x not in left.get(f, []))
    out, i = [()], 0
    while i < len(terms):
        n = max((len(f) for f in left if tuple(terms[i : i + len(f)]) == f), default=0)
        sides = left[tuple(terms[i : i + n])] if n else [(terms[i],)]
        out = [o + s for o in out for s in sides]
        i += n or 1
    return out


def test_phrases_match_brute_force():
    rng = random.Random(7)
    lines = ["a b => x", "b, c d", "a b c => y z, w", "d d, a"]
    rules = synonyms.Rules(lines)
    for _ in range(400):
        terms = [rng.choice("abcd") for _ in range(rng.randint(0, 7))]
        phrase = [rng.choice("abcdxyzw") for _ in range(rng.randint(1, 3))]
        want = any(tuple(phrase) == r[k : k + len(phrase)] for r in readings(lines, terms) for k in range(len(r)))
        assert rules.has(terms, phrase) == want, (terms, phrase)


def test_graph_and_cases(spark):
    lines = ["new york, ny  # a city", "", "big apple => ny"]
    df = spark.createDataFrame([(["in", "new", "york", "now"],), (["big", "apple"],), ([],), (None,)], "ts array<string>")
    got = [r["g"] for r in df.select(synonyms.graph(F.col("ts"), lines).alias("g")).collect()]
    assert [tuple(e) for e in got[0]] == [("in", 0, 1), ("new", 1, 5), ("york", 5, 3), ("ny", 1, 3), ("now", 3, 4)]
    assert [tuple(e) for e in got[1]] == [("ny", 0, 2)] and got[2] == [] and got[3] is None
    hits = [r["h"] for r in df.select(synonyms.phrases(F.col("ts"), lines, ["in ny now", "york now", "in york"]).alias("h")).collect()]
    assert hits[0] == [True, True, False] and hits[3] is None
    with pytest.raises(ValueError):
        synonyms.Rules(["a =>"])
