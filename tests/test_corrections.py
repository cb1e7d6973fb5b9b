"""Corrections by deletion keys, against comparing every pair."""

from __future__ import annotations

import random

import pytest

from capturelake.operators import relevance


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


@pytest.mark.parametrize("most", [1, 2])
def test_pairs_match_brute_force(spark, most):
    rng = random.Random(most)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(0, 14)))
    known = sorted({word() for _ in range(150)} | {"aaaaaaaaaaaa", "baaaaaaaaaaa", "aaaaaaaaaaab"})
    asked = sorted({word() for _ in range(80)} | {"aaaaaaaaaaaa", ""})
    terms = spark.createDataFrame([(t, i % 7) for i, t in enumerate(known)] + [(None, 1)], "term string, n long")
    words = spark.createDataFrame([(w,) for w in [*asked, *asked[:3], None]], "word string")
    index = relevance.Corrections(terms, most)
    want = {(w, t, d) for w in asked for t in known if (d := distance(w, t)) <= most}
    assert sorted((r["word"], r["term"], r["distance"]) for r in index.of(words).collect()) == sorted(want)
    n = {t: i % 7 for i, t in enumerate(known)}
    best = {}
    for w, t, d in want:
        best[w] = min(best.get(w, (9, 0, "")), (d, -n[t], t))
    assert {r["word"]: (r["distance"], -r["n"], r["term"]) for r in index.best(words).collect()} == best


def test_no_scan_of_the_vocabulary_per_word(spark):
    terms = spark.createDataFrame([("word", 1)], "term string, n long")
    plan = relevance.Corrections(terms).of(terms.selectExpr("term as word"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
