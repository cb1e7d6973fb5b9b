"""Clusters by shared phrases against a count of all phrases by hand."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from capturelake.operators import phrases

SCHEMA = "key long, body string, id string, base int, phrase string"


def frame(spark, rows):
    """Documents with columns whose names the operator uses itself."""
    return spark.createDataFrame([(k, t, "x", 7, "y") for k, t in rows], SCHEMA).repartition(3)


def by_hand(rows, most_words=6, least_docs=3, common_percent=40, most_bases=500):
    held = defaultdict(set)
    for k, t in rows:
        for sentence in re.split(r"[.!?\n]+", (t or "").lower()):
            w = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", sentence)
            for n in range(1, most_words + 1):
                for i in range(len(w) - n + 1):
                    held[tuple(w[i : i + n])].add(k)
    total = len({k for k, _ in rows})
    held = {p: frozenset(d) for p, d in held.items() if len(d) >= least_docs}
    common = {p[0] for p, d in held.items() if len(p) == 1 and 100 * len(d) > common_percent * total}
    named = {}
    for p, d in held.items():
        named[d] = min(named.get(d, (0, 0, "")), (-len(p), -sum(w not in common for w in p), " ".join(p)))
    found = []
    for d, (n, e, p) in named.items():
        e = -e
        if e:
            found.append((-len(d) * (2 * e if e > 1 else 1), p.encode(), -n, d))
    found = [(i, p.decode(), n, d, -s) for i, (s, p, n, d) in enumerate(sorted(found, key=lambda x: x[:2])[:most_bases], 1)]
    of = {b[0]: b[0] for b in found}
    for _ in found:
        for a in found:
            for b in found:
                if 2 * len(a[3] & b[3]) > max(len(a[3]), len(b[3])):
                    of[a[0]] = of[b[0]] = min(of[a[0]], of[b[0]])
    label = {b[0]: b[1] for b in found}
    out = defaultdict(int)
    for b in found:
        for k in b[3]:
            out[(k, of[b[0]], label[of[b[0]]])] += 1
    return [(b[0], b[1], b[2], len(b[3]), b[4]) for b in found], {(*x, n) for x, n in out.items()}


def both(spark, rows, **more):
    df = frame(spark, rows)
    got = [tuple(r) for r in phrases.bases(df, "key", "body", **more).orderBy("base").collect()]
    return got, {tuple(r) for r in phrases.clusters(df, "key", "body", **more).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_by_hand(spark, seed):
    rng = random.Random(seed)
    words = [*"abcdefgh", "É", "ß1", "日本"]
    passages = [" ".join(rng.choices(words, k=9)) for _ in range(4)]
    rows = [(i, "".join(rng.choice([*passages, *words]) + rng.choice([" ", " ", ", ", ". ", "\n", "! "]) for _ in range(rng.randint(0, 9)))) for i in range(40)]
    rows += [(None, passages[0]), (None, passages[0]), (3, passages[1]), (99, None), (98, ""), (97, " .?\n"), (96, passages[2].upper())]
    for more in ({}, {"most_bases": 12}, {"most_words": 3, "least_docs": 2, "common_percent": 15}):
        assert both(spark, rows, **more) == by_hand(rows, **more)


def test_long_texts_without_marks_lose_no_phrase(spark, monkeypatch):
    whole = pa.RecordBatch.from_pydict({"id": [1, 2, 1], "text": ["a b c d e f g h i j", "a b. c d", None]})
    emitted = lambda: {tuple(r.values()) for b in phrases._phrases(6, phrases.hashes(["c"]))([whole]) for r in b.to_pylist()}
    want = emitted()
    monkeypatch.setattr(phrases, "PIECE", 5)
    assert emitted() == want and len(want) == 45 + 6
    assert {(g, n) for _, n, _, g in want if n == 2} >= {(phrases.phrase_hash("a b"), 2), (phrases.phrase_hash("c d"), 2)}
    monkeypatch.setattr(phrases, "BLOCK", 3)
    shared = "one two three four five six seven eight"
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(i % 7)) + " " + shared) for i in range(9)]
    assert both(spark, rows, common_percent=100) == by_hand(rows, common_percent=100)


def test_many_words_change_nothing(spark, monkeypatch):
    rows = [(i, f"one two three rare{i} four. two three x{i % 2}") for i in range(8)]
    monkeypatch.setattr(phrases, "MOST_WORDS", 2)
    assert both(spark, rows, common_percent=100) == by_hand(rows, common_percent=100)


def test_topics_are_clusters_with_labels(spark):
    rows = [(i, f"the solar power plant of town{i}. It opened") for i in range(5)] + [(i, f"a stray cat sleeps at house{i}. It purrs") for i in range(10, 15)] + [(20, "nothing in common")]
    got = {r["id"]: r["label"] for r in phrases.clusters(frame(spark, rows), "key", "body", common_percent=60).where(~F.col("label").isin("it")).collect()}
    assert got == dict.fromkeys(range(5), "the solar power plant of") | dict.fromkeys(range(10, 15), "a stray cat sleeps at")


def test_nothing_to_cluster(spark):
    for rows in ([], [(1, None)], [(1, "only here")], [(i, "same words everywhere") for i in range(4)]):
        assert both(spark, rows) == ([], set())
    with pytest.raises(ValueError, match="most_bases"):
        phrases.bases(frame(spark, []), "key", "body", most_bases=0)


def test_counts_of_any_partitions_agree(spark):
    """Counts of shared documents are the same over any partitions."""
    rows = [(i, f"alpha beta gamma{i % 3}. delta epsilon{i % 2}") for i in range(60)]
    df = frame(spark, rows)
    found = phrases.bases(df, "key", "body", common_percent=100)
    belongs = phrases.members(df, found, "key", "body")
    one = {tuple(r) for r in phrases.merged(belongs.coalesce(1), found).collect()}
    assert one == {tuple(r) for r in phrases.merged(belongs.repartition(7), found).collect()} and len({c for _, c in one}) > 1


def test_phrases_are_shuffled_once_and_only_where_their_parts_are_frequent(spark):
    rows = [(i, f"one two three rare{i} four five{i % 4} six. two three") for i in range(8)]
    df = frame(spark, rows)
    counted = phrases.counted(df, "key", "body")
    assert counted._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    words, pairs = (phrases._sieve(phrases.counted(df, "key", "body", n, least=n)) for n in (1, 2))
    emitted = [tuple(r.values()) for b in phrases._phrases(4, phrases.hashes([]), words=words, pairs=pairs, least=3)([pa.RecordBatch.from_pydict({"id": [1, 1], "text": [rows[0][1]] * 2})]) for r in b.to_pylist()]
    found = {g for _, _, _, g in emitted}
    assert phrases.phrase_hash("one two three") in found and {n for _, n, _, _ in emitted} <= {3, 4}
    # a sieve lets some others through, but few; of two equal rows of one piece each gives its own
    assert len(found) <= 3 and len(emitted) <= 6


def test_no_shuffle_holds_several_lengths(spark, monkeypatch):
    """Of many words each length is counted by itself, in shares, and only of parts that are frequent."""
    counted, save = [], phrases.Scratch.save

    def saved(self, df, name, **more):
        out = save(self, df, name, **more)
        if "n_docs" in df.columns and name != "kept":
            counted.append((name, {r["n"] for r in out.select("n").distinct().collect()}))
        return out

    monkeypatch.setattr(phrases.Scratch, "save", saved)
    monkeypatch.setattr(phrases, "SMALL", 0, raising=False)
    rows = [(i, f"one two three rare{i} four five six seven eight{i % 2}. two three") for i in range(8)] + [(3, "one two three. six seven"), (None, "five six seven")]
    assert both(spark, rows, common_percent=100) == by_hand(rows, common_percent=100)
    assert all(len(lengths) <= 1 for _, lengths in counted)
    assert set().union(*(lengths for _, lengths in counted)) == {1, 2, 3, 4, 5}


def test_phrases_of_rare_parts_are_not_shuffled(spark):
    rows = [(1, [*map(phrases.phrase_hash, ["a", "b", "c", "d"]), 0, *map(phrases.phrase_hash, ["a", "b", "c"]), 0])]
    batch = pa.RecordBatch.from_pydict({"id": [1], "words": [rows[0][1]]})
    pairs = phrases._sieve(spark.createDataFrame([(phrases.phrase_hash(p),) for p in ("a b", "b c")], "g long"))
    emitted = [r for b in phrases._of_lengths([3], phrases.hashes(["b"]), pairs)([batch]) for r in b.to_pylist()]
    assert emitted == [{"id": 1, "n": 3, "e": 2, "g": phrases.phrase_hash("a b c")}]
    shares = [{r["g"] for b in phrases._of_lengths([2, 3], phrases.hashes([]), None, i, 2)([batch]) for r in b.to_pylist()} for i in range(2)]
    assert not shares[0] & shares[1] and shares[0] | shares[1] == {phrases.phrase_hash(p) for p in ("a b", "b c", "c d", "a b c", "b c d")}
