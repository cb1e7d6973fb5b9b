"""Scores from postings and the term dictionary, against plain counting."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from capturelake.operators import dictionary, postings


def words():
    return F.filter(F.split("text", " "), lambda w: w != "")


def texts(rng, n):
    words = [f"w{int(rng.paretovariate(0.6)) % 60}" for _ in range(400)]
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) if i % 17 else None) for i in range(n)]


def brute(rows, query):
    own = {i: Counter(t.split()) for i, t in rows if t}
    lengths = [len((t or "").split()) if t is not None else None for _, t in rows]
    n, mean = len(rows), sum(x for x in lengths if x is not None) / sum(x is not None for x in lengths)
    df = Counter(w for c in own.values() for w in c)
    out = {}
    for i, c in own.items():
        s = sum(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)) for w in dict.fromkeys(query) if c[w])
        if s:
            out[i] = s
    return out


@pytest.mark.parametrize("block", [3, 128])
def test_best_documents_match_brute_force(spark, tmp_path, block):
    rng = random.Random(block)
    rows = texts(rng, 300)
    held = postings.Postings.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "doc_id", words(), str(tmp_path / "p"), block=block)
    for query, k in ((["w1"], 5), (["w1", "w2", "w3"], 10), (["w59", "w1", "none", "w1"], 4), (["none"], 3), ([], 3), (["w2", "w7"], 1000)):
        want = brute(rows, query)
        best = sorted(want.items(), key=lambda x: (-round(x[1], 9), x[0]))[:k]
        got = [(r["id"], r["score"]) for r in held.top(query, k).collect()]
        assert [s for _, s in got] == pytest.approx([s for _, s in best])
        assert {i for i, _ in got} == {i for i, _ in best} or len({round(s, 9) for _, s in best}) < len(best)
        assert {r["id"]: r["score"] for r in held.score(query).collect()} == pytest.approx(want)


def test_only_blocks_that_can_matter_are_read(spark, tmp_path):
    """A few documents have a rare word often; of the common word's blocks few can reach them."""
    rows = [(i, "common " + "filler " * (i % 200 + 2)) for i in range(3000)] + [(5000 + i, "rare common") for i in range(12)]
    held = postings.Postings.write(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", words(), str(tmp_path / "p"), block=16)
    got = [r["id"] for r in held.top(["rare", "common"], 10).collect()]
    assert got == [5000 + i for i in range(10)]
    assert held.all > 150 and held.read < held.all / 3


def test_terms_of_a_batch_are_shuffled_as_lists(spark, tmp_path):
    """What is shuffled grows with the terms of a batch, not with its postings, and no list mixes levels."""
    rows = [(i, f"common common{i % 2} " + "filler " * (i % 9)) for i in range(900)] + [(None, "lost"), (3, "common"), (901, None), (902, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    sent = docs.where("doc_id is not null").select(F.col("doc_id").alias("id"), words().alias("words")).mapInArrow(postings._lists(1.2, 0.75, 5.0), postings.LISTS).collect()
    assert len(sent) <= 4 * postings.LEVELS < sum(len(r["ids"]) for r in sent) / 50
    assert all([*r["impacts"]] == sorted(r["impacts"], reverse=True) and len({int(x * postings.LEVELS / 2.2) for x in r["impacts"]}) == 1 for r in sent)
    held = postings.Postings.write(docs, "doc_id", words(), str(tmp_path / "p"), block=7)
    assert held.blocks.agg(F.max("n")).first()[0] == 7
    assert {r["id"]: r["score"] for r in held.score(["common", "filler"]).collect()}.keys() == set(range(900))
    assert {r["term"]: r["df"] for r in held.frequencies.collect()} == {"common": 901, "common0": 450, "common1": 450, "filler": 800}


def test_texts_are_read_twice_and_a_few_for_the_bounds(spark, tmp_path):
    """Words are told for the mean, for the lists and for some documents; tasks are even in postings, also within one term."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def split(text):
        seen.add(1)
        return text.split()

    rng, n = random.Random(3), 6000
    rows = [(i, " ".join(["common", "other"] + [f"r{rng.randrange(10**6)}" for _ in range(rng.randrange(2))] + ["filler"] * rng.randrange(6))) for i in range(n)]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = postings.Postings.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), "doc_id", split("text"), str(tmp_path / "p"), block=16)
    assert 2 * n < seen.value < 2 * n + 1.2 * (2000 + 20 * parts) < 3 * n
    found = [r["n"] for r in held.blocks.groupBy(F.input_file_name()).agg(F.sum("n").alias("n")).collect()]
    assert sum(found) == sum(len(set(t.split())) for _, t in rows) and max(found) < 2.5 * sum(found) / parts
    assert {r["id"]: r["score"] for r in held.score(["common", "filler"]).collect()} == pytest.approx(brute(rows, ["common", "filler"]))


def test_documents_without_words(spark, tmp_path):
    rows = [(i, (None, "", " ")[i % 3]) for i in range(60)]
    held = postings.Postings.write(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", words(), str(tmp_path / "p"))
    assert held.n == 60 and held.top(["a"], 3).count() == 0


def test_batches_are_joined_to_longer_lists(monkeypatch):
    """A rare term has one list, whatever its levels, and one for all batches that are joined."""
    ids, texts = [5, 3, 9, 1, 4], [["a"], ["a", "b", "b", "b"], ["a"] * 9, ["b"], []]
    batches = [pa.RecordBatch.from_arrays([pa.array(ids[k : k + 1]), pa.array(texts[k : k + 1], pa.list_(pa.string()))], ["id", "words"]) for k in range(5)]
    got = [r for x in postings._lists(1.2, 0.75, 3.0)(batches) for r in x.to_pylist()]
    assert [(r["term"], r["ids"]) for r in got] == [("a", [9, 5, 3]), ("b", [3, 1])]
    monkeypatch.setattr(postings, "JOINED", 5)
    assert [r["ids"] for x in postings._lists(1.2, 0.75, 3.0)(batches) for r in x.to_pylist()] == [[5, 3], [3], [9], [1]]
    monkeypatch.setattr(postings, "FREQUENT", 2)
    assert [r["ids"] for x in postings._lists(1.2, 0.75, 3.0)(batches[:3]) for r in x.to_pylist()][:2] == [[5], [3]]


def test_places_follow_term_and_falling_impact():
    lists = [("a", 9, 2.1), ("a", 9, 0.2), ("ab", 1, 0.1), ("abcdef", 1, 1.5), ("b", -4, 2.0), ("thé", 0, 1.0)]
    batch = pa.RecordBatch.from_arrays([pa.array([t for t, _, _ in lists]), pa.array([[i, 5] for _, i, _ in lists]), pa.array([[x, 0.0] for _, _, x in lists])], ["term", "ids", "impacts"])
    assert (np.diff(postings._places(batch, 1.2)) > 0).all()


def test_blocks_that_end_early_hold_enough():
    first = [{"most": 9.0 - i, "n": n} for i, n in enumerate([1, 2, 128, 128])]
    assert [postings._reaching(first, k) for k in (1, 3, 4, 131, 132, 1000)] == [9.0, 8.0, 7.0, 7.0, 6.0, 6.0]


def test_nothing_to_index(spark, tmp_path):
    held = postings.Postings.write(spark.createDataFrame([], "doc_id long, text string"), "doc_id", words(), str(tmp_path / "p"))
    assert held.top(["a"], 3).count() == 0 and held.score(["a"]).count() == 0


@pytest.mark.parametrize("block", [4, 256])
def test_dictionary_pages_match_sorted_terms(spark, tmp_path, block):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["th", "thé", "thin", "x"]) + str(rng.randint(0, 60)) for _ in range(9)), f"s{i % 3}") for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    d = dictionary.Dictionary.write(df, words(), str(tmp_path / "d"), F.col("source"), block)
    counts = Counter(w for _, t, _ in rows for w in set(t.split()))
    want = sorted(counts.items(), key=lambda x: x[0].encode())
    assert [tuple(r) for r in d.terms().collect()] == want
    for after, n in ((None, 7), ("th5", 10), ("thin", 1), ("x59", 50), ("zz", 5), ("", 3)):
        left = [x for x in want if after is None or x[0].encode() > after.encode()]
        assert [tuple(r) for r in d.page(after, n).collect()] == left[:n], (after, n)


def test_a_page_reads_one_block_a_part(spark, tmp_path):
    rows = [(i, f"t{i:05d}") for i in range(2000)]
    d = dictionary.Dictionary.write(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), words(), str(tmp_path / "d"), block=100)
    assert d.blocks.count() >= 20
    got = [r["term"] for r in d.page("t00510", 20).collect()]
    assert got == [f"t{i:05d}" for i in range(511, 531)] and d.read == 1
    # a second call adds a part
    d = dictionary.Dictionary.write(spark.createDataFrame([(1, "t00515 new")], "doc_id long, text string"), words(), str(tmp_path / "d"), F.lit("more"))
    assert [tuple(r) for r in d.page("t00513", 2).collect()] == [("t00514", 1), ("t00515", 2)]
