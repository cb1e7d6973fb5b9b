"""Tables in the order of URLs, PageRank by residuals, and JSON files that appear at the end."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from capturelake import schema
from capturelake.operators import graph
from capturelake.operators.ordered import Ordered
from capturelake.sources import records


def test_merge_without_a_shuffle(spark, tmp_path):
    rng = random.Random(1)
    a = [(f"u{rng.randint(0, 30)}", i) for i in range(200)] + [(None, -1)]
    b = [(f"u{i}", i) for i in range(25)]
    one = Ordered.write(spark.createDataFrame(a, "url string, n long"), "url", f"file://{tmp_path}/a", 4)
    two = Ordered.write(spark.createDataFrame(b, "url string, m long"), "url", f"file://{tmp_path}/b", 4)
    both = one.join(two)
    got = sorted((r["url"], r["n"], r["m"]) for r in both.collect())
    assert got == sorted((u, n, int(u[1:])) for u, n in a if u and int(u[1:]) < 25)
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "truncated" not in plan
    grouped = both.groupBy("url").count()
    assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()
    assert len(one.join(two, "left").collect()) == len(a)
    keys = sorted(u for u, _ in a if u)
    assert [r["url"] for r in one.between("u1", "u2").collect()] == [k for k in keys if "u1" <= k < "u2"]
    assert [r["url"] for r in one.page("u12", 9).collect()] == [k for k in keys if k > "u12"][:9]
    with pytest.raises(ValueError):
        one.join(Ordered.write(spark.createDataFrame(b, "url string, m long"), "url", f"file://{tmp_path}/c", 8))
    two.drop()
    assert os.path.exists(f"{tmp_path}/b")


def power(links, rounds=400):
    nodes = sorted({x for e in links for x in e})
    out = {}
    for s, d in set(links):
        out.setdefault(s, set()).add(d)
    rank = dict.fromkeys(nodes, 1 / len(nodes))
    for _ in range(rounds):
        loose = sum(rank[x] for x in nodes if x not in out)
        new = dict.fromkeys(nodes, (0.15 + 0.85 * loose) / len(nodes))
        for s, ds in out.items():
            for d in ds:
                new[d] += 0.85 * rank[s] / len(ds)
        rank = new
    return rank


def test_residuals_give_the_ranks_of_the_power_method(spark):
    """Cycles, a hub that most pages name, pages without links, repeated links."""
    rng = random.Random(2)
    links = [(f"p{i}", "hub") for i in range(30)] + [("hub", "p0"), ("p0", "p1"), ("p1", "p2"), ("p2", "p0"), ("p1", "p2")]
    links += [(f"p{rng.randint(0, 20)}", f"q{rng.randint(0, 20)}") for _ in range(30)] + [("self", "self")]
    df = spark.createDataFrame(links, "src string, dst string")
    got = {r["url"]: r["rank"] for r in graph.pagerank_push(df, least=1e-8).collect()}
    assert got == pytest.approx(power(links), abs=1e-7) and sum(got.values()) == pytest.approx(1)
    assert graph.pagerank_push(df.where("false")).count() == 0


def test_json_files_appear_when_the_job_has_ended(spark, tmp_path):
    df = spark.createDataFrame([("a.warc.gz", "http://h/1"), ("b.warc.gz", "http://h/2")], "filename string, url string")
    for field in spark.createDataFrame([], schema.PARSED_RECORD).schema:
        if field.name not in df.columns:
            df = df.withColumn(field.name, F.lit(None).cast(field.dataType))
    broken = df.withColumn("title", F.expr("if(filename = 'b.warc.gz', raise_error('broken'), 't')"))
    with pytest.raises(PySparkException):
        records.write_json_arrays(broken, str(tmp_path / "j"))
    assert not os.path.exists(tmp_path / "j") or os.listdir(tmp_path / "j") == []
    records.write_json_arrays(df, str(tmp_path / "j"), ["none.warc.gz"])
    assert sorted(os.listdir(tmp_path / "j")) == ["a.warc.gz.json.gz", "b.warc.gz.json.gz", "none.warc.gz.json.gz"]
