from __future__ import annotations

import hashlib
import random
import re

import corpus_pipeline
from capturelake.llm import registry
from capturelake.llm.toxicity import Toxicity
from pyspark.sql import functions as F
from tests.llm.test_llm import ODD, components, prose

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def write(spark, folder):
    rng = random.Random(11)
    texts = [t for t in ODD if t]
    for i in range(240):
        w = prose(rng, 90, 3000).split()
        if i % 4 == 0:
            for _ in range(4):
                w[rng.randrange(90)] = "nasty"
        texts.append(" ".join(w))
    clean = texts[len(texts) - 3 :]
    items = [prose(rng, 40, 9000) for _ in range(3)]
    texts += [clean[0], clean[0] + " end", f"{prose(rng, 60, 3000)} {items[1]} {prose(rng, 60, 3000)}", f"{prose(rng, 60, 3000)} 4845168114407329 {prose(rng, 60, 3000)} 4845168114407329"]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)] + [(900, None, None, None, None), (900, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int("nasty" in t)) for i, t in enumerate(texts)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return texts, items


def test_stages_against_brute_force(spark, tmp_path):
    sf = str(tmp_path / "sf")
    texts, items = write(spark, sf)
    docs, kept = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == COLUMNS
    model = Toxicity(spark).fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"), F.expr("crc32(cast(id as string)) % 5 <> 0"))
    scores = {r["id"]: r["score"] for r in model.score(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    assert set(kept["toxicity"]) == {i for i, s in scores.items() if s < 0.5}
    assert not any("nasty" in (r["text"] or "") for r in kept["toxicity"].values())
    sets = {}
    for i, r in kept["toxicity"].items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    assert set(kept["near_duplicates"]) == {i for i, c in components(sets, 80).items() if i == c}
    words = lambda t: " ".join(re.findall(r"\w+", (t or "").lower()))
    assert set(kept["decontamination"]) == {i for i, r in kept["near_duplicates"].items() if not any(words(x) in words(r["text"]) for x in items)}
    assert set(kept["personal_data"]) == set(kept["decontamination"])
    last = len(texts) - 1
    new = kept["personal_data"][last]["text"]
    assert "4845168114407329" not in new and len(new) == len(texts[last]) == kept["personal_data"][last]["n_chars"]
    for i, r in kept["tokens"].items():
        assert r["decoded_sha256"] == hashlib.sha256((kept["personal_data"][i]["text"] or "").encode()).hexdigest() and r["n_tokens"] == len(r["ids"])


def test_stages_take_extra_columns_and_odd_rows(spark, tmp_path):
    """Columns with names that operators use inside, repeated and null ids with different texts."""
    sf = str(tmp_path / "sf")
    write(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rng = random.Random(12)
    one, two = prose(rng, 80, 9000), prose(rng, 80, 9000)
    odd = [(7000, one, "en", "s", 1), (7000, two, "en", "s", 1), (7000, two, "en", "s", 1), (None, one, None, None, None), (None, "alone " + prose(rng, 80, 9000), None, None, None), (7001, "x " * 200_000, None, None, None)]
    docs = spark.createDataFrame(odd, docs.schema)
    for name in ("id", "row", "component", "key", "matches", "score", "sig", "kept", "ids", "digest", "class"):
        docs = docs.withColumn(name, F.lit("other"))
    docs.write.parquet(str(tmp_path / "odd"))
    docs = spark.read.parquet(str(tmp_path / "odd"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / f"s{k}"))
        docs = spark.read.parquet(str(tmp_path / f"s{k}"))
        if name == "near_duplicates":
            found = sorted((r["doc_id"] or -1, (r["text"] or "")[:20]) for r in docs.collect())
            assert found == sorted([(7000, one[:20]), (7000, two[:20]), (-1, odd[4][1][:20]), (7001, odd[5][1][:20])])
    assert docs.count() == 4


def test_run_on_empty_tables(spark, tmp_path):
    sf = str(tmp_path / "sf")
    write(spark, f"{sf}-full")
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf}-full/{t}.parquet").limit(0).write.parquet(f"{sf}/{t}.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_registry_has_all_thirteen():
    assert sorted(int(k[2:].split("_")[0]) for k in registry.QUERIES) == list(range(1, 14))
    assert set(registry.SQL) <= set(registry.QUERIES)
