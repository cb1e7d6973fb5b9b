"""The streamed merge gives the rows of the batch merge, however the input is split."""

from __future__ import annotations

import datetime
import random

import pytest

from capturelake.operators import captures
from capturelake.streaming import merge

DOC = "id string, arcname string, date timestamp, job string, content string, url string, outlinks array<long>, rec_seq long, ingest_seq long"


def shown(tables):
    docs, occurrences = tables
    return sorted(map(repr, docs.select("id", "url", "outlinks", "content").collect())), sorted(map(repr, occurrences.select("id", "arcname", "date", "job", "ingest_seq").collect()))


@pytest.mark.parametrize("splits", [[60], [20, 20, 20], [7, 1, 30, 2, 20]])
def test_streamed_merge_equals_batch_merge(spark, tmp_path, splits):
    rng = random.Random(len(splits))
    when = datetime.datetime(2020, 1, 1)
    rows = [
        (f"id{rng.randint(0, 8)}", f"arc{rng.randint(0, 3)}", rng.choice([when, None]), rng.choice(["j", None]), rng.choice(["", None, f"text {k}"]), f"u{k}", [k] if k % 2 else None, k, k % 5)
        for k in range(60)
    ]
    rng.shuffle(rows)
    df, at = spark.createDataFrame(rows, DOC), 0
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(DOC).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    for i, n in enumerate(splits):
        spark.createDataFrame(rows[at : at + n], DOC).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        at += n
        if i % 2 == 0 or i == len(splits) - 1:
            # the query starts again from its checkpoint
            merge.watch(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    want_docs, want_occurrences = captures.merge(df)
    got = shown(merge.merged(spark, f"{tmp_path}/out", df))
    docs, occurrences = shown((want_docs, want_occurrences))
    assert [x.replace("content=''", "content=None") for x in got[0]] == [x.replace("content=''", "content=None") for x in docs]
    assert got[1] == occurrences
