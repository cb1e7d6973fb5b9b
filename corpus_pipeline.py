"""A training corpus from ``documents``: five stages, each over all that the one before kept.

1. toxicity: rows that score 0.5 or more go.
2. near_duplicates: every row is a document, whatever its id; of each component of five-word-
   shingle similarity 0.8 or more the row with the smallest doc_id stays (null ids last).
3. decontamination: rows that hold a benchmark item (similarity 0.8 or more) go.
4. personal_data: numbers, dates, names of mail addresses and secrets become pseudonyms;
   n_chars follows the new text.
5. tokens: each text as ids, with its decoded digest.

All stages but the last return the columns of documents. Rows with a null or repeated doc_id
are judged by their own text. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capturelake.llm import bpe, decontam, neardup, pii
from capturelake.llm.toxicity import Toxicity
from capturelake.scratch import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = Toxicity(spark).fit(docs, labels, F.expr("crc32(cast(id as string)) % 5 <> 0"))
    return model.keep(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    work = Scratch(spark, "rows")
    # written, so that a row keeps its number in every read
    rows = work.save(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), "rows")
    found = neardup.near_duplicates(rows, percent=80, id_col="row").select(F.col("id").alias("row"), "component")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    kept = rows.select("row", "doc_id").join(found, "row").groupBy("component").agg(first).select("first.row")
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.clean(docs.select(*COLUMNS), bench)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.pseudonymise(docs, keep=["lang", "source"])
    return out.select(F.col("id").alias("doc_id"), "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, ids=True)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("tokens", tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each but the last is written to the shared folder and reread, so none runs twice."""
    work = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = work.save(docs, name)
            if i:
                work.drop(STAGES[i - 1][0])
    return docs
