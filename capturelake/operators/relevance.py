"""Ranked retrieval: TF-IDF and BM25 scores, similar documents, corrections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def score(df: DataFrame, id_col: str, words: Column, query: list[str], method: str = "tfidf", k1: float = 1.2, b: float = 0.75, boost: Column | None = None, explain: bool = False) -> DataFrame:
    """(id, score) of the documents with any query term, over whole texts; boost is added, explain tells each term's share.

    Only the query's terms leave a row: each is counted in the row's array, so nothing but one row for each
    document and the document counts of the terms is aggregated.
    """
    wanted = list(dict.fromkeys(query))
    added = [] if boost is None else ["boost"]
    rows = df.select(F.col(id_col).alias("id"), words.alias("words"), *([] if boost is None else [boost.cast("double").alias("boost")]))

    def count(term: str) -> Column:
        return F.size(F.filter("words", lambda w: w == term))

    rows = rows.select("id", *added, F.size("words").alias("dl"), *[count(t).alias(f"tf{i}") for i, t in enumerate(wanted)])
    stats = rows.agg(F.count("*").alias("n"), F.avg("dl").alias("mean"), *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(wanted))])
    # a few numbers
    known = stats.first()
    n, mean = F.lit(known["n"]), F.lit(known["mean"] or 1.0)
    shares = []
    for i in range(len(wanted)):
        tf, d = F.col(f"tf{i}"), F.lit(known[f"df{i}"])
        if method == "bm25":
            idf = F.log(1 + (n - d + 0.5) / (d + 0.5))
            shares.append(idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("dl") / mean)))
        else:
            shares.append(F.sqrt(tf.cast("double")) * (1 + F.log(n / (d + 1.0))))
    total = sum(shares, F.lit(0.0)) + (F.lit(0.0) if boost is None else F.col("boost"))
    told = [F.array(*[F.struct(F.lit(t).alias("term"), F.col(f"tf{i}").alias("tf"), F.lit(known[f"df{i}"]).alias("df"), x.alias("share")) for i, (t, x) in enumerate(zip(wanted, shares, strict=True))]).alias("explain")] * explain
    return rows.where(F.greatest(F.lit(0), *[F.col(f"tf{i}") for i in range(len(wanted))]) > 0).select("id", total.alias("score"), *told)


def top(scored: DataFrame, rows: int) -> DataFrame:
    return scored.orderBy(F.desc("score"), "id").limit(rows)


def more_like(df: DataFrame, id_col: str, words: Column, like, n_terms: int = 25) -> DataFrame:
    """(id, score): cosine of term counts with one document's n_terms most frequent terms, other documents only.

    One pass without a shuffle: each row counts those terms and its own squares. A null id is no document.
    """
    rows = df.select(F.col(id_col).alias("id"), words.alias("words"))
    mine = rows.where(F.col("id") == F.lit(like)).select(F.explode("words").alias("term")).groupBy("term").agg(F.count("*").alias("q")).orderBy(F.desc("q"), "term").limit(n_terms).collect()
    if not mine:
        return rows.where("false").select("id", F.lit(0.0).alias("score"))
    wanted = F.map_from_arrays(F.array(*[F.lit(r["term"]) for r in mine]), F.array(*[F.lit(r["q"]) for r in mine]))
    dot = F.aggregate("words", F.lit(0).cast("long"), lambda acc, w: acc + F.coalesce(F.element_at(wanted, w), F.lit(0).cast("long")))

    def square(acc: Column, w: Column) -> Column:
        # of equal words next to each other, the k-th adds 2k - 1
        k = F.when(w == acc["last"], acc["k"] + 1).otherwise(F.lit(1).cast("long"))
        return F.struct(w.alias("last"), k.alias("k"), (acc["sum"] + 2 * k - 1).alias("sum"))

    begin = F.struct(F.lit("").alias("last"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("sum"))
    rows = rows.where(F.col("id") != F.lit(like)).select("id", dot.alias("dot"), F.aggregate(F.array_sort("words"), begin, square)["sum"].alias("squares"))
    return rows.where("dot > 0").select("id", (F.col("dot") / F.sqrt("squares")).alias("score"))


def did_you_mean(terms: DataFrame, word: str, most: int = 2) -> DataFrame:
    """(term, distance, n) of known terms within some edits of a word; lengths that cannot match are not compared."""
    near = terms.where(F.length("term").between(len(word) - most, len(word) + most))
    return near.withColumn("distance", F.levenshtein("term", F.lit(word), most)).where("distance >= 0")


PREFIX = 8


def deletions(word: Column, most: int = 2, prefix: int = PREFIX) -> Column:
    """What is left of the first letters of a word without up to so many of them.

    Of two words within so many edits, the first prefix - most letters that they match lie in the prefix of both, so both have
    them as a key (or the shorter word's whole match, where a word is shorter than the prefix).
    """
    keys = F.array(F.left(word, F.lit(prefix)))
    level = keys
    for _ in range(most):
        cut = F.transform(level, lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))), lambda i: F.concat(F.left(w, i - 1), F.substr(w, i + 1))))
        level = F.array_distinct(F.flatten(cut))
        keys = F.array_distinct(F.concat(keys, level))
    return keys


class Corrections:
    """An index of known terms (term, n) by what is left of them without some letters."""

    def __init__(self, terms: DataFrame, most: int = 2):
        self.most = most
        self.keys = terms.where("term is not null").select("term", "n", F.explode(deletions(F.col("term"), most)).alias("key"))

    def of(self, words: DataFrame, column: str = "word") -> DataFrame:
        """(word, term, distance, n): the known terms within the edits of each word of a column; words meet terms by key alone."""
        asked = words.where(F.col(column).isNotNull()).select(F.col(column).alias("word")).distinct()
        probes = asked.select("word", F.explode(deletions(F.col("word"), self.most)).alias("key"))
        near = F.abs(F.length("word") - F.length("term")) <= self.most
        pairs = probes.join(self.keys, (probes["key"] == self.keys["key"]) & near).select("word", "term", "n").distinct()
        return pairs.withColumn("distance", F.levenshtein("word", "term", self.most)).where("distance >= 0").select("word", "term", "distance", "n")

    def best(self, words: DataFrame, column: str = "word") -> DataFrame:
        """(word, term, distance, n): for each word the nearest term, of those the most frequent, then the least."""
        first = F.min(F.struct("distance", (-F.col("n")).alias("rare"), "term")).alias("x")
        return self.of(words, column).groupBy("word").agg(first).select("word", "x.term", "x.distance", (-F.col("x.rare")).alias("n"))
