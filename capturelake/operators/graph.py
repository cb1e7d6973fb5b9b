"""The link graph: edges, dense node numbers, successors, outdegree and PageRank."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capturelake.functions import urls
from capturelake.operators import html
from capturelake.scratch import Scratch


def links(pages: DataFrame) -> DataFrame:
    """(src, dst, src_fp, dst_fp, date, text) for every link of pages (url, date, links array<struct<to, text>>), canonical."""
    rows = pages.select("url", "date", F.explode("links").alias("l"))
    rows = rows.select(urls.canonicalize(F.col("url")).alias("src"), urls.canonicalize(html.resolve(F.col("url"), F.array("l.to"))[0]).alias("dst"), "date", F.col("l.text").alias("text"))
    return rows.select("src", "dst", urls.fingerprint(F.col("src")).alias("src_fp"), urls.fingerprint(F.col("dst")).alias("dst_fp"), "date", "text")


def save(found: DataFrame, numbered: DataFrame, folder: str) -> None:
    """Keeps a graph: its numbered nodes in the order of their URLs and the successors of each node."""
    numbered.write.mode("overwrite").parquet(f"{folder}/nodes")
    successors(found, numbered).write.mode("overwrite").parquet(f"{folder}/successors")


def load(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, successors) of a kept graph."""
    return spark.read.parquet(f"{folder}/nodes"), spark.read.parquet(f"{folder}/successors")


def check(numbered: DataFrame, followed: DataFrame) -> list[str]:
    """What is inconsistent in a graph: numbers that aren't 0 to n - 1, successors that are out of range, repeated or unsorted."""
    n, least, most, different = numbered.agg(F.count("*"), F.min("node_id"), F.max("node_id"), F.count_distinct("node_id")).first()
    out = []
    if n and (least, most, different) != (0, n - 1, n):
        out.append("nodes are not numbered from 0 without gaps")
    wrong = followed.agg(
        F.count_if(F.exists("successors", lambda x: (x < 0) | (x >= n))).alias("range"),
        F.count_if(F.col("successors") != F.array_sort(F.array_distinct("successors"))).alias("sorted"),
        F.count_if((F.col("node_id") < 0) | (F.col("node_id") >= n)).alias("node"),
    ).first()
    return out + [f"{k}: {wrong[k]} rows" for k in ("range", "sorted", "node") if wrong[k]]


def edges(pages: DataFrame) -> DataFrame:
    """(src, dst, src_fp, dst_fp) of pages (url, targets array<string>), canonical and distinct."""
    src = urls.canonicalize(F.col("url"))
    rows = pages.select(src.alias("src"), F.explode("targets").alias("to")).select("src", urls.canonicalize(F.col("to")).alias("dst")).distinct()
    return rows.select("src", "dst", urls.fingerprint(F.col("src")).alias("src_fp"), urls.fingerprint(F.col("dst")).alias("dst_fp"))


def nodes(found: DataFrame) -> DataFrame:
    """(node_id, url): dense numbers from 0 in the order of the distinct URLs, without a global window.

    URLs are range-partitioned and sorted; a partition's first number is the count of those before it, of which
    the driver gets one number for each partition.
    """
    urls_ = found.select(F.col("src").alias("url")).union(found.select("dst")).distinct()
    work = Scratch(found.sparkSession, "nodes")
    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written once, so that the ranges are the same for counts and numbers
    ranged = work.save(urls_.repartitionByRange(n, "url").sortWithinPartitions("url").select("url", F.spark_partition_id().alias("part"), (F.monotonically_increasing_id() % (1 << 33)).alias("place")), "ranged")
    bases, base = [], 0
    for r in sorted(ranged.groupBy("part").agg(F.count("*").alias("n")).collect(), key=lambda r: r["part"]):
        bases.append((r["part"], base))
        base += r["n"]
    starts = found.sparkSession.createDataFrame(bases, "part int, base long")
    return ranged.join(F.broadcast(starts), "part").select((F.col("base") + F.col("place")).alias("node_id"), "url")


def successors(found: DataFrame, numbered: DataFrame) -> DataFrame:
    """(node_id, successors): sorted distinct numbers of the linked nodes."""
    a = numbered.select(F.col("url").alias("src"), "node_id")
    b = numbered.select(F.col("url").alias("dst"), F.col("node_id").alias("to"))
    return found.join(a, "src").join(b, "dst").groupBy("node_id").agg(F.array_sort(F.collect_set("to")).alias("successors"))


def outdegree(found: DataFrame) -> DataFrame:
    return found.select("src", "dst").distinct().groupBy("src").agg(F.count("*").alias("outdegree"))


def pagerank(found: DataFrame, iterations: int = 20, damping: float = 0.85, tolerance: float | None = 1e-6) -> DataFrame:
    """(url, rank, boost): power method with the mass of nodes without links spread evenly; boost is rank times nodes.

    Each round is one join and one partially aggregated sum, so a page that a third of all links name is no hot task.
    Links are dealt by page once and kept on the executors' disks; what is lost is dealt again from their table. Ranks
    are written to the shared folder each round, which ends their lineage.
    """
    work = Scratch(found.sparkSession, "pagerank")
    links = work.save(found.select("src", "dst").distinct(), "distinct")
    degree = links.groupBy("src").agg(F.count("*").alias("deg"))
    links = work.save(links.join(degree, "src"), "links")
    every = work.save(links.select(F.col("src").alias("url")).union(links.select("dst")).distinct().join(degree.select(F.col("src").alias("url"), "deg"), "url", "left"), "nodes")
    work.drop("distinct")
    n = every.count()
    if n == 0:
        return every.select("url", F.lit(0.0).alias("rank"), F.lit(0.0).alias("boost"))
    links = links.repartition("src").persist(StorageLevel.DISK_ONLY)
    ranks = work.save(every.select("url", "deg", F.lit(1.0 / n).alias("rank")), "ranks-0")
    work.drop("nodes")
    for i in range(1, iterations + 1):
        loose = ranks.where("deg is null").agg(F.coalesce(F.sum("rank"), F.lit(0.0)).alias("s")).first()["s"]
        given = links.join(ranks.select(F.col("url").alias("src"), "rank"), "src").groupBy(F.col("dst").alias("url")).agg(F.sum(F.col("rank") / F.col("deg")).alias("got"))
        new = F.lit((1 - damping) / n + damping * loose / n) + damping * F.coalesce("got", F.lit(0.0))
        nxt = work.save(ranks.join(given, "url", "left").select("url", "deg", new.alias("rank"), F.abs(new - F.col("rank")).alias("moved")), f"ranks-{i}")
        moved = nxt.agg(F.sum("moved").alias("s")).first()["s"]
        work.drop(f"ranks-{i - 1}")
        ranks = nxt.drop("moved")
        if tolerance is not None and moved < tolerance:
            break
    links.unpersist()
    work.drop("links")
    return ranks.select("url", "rank", (F.col("rank") * n).alias("boost"))


def pagerank_push(found: DataFrame, damping: float = 0.85, least: float = 1e-9, rounds: int = 1000) -> DataFrame:
    """(url, rank, boost) by residuals: a round moves the links of those pages alone whose residual is above least.

    Spreading the mass of pages without links evenly only scales the ranks, so it is left out and the sum made 1 at the end.
    Each page begins with a residual of 1, counts it and passes damping times it on to its links in equal shares; what is left
    at the end is at most least a page, so sums are exact to least / (1 - damping). A round is a join of the frontier with its
    links, a partially aggregated sum, and a merge into the table of pages, which is written to the shared folder.
    """
    work = Scratch(found.sparkSession, "push")
    distinct = work.save(found.select("src", "dst").distinct(), "distinct")
    degree = distinct.groupBy("src").agg(F.count("*").alias("deg"))
    links = work.save(distinct.join(degree, "src"), "links")
    every = links.select(F.col("src").alias("url")).union(links.select("dst")).distinct()
    state = work.save(every.select("url", F.lit(0.0).alias("sum"), F.lit(1.0).alias("left")), "state-0")
    work.drop("distinct")
    for i in range(1, rounds + 1):
        active = state.where(F.col("left") > least).select(F.col("url").alias("src"), "left")
        got = links.join(active, "src").groupBy(F.col("dst").alias("url")).agg(F.sum(F.lit(damping) * F.col("left") / F.col("deg")).alias("got"))
        moved = F.when(F.col("left") > least, F.col("left")).otherwise(0.0)
        new = state.join(got, "url", "left").select("url", (F.col("sum") + moved).alias("sum"), (F.col("left") - moved + F.coalesce("got", F.lit(0.0))).alias("left"))
        state = work.save(new, f"state-{i}")
        work.drop(f"state-{i - 1}")
        if state.where(F.col("left") > least).isEmpty():
            break
    total = state.agg(F.sum(F.col("sum") + F.col("left")), F.count("*")).first()
    work.drop("links")
    rank = (F.col("sum") + F.col("left")) / F.lit(total[0] or 1.0)
    return state.select("url", rank.alias("rank"), (rank * F.lit(total[1])).alias("boost"))
