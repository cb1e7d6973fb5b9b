"""MinHash near-duplicates with sequential Bayesian verification.

Method. A document is the set of its distinct k-word shingles (64-bit hashes of
words folded A-Z to a-z). Rows with equal sets form a class, so exact copies never meet
in a pair. Each class has a number, the MinHash signature of its set, and one row
whose text gives the set again; bands of the signature are buckets. The members of a bucket first meet two of them only, its
pivot, the one that shares most buckets, and the one with the smallest id. Pairs are
compared batch by batch of the signature and dropped as soon as the posterior probability
of reaching the threshold falls under ``miss``; the survivors are verified on their full
sets.

Members of one pivot P that are then in different components still have to be told
apart, without meeting all pairs of a large group. If A is not similar to P, a link
of A and B needs |A & B| >= r (|A| + |B|) with r = t / (1 + t), while A & B holds at
most |A & P| shingles of P. So either B is so small that |A & P| is enough, which its
size tells (such pairs are taken from common buckets), or both share shingles that P lacks,
at least as many as are wanting. Those pairs come from an index of such shingles, where each
set has only as many of its rarest as it must share one of (prefix filtering). Both leave
out only pairs that the sizes refute or that share no bucket.

Bands find a pair of similarity s with probability 1 - (1 - s^rows)^bands: with
25 bands of 5 rows 0.9999996 at 0.85 and 0.99995 at 0.8. There is no cap on
buckets, members or candidates.

Cases. Null, empty and blank texts have an empty set: n_shingles 0, linked with
nothing. Fewer than k words: the whole sequence is the one shingle. Rows that share an
id are one node with the links of all its texts; each row keeps its own n_shingles. A null
id is a row of its own: component null, kept true. Extra columns are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capturelake.llm import text as tx
from capturelake.scratch import Scratch

BANDS, ROWS, BATCH = 25, 5, 25
SALTS = 32
HASHES = BANDS * ROWS
_A = tx.mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
_B = tx.mix(np.arange(1001, HASHES + 1001, dtype=np.uint64))


def signatures(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash signatures (uint32) of the non-empty sets in values[bounds]."""
    full = np.flatnonzero(np.diff(bounds) > 0)
    out = np.zeros((len(bounds) - 1, HASHES), np.uint32)
    if len(full):
        starts = bounds[full]
        for i in range(HASHES):
            v = (values * _A[i] + _B[i]) >> np.uint64(32)
            out[full, i] = np.minimum.reduceat(v.astype(np.uint32), starts)
    return out


def _sketch(shingle_words: int):
    def run(batches):
        for batch in batches:
            for part in tx.slices(batch, "text"):
                buf, offs = tx.string_bytes(part.column(1))
                rows = part.num_rows
                sets, at = tx.distinct(*tx.shingles(tx.Words(buf, offs), rows, shingle_words))
                sizes = np.diff(at)
                sig = signatures(sets, at)
                marks = []
                for salt in (0, 0x51ED270B):
                    mixed = tx.mix(sets + np.uint64(salt))
                    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
                    marks.append((sums[at[1:]] - sums[at[:-1]]).view(np.int64))
                raw = pa.py_buffer(sig.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array(sizes, pa.int64()),
                        pa.array(marks[0]),
                        pa.array(marks[1]),
                        pa.Array.from_buffers(pa.binary(4 * HASHES), rows, [None, raw]).cast(pa.binary()),
                    ],
                    ["id", "digest", "n_shingles", "mark0", "mark1", "sig"],
                )

    return tx.released(run)


def _sets(shingle_words: int):
    def run(batches):
        for batch in batches:
            for part in tx.slices(batch, "text"):
                buf, offs = tx.string_bytes(part.column(1))
                sets, at = tx.distinct(*tx.shingles(tx.Words(buf, offs), part.num_rows, shingle_words))
                lists = pa.LargeListArray.from_arrays(pa.array(at, pa.int64()), pa.array(sets.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists.cast(pa.list_(pa.int64()))], ["class", "shingles"])

    return tx.released(run)


def least_matches(threshold: float, miss: float, batch: int = BATCH, n_hashes: int = HASHES) -> list[int]:
    """After each batch, the fewest matches with P(similarity >= threshold | matches) >= miss.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), and the probability of
    at least ``threshold`` under it equals that of at most m successes in n + 1 trials.
    """
    out = []
    for n in range(batch, n_hashes + 1, batch):
        total, m = 0.0, 0
        for m in range(n + 1):
            total += exp(lgamma(n + 2) - lgamma(m + 1) - lgamma(n + 2 - m) + m * log(threshold) + (n + 1 - m) * log(1 - threshold)) if threshold < 1 else 0.0
            if total >= miss:
                break
        out.append(m)
    return out


def _compare(bars: list[int], batch: int):
    """Keeps the pairs that pass every bar, with their number of matching hashes."""

    def run(batches):
        for got in batches:
            n = got.num_rows
            if n == 0:
                continue
            a = np.frombuffer(b"".join(got.column(2).to_pylist()), np.uint32).reshape(n, HASHES)
            b = np.frombuffer(b"".join(got.column(3).to_pylist()), np.uint32).reshape(n, HASHES)
            alive, matches = np.arange(n), np.zeros(n, np.int32)
            for i, bar in enumerate(bars):
                part = slice(i * batch, (i + 1) * batch)
                matches[alive] += (a[alive, part] == b[alive, part]).sum(1, dtype=np.int32)
                alive = alive[matches[alive] >= bar]
            yield pa.RecordBatch.from_arrays(
                [got.column(0).take(pa.array(alive)), got.column(1).take(pa.array(alive)), pa.array(matches[alive])],
                ["a", "b", "matches"],
            )

    return tx.released(run)


def components(edges: DataFrame, work: Scratch, tag: str) -> DataFrame:
    """Connected components (id, component = smallest id) of edges (a, b), by alternating stars.

    Each round is two partially aggregated minima and joins of pairs of longs; rounds grow
    with the logarithm of the graph's size. Nothing but a count and a checksum reaches the driver.
    """
    now = work.save(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), f"{tag}-0")
    seen, step = None, 0
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        step += 1
        now = work.save(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(),
            f"{tag}-{step}",
        )
        work.drop(f"{tag}-{step - 1}")
        got = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if got == seen:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component"))
        seen = got


class NearDuplicates:
    """Finds near-duplicate components of a table with an integer id and a text column."""

    def __init__(self, spark: SparkSession, percent: int = 80, shingle_words: int = 5, miss: float = 1e-6):
        self.spark, self.percent, self.k = spark, percent, shingle_words
        self.bars = least_matches(percent / 100, miss)
        self.work = Scratch(spark, "neardup")

    def _pairs(self, pairs: DataFrame, sketches: DataFrame) -> DataFrame:
        """Joins signatures to (a, b) and compares them."""
        one = sketches.select(F.col("id").alias("a"), F.col("sig").alias("sig_a"))
        two = sketches.select(F.col("id").alias("b"), F.col("sig").alias("sig_b"))
        joined = pairs.join(one, "a").join(two, "b").select("a", "b", "sig_a", "sig_b")
        return joined.mapInArrow(_compare(self.bars, BATCH), "a long, b long, matches int")

    def _verified(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs whose full sets are similar enough."""
        one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"))
        two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))
        both = pairs.select("a", "b").join(one, "a").join(two, "b")
        shared = F.size(F.array_intersect("set_a", "set_b"))
        return (
            both.select("a", "b", shared.alias("shared"), (F.size("set_a") + F.size("set_b")).alias("total"))
            .where(F.expr(f"100L * shared >= {self.percent} * (total - shared)"))
            .select("a", "b")
        )

    def fit(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(id, n_shingles, component, kept) for every row of docs."""
        work = self.work
        rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("digest", F.xxhash64("text"))
        sketch = work.save(rows.mapInArrow(_sketch(self.k), "id long, digest long, n_shingles long, mark0 long, mark1 long, sig binary"), "sketch")
        marks = ["mark0", "mark1", "n_shingles"]
        known = sketch.where("id is not null and n_shingles > 0")
        # the least row of a class stands for it; equal texts of one id are the same row here
        classes = known.groupBy(*marks).agg(F.min(F.struct("id", "digest")).alias("rep"), F.min("sig").alias("sig"))
        classes = work.save(classes.select(F.monotonically_increasing_id().alias("class"), *marks, "rep.id", "rep.digest", "sig"), "classes")
        sketches = classes.select(F.col("class").alias("id"), "sig", F.col("id").alias("doc"))
        member = known.select("id", *marks).join(classes.select("class", *marks), marks).groupBy("id").agg(F.min("class").alias("class"), F.max("class").alias("last"))
        member = work.save(member, "member")
        # an id with several sets joins the classes of all of them
        several = member.where("class <> last").select("id", F.col("class").alias("a"))
        bridges = known.select("id", *marks).join(several, "id").join(classes.select(F.col("class").alias("b"), *marks), marks).where("a <> b").select("a", "b").distinct()

        keys = F.expr(f"transform(sequence(0, {BANDS - 1}), b -> xxhash64(b, substring(sig, b * {4 * ROWS} + 1, {4 * ROWS})))")
        bands = sketches.select("id", "doc", F.explode(keys).alias("key"))
        sizes = bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        bucket = work.save(bands.join(sizes, "key"), "bucket")
        central = bucket.groupBy("id").agg(F.sum("n").alias("central"))
        pivots = bucket.join(central, "id").groupBy("key").agg(F.max_by("id", F.struct("central", -F.col("doc"), "id")).alias("pivot"), F.min_by("id", F.struct("doc", "id")).alias("other"))
        keyed = work.save(bucket.select("key", "id").join(pivots, "key"), "keyed")
        # the second centre saves pairs of members that hang together by it
        tried = keyed.select("id", F.explode(F.array("pivot", "other")).alias("b")).where("id <> b").select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct()
        keyed = keyed.where("id <> pivot").drop("other")
        stars = work.save(keyed.select("pivot", "id").distinct(), "stars")

        involved = classes.select("class", "id", "digest").join(bucket.select(F.col("id").alias("class")).distinct(), "class", "left_semi")
        # grouped before Python runs, so that it reuses the join's partitioning
        texts = rows.join(involved, ["id", "digest"]).groupBy("class").agg(F.min("text").alias("text"))
        sets = work.save(texts.mapInArrow(_sets(self.k), "class long, shingles array<long>").withColumnRenamed("class", "id"), "sets")

        links = work.save(self._verified(self._pairs(tried, sketches), sets).union(bridges), "links-1")
        comps = components(links, work, "comp-1")
        cross = self._across(stars, keyed, comps, sets)
        if cross is not None:
            rest = work.save(self._verified(self._pairs(cross, sketches), sets), "links-2")
            if not rest.isEmpty():
                links = links.union(rest)
                comps = components(links, work, "comp-2")
        # links are between classes; a component is named by its least id
        names = classes.select(F.col("class"), "id").join(comps.select(F.col("id").alias("class"), "component"), "class", "left")
        names = names.withColumn("component", F.coalesce("component", "class"))
        least = names.groupBy("component").agg(F.min("id").alias("name"))
        named = work.save(names.select("class", "component").join(least, "component").select("class", "name"), "named")
        of = work.save(member.select("id", "class").join(named, "class").select("id", F.col("name").alias("component")), "of")
        work.drop("bucket", "sets", "stars", "keyed", "apart", "classes", "member", "named")
        self.links = links

        out = sketch.select("id", "n_shingles").join(of, "id", "left")
        component = F.coalesce("component", "id")
        return out.select("id", "n_shingles", component.alias("component"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))

    def _across(self, stars: DataFrame, keyed: DataFrame, comps: DataFrame, sets: DataFrame) -> DataFrame | None:
        """Pairs (a, b) under one pivot, in different components, that may be similar; see the module."""
        of = comps.select("id", "component")
        placed = stars.join(of, "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component")
        placed = placed.join(of.select(F.col("id").alias("pivot"), F.col("component").alias("pc")), "pivot", "left")
        placed = placed.withColumn("apart", F.col("comp") != F.coalesce("pc", "pivot")).drop("pc")
        # a group needs a member apart from the pivot and another one
        mixed = placed.groupBy("pivot").agg(F.max("apart").alias("some"), F.count("*").alias("m")).where("some and m > 1").select("pivot")
        placed = placed.join(mixed, "pivot")
        own = sets.select("id", "shingles")
        core = sets.select(F.col("id").alias("pivot"), F.col("shingles").alias("core"))
        apart = placed.join(own, "id").join(core, "pivot").select(
            "pivot", "id", "comp", "apart", F.size("shingles").alias("n"), F.array_except("shingles", "core").alias("extra")
        )
        apart = self.work.save(apart.withColumn("shared", F.col("n") - F.size("extra")), "apart")
        if apart.isEmpty():
            return None
        # a large group is dealt to several tasks
        salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
        least = apart.groupBy("pivot").agg(F.min("n").alias("smallest")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        p, q = self.percent, 100 + self.percent
        every = apart.withColumn("salt", salt).join(least, ["pivot", "salt"]).select(
            "pivot",
            "id",
            "comp",
            "apart",
            "n",
            # the smallest partner, the largest one that needs no shingle beyond the pivot's, and the wanting shingles
            F.expr(f"greatest(smallest, cast(ceil({p} * n / 100) as int))").alias("lo"),
            F.expr(f"cast(floor({q} * shared / {p}) as int) - n").alias("hi"),
            "shared",
            "extra",
        )
        every = every.withColumn("want", F.expr(f"greatest(1, cast(ceil({p} * (n + lo) / {q}) as int) - shared)"))
        minor = every.where("apart")
        small = minor.where("hi >= lo").select("pivot", F.col("id").alias("x"), F.col("comp").alias("cx"), "lo", "hi")
        others = apart.select("pivot", F.col("id").alias("y"), F.col("comp").alias("cy"), F.col("n").alias("ny"))
        # similar sets share a bucket, so those are paired and not all of a pivot
        small = small.join(keyed.select("pivot", F.col("id").alias("x"), "key"), ["pivot", "x"])
        others = others.join(small.select("pivot").distinct(), "pivot", "left_semi").join(keyed.select("pivot", F.col("id").alias("y"), "key"), ["pivot", "y"])
        by_size = small.join(others, (small["key"] == others["key"]) & F.col("ny").between(F.col("lo"), F.col("hi")) & (F.col("cx") != F.col("cy")))

        index = every.select("pivot", "id", "comp", "apart", "n", "want", F.explode("extra").alias("e"))
        spread = index.groupBy("pivot", "e").agg(F.count("*").alias("df"), F.max("apart").alias("some")).where("df > 1 and some").drop("some")
        # how many of a set's shingles nobody shares follows from their number; those are its rarest
        each = index.join(spread, ["pivot", "e"]).groupBy("pivot", "id", "comp", "apart", "n", "want").agg(F.array_sort(F.collect_list(F.struct("df", "e"))).alias("by_df"))
        # with the last (want - 1) of all left out on either side, one of the rest must be shared
        prefix = each.select("pivot", "id", "comp", "apart", "n", F.explode(F.expr("slice(by_df, 1, greatest(0, size(by_df) - want + 1))")).alias("s"))
        prefix = prefix.select("pivot", F.col("s.e").alias("e"), "id", "comp", "apart", "n")
        one = prefix.where("apart").select("pivot", "e", F.col("id").alias("x"), F.col("comp").alias("cx"), F.col("n").alias("nx"))
        two = prefix.select("pivot", "e", F.col("id").alias("y"), F.col("comp").alias("cy"), F.col("n").alias("ny"))
        by_edit = one.join(two, ["pivot", "e"]).where(f"cx <> cy and 100 * ny >= {p} * nx and 100 * nx >= {p} * ny")
        both = by_size.select("x", "y").union(by_edit.select("x", "y"))
        return both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """See the module; a thin function over NearDuplicates.fit."""
    return NearDuplicates(docs.sparkSession, percent, **more).fit(docs, id_col, text_col)


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = near_duplicates(docs, percent=85)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")
