"""The archive service: parse, index, remove, set fields and search over versioned tables.

Tables live under one folder of any store that Spark reaches. Parsed records are partitioned by archive, so
parsing an archive again or deleting its parse touches its partition alone.

The index is a list of parts, each a folder with docs, occurrences, a filter of the docs' ids and the inverted index of their
texts. Indexing archives adds a part with the documents that are new and the occurrences of all; removing archives or
setting fields writes again only the parts that hold something of them. Docs are dealt to buckets by their id. What is known
of new documents is found without reading old ones: the manifest has the least and largest id of each part, the filter (a
blocked Bloom filter as a table of 64-bit words) tells which ids a part may hold, and of the parts and buckets that are left only
ids and a flag are read, never contents. Occurrences are read of parts that have one of the archives only. A version names its parts in a manifest that is written once, under the next
number; readers take the highest number and keep the version they opened. A failure before the manifest is in
place changes nothing, and nothing is ever without a current version. One writer at a time holds a lock file;
a lock older than ``lock_seconds`` is taken to be left by a writer that died. ``compact`` joins parts.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capturelake.config import Config
from capturelake.functions import urls
from capturelake.operators import captures, parse, search
from capturelake.schema import PARSE_LOG, PARSED_RECORD
from capturelake.scratch import Scratch
from capturelake.sources.webarchive import locations, name_of


#: bits of a part's filter for each document; four are set, all in one word
FILTER_BITS = 16


def bucket(n: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")


def probe(words: int) -> tuple[Column, Column]:
    """The word of a filter of so many words, a power of two, that an id belongs to, and its bits there."""
    h = F.xxhash64("id", F.lit("filter"))
    mask = F.lit(0).cast("long")
    for i in range(4):
        mask = mask.bitwiseOR(F.expr(f"shiftleft(1L, cast(shiftright(xxhash64(id, 'filter'), {6 * i}) & 63 as int))"))
    return F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(words - 1).cast("long")), mask


class ArchiveError(Exception):
    """The base of the service's own errors."""


class IndexError_(ArchiveError):
    """The index couldn't be read or changed."""


class UnparsedError(ArchiveError):
    def __init__(self, arcname: str):
        super().__init__(f"{arcname} has not been parsed")
        self.arcname = arcname


class BadRecordsError(ArchiveError):
    def __init__(self, message: str, arcname: str):
        super().__init__(message)
        self.arcname = arcname


class ParseError(ArchiveError):
    """Archives couldn't be parsed."""


@contextmanager
def wrapped(kind: type[ArchiveError]):
    """Own errors pass, Spark's and Java's become ``kind``."""
    try:
        yield
    except ArchiveError:
        raise
    except (PySparkException, Py4JJavaError, OSError) as e:
        raise kind(str(e)) from e


class Archive:
    def __init__(self, spark: SparkSession, config: Config | str):
        self.spark, self.config = spark, Config(config) if isinstance(config, str) else config
        self.base = self.config.base.rstrip("/")
        self.fs_path = spark._jvm.org.apache.hadoop.fs.Path
        #: (part, bucket) whose documents the last index() read
        self.opened: list[tuple[str, int | None]] = []

    # files

    def _fs(self):
        return self.fs_path(self.base).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, name: str) -> bool:
        return self._fs().exists(self.fs_path(f"{self.base}/{name}"))

    def _read_text(self, name: str) -> str | None:
        if not self._exists(name):
            return None
        stream = self._fs().open(self.fs_path(f"{self.base}/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _write_text(self, name: str, text: str, overwrite: bool = True) -> None:
        stream = self._fs().create(self.fs_path(f"{self.base}/{name}"), overwrite)
        stream.write(bytearray(text.encode()))
        stream.close()

    @contextmanager
    def lock(self):
        """One writer: creating the lock file fails while another has it, unless that one is older than ``lock_seconds``."""
        path = self.fs_path(f"{self.base}/_lock")
        own = uuid.uuid4().hex
        try:
            self._write_text("_lock", own, overwrite=False)
        except Py4JJavaError as e:
            try:
                age = time.time() - self._fs().getFileStatus(path).getModificationTime() / 1000
            except Py4JJavaError:
                age = 0.0
            if age < self.config.lock_seconds:
                raise IndexError_("another writer holds the lock") from e
            self._fs().delete(path, False)
            self._write_text("_lock", own, overwrite=False)
        try:
            yield
        finally:
            if self._read_text("_lock") == own:
                self._fs().delete(path, False)

    # parses

    def _log(self) -> DataFrame:
        if not self._exists("parse_log"):
            return self.spark.createDataFrame([], PARSE_LOG)
        rows = self.spark.read.schema(PARSE_LOG + ", at timestamp").parquet(f"{self.base}/parse_log")
        # the last entry of an archive holds
        return captures.first_by(rows.withColumn("age", -F.unix_micros("at")), ["arcname"], ["age"]).where("status <> 'deleted'").select("arcname", "path", "status", "n_records", "error")

    def _append_log(self, rows: DataFrame) -> None:
        rows.withColumn("at", F.current_timestamp()).write.mode("append").parquet(f"{self.base}/parse_log")

    def parse(self, paths: Sequence[str]) -> DataFrame:
        """Parses the archives that aren't parsed yet; gives their log."""
        with wrapped(ParseError):
            requested = self.spark.createDataFrame([(name_of(x), x) for p in paths for x in locations([p])], "arcname string, path string").dropDuplicates(["arcname"])
            new = [r.path for r in parse.unparsed(requested, self._log()).collect()]
            if not new:
                return self.spark.createDataFrame([], PARSE_LOG)
            names = self.spark.createDataFrame([(name_of(x),) for x in new], "arcname string")
            for at in range(0, len(new), self.config.archives_per_job):
                self._parse_some(requested, new[at : at + self.config.archives_per_job])
            return self._log().join(F.broadcast(names), "arcname", "left_semi")

    def _parse_some(self, requested: DataFrame, paths: Sequence[str]) -> None:
        """One job: the archives are read once, and what the log needs is written with their records."""
        raw = parse.read_archives(self.spark, list(paths), self.config.parse_mode, status=200)
        parsed = parse.parse(raw, self.config.strict_mime, damage=True)
        parsed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("filename").parquet(f"{self.base}/parsed")
        names = self.spark.createDataFrame([(name_of(x),) for x in paths], "arcname string")
        self._append_log(parse.parse_log(requested.join(F.broadcast(names), "arcname", "left_semi"), self._parsed([name_of(x) for x in paths])))

    def _folder(self, arcname: str) -> str:
        return f"parsed/filename={self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(arcname)}"

    def _parsed(self, arcnames: Sequence[str]) -> DataFrame:
        """What parsing wrote of some archives, from their folders alone."""
        folders = [f for f in map(self._folder, arcnames) if self._exists(f)]
        if not folders:
            return self.spark.createDataFrame([], PARSED_RECORD + ", rec_seq bigint, error string")
        rows = self.spark.read.option("basePath", f"{self.base}/parsed").parquet(*[f"{self.base}/{f}" for f in folders])
        return rows.withColumn("filename", F.col("filename").cast("string"))

    def is_parsed(self, arcname: str) -> bool:
        return not self._log().where((F.col("arcname") == arcname) & F.col("status").isin("ok", "empty")).isEmpty()

    def is_readable(self, arcname: str) -> bool:
        """Whether an archive is parsed and gave records, all or those before damage."""
        return not self._log().where((F.col("arcname") == arcname) & (F.col("status") != "failed")).isEmpty()

    def delete_parse(self, arcname: str) -> None:
        """Forgets a parse; nothing happens if there is none."""
        found = self._log().where(F.col("arcname") == arcname)
        if not found.isEmpty():
            self._append_log(found.select("arcname", "path", F.lit("deleted").alias("status"), F.lit(0).cast("long").alias("n_records"), F.lit(None).cast("string").alias("error")))
            self._fs().delete(self.fs_path(f"{self.base}/{self._folder(arcname)}"), True)

    # index

    def _versions(self) -> list[str]:
        """The names of the manifests, oldest first."""
        if not self._exists("_versions"):
            return []
        names = [str(f.getPath().getName()) for f in self._fs().listStatus(self.fs_path(f"{self.base}/_versions"))]
        return sorted(n for n in names if n.endswith(".json"))

    def _parts(self) -> list[dict] | None:
        """The parts of the current version: name, and the archives that occur in it."""
        found = self._versions()
        return json.loads(self._read_text(f"_versions/{found[-1]}")) if found else None

    def _retried(self, step):
        for left in range(self.config.commit_retries, -1, -1):
            try:
                return step()
            except (Py4JJavaError, OSError):
                if not left:
                    raise
                time.sleep(self.config.retry_seconds)

    def _commit(self, parts: list[dict]) -> None:
        found = self._versions()
        number = int(found[-1].partition(".")[0]) + 1 if found else 1
        name, draft = f"_versions/{number:012d}.json", f"_versions/draft-{uuid.uuid4().hex}"

        def place() -> None:
            self._write_text(draft, json.dumps(parts))
            if self._exists(name):
                raise IndexError_("another writer was faster")
            if not self._fs().rename(self.fs_path(f"{self.base}/{draft}"), self.fs_path(f"{self.base}/{name}")):
                raise OSError("the manifest can't be moved")

        self._retried(place)

    def _write_part(self, docs: DataFrame, occurrences: DataFrame) -> dict | None:
        """A new part; None if it has neither documents nor occurrences."""
        name = f"p{time.time_ns()}-{uuid.uuid4().hex[:8]}"
        folder = f"{self.base}/index/{name}"
        full = F.coalesce(F.col("content") != "", F.lit(False)) if "content" in docs.columns else F.lit(True)
        dealt = docs.drop("__part").withColumns({"__bucket": bucket(self.config.buckets), "__full": full})
        dealt.repartition("__bucket", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(16))).sortWithinPartitions("__bucket", "id").write.partitionBy("__bucket").parquet(f"{folder}/docs")
        occurrences.drop("__part").write.parquet(f"{folder}/occurrences")
        arcs = sorted(r["arcname"] for r in self.spark.read.schema(occurrences.schema).parquet(f"{folder}/occurrences").select("arcname").distinct().collect())
        held = self.spark.read.schema(dealt.schema).parquet(f"{folder}/docs")
        n, least, largest = held.agg(F.count("*"), F.min("id"), F.max("id")).first()
        part = {"name": name, "arcs": arcs, "n": n, "least": least, "largest": largest, "words": 1 << max(0, (n * FILTER_BITS // 64)).bit_length(), "buckets": self.config.buckets, "docs": dealt.schema.jsonValue()}
        word, mask = probe(part["words"])
        held.select(word.alias("word"), mask.alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("bits")).select(F.lit(name).alias("part"), "word", "bits").write.parquet(f"{folder}/filter")
        # terms of the written documents, so that nothing is computed twice
        search.inverted(held.drop("__bucket", "__full")).write.parquet(f"{folder}/terms")
        return part if arcs or n else None

    def _part(self, part: dict, tagged: bool = False) -> tuple[DataFrame, DataFrame]:
        occurrences = self.spark.read.parquet(f"{self.base}/index/{part['name']}/occurrences")
        docs = self._docs(part).drop("__bucket", "__full")
        return docs.withColumn("__part", F.lit(part["name"])) if tagged else docs, occurrences

    def _docs(self, part: dict) -> DataFrame:
        """The documents of a part with __bucket and __full; a part without documents has no file to tell its columns."""
        reader = self.spark.read.schema(T.StructType.fromJson(part["docs"])) if "docs" in part else self.spark.read
        return reader.parquet(f"{self.base}/index/{part['name']}/docs")

    def _tables(self, parts: list[dict], tagged: bool = False) -> tuple[DataFrame, DataFrame]:
        """The union of parts; fields that a part lacks are null. tagged: documents have the name of their part."""
        docs, occurrences = zip(*(self._part(p, tagged) for p in parts), strict=True)
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), docs), reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), occurrences)

    def _known(self, parts: list[dict], docs: DataFrame, work: Scratch) -> DataFrame:
        """(id, part, full) of those documents of docs that parts have, read from the parts and buckets alone that may have them."""
        least, largest = docs.agg(F.min("id"), F.max("id")).first()
        ids = docs.select("id")
        near = [p for p in parts if least is not None and (p.get("least") is None or p["least"] <= largest and p["largest"] >= least) and p.get("n", 1)]
        old = [p for p in near if "words" not in p]
        found = None
        for words in sorted({p["words"] for p in near if "words" in p}):
            own = [p for p in near if p.get("words") == words]
            filters = self.spark.read.parquet(*[f"{self.base}/index/{p['name']}/filter" for p in own])
            word, mask = probe(words)
            hit = ids.select("id", word.alias("word"), mask.alias("mask")).join(filters, "word").where("bits & mask = mask").select("id", "part")
            found = hit if found is None else found.union(hit)
        known = None
        if found is not None:
            found = work.save(found, "hits")
            size, named = {p["name"]: p.get("buckets", 1) for p in near}, {p["name"]: p for p in near}
            # at most a row for each part and bucket
            sizes = self.spark.createDataFrame(list(size.items()), "part string, n int")
            places = sorted(map(tuple, found.join(F.broadcast(sizes), "part").select("part", F.expr("cast(pmod(xxhash64(id), n) as int)").alias("bucket")).distinct().collect()))
            self.opened += places
            for name in sorted({p for p, _ in places}):
                at = [b for p, b in places if p == name]
                rows = self._docs(named[name]).where(F.col("__bucket").isin(at)).select("id", F.lit(name).alias("part"), F.col("__full").alias("full"))
                own = rows.join(found.where(F.col("part") == name).select("id"), "id", "left_semi")
                known = own if known is None else known.union(own)
        for p in old:
            # parts of earlier versions have neither filter nor flag
            self.opened.append((p["name"], None))
            own = self._part(p)[0].join(ids, "id", "left_semi").select("id", F.lit(p["name"]).alias("part"), F.expr("coalesce(content <> '', false)").alias("full"))
            known = own if known is None else known.union(own)
        return work.save(known if known is not None else self.spark.createDataFrame([], "id string, part string, full boolean"), "known")

    def index_tables(self) -> tuple[DataFrame, DataFrame] | None:
        parts = self._parts()
        if parts is None:
            return None
        if not parts:
            empty = captures.merge(captures.project(self.spark.createDataFrame([], PARSED_RECORD)))
            return empty
        return self._tables(parts)

    def index(self, arcnames: Sequence[str], extra_id: str = "", extra_fields: Mapping[str, Sequence[str]] | None = None) -> None:
        """Adds the parsed records of archives, in their order, to the index."""
        with wrapped(IndexError_), self.lock():
            status = {r["arcname"]: (r["status"], r["n_records"]) for r in self._log().where(F.col("arcname").isin(*arcnames)).collect()} if arcnames else {}
            for a in arcnames:
                if a not in status:
                    raise UnparsedError(a)
                if status[a][0] == "failed":
                    raise BadRecordsError("the archive could not be read", a)
            full = [a for a in arcnames if status[a][1]]
            if not full:
                return
            base = time.time_ns()
            order = self.spark.createDataFrame([(a, base + i) for i, a in enumerate(full)], "filename string, ingest_seq long")
            # one row for each archive of the call
            records = self._parsed(full).where("url is not null").join(F.broadcast(order), "filename")
            docs, occurrences = captures.merge(captures.project(records, extra_id, extra_fields))
            parts = self._parts()
            if not parts:
                self._commit([p for p in [self._write_part(docs, occurrences)] if p])
                return
            work = Scratch(self.spark, "index")
            docs, occurrences = work.save(docs, "docs"), work.save(occurrences, "occurrences")
            self.opened = []
            known = self._known(parts, docs, work)
            again = [p for p in parts if set(p["arcs"]) & set(full)]
            fresh = occurrences
            if again:
                old = self._tables(again)[1].where(F.col("arcname").isin(*full)).select("id", "arcname")
                fresh = occurrences.join(old, ["id", "arcname"], "left_anti")
            part = self._write_part(docs.join(known.select("id"), "id", "left_anti"), fresh)
            # a known document without content takes the first that there is
            blank = known.where("not full").select("id", "part")
            fill = work.save(docs.where("content <> ''").join(blank, "id").select("id", F.col("content").alias("__content"), "part"), "fill")
            # at most the parts
            names = {r["part"] for r in fill.select("part").distinct().collect()}
            content = fill.select("id", "__content").dropDuplicates(["id"])
            parts = self._changed(parts, names, lambda d: d.join(content, "id", "left").withColumn("content", F.coalesce("__content", "content")).drop("__content"))
            self._commit([*parts, *[p for p in [part] if p]])
            work.drop("docs", "occurrences", "hits", "known", "fill")

    def _changed(self, parts: list[dict], names: set[str], change) -> list[dict]:
        """The parts, where the named ones are written again with change(docs)."""
        out = []
        for part in parts:
            if part["name"] not in names:
                out.append(part)
            else:
                docs, occurrences = self._part(part)
                new = self._write_part(change(docs), occurrences)
                out += [new] if new else []
        return out

    def remove(self, arcnames: Sequence[str]) -> None:
        """Takes archives out of the index."""
        with wrapped(IndexError_), self.lock():
            parts, gone = self._parts() or [], set(arcnames)
            if not any(gone & set(p["arcs"]) for p in parts):
                return
            work = Scratch(self.spark, "remove")
            listed = self.spark.createDataFrame([(a,) for a in sorted(gone)], "arcname string")
            docs, occurrences = self._tables(parts, tagged=True)
            hit = occurrences.join(F.broadcast(listed), "arcname", "left_semi").select("id").distinct()
            left = occurrences.join(F.broadcast(listed), "arcname", "left_anti").select("id")
            dead = work.save(hit.join(left, "id", "left_anti"), "dead")
            # at most the parts
            names = {r["__part"] for r in docs.join(dead, "id", "left_semi").select("__part").distinct().collect()}
            out = []
            for part in parts:
                if gone & set(part["arcs"]) or part["name"] in names:
                    docs, own = self._part(part)
                    part = self._write_part(docs.join(dead, "id", "left_anti"), own.join(F.broadcast(listed), "arcname", "left_anti"))
                out += [part] if part else []
            self._commit(out)
            work.drop("dead")

    def set_fields(self, query: str, fields: Mapping[str, Sequence[str]]) -> None:
        """Sets fields of the documents that a query matches."""
        with wrapped(IndexError_), self.lock():
            parts = self._parts()
            if parts:
                work = Scratch(self.spark, "fields")
                hits = self._hits(parts, query, tagged=True)
                hits = self._search_view(parts, query, tagged=True) if hits is None else hits
                ids = work.save(hits.select("id", "__part"), "ids")
                mark = ids.select("id").distinct().withColumn("__hit", F.lit(True))
                # at most the parts
                names = {r["__part"] for r in ids.select("__part").distinct().collect()}
                parts = self._changed(parts, names, lambda d: captures.set_fields(d.join(mark, "id", "left"), F.col("__hit").isNotNull(), fields).drop("__hit"))
                self._commit(parts)
                work.drop("ids")

    def compact(self, parts: int = 1) -> None:
        """Writes the whole index as so many parts, of which small ones are joined in order."""
        with wrapped(IndexError_), self.lock():
            now = self._parts() or []
            if len(now) > parts:
                kept, rest = now[: parts - 1], now[parts - 1 :]
                self._commit([*kept, *[p for p in [self._write_part(*self._tables(rest))] if p]])

    def documents(self) -> DataFrame:
        now = self.index_tables()
        if now is None:
            raise IndexError_("nothing is indexed")
        return captures.view(*now)

    def _terms(self, parts: list[dict]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.base}/index/{p['name']}/terms" for p in parts])

    def _hits(self, parts: list[dict], query: str, tagged: bool = False) -> DataFrame | None:
        """The documents, without their arrays, that a query on fields of documents matches; None if it names others."""
        docs, occurrences = self._tables(parts, tagged)
        if search.fields_of(captures.view(docs, occurrences), query) & set(captures.MERGED):
            return None
        return search.search_indexed(docs, self._terms(parts), query)

    def _search_view(self, parts: list[dict], query: str, tagged: bool = False) -> DataFrame:
        return search.search_indexed(captures.view(*self._tables(parts, tagged)), self._terms(parts), query)

    def search(self, query: str) -> DataFrame:
        """Documents that a query matches; text clauses read the inverted index, and arrays are made for hits alone."""
        with wrapped(IndexError_):
            parts = self._parts()
            if not parts:
                return search.search(self.documents(), query)
            hits = self._hits(parts, query)
            if hits is None:
                return self._search_view(parts, query)
            occurrences = self._tables(parts)[1]
            return captures.view(hits, occurrences.join(hits.select("id"), "id", "left_semi"))

    def get(self, url: str) -> DataFrame:
        """The documents of a URL in any form."""
        return self.documents().where(F.col("canonicalurl") == urls.canonicalize(F.lit(url)))
