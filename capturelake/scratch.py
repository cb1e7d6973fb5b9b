"""Session helpers: the shared work folder, materialised tables in it, and worker import paths."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
PLAN = "spark.sql.maxPlanStringLength"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, as a whole URI.

    Where that is unset, a temporary folder if driver and executors are one process, else an error:
    executors of a cluster don't share the driver's folders.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        app = spark.sparkContext.applicationId
        if app not in _LOCAL:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            _LOCAL[app] = tempfile.mkdtemp(prefix="capturelake-")
            spark.sparkContext.setCheckpointDir(_LOCAL[app])
        found = _LOCAL[app]
    return qualified(spark, found)


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder as a whole URI, on the store that Spark takes it from."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder.rstrip("/"))
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    # Hadoop writes file:/a, other readers want file:///a
    return re.sub("^file:/(?!/)", "file:///", whole)


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package where it isn't installed on them, and send them rows in batches that suit whole texts.

    Spark's default of 10,000 rows a batch is held several times over by executor and worker; another setting stays.
    The driver keeps the texts of the last thousand plans for its pages, by default at any length: they get 20,000 characters.
    """
    if int(spark.conf.get(PLAN).rstrip("bB")) > 2_000_000_000:
        spark.conf.set(PLAN, "20000")
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, "2000")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if root not in have.split(":"):
        env["PYTHONPATH"] = f"{root}:{have}" if have else root


@contextmanager
def freed(spark: SparkSession):
    """Within it, what a job shuffled is deleted when the job ends, not when the driver's JVM next collects garbage."""
    old = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, old)


_ROOTS: list[tuple[SparkSession, str]] = []


def _clear() -> None:
    """Deletes the scratch folders of this process, as far as its Spark still runs."""
    for spark, root in _ROOTS:
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(root)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # noqa: BLE001, PERF203  the session may have ended before
            return


class Scratch:
    """Tables written to the shared folder, so that lineage ends there and a lost executor costs nothing.

    ``save`` writes and rereads; ``drop`` deletes a table that later steps no longer read. Results may read the
    others whenever they run, so what is left goes when the driver's process ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        ship(spark)
        if not _ROOTS:
            atexit.register(_clear)
        _ROOTS.append((spark, self.root))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, **options) -> DataFrame:
        df.write.mode("overwrite").options(**options).parquet(self.path(name))
        return self.load(name, df)

    def load(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
