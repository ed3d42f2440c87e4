"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Streaming state outgrows the heap long before it outgrows local disks.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


#: The folder of the innermost ``working`` block, if any.
_inside: ContextVar[str | None] = ContextVar("working", default=None)


def build_session(app: str = "keelson", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this library's defaults; ``conf`` keys use ``__`` for dots.

    Leave ``master`` unset on a cluster, so that spark-submit decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``work_dir`` gave, once no DataFrame reads it any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared checkpoint folder, for tables that cut lineage.

    Executors on any host must be able to read it, so the folder the cluster names in
    ``spark.checkpoint.dir`` is used. A temporary folder stands in only on a local master.
    Inside a ``working`` block the path is in that block's folder.
    """
    block = _inside.get()
    if block:
        return f"{block}/{label}-{uuid.uuid4().hex}"
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="keelson-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def keep(rows: DataFrame, label: str) -> DataFrame:
    """The rows, written once to a fresh folder of ``work_dir`` and read from there."""
    path = work_dir(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@contextmanager
def working(spark: SparkSession, label: str) -> Iterator[None]:
    """A block whose tables go when it ends or fails: what ``work_dir`` names inside is in one folder.

    A DataFrame that reads such a table cannot be used after the block. Put the block's result into a
    ``Held`` that was made before it. Blocks may be nested.
    """
    path = work_dir(spark, label)
    token = _inside.set(path)
    try:
        yield
    finally:
        _inside.reset(token)
        remove(spark, path)


class Held:
    """A stored table that each ``put`` replaces, in the folder of the block in which this was made.

    The rows are written before the table before them is removed, so they may be computed from it, and
    a lost executor finds what it reads at all times. Results that read the former table must be done.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.base, self.times = spark, work_dir(spark, label), 0

    def put(self, rows: DataFrame) -> DataFrame:
        path = f"{self.base}/{self.times}"
        rows.write.parquet(path)
        if self.times:
            remove(self.spark, f"{self.base}/{self.times - 1}")
        self.times += 1
        return self.spark.read.schema(rows.schema).parquet(path)
