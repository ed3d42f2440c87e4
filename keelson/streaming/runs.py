"""Running a streaming DataFrame into a sink."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keelson.session import remove, work_dir


def triggers(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the triggers whose results are whole, in order."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    found = (f.getPath() for f in files.listStatus(folder))
    whole = (p.getName() for p in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))
    return sorted(int(name.removeprefix("trigger=")) for name in whole if name.startswith("trigger="))


def merged(snapshot: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``snapshot`` with the rows of ``changes`` in place of those with the same keys; a null is a value."""
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    return snapshot.alias("s").join(changes.alias("c"), same, "left_anti").unionByName(changes)


def run_available(
    stream: DataFrame,
    mode: str = "complete",
    name: str | None = None,
    keys: Sequence[str] | None = None,
    each: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Process what the source holds now, stop, and return the result table.

    The result is a parquet table in the shared working folder, next to the query's checkpoint;
    rows go there from the executors. Append mode uses the file sink, or with ``each``, a function
    that reports on the rows of one trigger, a folder for each trigger. Complete mode replaces the
    whole result at each trigger, which the file sink cannot: each trigger writes its own
    ``trigger=<id>`` folder, and the last is read. Update mode gives the rows that a trigger
    changed; ``keys`` name a row, and a trigger writes the last snapshot before it with the
    changed rows in place of the old ones.

    A trigger that is replayed, also by a new driver, starts from the snapshot before it and
    overwrites only its own folder. Folders older than that snapshot are removed.
    """
    if mode not in ("append", "complete", "update"):
        raise ValueError(f"mode {mode!r} does not give a result table")
    if mode == "update" and not keys:
        raise ValueError("update mode needs the keys of a row")
    spark = stream.sparkSession
    root = work_dir(spark, name or "stream")
    result = f"{root}/result"
    writer = stream.writeStream.outputMode(mode).trigger(availableNow=True)
    writer = writer.option("checkpointLocation", f"{root}/checkpoint")
    if name:
        writer = writer.queryName(name)
    if mode == "append" and each is None:
        writer.format("parquet").option("path", result).start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(result)

    schema = stream.schema

    def save(batch: DataFrame, trigger: int) -> None:
        nonlocal schema
        write_trigger(batch, trigger, result, mode, keys, each)
        schema = batch.schema if each is None else each(batch).schema

    writer.foreachBatch(save).start().awaitTermination()
    whole = triggers(spark, result)
    if not whole:
        return spark.createDataFrame([], (each(spark.createDataFrame([], schema)) if each else stream).schema)
    # Append: the reports of all triggers. Else the last trigger's table.
    paths = [f"{result}/trigger={t}" for t in (whole if mode == "append" else whole[-1:])]
    return spark.read.schema(schema).parquet(*paths)


def write_trigger(
    batch: DataFrame,
    trigger: int,
    result: str,
    mode: str,
    keys: Sequence[str] | None = None,
    each: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write the result as of one trigger, and remove what no replay can need."""
    spark = batch.sparkSession
    rows = batch if each is None else each(batch)
    before = [t for t in triggers(spark, result) if t < trigger]
    if mode == "update" and before:
        last = spark.read.schema(rows.schema).parquet(f"{result}/trigger={before[-1]}")
        rows = merged(last, rows, keys)
    rows.write.mode("overwrite").parquet(f"{result}/trigger={trigger}")
    if mode != "append":
        for old in before[:-1] if mode == "update" else before:
            remove(spark, f"{result}/trigger={old}")


def start_console(
    stream: DataFrame, mode: str = "complete", name: str | None = None, truncate: bool = False, **trigger
) -> StreamingQuery:
    """Print each trigger's result on the driver: for looking at small aggregates."""
    writer = stream.writeStream.outputMode(mode).format("console").option("truncate", truncate)
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
