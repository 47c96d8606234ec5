"""Helpers that several operators share: staged tables, numbering, words."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters that separate words, for every operator of this folder.
BLANKS = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: A-Z to a-z and nothing else, as the contracts lower-case.
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: str) -> list[str]:
    """Words of a text: runs of anything but space and the controls 9 to 13."""
    if text.isascii() and not re.search("[\x1c-\x1f]", text):
        return text.split()
    return WORD.findall(text)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    The cluster names it in spark.checkpoint.dir; only where that is unset (as
    in tests on one machine) a temporary folder is set for the session.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_SCOPES: list[list[str]] = []


@contextmanager
def scope():
    """Collects the paths that are made within it, for those who know when they are read no more."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield made
    finally:
        _SCOPES[:] = [x for x in _SCOPES if x is not made]


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for made in _SCOPES:
        made.append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: cuts lineage, so
    that a lost executor costs a reread and not a recomputation."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete a staged table that no later step reads."""
    path = getattr(df, "_staged_path", None)
    if path:
        drop_path(df.sparkSession, path)


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_HELD: dict[str, list[dict]] = {}  # what a worker keeps from task to task, by the step that fills it


def held_by(step: str, cache: dict) -> dict:
    _HELD.setdefault(step, []).append(cache)
    return cache


_SERVED = [""]  # the step that a worker served last


def alone(step: str) -> None:
    """For the start of a task: a worker that served another step before gives back what
    this has kept and freed, so that the steps of a pipeline do not add up in its memory."""
    others = [c for k, caches in _HELD.items() if k != step for c in caches if c]
    for cache in others:
        cache.clear()
    if others or _SERVED[0] != step:
        _SERVED[0] = step
        give_back()


def give_back() -> None:
    """What is free goes back to the system: a worker that waits for its next task holds no batch."""
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # another C library keeps its free pages
        ctypes.CDLL(None).malloc_trim(0)


def few_rows(batches, most: int = 1_000):
    """Record batches of at most ``most`` rows: what a task makes of a batch lies in memory at once."""
    for batch in batches:
        for a in range(0, batch.num_rows, most):
            yield batch.slice(a, most)


#: Rows of a side of a join that may be sent to every executor.
SENT = 20_000


def met_by(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A side of a join, sent to every executor only if it was counted and has few rows. Spark
    takes a table that is exploded, or whose files are small, for much less than it holds."""
    return F.broadcast(df) if rows is not None and rows <= SENT else df.hint("merge")


def text_of(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def partition_bases(staged: DataFrame, keys: list[str]) -> DataFrame:
    """First free number of every (partition, key): exclusive prefix sums.

    ``staged`` holds ``part`` (the task that wrote a row) and ``local`` (its
    place among that task's rows of the key). The result has one row for each
    task and key, whatever the number of rows.
    """
    counts = staged.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*keys, "part", F.coalesce(F.sum("n").over(order), F.lit(0)).cast("long").alias("base"))


def add_local_numbers(df: DataFrame, key: str) -> DataFrame:
    """Add ``part`` and ``local``: the task and the row's place in it by key."""
    schema = T.StructType([*df.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("local", T.LongType())])

    def number(batches):
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), {}
        for pdf in batches:
            within = pdf.groupby(key, dropna=False).cumcount()
            pdf["part"] = part
            pdf["local"] = within + pdf[key].map(lambda k: seen.get(k, 0)).astype("int64") if len(pdf) else within
            for k, n in pdf[key].value_counts(dropna=False).items():
                seen[k] = seen.get(k, 0) + int(n)
            yield pdf

    return df.mapInPandas(number, schema)
