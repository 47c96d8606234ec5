"""Tables that are derived once and read many times, in the folder that all nodes share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_KEPT: dict[tuple, tuple[str, str]] = {}
_MADE: dict[str, list[str]] = {}  # tables of an application, for ``clean``


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; one of our own
    only where that is unset, as in tests on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _there(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path + "/_SUCCESS")
    return fs.exists(target)


def _new(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def version(spark: SparkSession, path: str, depth: int = 2) -> tuple:
    """Names, sizes and times of the files at a path: another tuple when the inputs change.
    Folders are looked into ``depth`` levels deep, deeper ones by their own time."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return ()
    out = []
    for s in fs.listStatus(target):
        name = s.getPath().getName()
        if s.isDirectory() and depth > 1:
            out.append((name, version(spark, s.getPath().toString(), depth - 1)))
        else:
            out.append((name, s.getLen(), s.getModificationTime()))
    return tuple(sorted(out, key=str))


@contextmanager
def small_batches(spark: SparkSession, most: int):
    """What runs within it sends rows to Python in batches of about ``most`` bytes. A batch is
    held several times outside of the JVM's heap, by each task."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def written(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """The table as Parquet in the shared folder: cuts lineage, and is read as often as needed."""
    path = _new(df.sparkSession, name)
    df.write.options(**options or {}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(spark: SparkSession, name: str, of: tuple, build: Callable[[], DataFrame]) -> DataFrame:
    """The table ``name`` derived from ``of`` (a folder of inputs, then parameters): written
    as Parquet when it is first asked for in an application, read from there afterwards. It
    is built again when an input file has changed, or when its own files are gone."""
    key = (spark.sparkContext.applicationId, name, *of, version(spark, of[0]))
    if key in _KEPT:
        path, schema = _KEPT[key]
        if _there(spark, path):
            return spark.read.schema(schema).parquet(path)
    df = build()
    path = _new(spark, name)
    df.write.parquet(path)
    _KEPT[key] = path, df.schema
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a table that may be sent to every executor.
SENT = 20_000


def sendable(df: DataFrame) -> bool:
    return df.limit(SENT + 1).count() <= SENT


def sent(df: DataFrame, few: bool, else_by: str = "merge") -> DataFrame:
    """A side of a join, sent to every executor if it was counted and has few rows. Sizes of
    files must not decide: texts that repeat are packed to a hundredth of what they hold."""
    return F.broadcast(df) if few else df.hint(else_by)


def clean(spark: SparkSession) -> int:
    """Delete all tables that ``written`` and ``kept`` have made in this application, when
    none of their results is read any more. Returns how many there were."""
    made = _MADE.pop(spark.sparkContext.applicationId, [])
    for path in made:
        fs, target = _fs(spark, path)
        fs.delete(target, True)
    return len(made)
