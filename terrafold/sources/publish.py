"""Publishing tables: a gate in flight, partitioned runs, stored indexes with a manifest."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


_DICTIONARY = 16 << 20


class Refused(ValueError):
    """A table or an index that does not hold what it must; nothing was published."""


def _store(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def there(spark: SparkSession, path: str) -> bool:
    fs, target = _store(spark, path)
    return fs.exists(target)


def _drop(spark: SparkSession, path: str) -> None:
    fs, target = _store(spark, path)
    fs.delete(target, True)


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, at = _store(spark, target)
    fs.mkdirs(at.getParent())
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(source), at):
        raise OSError(f"cannot publish {target}")


def publish(df: DataFrame, path: str, key: str, least_rows: int = 1, finish: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, int]:
    """Write a table whose ``key`` is there and unique in every row, or refuse it.

    The rows are counted while they are written, with no second scan: the numbers of
    rows and of null keys, and the most rows of a key. The table is written beside
    ``path`` and takes its place only when these are right; else it is deleted and
    ``Refused`` says what was found. A path that is taken is refused before any work.
    ``finish`` may add columns to the rows that were counted, one row for each: what is
    wide and shared then goes to the files without a shuffle. Returns the counts.
    """
    spark = df.sparkSession
    if there(spark, path):
        raise Refused(f"{path} is published already")
    of_key = "_of_key"
    while of_key in df.columns:
        of_key += "_"
    seen = Observation(f"gate-{uuid.uuid4().hex}")
    # null keys are dealt over parts: they are counted by themselves and must not meet in one task
    part = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(1024))).otherwise(-1)
    counted = df.withColumn(of_key, F.count(F.lit(1)).over(Window.partitionBy(key, part)))
    counted = counted.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("nulls"), F.max(F.when(F.col(key).isNotNull(), F.col(of_key))).alias("most"))
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    try:
        rows = counted.drop(of_key)
        # values that many rows share may be long: the dictionary of a column holds more of them than by default
        (finish(rows) if finish else rows).write.option("parquet.dictionary.page.size", _DICTIONARY).parquet(beside)
        got = {k: int(v or 0) for k, v in seen.get.items()}
        wrong = [text for bad, text in ((got["nulls"], f"{got['nulls']} rows without {key}"), (got["most"] > 1, f"{got['most']} rows of one {key}"), (got["rows"] < least_rows, f"{got['rows']} rows")) if bad]
        if wrong:
            raise Refused("; ".join(wrong))
        _move(spark, beside, path)
    finally:
        _drop(spark, beside)
    return got


def write_run(df: DataFrame, path: str, run_id: str) -> None:
    """A run of a table in a partition of its own, ``run_id=...``; written again, it is replaced."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_id={run_id}")


def run_ids(spark: SparkSession, path: str) -> list[str]:
    """The runs whose writing has ended, by the names of their folders alone."""
    fs, target = _store(spark, path)
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]
    ended = [n for n in names if n.startswith("run_id=") and there(spark, f"{path.rstrip('/')}/{n}/_SUCCESS")]
    return sorted(n.partition("=")[2] for n in ended)


def newest_run(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The table's largest run that has ended, None without any: the run is a literal over
    the partition column, so the scan lists and reads that partition only. Runs are text."""
    ids = run_ids(spark, path)
    if not ids:
        return None
    reader = spark.read.option("basePath", path)
    reader = reader.schema(f"{schema}, run_id string") if schema else reader.option("inferSchema", False)
    return reader.parquet(path).where(F.col("run_id").cast("string") == F.lit(ids[-1]))


_MANIFEST = "name string, rows bigint, digest string, kind string, version string"


def _digest(df: DataFrame):
    """Rows and an order-free sum of row hashes, in one aggregate."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return F.count(F.lit(1)).alias("rows"), F.sum(row.cast("decimal(38,0)")).cast("string").alias("digest")


def save_index(tables: dict[str, DataFrame], folder: str, version: str) -> None:
    """Tables of an index under ``folder/version``, each measured while it is written, and
    last a manifest with the rows, the digest and the schema of each."""
    rows = []
    for name, df in tables.items():
        seen = Observation(f"index-{uuid.uuid4().hex}")
        df.observe(seen, *_digest(df)).write.mode("overwrite").parquet(f"{folder}/{version}/{name}")
        got = seen.get
        rows.append((name, int(got["rows"]), got["digest"] or "", df.schema.simpleString(), version))
    spark = next(iter(tables.values())).sparkSession
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{version}/manifest")


def load_index(spark: SparkSession, folder: str, version: str | None = None, check: bool = True) -> dict[str, DataFrame]:
    """The tables of a stored index, the newest whose manifest is there.

    ``Refused`` if there is none, if a table is missing or has another schema, or
    (``check``) if its rows or their digest are not those of the manifest.
    """
    fs, target = _store(spark, folder)
    if version is None:
        names = [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()] if fs.exists(target) else []
        ended = sorted(n for n in names if there(spark, f"{folder}/{n}/manifest/_SUCCESS"))
        if not ended:
            raise Refused(f"no index in {folder}")
        version = ended[-1]
    if not there(spark, f"{folder}/{version}/manifest/_SUCCESS"):
        raise Refused(f"{version} has no manifest")
    out = {}
    for row in spark.read.schema(_MANIFEST).parquet(f"{folder}/{version}/manifest").collect():  # one row a table
        path = f"{folder}/{version}/{row['name']}"
        if not there(spark, f"{path}/_SUCCESS"):
            raise Refused(f"{row['name']} is missing or torn")
        df = spark.read.parquet(path)
        if df.schema.simpleString() != row["kind"]:
            raise Refused(f"{row['name']} has another schema")
        if check:
            got = df.agg(*_digest(df)).first()
            if (got["rows"], got["digest"] or "") != (row["rows"], row["digest"]):
                raise Refused(f"{row['name']} has changed")
        out[row["name"]] = df
    return out
