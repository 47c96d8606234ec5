"""Readers and sinks: the table with its gate, run records, shards, manifests."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import SCHEMA, schema_gate

COVERAGE = "runId string, exportedAt string, denominator struct<basis string, source string, assessedParcelCount bigint>, tables map<string, struct<rows bigint, source string>>, signals map<string, bigint>, limitations array<string>"
CATALOG = "county string, permits struct<jurisdictions array<struct<name string, supported boolean, certified boolean, records_request struct<method string, contact string>>>>"


def register(spark: SparkSession, path: str, view: str = "properties") -> DataFrame:
    """The table as a view; the name must be an identifier, the schema the contract's."""
    if not re.fullmatch(r"[A-Za-z_]\w*", view):
        raise ValueError(f"not an identifier: {view!r}")
    schema_gate(spark.read.parquet(path))
    df = spark.read.schema(SCHEMA).parquet(path)
    df.createOrReplaceTempView(view)
    return df


def relation(spark: SparkSession, ref: str) -> DataFrame:
    """A bare identifier is a table, anything else a path."""
    return spark.table(ref) if re.fullmatch(r"[A-Za-z_]\w*", ref) else spark.read.parquet(ref)


def first_readable(spark: SparkSession, paths: list[str], preferred: str | None = None) -> tuple[str, DataFrame]:
    """The first path that opens, the preferred one first; else all failures."""
    failed = {}
    for path in dict.fromkeys([p for p in (preferred, *paths) if p]):
        try:
            df = spark.read.parquet(path)
            df.limit(0).count()
            return path, df
        except Exception as e:  # noqa: BLE001 - every reason is reported
            failed[path] = str(e).splitlines()[0]
    raise OSError("; ".join(f"{p}: {e}" for p, e in failed.items()))


def run_record(spark: SparkSession, path: str, schema: str = COVERAGE) -> DataFrame | None:
    """A nested JSON record; a missing file is None."""
    try:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def jurisdictions(catalog: DataFrame) -> DataFrame:
    """One row a jurisdiction; it is harvested if supported and certified."""
    j = catalog.select("county", F.explode_outer("permits.jurisdictions").alias("j")).select("county", "j.*")
    return j.withColumn("harvested", F.coalesce(F.col("supported") & F.col("certified"), F.lit(False)))


def write_shards(df: DataFrame, path: str, key: str, size: int = 10_000) -> None:
    """JSON shards of about ``size`` rows, by ranges of the key."""
    n = max(1, -(-df.count() // size))
    df.repartitionByRange(n, key).withColumn("shard", F.spark_partition_id()).write.partitionBy("shard").json(path)


def manifest(spark: SparkSession, path: str, chunk: int = 1 << 22) -> DataFrame:
    """Name, size and SHA-256 of every file below a path.

    Files are listed without their content; each is then read and hashed in
    chunks in a task, so a large file is never one row.
    """
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.col("length").alias("size"))

    def digest(batches):
        import hashlib

        import pandas as pd
        from pyarrow import fs

        for pdf in batches:
            out = []
            for name, size in zip(pdf["path"], pdf["size"], strict=True):
                store, own = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", name))
                found = hashlib.sha256()
                with store.open_input_stream(own) as f:
                    while block := f.read(chunk):
                        found.update(block)
                out.append((name.rpartition("/")[2], size, found.hexdigest()))
            yield pd.DataFrame(out, columns=["name", "size", "sha256"])

    schema = StructType([StructField("name", StringType()), StructField("size", LongType()), StructField("sha256", StringType())])
    return files.mapInPandas(digest, schema)


def bounded(spark: SparkSession, statement: str, limit: int) -> tuple[DataFrame, bool]:
    """At most ``limit`` rows of an ad-hoc statement, and whether there were more."""
    wide = spark.sql(statement).limit(limit + 1)
    return wide.limit(limit), wide.count() > limit
