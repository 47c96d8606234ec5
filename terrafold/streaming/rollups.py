"""Permit rollups kept up to date: each batch of permits re-rolls the parcels it touches.

State is two tables under a folder, both in buckets of the parcel's key: the latest row
of each permit, and each parcel's rollup. A batch rewrites the buckets it touches as a
new version and then commits a small table that names each bucket's version; readers
see the last commit that has ended. A batch that is run again writes the same version
again, so a restart leaves the same state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.consolidate import AS_OF, latest, permit_rollup
from ..sources.publish import _store, there
from ..sources.shared import written

PERMIT = "number bigint, key bigint, issued date, type string, status string, modified date"
_COMMIT = "store string, bucket int, version bigint"


class PermitRollups:
    """The rollups in ``folder``; ``buckets`` is fixed when the folder is first used."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 32, as_of: str = AS_OF):
        self.spark, self.folder, self.buckets, self.as_of = spark, folder.rstrip("/"), buckets, as_of
        self.rollup_schema = permit_rollup(spark.createDataFrame([], PERMIT), as_of).schema.simpleString()[7:-1].replace(":", " ")

    def _version(self, before: int | None = None) -> int | None:
        fs, target = _store(self.spark, f"{self.folder}/commits")
        if not fs.exists(target):
            return None
        ids = [int(s.getPath().getName()) for s in fs.listStatus(target) if there(self.spark, f"{s.getPath()}/_SUCCESS")]
        return max((k for k in ids if before is None or k < before), default=None)

    def _heads(self, before: int | None = None) -> dict[tuple[str, int], int]:
        """The version of each bucket: at most three rows a bucket."""
        at = self._version(before)
        if at is None:
            return {}
        return {(r["store"], r["bucket"]): r["version"] for r in self.spark.read.schema(_COMMIT).parquet(f"{self.folder}/commits/{at}").collect()}

    def _read(self, store: str, schema: str, heads: dict, only: set[int] | None = None) -> DataFrame:
        paths = [f"{self.folder}/{store}/{v}/bucket={b}" for (s, b), v in sorted(heads.items()) if s == store and (only is None or b in only)]
        paths = [p for p in paths if there(self.spark, p)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _bucket(self, column: str):
        return F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(self.buckets)).cast("int")

    def permits(self) -> DataFrame:
        return self._read("permits", PERMIT, self._heads())

    def rollups(self) -> DataFrame:
        return self._read("rollups", self.rollup_schema, self._heads())

    def _write(self, df: DataFrame, store: str, by: str, version: int) -> None:
        df.withColumn("bucket", self._bucket(by)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/{store}/{version}")

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """Take in a batch of permit rows, late and repeated ones too.

        Of a number the row modified last counts (of several, the largest in its other
        columns); rows without a number or a parcel are passed over. A permit that moves to
        another parcel re-rolls both.
        """
        heads = self._heads(before=batch_id)
        new = written(latest(batch.where("number is not null and key is not null").select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in PERMIT.split(", ")]), "number", "modified"), "batch")
        # where a known permit stands now: an index by number, in buckets of the number
        numbers = {r["b"] for r in new.select(self._bucket("number").alias("b")).distinct().collect()}  # at most ``buckets`` rows
        index = "number bigint, key bigint"
        known = self._read("numbers", index, heads, numbers)
        stood = known.join(new.select("number"), "number", "left_semi")
        touched = written(new.select("key").union(stood.select("key")).distinct(), "touched")
        parcels = {r["b"] for r in touched.select(self._bucket("key").alias("b")).distinct().collect()}
        before = self._read("permits", PERMIT, heads, parcels)
        rows = written(latest(before.unionByName(new), "number", "modified"), "permits")
        rolled = permit_rollup(rows.join(touched, "key", "left_semi"), self.as_of)
        others = self._read("rollups", self.rollup_schema, heads, parcels).join(touched, "key", "left_anti")
        self._write(rows, "permits", "key", batch_id)
        self._write(others.unionByName(rolled), "rollups", "key", batch_id)
        # the latest row of a batch's number may be one that was known before, at its own parcel
        moved = rows.join(new.select("number"), "number", "left_semi").select("number", "key")
        self._write(known.join(new.select("number"), "number", "left_anti").unionByName(moved), "numbers", "number", batch_id)
        heads |= {(s, b): batch_id for s, own in (("permits", parcels), ("rollups", parcels), ("numbers", numbers)) for b in own}
        commit = self.spark.createDataFrame([(s, b, v) for (s, b), v in heads.items()], _COMMIT)
        commit.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/commits/{batch_id}")

    def follow(self) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``: an empty batch changes nothing."""

        def merge(batch: DataFrame, batch_id: int) -> None:
            if not batch.isEmpty():
                self.merge(batch, batch_id)

        return merge
