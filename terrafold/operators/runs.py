"""Run lifecycle: deltas between runs, history, verification, pointers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def row_hash(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).alias("key"), F.sha2(F.to_json(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00")).alias(c) for c in df.columns])), 256).alias("hash"))


def row_delta(before: DataFrame, now: DataFrame, key: str) -> DataFrame:
    """Counts of inserted, updated, unchanged and removed rows."""
    a, b = row_hash(before, key).withColumnRenamed("hash", "old"), row_hash(now, key).withColumnRenamed("hash", "new")
    status = F.when(F.col("old").isNull(), "inserted").when(F.col("new").isNull(), "removed").when(F.col("old") == F.col("new"), "unchanged").otherwise("updated")
    return a.join(b, "key", "full").groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


def count_delta(before: DataFrame, now: DataFrame) -> DataFrame:
    """Per table: rows, previous rows and difference; null at first sight."""
    joined = now.join(before.withColumnRenamed("n", "previous"), "name", "left")
    return joined.select("name", F.col("n").alias("rows"), "previous", (F.col("n") - F.col("previous")).alias("delta"))


def history_breaches(recorded: DataFrame, proposed: DataFrame) -> DataFrame:
    """Recorded runs that a proposed history changes or loses; must be empty."""
    h = lambda d: row_hash(d, "run_id")
    return h(recorded).join(h(proposed), ["key", "hash"], "left_anti")


def verified(results: DataFrame, hosts: int = 2) -> DataFrame:
    """Artifacts that enough distinct hosts returned with bytes and digest right."""
    good = F.col("ok") & (F.col("bytes") == F.col("size")) & (F.col("digest") == F.col("sha256"))
    n = F.countDistinct(F.when(good, F.col("host")))
    return results.groupBy("name").agg(n.alias("good_hosts"), (n >= hosts).alias("verified"), F.array_join(F.array_sort(F.collect_set(F.when(good, F.col("host")))), ",").alias("hosts"))


def newest_pointer(answers: DataFrame) -> DataFrame:
    """Largest run id; unparsed ids lose; ties keep the order of preference."""
    order = Window.partitionBy("pointer").orderBy(F.col("run_id").desc_nulls_last(), F.col("pref").asc())
    return answers.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def upgrade(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("action", F.when(F.col("root") == F.col("new_root"), "current").when(F.col("new_run").isNull() | (F.col("new_run") <= F.col("run")), "keep").otherwise("upgrade"))


def merge_window(known: DataFrame, changed: DataFrame, key: str, by: str) -> DataFrame:
    """Known rows and a window of changed ones, the latest of each key; of equally
    late ones the largest in the other columns."""
    both = known.unionByName(changed)
    rest = [c for c in both.columns if c not in (key, by)]
    best = both.groupBy(key).agg(F.max(F.struct(by, *rest)).alias("best"))
    return best.select(*[F.col(key) if c == key else F.col(f"best.{c}").alias(c) for c in both.columns])


def trusted(pointers: DataFrame) -> DataFrame:
    """Pointers whose read-back id is their root id, under the name that was asked."""
    return pointers.where((F.col("read_back") == F.col("root")) & (F.col("name") == F.col("asked")))


def served(run: DataFrame, bundled: DataFrame) -> DataFrame:
    """A served run with the bundled fields; those of another run are null."""
    return run.join(bundled, "run_id", "left")
