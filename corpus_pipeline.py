"""Documents to packed sequences: classify, deduplicate, clean, decontaminate, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's docs. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.llm import cotraining, decontamination, packing, simhash, suffix
from terrafold.llm.common import drop_path, release, scope, stage

_MADE: list[str] = []  # tables of the stage before, whose result is written by now


def tidied(step):
    """The stage, which first deletes the tables that the stage before it made."""

    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _MADE:
            drop_path(spark, _MADE.pop())
        with scope() as made:
            out = step(spark, docs, sf_dir)
        _MADE.extend(made)
        return out

    return run_step


@tidied
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return cotraining.accepted(docs, labels)


@tidied
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicate rows one stays: that of the smallest doc_id.

    Rows are named by a number of their own, so a doc_id that stands on unlike
    texts loses none of them, and rows without a doc_id are judged like others.
    """
    own = next(f"row_{k}" for k in range(len(docs.columns) + 1) if f"row_{k}" not in docs.columns)
    numbered = stage(docs.withColumn(own, F.monotonically_increasing_id()), "numbered")
    # the order of doc_id is kept where groups choose their smallest: the number only parts ties
    groups = simhash.simhash_groups(numbered.select(F.col(own).alias("doc_id"), "text"))
    named = groups.select(F.col("doc_id").alias(own), F.col("component_id").alias("group")).join(numbered.select(own, F.col("doc_id").alias("id")), own)
    first = named.groupBy("group").agg(F.min(F.struct(F.col("id").isNull(), "id", own)).alias("first")).select(F.col(f"first.{own}").alias(own))
    return numbered.join(first, own, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


@tidied
def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words, and strings of 400 bytes, that occur more than
    once are cut out of the texts."""
    return suffix.without_repeats(docs, words=51)


@tidied
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; each row is judged by itself."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    own = next(f"row_{k}" for k in range(len(docs.columns) + 1) if f"row_{k}" not in docs.columns)
    numbered = stage(docs.withColumn(own, F.monotonically_increasing_id()), "numbered")
    found = decontamination.leaks(numbered.select(F.col(own).alias("doc_id"), "text"), benchmark)
    return numbered.join(found.select(F.col("doc_id").alias(own)).distinct(), own, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


@tidied
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 2,048 tokens."""
    return packing.pack(docs, cached=300_000)  # the workers serve the other stages too


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", suffix_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: A trained classifier and a public tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        before, docs = docs, stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
        release(before)
    return docs
