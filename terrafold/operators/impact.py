"""Best documents of a question without reading every posting of its common terms.

The weight of a posting (its share of the score) does not depend on the question, so
it is stored: postings of a term stand in blocks by falling weight, and every block
knows its largest weight. A first round scores the documents in the heaviest blocks of
each question in full; its k-th best score is a bound. Terms whose largest weights sum
to less than the bound can bring no document in alone: they are looked up for the
documents that other terms bring, block by block while a block can still reach it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import sendable, sent, written
from .retrieval import K1, SCALE, B, by_term, round4, terms, with_lengths

BLOCK = 128


def weighted(post: DataFrame, n_docs: DataFrame, key: str) -> DataFrame:
    """(term, key, w): what a posting adds to a score. ``n_docs``: one row with n_docs."""
    post = with_lengths(post, key)
    total = post.agg(F.sum("tf").alias("n_terms"))
    df = post.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n = F.col("n_docs").cast("double")
    idf = F.log1p((n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    w = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / (F.col("n_terms") / n)))
    return by_term(post, df).crossJoin(F.broadcast(n_docs.crossJoin(total))).select("term", key, w.alias("w"))


def blocks(weights: DataFrame, key: str, size: int = BLOCK) -> DataFrame:
    """The postings with ``level`` and ``most``. A term's blocks are levels of weight,
    of 1/32 of its largest weight each: they follow from the term's largest weight alone,
    so no task sorts the postings of a common term."""
    weights = written(weights, "weights")
    top = weights.groupBy("term").agg(F.max("w").alias("top"), F.count(F.lit(1)).alias("df"))
    steps = F.least(F.lit(32), F.ceil(F.col("df") / size)).cast("int")
    level = F.least(steps - 1, F.floor((1 - F.col("w") / F.col("top")) * steps).cast("int"))
    placed = by_term(weights, top).withColumn("level", F.when(F.col("top") > 0, F.greatest(level, F.lit(0))).otherwise(0))
    return placed.withColumn("most", F.col("top") * (1 - F.col("level") / steps)).select("term", "level", "most", key, "w")


def laid_out(rows: DataFrame, key: str) -> DataFrame:
    """Blocks of a term together; the postings of a common term are dealt over files."""
    return rows.repartition("term", F.pmod(F.hash(key), F.lit(16))).sortWithinPartitions("term", "level")


def heads_of(rows: DataFrame) -> DataFrame:
    """The table of blocks: term, level, most (the largest weight in it) and n."""
    return rows.groupBy("term", "level").agg(F.max("w").alias("most"), F.count(F.lit(1)).alias("n"))


def _least_sum(score: Column) -> Column:
    """The least sum of weights whose rounded score is still ``score``."""
    x = F.greatest(score - 0.00005, F.lit(0.0))
    return SCALE * x / (1 - x) * (1 - 1e-12)


def best(rows: DataFrame, heads: DataFrame, queries: DataFrame, key: str, k: int = 5) -> DataFrame:
    """query_id, key, score, overlap, rank: the k best of every question by rounded score,
    ties by key, as the full computation gives them. Questions none of whose terms is in
    the index have no row; a null question is empty."""
    typed = written(terms(queries.select("query_id", F.coalesce("question", F.lit("")).alias("question")), "query_id", "question").distinct(), "typed")
    size = typed.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_typed"))
    tops = heads.groupBy("term").agg(F.max("most").alias("top"), F.sum("n").alias("df"))
    asked = written(typed.join(tops, "term"), "asked")  # (query, term, top, df)
    rows = written(rows.join(asked.select("term").distinct(), "term", "left_semi"), "own")  # the index is read once, and only where a question asks

    # first round: the heaviest blocks of each question's rarest terms, enough for k documents
    rare = Window.partitionBy("query_id").orderBy(F.col("top").desc(), "term")
    heaviest = heads.groupBy("term").agg(F.min(F.struct("level", "n")).alias("h")).select("term", F.col("h.level").alias("level"), F.col("h.n").alias("n"))
    first = asked.withColumn("place", F.row_number().over(rare)).join(heaviest, "term").withColumn("before", F.coalesce(F.sum("n").over(rare.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    first = first.where((F.col("before") < 4 * k) | (F.col("place") <= 2)).select("query_id", "term", "level")
    seen = rows.join(first, ["term", "level"]).select("query_id", key).distinct()
    bound = _kth(_scored(seen, rows, asked, key), key, k)

    # second round: terms in order of their largest weight; the lightest that cannot reach the bound together bring nobody in
    light = Window.partitionBy("query_id").orderBy("top", "term").rowsBetween(Window.unboundedPreceding, 0)
    graded = asked.join(bound, "query_id", "left").withColumn("upto", F.sum("top").over(light)).withColumn("bound", F.coalesce("bound", F.lit(0.0)))
    everything = F.sum("top").over(Window.partitionBy("query_id"))
    graded = graded.withColumn("others", everything - F.col("top"))
    bringing = graded.where(F.col("upto") >= F.col("bound") * (1 - 1e-9)).join(heads, "term").where(F.col("most") + F.col("others") >= F.col("bound") * (1 - 1e-9)).select("query_id", "term", "level")
    found = written(rows.join(bringing, ["term", "level"]).select("query_id", key).distinct(), "found")
    scored = _scored(found, rows, asked, key).join(size, "query_id")
    out = scored.select("query_id", key, round4(F.col("s") / (F.col("s") + SCALE)).alias("score"), (F.col("hits") / F.col("n_typed")).alias("overlap"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col(key).asc())
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def best_of_texts(rows: DataFrame, heads: DataFrame, queries: DataFrame, key: str, k: int = 5) -> DataFrame:
    """``best`` for questions whose texts repeat: each text is ranked once."""
    queries = written(queries.select("query_id", "question"), "questions")
    texts = written(queries.where(F.col("question").isNotNull()).groupBy("question").agg(F.min("query_id").alias("first")), "texts")
    found = best(rows, heads, texts.select(F.col("first").alias("query_id"), "question"), key, k).withColumnRenamed("query_id", "first")
    found = written(texts.join(found, "first"), "ranked").drop("first")
    return queries.join(sent(found, sendable(found)), "question").drop("question")


def _scored(found: DataFrame, rows: DataFrame, asked: DataFrame, key: str) -> DataFrame:
    """Full sums of documents: looked up by (term, document), so a common term is no hot key."""
    wanted = found.join(asked.select("query_id", "term"), "query_id")
    return wanted.join(rows.select("term", key, "w"), ["term", key]).groupBy("query_id", key).agg(F.sum("w").alias("s"), F.count(F.lit(1)).alias("hits"))


def _kth(scored: DataFrame, key: str, k: int) -> DataFrame:
    """query_id and the least sum that can still be among the k best; questions with fewer
    than k documents have no row."""
    score = round4(F.col("s") / (F.col("s") + SCALE))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col(key).asc())
    last = scored.withColumn("score", score).withColumn("n", F.row_number().over(order)).where(F.col("n") == k)
    return last.select("query_id", _least_sum(F.col("score")).alias("bound"))
