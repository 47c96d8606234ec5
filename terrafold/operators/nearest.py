"""Nearest unit vectors by cosine, exactly: inverted cells whose angles bound the score.

Centres are drawn by farthest-first steps from a bounded sample (``sample`` rows of the
least hashes): they only decide how tight the bounds are. Every row belongs to its
nearest centre's cell, and within it to a ring of its angle to the centre. The angle
between a query and a row is at least that between query and centre less the row's
angle, so a ring has an upper bound for each query. A first round scores each query's
rings of the highest bounds; the k-th best score decides which rings can still matter,
and all of these are scored. Nothing is lost: recall is 1 by the bound.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import written

CELLS, RINGS, SAMPLE, GROUP = 64, 8, 4000, 8192
_SLACK = 1e-6
_ROWS = "id {kind}, cell int, ring int, lo double, v array<double>"


def centres(rows: DataFrame, cells: int = CELLS, sample: int = SAMPLE) -> np.ndarray:
    """Unit centres, at most ``cells``, from at most ``sample`` rows; runs repeat."""
    some = rows.orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(sample).select("v").toPandas()["v"]
    if not len(some):
        return np.zeros((0, 0))
    x = np.stack(some.to_numpy())
    x = x[np.linalg.norm(x, axis=1) > 0]
    if not len(x):
        return np.zeros((0, 0))
    chosen, near = [0], x @ x[0]
    while len(chosen) < min(cells, len(x)):
        k = int(np.argmin(near))
        if near[k] > 1 - 1e-12:
            break
        chosen.append(k)
        near = np.maximum(near, x @ x[k])
    c = x[chosen]
    for _ in range(3):  # a few steps towards the middle of their own
        own = np.argmax(x @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 0, sums / np.maximum(size, 1e-300), c)
    return c


def _angles(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(v @ c.T, -1, 1))


def in_cells(rows: DataFrame, c: np.ndarray, rings: int = RINGS) -> DataFrame:
    """The rows with cell, ring and ``lo``, the ring's inner angle; laid out by both."""
    kind = dict(rows.dtypes)["id"]
    shared = rows.sparkSession.sparkContext.broadcast(c)  # at most ``cells`` vectors

    def run(batches):
        import pandas as pd

        for pdf in batches:
            if not len(pdf):
                continue
            v = np.stack(pdf["v"].to_numpy())
            a = _angles(v, shared.value)
            cell = np.argmin(a, axis=1)
            ring = np.minimum((a[np.arange(len(v)), cell] / np.pi * 2 * rings).astype(int), 2 * rings - 1)
            yield pd.DataFrame({"id": pdf["id"], "cell": cell.astype("i4"), "ring": ring.astype("i4"), "lo": ring * np.pi / 2 / rings, "v": pdf["v"]})

    out = rows.mapInPandas(run, _ROWS.format(kind=kind))
    return out.repartition("cell", "ring", F.pmod(F.hash("id"), F.lit(8))).sortWithinPartitions("cell", "ring")


def _bounds(queries: DataFrame, c: np.ndarray, rings: int) -> DataFrame:
    """(query_id, cell, ring, most): an upper bound of the cosine with any row there."""
    kind = dict(queries.dtypes)["query_id"]
    shared = queries.sparkSession.sparkContext.broadcast(c)

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for a in range(0, len(pdf), 500):
                part = pdf.iloc[a : a + 500]
                angle = _angles(np.stack(part["v"].to_numpy()), shared.value)[:, :, None]
                lo = np.arange(2 * rings) * np.pi / 2 / rings
                hi = lo + np.pi / 2 / rings
                gap = np.maximum(0, np.maximum(angle - hi, lo - angle))
                most = np.cos(np.minimum(gap, np.pi)) + _SLACK
                n, cells, _ = most.shape
                yield pd.DataFrame({"query_id": np.repeat(part["query_id"].to_numpy(), cells * 2 * rings), "cell": np.tile(np.repeat(np.arange(cells, dtype="i4"), 2 * rings), n), "ring": np.tile(np.arange(2 * rings, dtype="i4"), n * cells), "most": most.ravel()})

    return queries.mapInPandas(run, f"query_id {kind}, cell int, ring int, most double")


def _scores(wanted: DataFrame, placed: DataFrame, sizes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query within the wanted rings, by task first. Rows and
    queries meet by ring and part of the ring (of about ``GROUP`` rows); products are whole matrices."""
    kinds = dict(placed.dtypes)["id"], dict(queries.dtypes)["query_id"]
    split = F.broadcast(sizes.select("cell", "ring", F.ceil(F.col("n") / GROUP).cast("int").alias("parts")))
    asked = wanted.join(split, ["cell", "ring"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts").join(queries, "query_id")
    held = placed.join(split, ["cell", "ring"]).withColumn("part", F.pmod(F.xxhash64("id", "v"), F.col("parts")).cast("int")).drop("parts")

    def run(key, rows, own):
        import pandas as pd

        if not len(rows) or not len(own):
            return pd.DataFrame({"query_id": [], "id": [], "sim": []})
        x, out = np.stack(rows["v"].to_numpy()), []
        ids = rows["id"].to_numpy()
        for a in range(0, len(own), 256):
            block = own.iloc[a : a + 256]
            s = np.round(np.stack(block["v"].to_numpy()) @ x.T, 9)
            for q, line in zip(block["query_id"], s, strict=True):
                first = np.lexsort((ids, -line))[:k] if len(line) <= 4 * k else _first(line, ids, k)
                out.append(pd.DataFrame({"query_id": q, "id": ids[first], "sim": line[first]}))
        return pd.concat(out)

    key = ["cell", "ring", "part"]
    met = held.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(run, f"query_id {kinds[1]}, id {kinds[0]}, sim double")
    order = Window.partitionBy("query_id").orderBy(F.col("sim").desc(), F.col("id").asc())
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _first(line: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    least = np.partition(line, len(line) - k)[len(line) - k]
    some = np.flatnonzero(line >= least)  # with all ties of the k-th
    return some[np.lexsort((ids[some], -line[some]))[:k]]


def nearest(rows: DataFrame, queries: DataFrame, k: int = 10, cells: int = CELLS, rings: int = RINGS) -> DataFrame:
    """query_id, id, sim (rounded to 9 places), rank: the k rows of the largest cosine.

    ``rows``: id and v, ``queries``: query_id and v, arrays of doubles of one width and
    length 1 (or 0, then every cosine is 0). Null vectors take no part; ties go to the
    smaller id; repeated rows count each. Exact for every query.
    """
    good = written(rows.where(F.col("v").isNotNull()).select("id", F.col("v").cast("array<double>").alias("v")), "vectors")
    asked = written(queries.where(F.col("v").isNotNull()).select("query_id", F.col("v").cast("array<double>").alias("v")), "queries")
    c = centres(good, cells)
    if not len(c):
        c = np.ones((1, len((good.first() or asked.first() or {"v": [0.0]})["v"])))
        c /= np.linalg.norm(c)
    placed = written(in_cells(good, c, rings), "placed")
    sizes = written(placed.groupBy("cell", "ring").agg(F.count(F.lit(1)).alias("n")), "sizes")  # at most cells x 2 rings rows
    bounds = written(_bounds(asked, c, rings).join(F.broadcast(sizes), ["cell", "ring"]), "bounds")
    order = Window.partitionBy("query_id").orderBy(F.col("most").desc(), "cell", "ring")
    # the first rings that hold k rows together
    ranked = bounds.withColumn("before", F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    first = written(ranked.where(F.col("before") < k).select("query_id", "cell", "ring"), "first")
    near = written(_scores(first, placed, sizes, asked, k).select("query_id", "id", "sim", "rank"), "near")
    kth = near.where(F.col("rank") == k).select("query_id", F.col("sim").alias("least"))
    more = bounds.join(kth, "query_id", "left").where(F.col("least").isNull() | (F.col("most") >= F.col("least"))).join(first, ["query_id", "cell", "ring"], "left_anti").select("query_id", "cell", "ring")
    both = near.select("query_id", "id", "sim").unionByName(_scores(more, placed, sizes, asked, k).select("query_id", "id", "sim"))
    final = Window.partitionBy("query_id").orderBy(F.col("sim").desc(), F.col("id").asc())
    return both.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
