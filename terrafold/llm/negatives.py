"""Hard negatives: rows of another label that score a little below an anchor's positives.

Scores are integer inner products. The anchors of a block are the nodes of a spanning
tree of least total distance. The root's scores with a group of candidates are
computed; going down the tree, a score differs from the parent's by at most the edge's
length times the candidate's norm, so an interval for every score comes without a
product. Only candidates whose interval meets the window that is asked for are
rescored, in integers. Windows: for positives, at or above the best so far; for
negatives, the given share of each positive's score, at or above the best so far.

Blocks of anchors meet groups of candidates as keys of a shuffle: both have a bounded
number of rows, and neither side is broadcast or collected.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import release, stage

ANCHORS, CANDIDATES, _PART = 1024, 8192, 2048  # rows of a block, of a group, and of a group's part that is scored at once
_EXACT = float(1 << 52)


def integer_rows(rows: DataFrame, scale: int = 256) -> DataFrame:
    """id, label, vec (packed 64-bit integers floor(scale * x)) of the rows that take part:
    with an id, a label, and finite components only."""
    x = F.col("vec").cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    good = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()).where(~bad)
    whole = good.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("vec"))

    def pack(batches):
        import pyarrow as pa

        for b in batches:
            lists = b.column(2)
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False).astype("<i8"), np.cumsum(np.r_[0, lists.value_lengths().to_numpy(zero_copy_only=False)]).astype("i8")
            packed = [flat[s:e].tobytes() for s, e in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(packed, pa.binary())], ["id", "label", "vec"])

    return whole.mapInArrow(pack, "id long, label long, vec binary")


def matrix(packed, width: int | None = None) -> np.ndarray:
    """Rows of packed integers; shorter ones end in zeros."""
    sizes = [len(p) // 8 for p in packed]
    width = max(sizes, default=0) if width is None else width
    if sizes and min(sizes) == width:
        return np.frombuffer(b"".join(packed), "<i8").reshape(len(packed), width)
    out = np.zeros((len(packed), width), "i8")
    for row, p in zip(out, packed, strict=True):
        row[: len(p) // 8] = np.frombuffer(p, "<i8")
    return out


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order in which nodes join a tree of least total distance (from the node nearest to
    the mean), each node's parent (-1 for the root) and the length of the edge to it."""
    x = points.astype("f8")
    n = len(x)
    order, parent, edge = np.zeros(n, "i4"), np.full(n, -1, "i4"), np.zeros(n)
    norms = (x * x).sum(1)
    now = int(np.argmin(((x - x.mean(0)) ** 2).sum(1))) if n else 0
    nearest, via, out = np.full(n, np.inf), np.full(n, -1, "i4"), np.ones(n, bool)
    for k in range(n):
        order[k], parent[now], edge[now] = now, via[now], nearest[now] if k else 0.0
        out[now] = False
        d = np.sqrt(np.maximum(norms + norms[now] - 2 * (x @ x[now]), 0))
        closer = out & (d < nearest)
        nearest[closer], via[closer] = d[closer], now
        now = int(np.argmin(np.where(out, nearest, np.inf)))
    # an edge's length again from the difference itself: the expanded form may round it down
    has = parent >= 0
    edge[has] = np.sqrt(((x[has] - x[parent[has]]) ** 2).sum(1))
    return order, parent, edge


class Group:
    """A part of the candidates, and intervals of their scores along the tree."""

    def __init__(self, vec: np.ndarray, anchors: np.ndarray):
        top = float(np.abs(vec).max(initial=0)) * float(np.abs(anchors).max(initial=0)) * max(vec.shape[1], 1)
        self.exact = top < _EXACT  # else products are summed as whole numbers
        if top >= 2.0**62:
            raise OverflowError("scores pass 64 bits")
        self.vec = vec.astype("f8") if self.exact else vec
        self.norm = np.sqrt((vec.astype("f8") ** 2).sum(1))
        self.slack = 1.0 + top * 1e-12

    def scores(self, anchor: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        own = self.vec if rows is None or 2 * len(rows) > len(self.vec) else self.vec[rows]
        found = own @ anchor.astype(own.dtype)
        if rows is not None and len(own) != len(rows):
            found = found[rows]
        return found if found.dtype == "i8" else np.rint(found).astype("i8")


def walk(group: Group, anchors: np.ndarray, parent: np.ndarray, edge: np.ndarray, wanted, take) -> int:
    """Down the tree: ``wanted(k, lo, hi)`` gives the candidates of node k whose interval
    meets its window, ``take(k, rows, scores)`` gets their scores. Nodes stand after
    their parents. Returns how many scores were computed."""
    left = np.bincount(parent[parent >= 0], minlength=len(parent))  # children that still need a node's intervals
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    computed = 0
    for k in range(len(anchors)):
        p = int(parent[k])
        if p < 0:
            s = group.scores(anchors[k])
            lo, hi = s.astype("f8"), s.astype("f8")
            rows = wanted(k, lo, hi)
            found = s[rows]
            computed += len(s)
        else:
            reach = edge[k] * group.norm * (1 + 1e-9) + group.slack
            lo, hi = bounds[p][0] - reach, bounds[p][1] + reach
            left[p] -= 1
            if not left[p]:
                del bounds[p]
            rows = wanted(k, lo, hi)
            found = group.scores(anchors[k], rows)
            lo[rows] = hi[rows] = found
            computed += len(rows)
        if left[k]:
            bounds[k] = lo, hi
        if len(rows):
            take(k, rows, found)
    return computed


def _first(ids: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
    """Places of the first rows: higher scores, then smaller ids."""
    return np.lexsort((ids, -scores))[:most]


def _pairs(rows: DataFrame, anchors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with a key for each pair of a block of anchors and a group of candidates."""
    n_blocks = max(1, -(-anchors.count() // ANCHORS))
    n_groups = max(1, -(-rows.count() // CANDIDATES))
    block = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_blocks)).cast("int")
    group = F.pmod(F.xxhash64("mark", F.lit(2)), F.lit(n_groups)).cast("int")

    def tree(key, pdf):
        order, parent, edge = spanning_tree(matrix(pdf["vec"].tolist()))
        place = np.empty(len(order), "i4")
        place[order] = np.arange(len(order))
        out = pdf.iloc[order].copy()
        out["place"], out["edge"] = np.arange(len(order)), edge[order]
        out["parent"] = np.where(parent[order] < 0, -1, place[parent[order]])
        return out[["block", "place", "parent", "edge", "id", "label", "vec"]]

    trees = stage(anchors.withColumn("block", block).groupBy("block").applyInPandas(tree, "block int, place int, parent int, edge double, id long, label long, vec binary"), "trees")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    return trees.withColumn("group", numbers(n_groups)), rows.withColumn("group", group).withColumn("block", numbers(n_blocks))


def _positives(most: int):
    def run(key, anchors, rows):
        import pandas as pd

        a = anchors.sort_values("place")
        ids, labels, parent, edge = (a[c].to_numpy() for c in ("id", "label", "parent", "edge"))
        if not len(a) or not len(rows):
            return pd.DataFrame({"anchor_id": [], "positive_id": [], "positive_score": []})
        va, vr = matrix(a["vec"].tolist()), matrix(rows["vec"].tolist())
        width = max(va.shape[1], vr.shape[1])
        va = matrix(a["vec"].tolist(), width)
        rid, rlabel = rows["id"].to_numpy(), rows["label"].to_numpy()
        best = [(np.zeros(0, "i8"), np.zeros(0, "i8"))] * len(a)
        for start in range(0, len(rows), _PART):
            part = slice(start, start + _PART)
            pid, plabel = rid[part], rlabel[part]
            group = Group(matrix(rows["vec"].iloc[part].tolist(), width), va)

            def wanted(k, lo, hi):
                own = (plabel == labels[k]) & (pid != ids[k])
                if len(best[k][0]) >= most:
                    own &= hi >= best[k][1][-1]
                return np.flatnonzero(own)

            def take(k, at, scores):
                i, s = np.r_[best[k][0], pid[at]], np.r_[best[k][1], scores]
                first = _first(i, s, most)
                best[k] = i[first], s[first]

            walk(group, va, parent, edge, wanted, take)
        return pd.DataFrame({"anchor_id": np.repeat(ids, [len(b[0]) for b in best]), "positive_id": np.concatenate([b[0] for b in best]), "positive_score": np.concatenate([b[1] for b in best])})

    return run


def _negatives(most: int, low: int, high: int):
    def run(key, anchors, rows):
        import pandas as pd

        columns = ["anchor_id", "positive_id", "place_of", "negative_id", "positive_score", "negative_score"]
        a = anchors.sort_values("place").reset_index(drop=True)
        if not len(a) or not len(rows):
            return pd.DataFrame({c: [] for c in columns})
        ids, labels, parent, edge = (a[c].to_numpy() for c in ("id", "label", "parent", "edge"))
        width = max(matrix(a["vec"].tolist()).shape[1], matrix(rows["vec"].tolist()).shape[1])
        va = matrix(a["vec"].tolist(), width)
        rid, rlabel = rows["id"].to_numpy(), rows["label"].to_numpy()
        # of each anchor's positives only their scores make windows: equal scores share one
        windows = [sorted({int(p["score"]) for p in x}) if x is not None else [] for x in a["positives"]]
        best = [{w: (np.zeros(0, "i8"), np.zeros(0, "i8")) for w in own} for own in windows]
        for start in range(0, len(rows), _PART):
            part = slice(start, start + _PART)
            pid, plabel = rid[part], rlabel[part]
            group = Group(matrix(rows["vec"].iloc[part].tolist(), width), va)

            def wanted(k, lo, hi):
                own = np.zeros(len(pid), bool)
                for w in windows[k]:
                    least = low * w / 100
                    if len(best[k][w][0]) >= most:
                        least = max(least, float(best[k][w][1][-1]))
                    own |= (hi >= least - group.slack) & (lo <= high * w / 100 + group.slack)
                return np.flatnonzero(own & (plabel != labels[k]))

            def take(k, at, scores):
                for w in windows[k]:
                    inside = (scores >= -(-low * w // 100)) & (scores <= high * w // 100)  # whole numbers: the products would pass 64 bits
                    i, s = np.r_[best[k][w][0], pid[at[inside]]], np.r_[best[k][w][1], scores[inside]]
                    first = _first(i, s, most)
                    best[k][w] = i[first], s[first]

            walk(group, va, parent, edge, wanted, take)
        out = [(ids[k], int(p["id"]), int(p["place_of"]), i, int(p["score"]), s) for k, x in enumerate(a["positives"]) if x is not None for p in x for i, s in zip(*best[k][int(p["score"])], strict=True)]
        return pd.DataFrame(out, columns=columns)

    return run


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` and ``anchors``: id, label, vec (an array of numbers); other columns are
    ignored. Rows take part if their id, label and vector are there and all components are
    finite numbers; shorter vectors end in zeros. Components become floor(256 x). A row is
    named by its id: rows of an anchor's own id are not others to it, repeated rows else
    count each, and of repeated anchors one is taken (the least by label and vector).
    Higher scores come first, ties by smaller id. Tables without rows, and anchors without
    positives or negatives within ``low`` to ``high`` per cent of a positive's score, give
    no rows. Scores beyond 64 bits raise an error.
    """
    own = stage(integer_rows(rows).withColumn("mark", F.monotonically_increasing_id()), "rows")
    asked = stage(integer_rows(anchors).groupBy("id").agg(F.min(F.struct("label", "vec")).alias("m")).select("id", "m.label", "m.vec"), "anchors")
    trees, cands = _pairs(own, asked)
    key = ["block", "group"]
    met = trees.groupBy(*key).cogroup(cands.groupBy(*key)).applyInPandas(_positives(positives), "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    first = met.withColumn("place_of", F.row_number().over(order)).where(F.col("place_of") <= positives)
    chosen = stage(first.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"), "place_of")).alias("positives")), "positives")
    known = stage(trees.drop("group").distinct().join(chosen, "id", "left"), "asked")
    n_groups = cands.agg(F.max("group")).first()[0]
    known = known.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(n_groups or 0))))
    found = known.groupBy(*key).cogroup(cands.groupBy(*key)).applyInPandas(_negatives(negatives, low, high), "anchor_id long, positive_id long, place_of int, negative_id long, positive_score long, negative_score long")
    ranked = Window.partitionBy("anchor_id", "place_of").orderBy(F.col("negative_score").desc(), "negative_id")
    out = stage(found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= negatives), "negatives")
    for old in (own, asked, chosen, known):
        release(old)
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score")
