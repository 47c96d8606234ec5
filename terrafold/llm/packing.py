"""Packing documents into fixed-length sequences by minimum bin slack.

A bin is filled by a subset-sum dynamic program over the lengths still
available: reachable sums are the bits of one integer, and the fullest reachable
one is taken out. Bins depend on how many pieces each length has, never on the
pieces themselves, so the plan is made from a table of at most ``capacity``
counts; a combination is repeated as long as its lengths last. Pieces then find
their places by their rank within their length, which comes from prefix sums
over the writing tasks.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partition_bases, stage
from .encoder import _MOST, default_path, encoder

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local long"


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths with the largest sum not over the capacity.

    The longest length left is always in it, so that long pieces go first; of
    equally full combinations the one with longer pieces is found first.
    """
    lengths = sorted((n for n in counts if counts[n] > 0 and n <= capacity), reverse=True)
    if not lengths:
        return {}
    first = lengths[0]
    room = capacity - first
    every, reach = (1 << (room + 1)) - 1, 1
    steps = []
    for n in lengths:
        if n > room:
            continue
        left, size = min(counts[n] - (n == first), room // n), 1
        while left > 0:
            take = min(size, left)
            grown = (reach | reach << (take * n)) & every
            if grown != reach:
                steps.append((n, take, reach))
                reach = grown
            left -= take
            size *= 2
        if reach >> room & 1:
            break
    chosen, at = {first: 1}, reach.bit_length() - 1
    for n, take, before in reversed(steps):
        if not before >> at & 1:
            chosen[n] = chosen.get(n, 0) + take
            at -= n * take
    return chosen


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Combinations and how often each is used; every length is used up."""
    left, plan = {n: c for n, c in counts.items() if c > 0}, []
    while left:
        chosen = fullest(left, capacity)
        times = min(left[n] // k for n, k in chosen.items())
        plan.append((chosen, times))
        for n, k in chosen.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return plan


def _places(plan: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """Runs of ranks: which bins and offsets the pieces of a length go to."""
    used: dict[int, int] = {}
    rows, bins = [], 0
    for chosen, times in plan:
        offset = 0
        for n, k in sorted(chosen.items(), reverse=True):
            rows.append((n, used.get(n, 0), bins, k, offset))
            used[n] = used.get(n, 0) + k * times
            offset += n * k
        bins += times
    rows.sort()
    table = np.array(rows, "i8").reshape(-1, 5)
    return {"length": table[:, 0], "rank": table[:, 1], "bin": table[:, 2], "mult": table[:, 3], "offset": table[:, 4]}


def pieces(docs: DataFrame, capacity: int = 2048, tokenizer_path: str | None = None, end_id: int = 0, cached: int = _MOST) -> DataFrame:
    """Encode whole texts, add the end id, cut only what exceeds the capacity.

    A null text is empty and gives one piece with the end id alone.
    """
    path = tokenizer_path or default_path("word_bpe_49k.json")

    def cut(batches):
        import pandas as pd
        from pyspark import TaskContext

        part, seen, enc = TaskContext.get().partitionId(), {}, encoder(path, "words", cached)
        end = np.array([end_id], "<u4").tobytes()
        for pdf in batches:
            out = []
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                ids = np.frombuffer(enc.ids(text), "<u2").astype("<u4").tobytes() + end
                for k, a in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[a : a + 4 * capacity]
                    n = len(own) // 4
                    out.append((doc, k, a // 4, n, zlib.crc32(own), part, seen.get(n, 0)))
                    seen[n] = seen.get(n, 0) + 1
            made = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32", "part", "local"])
            yield made.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInPandas(cut, _PIECES)


def pack(docs: DataFrame, capacity: int = 2048, tokenizer_path: str | None = None, cached: int = _MOST) -> DataFrame:
    """Sequences for all documents: one row a piece with its sequence and place.

    doc_id, piece, start, length, ids_crc32, sequence_id, offset, and the
    sequence's fill. Rows with equal ids are packed each on its own; an empty
    table gives an empty result; other columns are ignored. ``cached``: units whose
    ids a worker holds; fewer take less memory and more time.
    """
    made = stage(pieces(docs, capacity, tokenizer_path, cached=cached), "pieces")
    # one count for each length, at most `capacity` rows whatever the input
    counts = {int(r["length"]): int(r["n"]) for r in made.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = plan_bins(counts, capacity)
    at = _places(plan)
    fill = np.array([sum(n * k for n, k in c.items()) for c, _ in plan], "i8")
    first_bin = np.concatenate([[0], np.cumsum([t for _, t in plan])])[:-1].astype("i8") if plan else np.zeros(0, "i8")
    key = at["length"] << 44 | at["rank"]

    def place(batches):
        for pdf in batches:
            n, rank = pdf["length"].to_numpy("i8"), (pdf["base"] + pdf["local"]).to_numpy("i8")
            run = np.searchsorted(key, n << 44 | rank, "right") - 1
            k, since = at["mult"][run], rank - at["rank"][run]
            pdf["sequence_id"] = at["bin"][run] + since // k
            pdf["offset"] = at["offset"][run] + since % k * n
            pdf["sequence_fill"] = fill[np.searchsorted(first_bin, at["bin"][run], "right") - 1]
            yield pdf[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "sequence_fill"]]

    bases = partition_bases(made, ["length"])
    joined = made.join(bases, ["length", "part"])
    return joined.mapInPandas(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, sequence_fill long")
