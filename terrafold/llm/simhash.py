"""SimHash near-duplicates by covering locality-sensitive hashing.

A covering family for radius r has 2^(r+1) - 1 bit masks: bit i gets a vector
m(i) of r+1 bits, and mask v keeps the bits with <v, m(i)> = 1. The vectors of at
most r differing bits do not span r+1 dimensions, so some v is orthogonal to all
of them, and under that mask the two fingerprints are equal: no link is missed.

Only distinct fingerprints enter the tables. Within a bucket a spanning forest
of its links is kept, not all pairs; buckets over ``block`` fingerprints are
dealt in pairs of blocks, so that no task holds a whole one.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import alone, give_back, met_by, release, stage
from .components import components


def shingle_hashes(text: str, width: int = 4) -> np.ndarray:
    """XXH64 (seed 42) of each run of ``width`` words, lower-cased A to Z."""
    from xxhash import xxh64_intdigest as digest

    words = text.encode().lower().split()  # bytes: ASCII blanks and letters only
    if not words:
        return np.zeros(0, "<u8")
    whole = b" ".join(words)
    if len(words) <= width:
        return np.array([digest(whole, 42)], "<u8")
    sizes = np.fromiter(map(len, words), "i8", len(words))
    ends = np.cumsum(sizes + 1) - 1
    first, last = (ends - sizes)[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    return np.array([digest(whole[a:b], 42) for a, b in zip(first, last, strict=True)], "<u8")


def fingerprint(hashes: np.ndarray) -> int:
    """Bit k is set if it is in over half of the hashes; as a signed 64-bit."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, "i8")
    for a in range(0, len(hashes), 1 << 16):
        part = hashes[a : a + (1 << 16)]
        counts += np.unpackbits(part.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="i8")
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """doc_id and fp (signed 64-bit) of whole texts; null texts count as empty."""

    def run(batches):
        import pyarrow as pa

        alone("fingerprints")
        for batch in batches:
            found = [fingerprint(shingle_hashes(t.as_py(), width)) for t in batch.column("text")]  # one text at a time
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64())], ["doc_id", "fp"])
            del batch
        give_back()

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "doc_id long, fp long")


def covering_masks(radius: int) -> list[int]:
    """2^(radius+1) - 1 masks of 64 bits, as signed integers."""
    size = (1 << (radius + 1)) - 1
    out = []
    for v in range(1, size + 1):
        mask = sum(1 << i for i in range(64) if (v & (i % size + 1)).bit_count() & 1)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def _differing(x: np.ndarray, y) -> np.ndarray:
    return np.bitwise_count((x ^ y).view("u8"))  # of a signed number it counts the bits of the absolute value


def spanning_links(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join what is within the radius, directly or over others."""
    left, links = np.sort(fps), []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = _differing(left, x) <= radius
            if near.any():
                found = left[near]
                links += [(int(x), int(y)) for y in found]
                queue += list(found)
                left = left[~near]
    return links


def links(distinct: DataFrame, radius: int = 4, block: int = 2048) -> DataFrame:
    """Links (a, b) over distinct fingerprints ``fp`` whose closure is that of
    all pairs at ``radius`` or fewer differing bits."""
    masks = F.array(*[F.lit(m) for m in covering_masks(radius)])
    rows = distinct.select("fp", F.posexplode(masks).alias("tab", "mask")).select("fp", "tab", (F.col("fp").bitwiseAND(F.col("mask"))).alias("key"))
    full = rows.groupBy("tab", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.hash("fp", "tab"), F.col("blocks"))
    dealt = (
        rows.join(met_by(full), ["tab", "key"])
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("fp", F.xxhash64("tab", "key", F.least("own", "other"), F.greatest("own", "other")).alias("group"))
    )

    def link(batches):
        import pandas as pd

        held = None
        for pdf in batches:
            held = pdf if held is None else pd.concat([held, pdf])
            group = held["group"].to_numpy()
            cut = int(np.searchsorted(group, group[-1]))  # the last group may go on
            yield _linked(held["fp"].to_numpy()[:cut], group[:cut], radius)
            held = held.iloc[cut:]
        if held is not None:
            yield _linked(held["fp"].to_numpy(), held["group"].to_numpy(), radius)

    spread = dealt.repartition("group").sortWithinPartitions("group")
    return spread.mapInPandas(link, "a long, b long").distinct()


def _linked(fps: np.ndarray, group: np.ndarray, radius: int):
    """Links within each group of a sorted run of groups."""
    import pandas as pd

    found = [np.zeros((0, 2), "i8")]
    if len(fps):
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        sizes = np.diff(np.r_[starts, len(group)])
        size_of = np.repeat(sizes, sizes)
        for k in range(1, 9):  # small groups: all at once
            same = (group[k:] == group[:-k]) & (size_of[k:] <= 8) if len(fps) > k else np.zeros(0, bool)
            if not same.any():
                continue
            i = np.flatnonzero(same)
            i = i[_differing(fps[i], fps[i + k]) <= radius]
            found.append(np.stack([fps[i], fps[i + k]], 1))
        for s, n in zip(starts[sizes > 8], sizes[sizes > 8], strict=True):
            found.append(np.array(spanning_links(fps[s : s + n], radius), "i8").reshape(-1, 2))
    pairs = np.concatenate(found)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    return pd.DataFrame({"a": pairs.min(1), "b": pairs.max(1)}).drop_duplicates()


def simhash_groups(docs: DataFrame, radius: int = 4, width: int = 4) -> DataFrame:
    """One row a document: doc_id, fingerprint (hex), component_id.

    component_id is the smallest doc_id reachable over links. Rows without a
    doc_id stay; they link others, and their component has a null id if nobody
    in it has one. Repeated rows stay as they are; other columns are ignored.
    """
    made = stage(fingerprints(docs, width), "fingerprints")
    nodes = made.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    found = stage(links(nodes.select("fp"), radius), "links")
    labels = components(found)
    named = nodes.join(met_by(labels.withColumnRenamed("node", "fp")), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    named = stage(named, "classes")
    least = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    whole = named.join(met_by(least), "label").select("fp", "component_id")
    release(found)
    return made.join(met_by(whole), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
