"""K-d tree shards: splits at distributed weighted medians.

The units are groups of rows with equal texts, or single rows of a group that no
shard has room for. A node is split along its widest metadata dimension; the
median is found by narrowing: each pass sums the weights in 4,096 slices of the
interval left, for all nodes of a level at once, so the driver sees slices and
never units.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import add_local_numbers, partition_bases, release, stage

_SLICE = 12
_BITS = 63


def _pick(node: Column, by_node: dict[int, object], kind: str) -> Column:
    out = F.lit(None).cast(kind)
    for k, v in by_node.items():
        out = F.when(node == k, F.lit(v).cast(kind) if isinstance(v, int) else v).otherwise(out)
    return out


def kd_cuts(units: DataFrame, dims: list[str], weight: str, tie: str, targets: list[int]) -> Column:
    """The shard (from 0) of each unit as an expression over its columns.

    ``dims``: integers of 31 bits; ``tie``: integer of 32 bits that orders units
    alike in a dimension. Nodes halve their number of shards, and their weight as
    the ``targets`` of these say, until each has one.
    """
    shards = len(targets)
    total = units.agg(*[F.min(d).alias(f"lo_{d}") for d in dims], *[F.max(d).alias(f"hi_{d}") for d in dims]).first()
    if total[0] is None:
        return F.lit(0)
    whole = {d: max(1, total[f"hi_{d}"] - total[f"lo_{d}"]) for d in dims}
    cuts: dict[int, tuple[str, int]] = {}
    parts = {0: (0, shards)}  # of each leaf so far: its first shard and how many it holds

    def key_of(dim: str) -> Column:
        return F.shiftleft(F.col(dim).cast("long"), 32) + F.col(tie).cast("long")

    def place(k: int, names: dict[int, int]) -> Column:
        if k not in cuts:
            return F.lit(names[k])
        dim, cut = cuts[k]
        return F.when(key_of(dim) <= cut, place(2 * k + 1, names)).otherwise(place(2 * k + 2, names))

    while open_ := [k for k, (_, n) in parts.items() if n > 1]:
        at = units.withColumn("node", place(0, {k: k for k in parts})).where(F.col("node").isin(open_))
        spread = at.groupBy("node").agg(F.sum(weight).alias("w"), *[(F.max(d) - F.min(d)).alias(d) for d in dims]).collect()
        widest = {r["node"]: max(dims, key=lambda d: (r[d] / whole[d], d)) for r in spread}  # noqa: B023
        goal = {}
        for r in spread:
            first, n = parts[r["node"]]
            left, whole_node = sum(targets[first : first + n // 2]), sum(targets[first : first + n])
            goal[r["node"]] = int(r["w"]) * left / whole_node if whole_node else 0
        keyed = at.select("node", weight, _pick(F.col("node"), {k: key_of(d) for k, d in widest.items()}, "long").alias("key"))
        low, below, bits = dict.fromkeys(widest, 0), dict.fromkeys(widest, 0), _BITS
        while bits > 0:
            step = min(_SLICE, bits)
            bits -= step
            slice_ = F.shiftright(F.col("key") - _pick(F.col("node"), low, "long"), bits)
            rows = keyed.withColumn("slice", slice_).where((F.col("slice") >= 0) & (F.col("slice") < 1 << step)).groupBy("node", "slice").agg(F.sum(weight).alias("w")).collect()
            for k in widest:
                run, last = below[k], 0
                for r in sorted((r for r in rows if r["node"] == k), key=lambda r: r["slice"]):
                    last, run = r["slice"], run + int(r["w"])
                    if run >= goal[k]:
                        run -= int(r["w"])
                        # at the finest slice the key goes where it leaves the halves closer
                        if not bits and run + int(r["w"]) - goal[k] > goal[k] - run:
                            last -= 1
                        break
                low[k], below[k] = low[k] + (last << bits), run
        for k in open_:
            first, n = parts.pop(k)
            if k in widest:
                cuts[k] = (widest[k], low[k])
                parts |= {2 * k + 1: (first, n // 2), 2 * k + 2: (first + n // 2, n - n // 2)}
            else:  # no unit came here
                parts[k] = (first, 1)
    return place(0, {k: first for k, (first, _) in parts.items()})


def place_heavy(heavy: list, target: float, shards: int) -> tuple[list[tuple], list[tuple], list[float]]:
    """Whole groups, heaviest first, to the shard with the least of them so far, as
    long as it stays within the target; the groups that fit nowhere; and the loads."""
    loads, placed, split = [0.0] * shards, [], []
    for r in sorted(heavy, key=lambda r: (-r["w"], r["text_crc32"], r["size"])):
        k = min(range(shards), key=lambda k: (loads[k], k))
        if loads[k] + r["w"] > target:
            split.append((r["text_crc32"], r["size"]))
            continue
        loads[k] += r["w"]
        placed.append((r["text_crc32"], r["size"], k))
    return placed, split, loads


def kd_shards(docs: DataFrame, shards: int = 8, metadata: tuple[str, ...] = ("source", "lang"), heavy: float = 0.01) -> DataFrame:
    """Rows of ``docs`` (doc_id, text, metadata columns) in shards near equal in bytes.

    doc_id, size (UTF-8 bytes of the text plus 1; null: 1), text_crc32, law
    ('bytes'), shard, slot (gapless from 0), grown_shard (null). Rows with equal
    texts go to one shard. Groups of over ``heavy`` of a shard's target are placed
    before the tree is built, and its leaves get what is left of the target; only
    a group that no shard has room for is split, row by row. Metadata of a group is
    its least value; nulls and columns that are not there count as ''. An empty
    table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *[F.shiftright(F.crc32(F.coalesce(F.col(f"`{c}`").cast("string") if c in docs.columns else F.lit(""), F.lit("")).cast("binary")), 1).alias(f"m_{i}") for i, c in enumerate(metadata)],
    )
    rows = stage(rows, "shard-rows")
    dims, spark = [f"m_{i}" for i in range(len(metadata))], docs.sparkSession
    groups = rows.groupBy("text_crc32", "size").agg(F.sum("size").alias("w"), *[F.min(d).alias(d) for d in dims])
    groups = stage(groups, "shard-groups")
    target = (groups.agg(F.sum("w")).first()[0] or 0) / shards
    # at most shards / heavy groups can weigh so much: a proven bound for the driver and the broadcasts
    large = groups.where(F.col("w") > target * heavy)
    placed, split, loads = place_heavy(large.select("text_crc32", "size", "w").collect(), target, shards)
    placed = spark.createDataFrame(placed, "text_crc32 long, size long, shard int")
    split = spark.createDataFrame(split, "text_crc32 long, size long")
    key = ["text_crc32", "size"]
    sub = F.shiftright(F.xxhash64("doc_id"), 32).bitwiseAND(F.lit(0xFFFFFFFF))
    marked = rows.join(F.broadcast(split.withColumn("alone", F.lit(True))), key, "left").withColumn("sub", F.when(F.col("alone"), sub).otherwise(F.lit(-1)))
    light = groups.where(F.col("w") <= target * heavy).select(*key, F.lit(-1).cast("long").alias("sub"), "w", *dims)
    single = marked.where("alone").groupBy(*key, "sub").agg(F.sum("size").alias("w"), *[F.min(d).alias(d) for d in dims])
    units = light.unionByName(single).withColumn("tie", F.when(F.col("sub") >= 0, F.col("sub")).otherwise(F.col("text_crc32"))).withColumn("extent", (F.log2("size") * (1 << 26)).cast("long"))
    units = stage(units, "shard-units")
    shard = kd_cuts(units, [*dims, "extent"], "w", "tie", [max(0, round(target - x)) for x in loads])
    whole = units.select(*key, "sub", shard.cast("int").alias("shard")).unionByName(placed.select(*key, F.lit(-1).cast("long").alias("sub"), "shard"))
    joined = marked.join(whole, [*key, "sub"]).select("doc_id", "size", "text_crc32", "shard")
    numbered = stage(add_local_numbers(joined, "shard"), "shard-numbered")
    release(groups)
    bases = partition_bases(numbered, ["shard"])
    return numbered.join(bases, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("base") + F.col("local")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
