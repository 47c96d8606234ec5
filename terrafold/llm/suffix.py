"""Exact removal of long repeated byte strings by distributed suffix sorting.

The suffixes that are sorted begin at content-defined bases: the base of a
position p is the least-hashed 16-gram that starts in [p, p + 128) (128 follows
from 400 bytes). It depends on the bytes after p only, so equal 400-byte strings
have equal bases at equal distances. What lies between two bases is a letter, and
on the string of letters runs the difference-cover algorithm:

1. a base whose next 273 bytes (all strings with this base have them) occur once
   holds nothing and drops out;
2. suffixes at positions 1 and 2 modulo 3 are sorted by triples of letters and
   named by rank; names are sorted by triples again until each is unique or
   covers as many bytes as can matter;
3. the remaining suffixes (0 modulo 3) are merged: every pair of residues has a
   distance at which both are named, so for each pair the union is sorted by
   (letters up to there, name there);
4. adjacent suffixes are compared name by name. The bytes that two neighbours
   share are repeated; so is every string within them. The ends of the sorted
   partitions are compared in a pass of their own.

Left over are the edges of matches, where a string begins before its first base
or ends after its last: at most a few positions' worth of gaps a match. They are
cut into blocks of 16 positions at fixed distances from the base: a block whose
common core (in each of its strings) occurs once holds nothing, one whose whole
bytes occur twice is repeated, and only for the rest the strings are compared one
by one. Of strings that step 4 settled, the first of each run of equal suffixes
stands for all in these comparisons. Of equal texts one takes part, for all.

Bytes are held equal by 128-bit hashes (XXH3) of the whole string or block, and
by four independent 64-bit hashes of a triple's letters and bytes.

The same runs over words: a text is then an array of 64-bit word hashes, and all
lengths and positions count words.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_path, new_path

LENGTH = 400
_GRAM, _WORD_GRAM = 16, 4
_SEGMENT = 1 << 21
_BLOCK = 16
_BUCKET = 1_000_000
_PACKED = "rid long, i int, n int, base binary, lo binary, hi binary, letters binary, checks binary, spans binary, fixed binary"
_LEFT = "rid long, i int, base int, lo int, hi int, l0 long, l1 long, l2 long, check long, span int"
_MERGED = "rid long, i int, base int, pair int, k0 long, k1 long, k2 long, own int, names array<long>, ends array<int>"
_FOUND = "rid long, base int, shared int, before int, part int, side int, pair int, k0 long, k1 long, names array<long>, ends array<int>, own int"
_JUDGED = "rid long, key long, base int, lo int, hi int, times int"
_STRINGS = "rid long, p int, times int, h1 long, h2 long"
_BLOCKS = "rid long, lo int, hi int, times int, core long, w1 long, w2 long"


def _reach(length: int, gram: int) -> int:
    """Positions a base is the least of: a third of what leaves a gram in each string."""
    reach = (length - gram + 1) // 3
    if reach < 1 or length < _BLOCK:
        raise ValueError(f"strings of {length} are too short: {max(_BLOCK, gram + 2)} at least")
    return reach


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ x >> np.uint64(31)
    x = x * np.uint64(0x9FB21C651E98DF25)
    return x ^ x >> np.uint64(28)


class _Hash:
    """Polynomial hashes of any substring of a segment, modulo 2^64."""

    _powers: tuple[np.ndarray, np.ndarray] = (np.zeros(0, "u8"), np.zeros(0, "u8"))
    _odd = 0xA0761D6478BD642F
    _letters = _mixed(np.arange(1, 257, dtype="u8") * np.uint64(_odd))

    def __init__(self, data: np.ndarray):
        n, odd = len(data), self._odd
        if len(_Hash._powers[0]) < n + 1:
            size = max(n + 1, 1 << 16)
            with np.errstate(over="ignore"):
                up = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, odd, "u8")])
                down = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, pow(odd, -1, 1 << 64), "u8")])
            _Hash._powers = up, down
        up, self.down = _Hash._powers
        self.sums = np.zeros(n + 1, "u8")
        letters = self._letters[data] if data.dtype == np.uint8 else _mixed(data * np.uint64(odd))
        np.cumsum(letters * up[:n], out=self.sums[1:])

    def of(self, start, end) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.down[start] + np.asarray(end - start).astype("u8"))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word of a text, and the byte after its last."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))  # BLANKS, as words_of splits
    padded = np.r_[True, blank, True]
    edges = np.flatnonzero(padded[1:] != padded[:-1])
    return edges[::2], edges[1::2]


def word_codes(data: np.ndarray) -> np.ndarray:
    """XXH64 of each word."""
    from xxhash import xxh64_intdigest

    starts, ends = word_bounds(data)
    raw = data.tobytes()
    return np.fromiter((xxh64_intdigest(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), "u8", len(starts))


def _symbols(text: str, words: bool) -> np.ndarray:
    data = np.frombuffer(text.encode(), "u1")
    return word_codes(data) if words else data


def gaps(data: np.ndarray, length: int = LENGTH, gram: int = _GRAM, segment: int | None = None):
    """Runs of positions with one base, by segments: bases, first and last position
    of each, the bases that follow the segment (three at most), the place of the
    segment, the hashes of its bytes, and whether it is the last.

    Long texts are worked off in segments, so memory is bounded; a segment ends
    with a gap, so each base has one gap.
    """
    n, reach, a = len(data), _reach(length, gram), 0
    segment = max(segment or _SEGMENT, 2 * reach)  # a gap has ``reach`` positions at most
    while a < n - length + 1:
        part = data[a : a + segment + 2 * length]
        final = a + segment >= n - length + 1
        one = _Hash(part)
        grams = np.arange(len(part) - gram + 1)
        low = (one.of(grams, grams + gram) >> np.uint64(32) << np.uint64(32)) | grams.astype("u8")
        size = 1
        while size < reach:
            step = min(size, reach - size)
            low = np.minimum(low[:-step], low[step:])
            size += step
        base = (low & np.uint64(0xFFFFFFFF)).astype("i8")
        first = np.flatnonzero(np.r_[True, base[1:] != base[:-1]])
        bases = base[first]
        end = min(segment, n - length + 1 - a)
        count = int(np.searchsorted(first, end)) - (not final)  # the last gap may go on: it begins the next segment
        last = np.minimum(np.append(first[1:], len(base))[:count] - 1, end - 1)
        lo = first[:count]
        more = len(bases) if final else min(len(bases), count + 3)
        yield a + bases[:count], a + lo, a + last, a + bases[count:more], a, one, final
        a = n if final else a + int(first[count])


def letters(data: np.ndarray, length: int = LENGTH, gram: int = _GRAM, segment: int | None = None):
    """For each segment: number of its first base, bases, first and last position
    of their gaps (none: last before first), hashes of the letters from each base
    (and from the two after the last), of the three letters from it, their bytes,
    and hashes of the bytes that all strings of the base have.

    The start and the end of a text are bases without a gap, so that texts that
    agree from the first or to the last byte agree in letters, too.
    """
    from xxhash import xxh64_intdigest

    n, fixed, at = len(data), length - _reach(length, gram) + 1, 0
    for base, lo, hi, after, a, one, final in gaps(data, length, gram, segment):
        if final:  # what follows the last gap are bases as well, and so is the end
            more = after if len(after) and after[-1] == n - gram else np.append(after, n - gram)
            if not len(after) and len(base) and base[-1] == n - gram:
                more = after
            base, after = np.append(base, more), more[:0]
            lo, hi = np.append(lo, np.zeros(len(more), "i8")), np.append(hi, np.full(len(more), -1))
        if at == 0 and len(base) and base[0] > 0:
            base, lo, hi = np.r_[0, base], np.r_[0, lo], np.r_[-1, hi]
        every = np.append(base, after)
        k = np.arange(len(base))
        third = every[np.minimum(k + 3, len(every) - 1)] + gram
        raw, size = memoryview(data[a : int(every[-1]) + gram].tobytes()), data.itemsize
        cuts = ((every - a) * size).tolist()
        extra = gram * size
        found = [xxh64_intdigest(raw[x : y + extra]) for x, y in zip(cuts, cuts[1:], strict=False)][: len(base) + 2]
        found = np.array(found + [0] * (len(base) + 2 - len(found)), "u8").view("i8")
        stop = np.minimum(base + fixed, n)
        yield at, base, lo, hi, found, one.of(base - a, third - a).view("i8"), third - base, one.of(base - a, stop - a).view("i8")
        at += len(base)


def blocks(data: np.ndarray, base: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: int = LENGTH):
    """Blocks of gaps [lo, hi]: gap, first and last position, hash of the core, and
    two words of a hash of the whole bytes if the gap has the whole block (else 0)."""
    from xxhash import xxh3_128_digest

    low = (base - hi) // _BLOCK
    n = (base - lo) // _BLOCK - low + 1
    gap = np.repeat(np.arange(len(base)), n)
    k = np.arange(len(gap)) - np.repeat(np.cumsum(n) - n, n) + low[gap]
    last, first = base[gap] - k * _BLOCK, base[gap] - k * _BLOCK - _BLOCK + 1
    core, whole, size = np.zeros(len(gap), "i8"), np.zeros((len(gap), 2), "<i8"), data.itemsize
    full = (first >= lo[gap]) & (last <= hi[gap])
    order, a = np.argsort(last, kind="stable"), 0
    while a < len(order):  # bytes of a segment at a time
        start = max(0, int(first[order[a]]))
        b = int(np.searchsorted(last[order], last[order[a]] + _SEGMENT, "right"))
        own = order[a:b]
        part = data[start : int(last[own[-1]]) + length]
        core[own] = _Hash(part).of(last[own] - start, first[own] + length - start).view("i8")
        raw = memoryview(part.tobytes())
        own = own[full[own]]
        ends = zip(((first[own] - start) * size).tolist(), ((last[own] + length - start) * size).tolist(), strict=True)
        whole[own] = np.frombuffer(b"".join([xxh3_128_digest(raw[x:y]) for x, y in ends]), "<i8").reshape(-1, 2)
        a = b
    return gap, np.maximum(first, lo[gap]), np.minimum(last, hi[gap]), core, whole[:, 0], whole[:, 1]


def strings(data: np.ndarray, lo: int, hi: int, length: int = LENGTH) -> np.ndarray:
    """A hash of two words for each string that starts in [lo, hi]."""
    from xxhash import xxh3_128_digest

    size = data.itemsize
    raw = memoryview(data[lo : hi + length].tobytes())
    return np.frombuffer(b"".join([xxh3_128_digest(raw[x * size : (x + length) * size]) for x in range(hi - lo + 1)]), "<i8").reshape(-1, 2)


def _tables(spark):
    """Staged tables of one run, compressed; dropped when no longer read."""
    folder = new_path(spark, "suffixes")

    def stage(df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    def drop(*names: str) -> None:
        for name in names:
            drop_path(spark, f"{folder}/{name}")
        spark._jvm.System.gc()  # lets the context cleaner find shuffles that nothing reads any more

    return stage, drop


def _parsed(texts: DataFrame, length: int, words: bool) -> DataFrame:
    """The letters of each text, packed: one row a segment."""
    gram, segment = _WORD_GRAM if words else _GRAM, _SEGMENT
    _reach(length, gram)

    def parse(batches):
        import pandas as pd

        names = [f.split()[0] for f in _PACKED.split(", ")]
        kinds = ("<i4", "<i4", "<i4", "<i8", "<i8", "<i4", "<i8")
        for pdf in batches:
            out, held = [], 0
            for rid, text in zip(pdf["rid"], pdf["text"], strict=True):
                for at, *arrays in letters(_symbols(text, words), length, gram, segment):
                    out.append((rid, at, len(arrays[0]), *(x.astype(t).tobytes() for x, t in zip(arrays, kinds, strict=True))))
                    held += len(arrays[0])
                    if held > 100_000:
                        yield pd.DataFrame(out, columns=names)
                        out, held = [], 0
            if out:
                yield pd.DataFrame(out, columns=names)

    return texts.select("rid", "text").mapInPandas(parse, _PACKED)


def _grouped(rid: np.ndarray, i: np.ndarray):
    """rid and the packed numbers i of each."""
    import pandas as pd

    order = np.argsort(rid, kind="stable")
    rid, i = rid[order], i[order].astype("<i4")
    cuts = np.flatnonzero(np.r_[True, rid[1:] != rid[:-1]]) if len(rid) else np.zeros(0, "i8")
    return pd.DataFrame({"rid": rid[cuts], "i": [x.tobytes() for x in np.split(i, cuts[1:])] if len(rid) else []})


def repeated_bases(packed: DataFrame, stage) -> DataFrame:
    """rid and packed numbers of the bases whose fixed bytes occur more than once.

    Hashes are dealt into buckets, packed. A batch sends one entry for each of its
    distinct hashes, so a frequent one adds an entry a batch and not a row each;
    what occurs twice within a batch is known there.
    """
    spark = packed.sparkSession
    total = packed.agg(F.sum("n")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // _BUCKET))

    def deal(batches):
        import pandas as pd

        for pdf in batches:
            if not len(pdf):
                continue
            sizes = pdf["n"].to_numpy("i8")
            rid = np.repeat(pdf["rid"].to_numpy("i8"), sizes)
            i = np.arange(len(rid)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(pdf["i"].to_numpy("i8"), sizes)
            fixed = np.frombuffer(b"".join(pdf["fixed"]), "<u8")
            distinct, first, of, times = np.unique(fixed, return_index=True, return_inverse=True, return_counts=True)
            here = times[of] > 1
            bucket = (distinct % np.uint64(buckets)).astype("i8")
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            sent = np.where(times > 1, -1, rid[first])[order], i[first][order].astype("<i4"), distinct[order]
            out = [(b, *(x[cuts[b] : cuts[b + 1]].tobytes() for x in sent)) for b in range(buckets) if cuts[b + 1] > cuts[b]]
            out.append((-1, rid[here].tobytes(), i[here].astype("<i4").tobytes(), b""))
            yield pd.DataFrame(out, columns=["bucket", "rid", "i", "fixed"])

    def meet(pdf):
        rid, i, fixed = (np.frombuffer(b"".join(pdf[c]), t) for c, t in (("rid", "<i8"), ("i", "<i4"), ("fixed", "<u8")))
        _, of, times = np.unique(fixed, return_inverse=True, return_counts=True)
        found = (times[of] > 1) & (rid >= 0)
        return _grouped(rid[found], i[found])

    def known(batches):
        for pdf in batches:
            for rid, i in zip(pdf["rid"], pdf["i"], strict=True):
                yield _grouped(np.frombuffer(rid, "<i8"), np.frombuffer(i, "<i4"))

    dealt = stage(packed.select("rid", "i", "n", "fixed").mapInPandas(deal, "bucket int, rid binary, i binary, fixed binary"), "dealt")
    found = dealt.where("bucket >= 0").groupBy("bucket").applyInPandas(meet, "rid long, i binary")
    return found.unionByName(dealt.where("bucket < 0").mapInPandas(known, "rid long, i binary"))


def _unpacked(packed: DataFrame, repeated: DataFrame) -> DataFrame:
    """A row for each repeated base, with its letters."""
    by_rid = repeated.groupBy("rid").agg(F.collect_list("i").alias("own"))

    def unpack(batches):
        import pandas as pd

        for pdf in batches:
            for r in pdf.itertuples(index=False):
                i = np.sort(np.frombuffer(b"".join(r.own), "<i4"))
                k = i[np.searchsorted(i, r.i) : np.searchsorted(i, r.i + r.n)] - r.i
                if not len(k):
                    continue
                base, lo, hi, spans = (np.frombuffer(x, "<i4")[k] for x in (r.base, r.lo, r.hi, r.spans))
                letter = np.frombuffer(r.letters, "<i8")
                yield pd.DataFrame({"rid": r.rid, "i": k + r.i, "base": base, "lo": lo, "hi": hi, "l0": letter[k], "l1": letter[k + 1], "l2": letter[k + 2], "check": np.frombuffer(r.checks, "<i8")[k], "span": spans})

    def batched(batches):
        import pandas as pd

        held, n = [], 0
        for made in unpack(batches):
            held.append(made)
            n += len(made)
            if n > 20_000:
                yield pd.concat(held)
                held, n = [], 0
        if held:
            yield pd.concat(held)

    return packed.drop("fixed").join(by_rid, "rid").mapInPandas(batched, _LEFT)


def _named(rows: DataFrame, keys: list[str], stage, name: str) -> DataFrame:
    """The distinct keys in their sorted order, with how many rows have them, the
    first of these, and how many rows have smaller keys (``at``), by prefix sums
    over the sorted partitions."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("rid", "i")).alias("first"))
    distinct = stage(counts.select(*keys, "n", F.col("first.rid").alias("rid0"), F.col("first.i").alias("i0")), f"{name}-keys")
    kinds = ", ".join(f"{k} long" for k in keys)

    def number(batches):
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for pdf in batches:
            n = pdf["n"].to_numpy("i8")
            pdf["part"], pdf["local"] = part, at + np.cumsum(n) - n
            at += int(n.sum())
            yield pdf

    order = distinct.repartitionByRange(*keys).sortWithinPartitions(*keys)
    numbered = stage(order.mapInPandas(number, f"{kinds}, n long, rid0 long, i0 int, part int, local long"), f"{name}-ranks")
    sizes = numbered.groupBy("part").agg(F.sum("n").alias("m"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    bases = sizes.select("part", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("start"))
    return numbered.join(F.broadcast(bases), "part").select(*keys, "n", "rid0", "i0", (F.col("start") + F.col("local")).alias("at"))


def named_sample(left: DataFrame, enough: int, stage, drop) -> DataFrame:
    """The sampled suffixes (1 and 2 modulo 3) with ``name`` (of the triple of
    letters) and ``rank`` (of names of names, until unique or ``enough`` long), how
    many bytes that covers, how many suffixes have it and whether this is the first.

    A rank is one more than the number of suffixes with smaller ones. So a group of
    equal suffixes is refined within its own ranks, and groups that are unique or
    long enough are left alone.
    """
    triple, kept = ["l0", "l1", "l2", "check"], ["rid", "i", "base", "l0", "l1", "span", "name", "rank", "covers", "n", "first"]
    first = ((F.col("rid") == F.col("rid0")) & (F.col("i") == F.col("i0"))).alias("first")
    sample = left.where("i % 3 <> 0").drop("lo", "hi")
    rank = (F.col("at") + 1).alias("rank")
    now = sample.join(_named(sample, triple, stage, "names-3"), triple).select(*kept[:6], rank.alias("name"), rank, F.col("span").alias("covers"), "n", first)
    now = stage(now, "sample-3")
    drop("names-3-keys", "names-3-ranks")
    covered, few = 3, False
    while True:
        again = (F.col("n") > 1) & (F.col("covers") < enough)
        if few:  # what few suffixes need is looked up by place
            open_ = now.where(again)
            for k in (1, 2):
                later = now.select("rid", (F.col("i") - k * covered).alias("i"), F.struct("rank", "base", (F.col("base") + F.col("covers")).alias("end")).alias(f"next{k}"))
                open_ = open_.join(later, ["rid", "i"], "left")
        else:
            order = Window.partitionBy("rid", F.col("i") % 3).orderBy("i")
            open_ = now
            for k in (1, 2):
                later = F.lead(F.struct("i", "rank", "base", (F.col("base") + F.col("covers")).alias("end")), k * covered // 3).over(order)
                open_ = open_.withColumn(f"next{k}", F.when(later["i"] == F.col("i") + k * covered, later))
            open_ = open_.where(again)
        # what was left alone earlier, or ends where a base has dropped out, covers less and may not reach so far
        open_ = open_.withColumn("next1", F.when(F.col("base") + F.col("covers") >= F.col("next1.base"), F.col("next1")))
        open_ = open_.withColumn("next2", F.when(F.col("next1.end") >= F.col("next2.base"), F.col("next2")))
        reached = F.coalesce("next2.end", "next1.end", F.col("base") + F.col("covers")) - F.col("base")
        keyed = open_.select(*kept, F.col("rank").alias("k0"), F.coalesce("next1.rank", F.lit(0)).alias("k1"), F.coalesce("next2.rank", F.lit(0)).alias("k2"), reached.alias("reached"))
        keyed = stage(keyed, f"keyed-{covered}")
        if keyed.where("k1 > 0").isEmpty():
            return now
        keys = ["k0", "k1", "k2"]
        ranks = _named(keyed, keys, stage, f"names-{3 * covered}")
        starts = ranks.groupBy("k0").agg(F.min("at").alias("from"))
        ranks = ranks.join(starts, "k0").withColumn("rank", F.col("k0") + F.col("at") - F.col("from"))
        finer = keyed.drop("rank", "covers", "n", "first").join(ranks, keys).select(*kept[:7], "rank", F.col("reached").alias("covers"), "n", first)
        few = 3 * covered >= 27
        now = stage(finer.unionByName(now.where(~again)), f"sample-{3 * covered}")
        drop(f"sample-{covered}", f"keyed-{covered}", f"names-{3 * covered}-keys", f"names-{3 * covered}-ranks")
        covered *= 3


def _pairs(d: dict, length: int, enough: int):
    """Rows of whole texts, sorted by text and number, to the rows that are merged:
    each suffix with the names from where it and the other residue are named."""
    rid, i, base = d["rid"], d["i"].astype("i8"), d["base"].astype("i8")
    n = len(rid)
    key = np.cumsum(np.r_[0, rid[1:] != rid[:-1]]).astype("i8") << 32 | i

    def ahead(by: int) -> np.ndarray:
        at = np.minimum(np.searchsorted(key, key + by), n - 1)
        return np.where(key[at] == key + by, at, -1)

    named, third = d["rank"] > 0, ahead(3)
    settled = named & (d["n"] > 1) & (d["covers"] >= enough)
    again = settled & ~d["first"]
    after, back = ahead(1), ahead(-1)
    # a suffix 0 modulo 3 within a long match adds nothing to the one before it
    inner = ~named & (after >= 0) & (back >= 0)
    inner &= settled[back] & (base[back] + d["covers"][back] >= base[after] + length)
    asked = ~again & ~inner
    rest, two = i % 3, ahead(2)
    sources, targets, numbers = [], [], []
    for number, at, own in ((0, after, rest != 2), (1, two, rest != 1), (2, np.arange(n), rest != 0)):
        own = np.flatnonzero(own & asked & (at >= 0))
        own = own[named[at[own]]]
        sources.append(own)
        targets.append(at[own])
        numbers.append(np.full(len(own), number))
    source, target, number = np.concatenate(sources), np.concatenate(targets), np.concatenate(numbers)
    rows, now, t, found = np.arange(len(source)), target, 0, []
    while len(rows):
        end = base[now] + d["span"][now] - base[source[rows]]
        found.append((rows, d["name"][now], end))
        on = (base[now] - base[target[rows]] < enough) & (third[now] >= 0)
        rows, now = rows[on], third[now[on]]
        t += 1
    sizes = np.bincount(np.concatenate([r for r, _, _ in found]), minlength=len(source)) if found else np.zeros(0, "i8")
    cuts = np.r_[0, np.cumsum(sizes)]
    names, ends = np.zeros(cuts[-1], "i8"), np.zeros(cuts[-1], "i4")
    for t, (r, x, e) in enumerate(found):
        names[cuts[r] + t], ends[cuts[r] + t] = x, e
    rank, zero = d["rank"][target], np.zeros(len(source), "i8")
    keys = [np.select([number == 2], [rank], d["l0"][source]), np.select([number == 0, number == 1], [rank, d["l1"][source]], zero), np.where(number == 1, rank, 0)]
    own = np.where(settled[source] & (number == 2), d["covers"][source], 0)
    merged = rid[source], i[source], base[source], number, *keys, own
    same = np.flatnonzero(again)
    none = np.zeros(len(same), "i8")
    direct = rid[same], i[same], base[same], none - 1, none, none, none, d["covers"][same]
    return [np.r_[x, y] for x, y in zip(merged, direct, strict=True)], np.r_[cuts, np.full(len(same), cuts[-1])], names, ends


def _merged(left: DataFrame, sample: DataFrame, length: int, enough: int) -> DataFrame:
    """Suffixes to be sorted, for each pair of residues: the pair, the keys and the
    names from where both are named. Of suffixes that are equal as far as can
    matter the first goes on; the others are settled (pair -1, ``own`` bytes)."""
    rest = left.where("i % 3 = 0").select("rid", "i", "base", "l0", "l1", *[F.lit(0).cast(t).alias(c) for c, t in (("span", "int"), ("name", "long"), ("rank", "long"), ("covers", "int"), ("n", "long"))], F.lit(False).alias("first"))
    rows = sample.unionByName(rest).repartition("rid").sortWithinPartitions("rid", "i")

    def merge(batches):
        import pyarrow as pa

        names = [f.split()[0] for f in _MERGED.split(", ")]
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32())

        def made(d):
            columns, cuts, run, ends = _pairs(d, length, enough)
            cuts = pa.array(cuts.astype("i4"))
            lists = pa.ListArray.from_arrays(cuts, pa.array(run, pa.int64())), pa.ListArray.from_arrays(cuts, pa.array(ends, pa.int32()))
            return pa.RecordBatch.from_arrays([*[pa.array(x).cast(t) for x, t in zip(columns, kinds, strict=True)], *lists], names)

        held: list[dict] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append({c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names})
            # the last text may go on
            start = int(np.searchsorted(held[-1]["rid"], held[-1]["rid"][-1]))
            if start or len(held) > 1 and held[-2]["rid"][-1] != held[-1]["rid"][0]:
                rows = held[:-1] + [{c: x[:start] for c, x in held[-1].items()}]
                d = {c: np.concatenate([h[c] for h in rows]) for c in rows[0]}
                if len(d["rid"]):
                    yield made(d)
                held = [{c: x[start:] for c, x in held[-1].items()}]
        if held:
            yield made({c: np.concatenate([h[c] for h in held]) for c in held[0]})

    return rows.mapInArrow(merge, _MERGED)


def _common(names: np.ndarray, starts: np.ndarray, sizes: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """How many names each row shares with the row before, from the first on."""
    out, t = np.zeros(len(starts), "i8"), 0
    at = np.flatnonzero(alive)
    while len(at):
        at = at[(sizes[at] > t) & (sizes[at - 1] > t)]
        at = at[names[starts[at] + t] == names[starts[at - 1] + t]]
        t += 1
        out[at] = t
    return out


def adjacent(rows: DataFrame, length: int) -> DataFrame:
    """Sorts the merged suffixes and compares neighbours: rid, base, shared (bytes
    from the base that the nearer neighbour, or an equal suffix, has too), before
    (those that the neighbour before has). Rows with ``side`` are the ends of
    partitions."""

    def compare(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, held = TaskContext.get().partitionId(), None
        long, short = pa.int64(), pa.int32()
        kinds = dict(zip([f.split()[0] for f in _FOUND.split(", ")], (long, short, short, short, short, short, short, long, long, pa.list_(long), pa.list_(short), short), strict=True))

        def rows_of(n, **columns):
            arrays = [pa.array(columns[c]).cast(t) if c in columns else pa.nulls(n, t) for c, t in kinds.items()]
            return pa.RecordBatch.from_arrays(arrays, list(kinds))

        def edge(side, row, before):
            rid, base, pair, k0, k1, own, names, ends = row
            return rows_of(1, rid=[rid], base=[base], shared=[0], before=[before], part=[part], side=[side], pair=[pair], k0=[k0], k1=[k1], names=[names.tolist()], ends=[ends.tolist()], own=[own])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("rid", "base", "pair", "k0", "k1", "own")]
            sizes = batch.column("names").value_lengths().to_numpy(zero_copy_only=False).astype("i8")
            names, ends = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("names", "ends"))
            if held is not None:
                columns = [np.r_[x, y] for x, y in zip(held[:6], columns, strict=True)]
                sizes, names, ends = np.r_[len(held[6]), sizes], np.r_[held[6], names], np.r_[held[7], ends]
            rid, base, pair, k0, k1, own = columns
            starts = np.cumsum(sizes) - sizes
            same = np.r_[False, (pair[1:] == pair[:-1]) & ((pair[1:] == 2) | (k0[1:] == k0[:-1])) & ((pair[1:] != 1) | (k1[1:] == k1[:-1]))]
            t = _common(names, starts, sizes, same)
            before = np.where(t > 0, ends[np.maximum(starts + t - 1, 0)], 0)
            if held is not None:
                before[0] = held[8]
            else:
                yield edge(0, (*(x[0] for x in columns), names[: sizes[0]], ends[: sizes[0]]), 0)
            shared = np.maximum(np.maximum(before[:-1], before[1:]), own[:-1])
            good = shared >= length
            if good.any():
                yield rows_of(int(good.sum()), rid=rid[:-1][good], base=base[:-1][good], shared=shared[good], before=before[:-1][good])
            last = slice(starts[-1], starts[-1] + sizes[-1])
            held = *(x[-1:] for x in columns), names[last], ends[last], int(before[-1])
        if held is not None:
            shared = max(held[8], int(held[5][0]))
            if shared >= length:
                yield rows_of(1, rid=held[0], base=held[1], shared=[shared], before=[held[8]])
            yield edge(1, (*(x[0] for x in held[:6]), held[6], held[7]), held[8])

    keys = ["pair", "k0", "k1", "k2", "rid", "i"]
    spread = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return spread.select("rid", "base", "pair", "k0", "k1", "own", "names", "ends").mapInArrow(compare, _FOUND)


def _across(found: DataFrame) -> DataFrame:
    """What the last suffix of a partition and the first of the next share."""
    order = Window.orderBy("part", "side")  # two rows a partition
    kept = ["rid", "base", "before", "part", "pair", "k0", "k1", "names", "ends"]
    ends = found.where("side is not null").select("side", *kept).withColumn("prev", F.lag(F.struct(*kept)).over(order)).where("side = 0 and prev is not null")
    same = (F.col("pair") == F.col("prev.pair")) & ((F.col("pair") == 2) | (F.col("k0") == F.col("prev.k0"))) & ((F.col("pair") != 1) | (F.col("k1") == F.col("prev.k1")))
    zipped = F.arrays_zip(F.col("names").alias("a"), F.col("prev.names").alias("b"), F.col("ends").alias("e"))
    start = F.struct(F.lit(True).alias("on"), F.lit(0).alias("e"))
    def step(s, x):
        return F.when(s["on"] & x["a"].eqNullSafe(x["b"]), F.struct(F.lit(True).alias("on"), x["e"].alias("e"))).otherwise(F.struct(F.lit(False).alias("on"), s["e"].alias("e")))

    shared = F.aggregate(zipped, start, step, lambda s: s["e"])
    met = ends.where(same).withColumn("shared", shared)
    # the last one stands for what it shares with the next as well
    last = met.select(F.col("prev.rid").alias("rid"), F.col("prev.base").alias("base"), "shared", F.col("prev.before").alias("before"))
    return last.unionByName(met.select("rid", "base", "shared", F.col("shared").alias("before")))


def _lists(batch, column: str, fields: tuple[str, ...]):
    """Fields of a column of lists of structs, with the cuts between its rows."""
    lists = batch.column(column)
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype("i8")
    flat = lists.flatten()
    return np.r_[0, np.cumsum(sizes)], [flat.field(f).to_numpy(zero_copy_only=False).astype("i8") for f in fields]


def _union(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs under [lo, hi), sorted."""
    if not len(lo):
        return lo, hi
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    fresh = np.r_[True, lo[1:] > hi[:-1]]
    return lo[fresh], hi[np.r_[np.flatnonzero(fresh)[1:] - 1, len(hi) - 1]]


def _within(lo: np.ndarray, hi: np.ndarray, first: np.ndarray, end: np.ndarray):
    """The parts of sorted gaps [lo, hi] under sorted runs [first, end): gap, first and last position."""
    a, b = np.searchsorted(hi, first), np.searchsorted(lo, end)
    n = np.maximum(b - a, 0)
    run = np.repeat(np.arange(len(first)), n)
    gap = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n) + a[run]
    return gap, np.maximum(lo[gap], first[run]), np.minimum(hi[gap], end[run] - 1)


def _batches(schema: str):
    """Puts arrays together to a batch of the schema."""
    names = [f.split()[0] for f in schema.split(", ")]

    def made(rows):
        import pyarrow as pa

        kinds = [pa.int64() if f.endswith("long") else pa.int32() for f in schema.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([r[c] for r in rows])).cast(t) for c, t in enumerate(kinds)], names)

    return made


def _judge(length: int):
    """For each text: what neighbours settled (times 0), the parts of gaps that are
    open (1), and those with the strings that stand for settled ones (2)."""
    made = _batches(_JUDGED)

    def run(batches):
        for batch in batches:
            cuts, gap = _lists(batch, "gaps", ("base", "lo", "hi", "key"))
            marks, near = _lists(batch, "near", ("base", "shared", "before"))
            rids, copied, out, held = batch.column("rid").to_numpy(), batch.column("copied").to_pylist(), [], 0
            for k in range(batch.num_rows):
                base, lo, hi, key = (x[cuts[k] : cuts[k + 1]] for x in gap)
                order = np.argsort(lo, kind="stable")
                base, lo, hi, key = base[order], lo[order], hi[order], key[order]
                at, shared, before = (x[marks[k] : marks[k + 1]] for x in near)
                end = at + shared - length + 1
                first, last = _union(at, end)
                none = np.zeros(len(first), "i8")
                rows = [(np.full(len(first), rids[k]), none, none, first, last - 1, none)]
                begin = np.maximum(at, at + before - length + 1)
                stand = begin < end
                size = int(hi[-1]) + 1 if len(hi) else 0
                opened = np.r_[0, last], np.r_[first, max(size, int(last[-1]) if len(last) else 0)]
                stands = _union(begin[stand], end[stand])
                if copied[k]:  # removed anyway: all its strings stand for those of other texts
                    opened, stands = (last[:0], last[:0]), (np.array([0]), np.array([size]))
                for times, (x, y) in ((1, opened), (2, stands)):
                    own, p, q = _within(lo, hi, x, y)
                    good = p <= q
                    own = own[good]
                    rows.append((np.full(len(own), rids[k]), key[own], base[own], p[good], q[good], np.full(len(own), times)))
                out += rows
                held += sum(len(r[0]) for r in rows)
                if held > 50_000:
                    yield made(out)
                    out, held = [], 0
            if out:
                yield made(out)

    return run


def _cut_up(length: int, words: bool):
    """The blocks of the gaps of each text."""
    made = _batches(_BLOCKS)

    def run(batches):
        for batch in batches:
            cuts, (base, lo, hi, times) = _lists(batch, "ranges", ("base", "lo", "hi", "times"))
            rids, out, held = batch.column("rid").to_numpy(), [], 0
            for k in range(batch.num_rows):
                own = slice(cuts[k], cuts[k + 1])
                of, a, b, core, w1, w2 = blocks(_symbols(batch.column("text")[k].as_py(), words), base[own], lo[own], hi[own], length)
                out.append((np.full(len(of), rids[k]), a, b, times[own][of], core, w1, w2))
                held += len(of)
                if held > 50_000:
                    yield made(out)
                    out, held = [], 0
            if out:
                yield made(out)

    return run


def _compared(length: int, words: bool):
    """Two words of the hash of every string of the blocks that are still open."""

    made = _batches(_STRINGS)

    def run(batches):
        for batch in batches:
            cuts, (lo, hi, times) = _lists(batch, "ranges", ("lo", "hi", "times"))
            rids, out, held = batch.column("rid").to_numpy(), [], 0
            for k in range(batch.num_rows):
                data = _symbols(batch.column("text")[k].as_py(), words)
                for j in range(cuts[k], cuts[k + 1]):
                    found = strings(data, int(lo[j]), int(hi[j]), length)
                    out.append((np.full(len(found), rids[k]), np.arange(lo[j], hi[j] + 1), np.full(len(found), times[j]), found[:, 0], found[:, 1]))
                    held += len(found)
                if held > 50_000:
                    yield made(out)
                    out, held = [], 0
            if out:
                yield made(out)

    return run


def repeated_spans(texts: DataFrame, length: int, stage, drop, words: bool = False) -> DataFrame:
    """rid, lo, hi: first positions of strings of ``length`` bytes (or words)
    that start anywhere else too, as ranges. ``texts``: rid (unique), text, and
    whether it is ``copied`` (one of equal texts, and removed anyway)."""
    reach = _reach(length, _WORD_GRAM if words else _GRAM)
    enough = length + 3 * reach
    packed = stage(_parsed(texts, length, words), "packed")
    left = stage(_unpacked(packed, repeated_bases(packed, stage)), "left")
    drop("packed", "dealt")
    merged = stage(_merged(left, named_sample(left, enough, stage, drop), length, enough), "merged")
    found = stage(adjacent(merged.where("pair >= 0"), length), "adjacent")
    near = found.where("side is null").select("rid", "base", "shared", "before").unionByName(_across(found).where(F.col("shared") >= length))
    near = near.unionByName(merged.where("pair < 0").select("rid", "base", F.col("own").alias("shared"), F.col("own").alias("before")))
    near = near.groupBy("rid").agg(F.collect_list(F.struct("base", "shared", "before")).alias("near"))
    # two letters from the base lie in every string that has it
    key = F.xxhash64("l0", "l1")
    gaps_of = left.where("lo <= hi").groupBy("rid").agg(F.collect_list(F.struct("base", "lo", "hi", key.alias("key"))).alias("gaps"))
    given = gaps_of.join(near, "rid", "left").join(texts.select("rid", "copied"), "rid")
    judged = stage(given.mapInArrow(_judge(length), _JUDGED), "judged")
    drop("left", "adjacent", "merged")
    # of what repeats, only what concerns an open gap goes on
    open_ = judged.where("times = 1")
    concerned = open_.unionByName(judged.where("times = 2").join(open_.select("key").distinct(), "key", "left_semi").select(*open_.columns))
    ranges = concerned.groupBy("rid").agg(F.collect_list(F.struct("base", "lo", "hi", "times")).alias("ranges"))
    cut = stage(texts.select("rid", "text").join(ranges, "rid").mapInArrow(_cut_up(length, words), _BLOCKS), "blocks")
    cores = cut.groupBy("core").agg(F.sum("times").alias("n"), F.min("times").alias("least")).where("n > 1 and least = 1").select("core")
    # blocks that are not whole have no hash, and no part in the join by it
    whole = cut.where("w1 <> 0 or w2 <> 0")
    wholes = whole.groupBy("w1", "w2").agg(F.sum("times").alias("n"), F.min("times").alias("least")).where("n > 1 and least = 1").select("w1", "w2", F.lit(True).alias("again"))
    kept = ["rid", "lo", "hi", "times", "core"]
    alive = whole.join(wholes, ["w1", "w2"], "left").select(*kept, F.coalesce("again", F.lit(False)).alias("again")).unionByName(cut.where("w1 = 0 and w2 = 0").select(*kept, F.lit(False).alias("again")))
    alive = stage(alive.join(cores, "core", "left_semi").select(*kept, "again"), "alive")
    # a block repeated as a whole is settled, yet its strings may meet those of an open block with the same core
    still = alive.where("times = 1 and not again").select("core").distinct()
    single = alive.join(still, "core", "left_semi").groupBy("rid").agg(F.collect_list(F.struct("lo", "hi", F.when(F.col("again"), 2).otherwise(F.col("times")).alias("times"))).alias("ranges"))
    single = stage(texts.select("rid", "text").join(single, "rid").mapInArrow(_compared(length, words), _STRINGS), "strings")
    again = single.groupBy("h1", "h2").agg(F.sum("times").alias("n"), F.min("times").alias("least")).where("n > 1 and least = 1").select("h1", "h2")
    points = single.where("times = 1").join(again, ["h1", "h2"], "left_semi").select("rid", F.col("p").alias("lo"), F.col("p").alias("hi"))
    settled = alive.where("times = 1 and again").select("rid", "lo", "hi")
    spans = stage(judged.where("times = 0").select("rid", "lo", "hi").unionByName(settled).unionByName(points), "spans")
    drop("judged", "blocks", "strings", "alive")
    return spans


def _cut(docs: DataFrame, length: int, words: int | None) -> DataFrame:
    """``row`` (all columns of ``docs``), what is left of its text, and figures."""
    stage, drop = _tables(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    texts = stage(docs.select(F.monotonically_increasing_id().alias("rid"), F.unhex(F.sha2(text, 256)).alias("digest"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), "texts")
    # of equal texts one goes on
    copies = texts.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("rid").alias("one")).where("n > 1")
    copies = stage(texts.select("rid", "digest").join(copies, "digest").select("rid", (F.col("rid") == F.col("one")).alias("one")), "copies")
    keyed = texts.join(copies, "rid", "left").where("one is null or one").select("rid", F.coalesce("row.text", F.lit("")).alias("text"), F.col("one").isNotNull().alias("copied"))
    spans = repeated_spans(keyed, length, stage, drop).select("rid", "lo", "hi", F.lit(False).alias("of_words"))
    if words:
        spans = spans.unionByName(repeated_spans(keyed, words, *_tables(docs.sparkSession), words=True).select("rid", "lo", "hi", F.lit(True).alias("of_words")))
    ranges = spans.groupBy("rid").agg(F.collect_list(F.struct("lo", "hi", "of_words")).alias("ranges"))
    made = ["kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def cut(batches):
        import pyarrow as pa

        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        for batch in batches:
            out, spans = [], batch.column("ranges")
            for k, (text, copied) in enumerate(zip(batch.column("row").field("text").to_pylist(), batch.column("copied").to_pylist(), strict=True)):
                raw = (text or "").encode()
                own, first = spans[k], np.zeros(0, "i8")
                if copied:  # long enough, all of it occurs twice
                    starts, ends = word_bounds(np.frombuffer(raw, "u1"))
                    if len(raw) >= length:
                        first, end = np.array([0]), np.array([len(raw)])
                    elif words and len(starts) >= words:
                        first, end = starts[:1], ends[-1:]
                elif own.is_valid and len(own):
                    lo, hi, of_words = (own.values.field(f).to_numpy(zero_copy_only=False) for f in ("lo", "hi", "of_words"))
                    first, end = lo[~of_words], hi[~of_words] + length
                    if of_words.any():
                        starts, ends = word_bounds(np.frombuffer(raw, "u1"))
                        first, end = np.r_[first, starts[lo[of_words]]], np.r_[end, ends[hi[of_words] + words - 1]]
                if not len(first):
                    out.append((text, len(raw), 0, 0, hashlib.sha256(raw).hexdigest()))
                    continue
                lo, hi = _union(first, end)
                kept = b"".join(raw[a:b] for a, b in zip(np.r_[0, hi], np.r_[lo, len(raw)], strict=True))
                out.append((kept.decode(errors="ignore"), len(raw), len(raw) - len(kept), len(lo), hashlib.sha256(kept).hexdigest()))
            new = zip(*out, strict=True) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([batch.column("row"), *[pa.array(list(x), t) for x, t in zip(new, kinds, strict=True)]], ["row", *made])

    schema = T.StructType([texts.schema["row"], *[T.StructField(c, T.StringType() if c in ("kept", "kept_sha256") else T.LongType()) for c in made]])
    marks = ranges.join(copies.select("rid", F.lit(True).alias("copied")), "rid", "full")
    return texts.join(marks, "rid", "left").select("row", "ranges", F.coalesce("copied", F.lit(False)).alias("copied")).mapInArrow(cut, schema)


def remove_repeats(docs: DataFrame, length: int = LENGTH, words: int | None = None) -> DataFrame:
    """``docs`` without the bytes under strings of ``length`` that occur twice,
    and, if ``words`` is given, under runs of so many words that do.

    All columns of ``docs`` with ``text`` replaced by what is left (characters
    that were cut through are dropped), then n_bytes, n_removed, n_spans and
    kept_sha256 of the remaining bytes. Matches lie within one document; a null
    text is empty and stays null; repeated rows repeat each other's bytes, so
    long ones lose them all. Empty in, empty out. New columns replace any of
    the same name; ``without_repeats`` has none.
    """
    made = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    own = [F.col("kept").alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in made]
    return _cut(docs, length, words).select(*own, *made)


def without_repeats(docs: DataFrame, length: int = LENGTH, words: int | None = None) -> DataFrame:
    """Exactly the columns of ``docs``, with ``text`` cut as ``remove_repeats``
    does, and ``n_chars``, if there is one, counted anew where text was cut."""
    kinds = {f.name: f.dataType for f in docs.schema}

    def column(c: str):
        if c == "text":
            return F.col("kept").alias(c)
        if c == "n_chars":
            return F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col("row.n_chars")).cast(kinds[c]).alias(c)
        return F.col(f"row.`{c}`").alias(c)

    return _cut(docs, length, words).select(*[column(c) for c in docs.columns])
