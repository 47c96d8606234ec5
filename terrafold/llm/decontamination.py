"""Benchmark decontamination by template windows.

Numbers, names and units become typed placeholders, so that a question with
other parameters has the same template. Windows of eight template words of the
documents are hash-joined to those of the benchmark. Along a passage the placeholders
must be filled consistently, judged from the item to the document: of all places at
least half hold what their item's value mostly becomes. So two values that become one,
or equal values of which one is edited, are still found; a passage whose fills follow
no rule is not. Whether the fills map one to one is reported. A document is reported
with an item if matched windows cover at least half of the item's.

An item without a window of four literal words has no template to speak of: its words
themselves, numbers and names included, are compared, in windows of eight; an item of
under four words only with whole documents.

Documents send only windows whose bit is set in a bitmap of the benchmark's
windows. The bitmap's size is fixed; a larger benchmark sets more bits and more
windows travel, and the join decides in every case.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 8
LEAST_LITERAL = 4
_BITS = 22
#: Words that are units after a number.
UNITS = frozenset(
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres "
    "g kg mg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons tonne tonnes l ml liter liters litre litres gallon gallons "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "percent dollar dollars euro euros cent cents degree degrees k c f v w kw mph kmh hz mhz ghz kb mb gb tb".split()
)
_NUMBER = re.compile(r"[$€£]?[+-]?\d[\d.,:/]*(?:st|nd|rd|th|%)?\Z")
_GLUED = re.compile(r"[$€£]?[+-]?\d[\d.,]*([a-zµ°]+)\Z")
_EDGE = re.compile(r"^\W+|\W+$")
_END = re.compile(r"[.!?][\"')\]]*\Z")
_NUM, _UNIT, _TITLE, _ENDS, _NONE = 1, 2, 4, 8, 16
_PLACE = {_NUM: 0x9E3779B97F4A7C15, _UNIT: 0xC2B2AE3D27D4EB4F, _TITLE: 0x165667B19E3779F9}
_HIT = "doc_id long, pos int, window long, slots array<string>"
_PLAIN, _WHOLE = np.uint64(0x94D049BB133111EB), np.uint64(0x2545F4914F6CDD1D)  # set windows of plain words, and short whole texts, apart


class Vocabulary(dict):
    """word -> row of its hash and kind; emptied when it has grown too large."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most = most
        self.hash, self.kind, self.core = np.zeros(1 << 12, "u8"), np.zeros(1 << 12, "u1"), []

    def __missing__(self, word: str) -> int:
        from xxhash import xxh64_intdigest

        k = len(self.core)
        if k == len(self.hash):
            self.hash, self.kind = np.concatenate([self.hash, self.hash]), np.concatenate([self.kind, self.kind])
        core = word if word.isalnum() else _EDGE.sub("", word)
        low = core.lower()
        kind = 0 if core else _NONE
        if low in UNITS:
            kind |= _UNIT
        if core[:1].isdigit() or core[:1] in "$€£+-":
            glued = _GLUED.match(low)
            if _NUMBER.match(low) or glued and glued[1] in UNITS:
                kind |= _NUM
        elif core[:1].isupper() and (len(core) > 1 and not core.isupper()):
            kind |= _TITLE
        if _END.search(word):
            kind |= _ENDS
        self.hash[k], self.kind[k] = xxh64_intdigest(low.encode()), kind
        self.core.append(low)
        self[word] = k
        return k

    def fresh(self) -> "Vocabulary":
        return self if len(self) < self.most else Vocabulary(self.most)


def template(codes: np.ndarray, doc: np.ndarray, words: Vocabulary):
    """Template hashes of the words that have a core, with what they belong to.

    A capitalised word is a name unless it starts a text or a sentence (after
    . ! ?); words in capitals only are ordinary. A unit counts after a number.
    """
    kind = words.kind[codes]
    starts = np.r_[True, (doc[1:] != doc[:-1]) | (kind[:-1] & _ENDS > 0)] if len(codes) else np.zeros(0, bool)
    real = kind & _NONE == 0
    # the sentence mark of a word without a core holds for the next word
    codes, doc, kind, starts = codes[real], doc[real], kind[real], starts[real]
    number = kind & _NUM > 0
    after = np.r_[False, number[:-1] & (doc[1:] == doc[:-1])] if len(codes) else number
    unit = (kind & _UNIT > 0) & after & ~number
    name = (kind & _TITLE > 0) & ~starts & ~number & ~unit
    hashes = words.hash[codes].copy()
    for mask, bit in ((number, _NUM), (unit, _UNIT), (name, _TITLE)):
        hashes[mask] = _PLACE[bit]
    return hashes, doc, codes, number | unit | name


def windows(hashes: np.ndarray, doc: np.ndarray, slot: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each window within one text with enough literal words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, "i8"), np.zeros(0, "u8")
    total, power = np.zeros(n, "u8"), 1
    for j in range(width):
        total += hashes[j : j + n] * np.uint64(power)
        power = power * 0xD6E8FEB86659FD93 % (1 << 64)
    literal = np.concatenate([[0], np.cumsum(~slot)])
    good = (doc[:n] == doc[width - 1 :]) & (literal[width:] - literal[:-width] >= LEAST_LITERAL)
    total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9 + 2 * width)
    total ^= total >> np.uint64(32)
    return np.flatnonzero(good), total[good]


def _rows(pdf, words: Vocabulary, widths, wanted, plain=(), whole: bool = False):
    """Windows of a batch of texts that ``wanted`` lets through: of template words by
    ``widths``, of plain words by ``plain``, and with ``whole`` texts of one to three words."""
    import pandas as pd

    from .common import words_of

    split = [words_of(t) for t in pdf["text"]]
    doc = np.repeat(np.arange(len(split)), [len(s) for s in split])
    codes = np.fromiter((words[w] for s in split for w in s), "i8", len(doc))
    hashes, doc, codes, slot = template(codes, doc, words)
    first = np.searchsorted(doc, np.arange(len(split) + 1))
    ids, out = pdf["doc_id"].tolist(), []
    none = np.zeros(len(slot), bool)
    for width, own, slots, mark in [*((w, hashes, slot, np.uint64(0)) for w in widths), *((w, words.hash[codes], none, _PLAIN) for w in plain)]:
        start, h = windows(own, doc, slots, width)
        h = h ^ mark
        hit = wanted(h)
        for i, x in zip(start[hit].tolist(), h[hit].view("i8").tolist(), strict=True):
            values = [words.core[c] for c in codes[i : i + width][slots[i : i + width]]]
            out.append((ids[doc[i]], i - int(first[doc[i]]), x, values))
    if whole:
        from xxhash import xxh64_intdigest

        few = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < LEAST_LITERAL))
        h = np.array([xxh64_intdigest(" ".join(words.core[c] for c in codes[first[k] : first[k + 1]]).encode()) for k in few.tolist()], "u8") ^ _WHOLE
        out += [(ids[k], 0, x, []) for k, x, hit in zip(few.tolist(), h.view("i8").tolist(), wanted(h).tolist(), strict=True) if hit]
    return pd.DataFrame(out, columns=["doc_id", "pos", "window", "slots"]).astype({"doc_id": "Int64"})


def item_windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id (the item), pos, window, slots of every item and the width and kind of its
    windows; shorter items have one window over all their words. Windows with under four
    literal words name nothing; an item that has no other is taken as plain words."""

    def run(batches):
        import pandas as pd

        words = Vocabulary()
        for pdf in batches:
            words = words.fresh()
            for k in range(len(pdf)):
                own = pdf.iloc[k : k + 1]
                made = _rows(own, words, (width,), lambda h: np.ones(len(h), bool))
                for w in range(width - 1, LEAST_LITERAL - 1, -1):
                    if len(made) or _length(own, words) > w:
                        break
                    made = _rows(own, words, (w,), lambda h: np.ones(len(h), bool))
                n = _length(own, words)
                kind = "template" if len(made) else "plain" if n >= LEAST_LITERAL else "whole"
                if not len(made):
                    made = _rows(own, words, (), lambda h: np.ones(len(h), bool), (min(width, n),) if n >= LEAST_LITERAL else (), True)
                if not len(made):
                    continue  # an item without words
                made["width"], made["kind"] = min(width, n), [kind] * len(made)
                places = _places(own, words, made["pos"].tolist(), min(width, n)) if kind == "template" else [[] for _ in range(len(made))]
                made["places"] = pd.Series(places, index=made.index, dtype=object)
                yield made

    items = benchmark.select(F.col("item_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    return items.mapInPandas(run, _HIT + ", width int, kind string, places array<int>")


def _places(pdf, words: Vocabulary, starts: list[int], width: int) -> list[list[int]]:
    """Which words of an item are the slots of each of its windows."""
    from .common import words_of

    split = words_of(pdf["text"].iloc[0])
    codes = np.fromiter((words[w] for w in split), "i8", len(split))
    slot = template(codes, np.zeros(len(codes), "i8"), words)[3]
    at = np.flatnonzero(slot)
    return [at[(at >= s) & (at < s + width)].tolist() for s in starts]


def _length(pdf, words: Vocabulary) -> int:
    from .common import words_of

    return sum(bool(words.kind[words[w]] & _NONE == 0) for w in words_of(pdf["text"].iloc[0]))


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = 0.5, width: int = WIDTH, small: int = 200_000) -> DataFrame:
    """doc_id, item_id, n_windows (the item's), n_matched, coverage, exact, one_to_one.

    ``exact``: all placeholders are filled as in the item; ``one_to_one``: no value of
    the item becomes two, and no two become one. Items without words give no rows. Null texts are empty;
    rows with equal ids count as one document, those without an id as another;
    other columns are ignored; empty tables give no rows.
    """
    from .common import stage

    items = stage(item_windows(benchmark, width), "item-windows")
    mask = (1 << _BITS) - 1
    bit = F.col("window").bitwiseAND(F.lit(mask))
    # at most 2^22 / 64 words of 64 bits, whatever the benchmark
    rows = items.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(window & 63 as int))")).alias("bits")).collect()
    table = np.zeros(1 << (_BITS - 6), "i8")
    for r in rows:
        table[r["word"]] = r["bits"]
    sizes = items.agg(F.count(F.lit(1)), *[F.collect_set(F.when(F.col("kind") == k, F.col("width"))) for k in ("template", "plain", "whole")]).first()
    n_items, widths, plain, whole = sizes[0], sorted(sizes[1]), sorted(sizes[2]), bool(sizes[3])
    shared = docs.sparkSession.sparkContext.broadcast(table.view("u8"))

    def wanted(h: np.ndarray) -> np.ndarray:
        at = h & np.uint64(mask)
        return shared.value[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1) > 0

    def run(batches):
        words = Vocabulary()
        for pdf in batches:
            for a in range(0, len(pdf), 200):  # few texts at once: a batch's words would not fit
                words = words.fresh()
                yield _rows(pdf.iloc[a : a + 200], words, widths, wanted, plain, whole)

    hits = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInPandas(run, _HIT)
    item = items.select(F.col("doc_id").alias("item_id"), F.col("pos").alias("item_pos"), "window", F.col("slots").alias("item_slots"), "places")
    # the benchmark's windows are counted: beyond the bound both sides are shuffled
    pairs = hits.join(F.broadcast(item) if n_items <= small else item, "window")
    # a place is a slot of the item: windows that overlap see it several times
    fill = F.transform(F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d"), F.col("places").alias("at")), lambda x: F.struct(x["at"].alias("at"), x["i"].alias("i"), x["d"].alias("d")))
    passage = (
        pairs.withColumn("shift", F.col("pos") - F.col("item_pos"))
        .groupBy("doc_id", "item_id", "shift")
        .agg(F.array_distinct(F.flatten(F.collect_set(fill))).alias("fills"), F.collect_set("item_pos").alias("at"))
    )
    count = lambda own, other: F.size(F.filter("fills", lambda y: (y["i"] == own["i"]) & (y["d"] == other["d"])))
    most = F.aggregate(
        F.array_distinct(F.transform("fills", lambda x: x["i"])),
        F.lit(0),
        lambda n, v: n + F.array_max(F.transform(F.filter("fills", lambda x: x["i"] == v), lambda x: count(x, x))),
    )
    pairs_of = F.array_distinct(F.transform("fills", lambda x: F.struct(x["i"], x["d"])))
    distinct = lambda c: F.size(F.array_distinct(F.transform("fills", lambda x: x[c])))
    sound = passage.where((F.size("fills") == 0) | (2 * most >= F.size("fills")))
    sound = sound.withColumn("exact", F.forall("fills", lambda x: x["i"] == x["d"])).withColumn("one_to_one", (distinct("i") == F.size(pairs_of)) & (distinct("d") == F.size(pairs_of)))
    by = sound.groupBy("doc_id", "item_id").agg(F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("n_matched"), F.bool_and("exact").alias("exact"), F.bool_and("one_to_one").alias("one_to_one"))
    counts = items.groupBy(F.col("doc_id").alias("item_id")).agg(F.countDistinct("pos").alias("n_windows"))
    share = F.col("n_matched") / F.col("n_windows")
    return by.join(counts, "item_id").where(share >= coverage).select("doc_id", "item_id", F.col("n_windows").cast("long"), F.col("n_matched").cast("long"), share.alias("coverage"), "exact", "one_to_one")
