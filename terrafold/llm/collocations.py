"""Phrase collocations from a weighted de Bruijn graph of the corpus.

Nodes are runs of ``longest`` - 1 words, edges the longest grams: an edge leads from
its first words to its last ones and weighs its occurrences. Only the edges are
counted over the corpus, together with the shorter grams that remain where a piece
ends. What a node's edges carry, plus those ends, is the count of the node; the
counts of all shorter phrases follow in the same way. Paths whose nodes have one edge
in and one out of the same weight are compacted to one row before that.

A phrase that occurs ``least`` times has no word and no shorter run of words that occurs
less often. So bitmaps of bounded size, of words and of runs of two and three by hash,
end a run at what cannot be part of any candidate. A bit set by chance only lengthens a run:
the counts of all phrases that reach ``least`` are exact.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import release, stage

_BITS = 27  # of a bitmap at most: 16 MB, whatever the corpus
KNOWN = 3  # words of the longest runs that get a bitmap
_TOKENS = 250_000  # distinct words of a language that a task holds before it sends its counts
_GRAMS = 300_000  # grams of a language that a task holds before it sends their counts
_BLOCK = 2_000_000  # bytes of text taken at once, or one text
_BREAK = b"\xff"  # never a byte of UTF-8
#: What ends a piece, and what parts words.
_ENDS, _BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
_MAP = bytes.maketrans(_ENDS + b"\x09", _BREAK * len(_ENDS) + b" ")
UNKNOWN = "und"


class Interned(dict):
    """word -> its number, in the order in which words are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def tokens_of(texts: list[str]) -> list[bytes]:
    """Words of texts, with a mark at the ends of pieces and texts."""
    joined = _BREAK.join(t.encode() for t in texts).lower().translate(_MAP)
    return joined.replace(_BREAK, b" " + _BREAK + b" ").split()


def _blocks(batches):
    """(lang, texts) of about ``_BLOCK`` bytes."""
    for pdf in batches:
        for lang, own in pdf.groupby("lang", sort=False)["text"]:
            held, size = [], 0
            for t in own:
                held.append(t)
                size += len(t)
                if size >= _BLOCK:
                    yield lang, held
                    held, size = [], 0
            if held:
                yield lang, held


def _hash(lang: str, word: bytes) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(lang.encode() + b"\t" + word, 42)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two, in order."""
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0xD6E8FEB86659FD93))
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def bitmap(hashes: DataFrame, column: str, n: int) -> np.ndarray:
    """Bits of the hashes of a table: 16 bits or more a row, up to 2^27 in all.

    What reaches the driver is at most one row for each 64 bits of that."""
    bits = max(16, min(_BITS, (16 * n).bit_length()))
    at = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    rows = hashes.groupBy(F.shiftright(at, 6).cast("int").alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), "i8")
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return out.view("u8")


def _in(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.uint64(len(table) * 64 - 1)
    return table[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1) > 0


class Words:
    """Numbers, hashes and flags of one language's words in a task."""

    def __init__(self, lang: str, table: np.ndarray | None = None):
        self.lang, self.table, self.seen = lang, table, Interned()
        self.hash, self.known, self.words = np.zeros(0, "u8"), np.zeros(0, bool), []

    def numbers(self, texts: list[str]) -> np.ndarray:
        tokens = tokens_of(texts)
        out = np.fromiter(map(self.seen.__getitem__, tokens), "i8", len(tokens))
        if len(self.seen) > len(self.words):
            new = list(self.seen)[len(self.words) :]
            self.words += new
            if self.table is not None:
                h = np.array([_hash(self.lang, w) for w in new], "u8")
                self.hash = np.concatenate([self.hash, h])
                self.known = np.concatenate([self.known, _in(self.table, h) & np.array([w != _BREAK for w in new], bool)])
        return out


def _of_lang(held: dict, lang: str, table=None) -> Words:
    if lang not in held or len(held[lang].words) > _TOKENS:
        held[lang] = Words(lang, table)
    return held[lang]


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, n) of all words: summed in each task, then by word."""

    def run(batches):
        import pandas as pd

        held: dict[str, Words] = {}
        sums: dict[str, np.ndarray] = {}

        def out(lang):
            own, n = held.pop(lang), sums.pop(lang)
            keep = [k for k, w in enumerate(own.words) if w != _BREAK]
            return pd.DataFrame({"lang": [lang] * len(keep), "word": [own.words[k].decode() for k in keep], "n": n[keep]})

        for lang, block in _blocks(batches):
            own = held.setdefault(lang, Words(lang))
            found = own.numbers(block)
            n = np.bincount(found, minlength=len(own.words))
            n[: len(sums.get(lang, ()))] += sums.get(lang, np.zeros(0, "i8"))
            sums[lang] = n
            if len(own.words) > _TOKENS:
                yield out(lang)
        for lang in list(held):
            if held[lang].words != [_BREAK]:
                yield out(lang)

    parts = texts.mapInPandas(run, "lang string, word string, n long")
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _linked(own: Words, found: np.ndarray, tables: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For runs of 2, 3 ... words: the places where one starts whose shorter runs are all
    known, and its hash; with a bitmap for the order, only those that it knows."""
    known = own.known[found]
    at = np.flatnonzero(known[:-1] & known[1:])
    h = _mix(own.hash[found[at]], own.hash[found[at + 1]])
    out = []
    for k in range(len(tables) + 1):
        if k:
            hit = _in(tables[k - 1], h)
            at, h = at[hit], h[hit]
            out.append((at, h))
            # a run of one word more: the run that starts a word later is known, too
            more = np.flatnonzero(at[1:] == at[:-1] + 1)
            at, h = at[more], _mix(h[more], own.hash[found[at[more] + k + 1]])
    out.append((at, h))
    return out


def run_hashes(texts: DataFrame, words: np.ndarray, tables: list[np.ndarray], least: int) -> DataFrame:
    """Hashes of runs of one word more than the last bitmap's, of known runs only, that
    occur ``least`` times or share a hash with such."""
    spark = texts.sparkSession
    shared, known = spark.sparkContext.broadcast(words), spark.sparkContext.broadcast(tables)

    def run(batches):
        import pandas as pd

        held: dict[str, Words] = {}
        parts, size = [], 0

        def out():
            h, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return pd.DataFrame({"h": h.view("i8"), "n": np.bincount(at, np.concatenate([p[1] for p in parts]), len(h)).astype("i8")})

        for lang, block in _blocks(batches):
            own = _of_lang(held, lang, shared.value)
            h, n = np.unique(_linked(own, own.numbers(block), known.value)[-1][1], return_counts=True)
            parts.append((h, n))
            size += len(h)
            if size > 700_000:
                yield out()
                parts, size = [], 0
        if parts:
            yield out()

    return texts.mapInPandas(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def graph_grams(texts: DataFrame, words: np.ndarray, tables: list[np.ndarray], longest: int) -> DataFrame:
    """(lang, gram, size, n): at each place of a run its longest gram of up to ``longest``
    words. Those of ``longest`` words are the edges, the others end a run."""
    spark = texts.sparkSession
    shared, known = spark.sparkContext.broadcast(words), spark.sparkContext.broadcast(tables)
    whole = len(tables) + 1  # words of the longest runs that a bitmap knows

    def run(batches):
        import pandas as pd

        held: dict[str, Words] = {}
        parts: dict[str, list] = {}

        def out(lang):
            """The grams that a task has met in a language, each once."""
            rows, at = np.unique(np.concatenate([p[0] for p in parts[lang]]), return_inverse=True)
            n = np.bincount(at, np.concatenate([p[1] for p in parts.pop(lang)]), len(rows)).astype("i8")
            rows = rows.view("i4").reshape(-1, longest)
            sizes, w = (rows >= 0).sum(1), held[lang].words
            text = [b" ".join([w[k] for k in r[:s]]).decode() for r, s in zip(rows.tolist(), sizes.tolist(), strict=True)]
            return pd.DataFrame({"lang": lang, "gram": text, "size": sizes.astype("i4"), "n": n})

        for lang, block in _blocks(batches):
            if lang in parts and (len(held[lang].words) > _TOKENS or sum(len(p[0]) for p in parts[lang]) > _GRAMS):
                yield out(lang)
            own = _of_lang(held, lang, shared.value)
            found = own.numbers(block)
            linked = np.zeros((whole + 1, len(found) + longest), bool)
            for k, (at, _) in enumerate(_linked(own, found, known.value)[:-1], 2):
                linked[k, at] = True
            start = np.flatnonzero(linked[2])
            if not len(start):
                continue
            grams, going = np.full((len(start), longest), -1, "i4"), np.ones(len(start), bool)
            grams[:, 0] = found[start]
            for k in range(1, longest):  # the word at k is there if the run that ends with it is known
                size = min(k + 1, whole)
                going &= linked[size, start + k + 1 - size]
                grams[going, k] = found[start[going] + k]
            parts.setdefault(lang, []).append(np.unique(grams.view(f"V{4 * longest}").ravel(), return_counts=True))
        for lang in list(parts):
            yield out(lang)

    parts = texts.mapInPandas(run, "lang string, gram string, size int, n long")
    return parts.groupBy("lang", "gram", "size").agg(F.sum("n").alias("n"))


def _run(words, start, size):
    return F.array_join(F.slice(words, start, size), " ")


def compact(edges: DataFrame, order: int, rounds: int = 4) -> DataFrame:
    """Unary paths of a graph as single rows: (lang, path, n), a path a string of words.

    ``edges``: lang, path and n, each of ``order`` + 1 words. Two paths are joined at a
    node that has them as its only edge in and its only edge out, of the same weight. In
    each round a toss by hash decides which of its ends a path offers, so a path takes
    part in one join at most; longer paths stay in parts after ``rounds``, which changes
    no count. Self-loops stay as they are.
    """
    paths = stage(edges.select("lang", "path", "n"), "paths")
    for turn in range(rounds):
        words = F.split("path", " ")
        ended = paths.select("lang", "path", "n", _run(words, F.lit(1), F.lit(order)).alias("first"), F.array_join(F.slice(words, -order, order), " ").alias("last"))
        ended = ended.where("first <> last").withColumn("gives", F.pmod(F.xxhash64("lang", "path", F.lit(turn)), F.lit(2)) == 0)
        out = ended.groupBy("lang", F.col("first").alias("node")).agg(F.count(F.lit(1)).alias("outs"), F.max("n").alias("n_out"), F.max("path").alias("right"), F.max(~F.col("gives")).alias("takes"))
        into = ended.groupBy("lang", F.col("last").alias("node")).agg(F.count(F.lit(1)).alias("ins"), F.max("n").alias("n_in"), F.max("path").alias("left"), F.max("gives").alias("gives"))
        met = into.where("ins = 1 and gives").join(out.where("outs = 1 and takes"), ["lang", "node"]).where("n_in = n_out")
        joined = stage(met.select("lang", "left", "right", F.col("n_in").alias("n"), F.concat("left", F.substring("right", F.length("node") + 1, F.length("right"))).alias("path")), "joined")
        used = joined.select("lang", F.explode(F.array("left", "right")).alias("path"))
        grown = stage(paths.join(used, ["lang", "path"], "left_anti").unionByName(joined.select("lang", "path", "n")), "paths")
        for old in (paths, joined):
            release(old)
        paths = grown
    return paths


def phrase_counts(paths: DataFrame, ends: DataFrame, longest: int) -> DataFrame:
    """(lang, phrase, size, n) of phrases of 2 to ``longest`` words: each edge of a path
    carries the path's weight to what it begins with, each end of a run its own."""
    words = F.split("path", " ")
    starts = F.sequence(F.lit(1), F.size(words) - (longest - 1))
    flow = paths.select("lang", "n", F.explode(F.transform(starts, lambda i: F.slice(words, i, longest))).alias("w"))
    rest = ends.select("lang", "n", F.split("gram", " ").alias("w"))
    heads = F.transform(F.sequence(F.lit(2), F.size("w")), lambda k: F.struct(k.alias("size"), F.array_join(F.slice("w", 1, k), " ").alias("phrase")))
    each = flow.unionByName(rest).select("lang", "n", F.explode(heads).alias("h"))
    return each.groupBy("lang", F.col("h.phrase").alias("phrase"), F.col("h.size").alias("size")).agg(F.sum("n").alias("n"))


def _best_of(rows: DataFrame, key: str, order: list, most: int, salts: tuple[int, ...] = (1024, 32, 1)) -> DataFrame:
    """The first ``most`` rows of each key with their rank: within parts first, so that
    no task sorts what has not been cut to ``most`` rows a part, but for the parts of a key."""
    for salt in salts:
        rows = rows.withColumn("part", F.pmod(F.col("mark"), F.lit(salt)))
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(key, "part").orderBy(*order))).where(F.col("rank") <= most)
    return rows.drop("part", "mark")


def collocations(docs: DataFrame, longest: int = 5, least: int = 100, most: int = 2000, absorbed: int = 100) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases.

    ``docs``: lang and text; other columns are ignored. Texts are lower-cased from A to Z,
    cut into pieces at ``. , ; : ! ?`` and line ends and into words at blanks; null texts
    are empty, a null lang is ``und``; repeated rows count as often as they stand; an
    empty table gives no rows. a, l, r: occurrences of the phrase and of both parts of its
    worst cut, n: all words; score: floor(1000 a n / (l r)), exact in decimals of 38
    digits; ties go to the shortest first part. A candidate with ``absorbed`` per cent or
    more of its occurrences within one longer candidate is left out.
    """
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text").where(F.length("text") > 0)
    counted = stage(word_counts(texts), "words")
    frequent = counted.where(F.col("n") >= least).withColumn("h", F.xxhash64(F.concat_ws("\t", "lang", "word")))
    words = bitmap(frequent, "h", frequent.count())
    tables: list[np.ndarray] = []
    for _ in range(2, max(3, min(longest, KNOWN + 1))):
        runs = stage(run_hashes(texts, words, tables, least), "runs")
        tables = [*tables, bitmap(runs, "h", runs.count())]
        release(runs)
    grams = stage(graph_grams(texts, words, tables, longest), "grams")
    edges = grams.where(F.col("size") == longest).select("lang", F.col("gram").alias("path"), "n")
    paths = compact(edges, longest - 1)
    phrases = stage(phrase_counts(paths, grams.where(F.col("size") < longest), longest).where(F.col("n") >= least), "phrases")
    for old in (grams, paths):
        release(old)

    # candidates within longer ones, which hold them at each of their places
    w = F.split("phrase", " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda k: F.transform(F.sequence(F.lit(1), F.col("size") - k + 1), lambda i: F.array_join(F.slice(w, i, k), " "))))
    holds = phrases.where("size > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("within"))
    kept = phrases.join(holds, ["lang", "phrase"], "left").where(F.col("within").isNull() | (100 * F.col("within") < absorbed * F.col("n")))

    counts = phrases.where(F.col("size") < longest).select("lang", "phrase", "n").unionByName(counted.where(F.col("n") >= least).select("lang", F.col("word").alias("phrase"), "n"))
    cuts = kept.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.struct(k.alias("k"), F.array_join(F.slice(w, 1, k), " ").alias("head"), F.array_join(F.slice(w, k + 1, F.col("size") - k), " ").alias("tail")))).alias("c")).select("lang", "phrase", "a", "c.*")
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"]).join(counts.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r")), ["lang", "tail"])
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    part = F.expr("cast(cast(1000 as decimal(38,0)) * cast(a as decimal(18,0)) * cast(n as decimal(18,0)) as decimal(38,0)) div cast(cast(l as decimal(18,0)) * cast(r as decimal(18,0)) as decimal(38,0))")
    scored = cuts.join(totals, "lang").withColumn("score", part)
    worst = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("m")).select("lang", "phrase", "a", "n", "m.score", "m.l", "m.r")
    best = _best_of(worst.withColumn("mark", F.xxhash64("phrase")), "lang", [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()], most)
    return best.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", F.col("score").cast("long"))
