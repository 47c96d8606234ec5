"""Quality rules: a learned, ordered list of threshold conjunctions.

Sequential covering over labelled statistics. A rule is grown one condition at
a time by FOIL's gain on two thirds of the labelled rows, then its last
conditions are dropped as long as that does not hurt on the other third; rows a
rule covers are set aside for the next. Every step is one grouped count over
(statistic, bin), so the driver sees bins and never rows, and the list comes out
as one conditional expression. Everything here is DataFrame functions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, release, stage

SYMBOLS = "#*$%&|<>"
#: What rules may test; all are doubles that no document leaves null.
STATISTICS = ["n_words", "mean_word", "symbol_share", "mark_share", "upper_share", "digit_share", "dup_line_share", "repeat_share", "distinct_share", "line_words"]
_BASE = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _pairs(items: Column, shift: int = 1) -> tuple[Column, Column]:
    n = F.greatest(F.size(items) - shift, F.lit(0))
    return F.slice(items, F.lit(1), n), F.slice(items, F.lit(1 + shift), n)


def _without(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, letters, ""))


def statistics(docs: DataFrame) -> DataFrame:
    """Statistics of whole texts (a null text has no words), one row a document.

    n_repeat_words: words that stand in a window of three words found twice or
    more in the text. Windows are compared by a 64-bit hash within their text.
    """
    text = F.coalesce("text", F.lit(""))
    blank = "[ \\t\\n\\x0B\\f\\r]"
    d = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    d = d.withColumn("words", F.array_remove(F.split("text", blank + "+"), ""))
    d = d.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0))
    a, b = _pairs(F.col("words"))
    d = d.withColumn("two", F.zip_with(a, b, lambda x, y: F.xxhash64(x, y)))
    first, _ = _pairs(F.col("two"))
    _, third = _pairs(F.col("words"), 2)
    d = d.withColumn("windows", F.zip_with(first, third, lambda x, y: F.xxhash64(x, y)))
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("placed", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), placed).otherwise(F.slice(placed, 1, 0)))
    a, b = _pairs(F.col("placed"))
    equal = F.zip_with(a, b, lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])))
    d = d.withColumn("starts", F.sort_array(F.array_distinct(F.flatten(F.filter(equal, lambda x: x.isNotNull())))))
    a, b = _pairs(F.col("starts"))
    covered = F.aggregate(F.zip_with(a, b, lambda x, y: F.least(y - x, F.lit(3))), F.lit(3), lambda s, x: s + x)
    d = d.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"),
        _without(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("starts") > 0, covered).otherwise(0).cast("long").alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        _without(F.col("text"), "!?\"'()[]{}").alias("n_marks"),
        _without(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"),
        _without(F.col("text"), "0123456789").alias("n_digits"),
    )

    def share(x: str, y: str) -> Column:
        return F.col(x).cast("double") / F.greatest(F.col(y), F.lit(1))

    return d.select(
        *_BASE,
        share("word_chars", "n_words").alias("mean_word"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_marks", "word_chars").alias("mark_share"),
        share("n_upper", "word_chars").alias("upper_share"),
        share("n_digits", "word_chars").alias("digit_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("n_distinct", "n_words").alias("distinct_share"),
        share("n_words", "n_lines").alias("line_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def holds(self) -> Column:
        x = F.col(self.statistic).cast("double")
        return x > self.threshold if self.above else x <= self.threshold


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    precision: float
    covered: int

    def holds(self) -> Column:
        return _all(self.conditions)


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c.holds()
    return out


def _bin(statistic: str, cuts: list[float]) -> Column:
    """How many of the cuts lie below the statistic."""
    return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda t: F.col(statistic) > t))


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def learn(labelled: DataFrame, bins: int = 32, most_rules: int = 8, most_conditions: int = 4, precision: float = 0.9, least_covered: int = 5) -> list[Rule]:
    """Rules for rows with ``bad`` (boolean), in the order they apply.

    ``labelled``: the statistics, ``bad`` and ``part`` (0 or 1: grow, 2: prune).
    A rule is taken if at least ``precision`` of what it covers in the pruning
    part, and overall, is bad; learning ends at the first that is not.
    """
    quantiles = [(i + 1) / bins for i in range(bins - 1)]
    cut = labelled.agg(*[F.percentile_approx(F.col(s).cast("double"), quantiles, 10_000).alias(s) for s in STATISTICS]).first()
    if cut[0] is None:
        return []
    cuts = {s: sorted(set(cut[s])) for s in STATISTICS}
    place = [F.struct(F.lit(k).alias("s"), _bin(s, cuts[s]).alias("bin")) for k, s in enumerate(STATISTICS)]
    table = stage(labelled.select(*STATISTICS, F.col("bad").cast("int").alias("bad"), "part", F.array(*place).alias("bins")), "rule-bins")

    def counts(rows: DataFrame) -> dict[tuple[str, int], tuple[int, int]]:
        got = rows.select("bad", F.explode("bins").alias("x")).groupBy("x.s", "x.bin").agg(F.sum("bad").alias("p"), F.count(F.lit(1)).alias("n")).collect()
        return {(STATISTICS[r["s"]], r["bin"]): (r["p"], r["n"] - r["p"]) for r in got}

    def total(rows: DataFrame) -> tuple[int, int]:
        r = rows.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.count(F.lit(1))).first()
        return r[0], r[1] - r[0]

    rules: list[Rule] = []
    rest = table
    for _ in range(most_rules):
        grow, own = rest.where("part < 2"), []
        p0, n0 = total(grow)
        if p0 < least_covered:
            break
        while len(own) < most_conditions and n0:
            by, best = counts(grow.where(_all(own))), (0.0, None, 0, 0)
            for s in STATISTICS:
                below = (0, 0)
                for k, t in enumerate(cuts[s]):
                    p, n = by.get((s, k), (0, 0))
                    below = (below[0] + p, below[1] + n)
                    for above, (a, b) in ((False, below), (True, (p0 - below[0], n0 - below[1]))):
                        if a >= least_covered and (g := _gain(a, b, p0, n0)) > best[0]:
                            best = (g, Condition(s, above, t), a, b)
            if best[1] is None:
                break
            own.append(best[1])
            _, _, p0, n0 = best
        if not own:
            break
        # all prefixes of the rule on the pruning part, in one pass
        prune = rest.where("part = 2")
        sums = prune.agg(*[F.sum(F.when(_all(own[:k]), F.lit(2) * F.col("bad") - 1)).alias(f"v{k}") for k in range(1, len(own) + 1)], *[F.count_if(_all(own[:k])).alias(f"n{k}") for k in range(1, len(own) + 1)]).first()
        value = {k: (sums[f"v{k}"] or 0) / sums[f"n{k}"] if sums[f"n{k}"] else -1.0 for k in range(1, len(own) + 1)}
        kept = max(value, key=lambda k: (value[k], -k))
        p, n = total(rest.where(_all(own[:kept])))
        if (value[kept] + 1) / 2 < precision or p < precision * (p + n):
            break
        rules.append(Rule(tuple(own[:kept]), p / (p + n), p + n))
        rest = rest.where(~_all(own[:kept]))
    release(table)
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Index of the first rule that holds, from 1; null if none does."""
    out = F.lit(None).cast("int")
    for k, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(rule.holds(), F.lit(k)).otherwise(out)
    return out


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a document: base statistics, base_failed, kept, rule.

    ``labels``: doc_id and quality (0: bad); rows without either are left out,
    repeated ones count each. Rules are learned from labelled documents that
    pass the base test; ``rule`` is the one that rejected a document. Without
    labels there are no rules and ``kept`` is the base test alone. Rows with a
    null doc_id are judged like others; repeated rows stay; empty in, empty out.
    """
    made = stage(statistics(docs).withColumn("base_failed", base_failed()), "statistics")
    known = labels.where("doc_id is not null and quality is not null").select(F.col("doc_id").cast("long"), (F.col("quality") == 0).alias("bad"))
    labelled = made.where(~F.col("base_failed")).join(known, "doc_id").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(3)))
    fired = verdict(learn(labelled))
    return made.select(*_BASE, "base_failed", (~F.col("base_failed") & fired.isNull()).alias("kept"), F.when(~F.col("base_failed"), fired).alias("rule"))
