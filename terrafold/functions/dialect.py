"""SQL functions whose name or meaning differs in Spark, as columns.

Each function has the meaning that users of the ad-hoc SQL surface know; names
that Spark has with the same meaning are not repeated here.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# numbers
def trunc(x: Column) -> Column:
    return F.signum(x) * F.floor(F.abs(x))


def log(x: Column) -> Column:
    return F.log10(x)


def even(x: Column) -> Column:
    return F.signum(x) * 2 * F.ceil(F.abs(x) / 2)


def gcd(a: Column, b: Column) -> Column:
    """Euclid's steps inside one expression: five a decimal digit of the smaller number
    suffice (Lamé), and one to bring the larger first."""
    steps = F.length(F.least(F.abs(a), F.abs(b)).cast("string")) * 5 + 1
    start = F.struct(F.abs(a).cast("long").alias("a"), F.abs(b).cast("long").alias("b"))

    def step(s: Column, _: Column) -> Column:
        return F.when(s["b"] == 0, s).otherwise(F.struct(s["b"].alias("a"), (s["a"] % F.when(s["b"] == 0, F.lit(1).cast("long")).otherwise(s["b"])).alias("b")))

    return F.aggregate(F.sequence(F.lit(1), F.when(a.isNotNull() & b.isNotNull(), steps)), start, step, lambda s: s["a"])


def lcm(a: Column, b: Column) -> Column:
    g = gcd(a, b)
    return F.when(g == 0, F.lit(0)).otherwise(F.abs(a * b) / g).cast("long")


# text
def substr(s: Column, start: int, n: int | None = None) -> Column:
    """Start 0 is the place before the first character."""
    if start == 0:
        return F.substring(s, 1, n - 1 if n is not None else 2**31 - 1)
    return F.substring(s, start, n if n is not None else 2**31 - 1)


def concat(*parts: Column) -> Column:
    return F.concat_ws("", *parts)


def strpos(s: Column, part: str) -> Column:
    return F.instr(s, part)


def sha256(s: Column) -> Column:
    return F.sha2(s, 256)


def format_(pattern: str, *values: Column) -> Column:
    return F.format_string(pattern.replace("%", "%%").replace("{}", "%s"), *values)


def regexp_replace(s: Column, pattern: str, by: str) -> Column:
    """The first match only."""
    return F.regexp_replace(s, f"^(.*?)(?:{pattern})", "$1" + by) if not pattern.startswith("^") else F.regexp_replace(s, pattern, by)


def regexp_matches(s: Column, pattern: str) -> Column:
    return s.rlike(pattern)


def string_split(s: Column, separator: str) -> Column:
    return F.split(s, re.escape(separator))


def jaccard(a: Column, b: Column) -> Column:
    x, y = (F.array_distinct(F.filter(F.split(c, ""), lambda t: t != "")) for c in (a, b))
    return F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))


@F.pandas_udf(T.StringType())
def nfc_normalize(s):
    import unicodedata

    return s.map(lambda t: t if t is None else unicodedata.normalize("NFC", t))


@F.pandas_udf(T.StringType())
def strip_accents(s):
    import unicodedata

    return s.map(lambda t: t if t is None else "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c)))


# dates
def date_diff(unit: str, a: Column, b: Column) -> Column:
    """Boundaries of the unit that lie between two dates."""
    if unit == "day":
        return F.datediff(b, a)
    months = (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)
    return {"month": months, "year": F.year(b) - F.year(a), "quarter": (F.year(b) - F.year(a)) * 4 + F.quarter(b) - F.quarter(a)}[unit]


def date_sub(unit: str, a: Column, b: Column) -> Column:
    """Whole units between two dates."""
    return F.timestamp_diff(unit.upper(), a, b)


def dayname(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def monthname(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def dayofweek(d: Column) -> Column:
    return F.dayofweek(d) - 1


def isodow(d: Column) -> Column:
    return F.weekday(d) + 1


def isoyear(d: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), d)


def week(d: Column) -> Column:
    return F.weekofyear(d)


def yearweek(d: Column) -> Column:
    return isoyear(d) * 100 + F.weekofyear(d)


def century(d: Column) -> Column:
    return F.ceil(F.year(d) / 100)


def epoch(t: Column) -> Column:
    return F.unix_micros(t.cast("timestamp")) / 1e6


def epoch_ms(t: Column) -> Column:
    return F.unix_millis(t.cast("timestamp"))


#: Percent patterns and what they are in Spark.
_PATTERN = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%y": "yy", "%j": "DDD", "%b": "MMM", "%B": "MMMM", "%a": "EEE", "%A": "EEEE"}


def _pattern(p: str) -> str:
    return "".join(_PATTERN.get(x) or (x if not x.isalpha() else f"'{x}'") for x in re.findall("%.|.", p))


def strftime(t: Column, pattern: str) -> Column:
    return F.date_format(t, _pattern(pattern))


def strptime(s: Column, pattern: str) -> Column:
    return F.to_timestamp(s, _pattern(pattern))


def to_timestamp(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


# lists and JSON
def list_position(a: Column, x) -> Column:
    return F.nullif(F.array_position(a, x), F.lit(0))


def list_distinct(a: Column) -> Column:
    return F.array_compact(F.array_distinct(a))


def list_aggregate(x: Column) -> Column:
    """A list with its nulls, which Spark's own aggregate leaves out."""
    return F.transform(F.collect_list(F.struct(x.alias("x"))), lambda s: s["x"])


def json_extract_string(j: Column, path: str) -> Column:
    return F.get_json_object(j, path)


# aggregates in two steps
def entropy(df: DataFrame, column: str) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t"))
    return counts.crossJoin(F.broadcast(total)).agg((-F.sum(F.col("n") / F.col("t") * F.log2(F.col("n") / F.col("t")))).alias("entropy"))


def histogram(df: DataFrame, column: str) -> DataFrame:
    counts = df.groupBy(F.col(column).alias("x")).agg(F.count(F.lit(1)).alias("n"))
    return counts.where("x is not null").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("x", "n")))).alias("histogram"))
