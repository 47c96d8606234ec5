"""Documents to chunks: tidy text, windows, ids and hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tidy(text: Column) -> Column:
    out = F.regexp_replace(text, "[ \\t]+", " ")
    return F.trim(F.regexp_replace(out, "\\n{3,}", "\n\n"))


def content_hash(text: Column) -> Column:
    return F.left(F.sha2(text, 256), F.lit(16))


def paragraph_windows(body: Column, size: int = 1500, overlap: int = 200, hard: int = 3000, step: int = 1300) -> Column:
    """Paragraphs (between blank lines) folded into windows: one is closed when the
    next paragraph would exceed ``size``, and the next begins with its last
    ``overlap`` characters; a window over ``hard`` characters is cut by ``step``."""
    parts = F.filter(F.split(body, "\n\\s*\n"), lambda x: F.trim(x) != "")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def add(state, part):
        joined = F.when(state["open"] == "", part).otherwise(F.concat(state["open"], F.lit("\n\n"), part))
        tail = F.concat(F.substring(state["open"], -overlap, overlap), F.lit("\n\n"), part)
        return F.when((state["open"] != "") & (F.length(joined) > size), F.struct(F.concat(state["done"], F.array(state["open"])).alias("done"), tail.alias("open"))).otherwise(F.struct(state["done"].alias("done"), joined.alias("open")))

    folded = F.aggregate(parts, start, add, lambda s: F.filter(F.concat(s["done"], F.array(s["open"])), lambda x: x != ""))
    cut = lambda w: F.transform(F.sequence(F.lit(0), F.floor((F.length(w) - 1) / step).cast("int")), lambda k: F.substr(w, k * step + 1, F.lit(size)))
    return F.flatten(F.transform(folded, lambda w: F.when(F.length(w) > hard, cut(w)).otherwise(F.array(w))))


def chunks(docs: DataFrame, least: int = 40) -> DataFrame:
    """Windows of each document with id ``doc#n``, count and content hash."""
    rows = docs.select("doc_id", F.posexplode(paragraph_windows(tidy(F.coalesce("text", F.lit(""))))).alias("n", "body")).where(F.length("body") >= least)
    own = Window.partitionBy("doc_id")
    return rows.select(
        F.concat_ws("#", F.col("doc_id").cast("string"), (F.row_number().over(own.orderBy("n")) - 1).cast("string")).alias("chunk_id"),
        "doc_id",
        F.count(F.lit(1)).over(own).alias("chunk_count"),
        F.length("body").alias("n_chars"),
        content_hash(F.col("body")).alias("source_hash"),
        "body",
    )


def section_chunks(sections: DataFrame, key: str, title: str, least: int = 40) -> DataFrame:
    """Chunks of the sections of documents (see ``markdown_sections``): id ``doc#n`` in the
    order of sections and windows, the trail of the title and the headings, and the text,
    which is the trail, an empty line and the body. Bodies of under ``least`` characters
    drop out; ids have no gaps. ``sections``: key, section, trail, body and ``title``."""
    rows = sections.select(key, "section", "trail", F.col(title).alias("_t"), F.posexplode(paragraph_windows(F.col("body"))).alias("n", "body"))
    rows = rows.withColumn("body", tidy(F.col("body"))).where(F.length("body") >= least)
    own = Window.partitionBy(key)
    trail = F.concat_ws(" > ", F.when(F.col("_t") != "", F.col("_t")), F.when(F.col("trail") != "", F.col("trail")))
    return rows.select(
        F.concat_ws("#", F.col(key).cast("string"), (F.row_number().over(own.orderBy("section", "n")) - 1).cast("string")).alias("chunk_id"),
        key,
        F.count(F.lit(1)).over(own).alias("chunk_count"),
        trail.alias("trail"),
        F.concat(trail, F.lit("\n\n"), "body").alias("text"),
        content_hash(F.col("body")).alias("source_hash"),
    )


def heading_sections(pages: DataFrame) -> DataFrame:
    """Headings of pages with their trail; a level's entry ends at a shallower one."""
    found = pages.select("page_id", F.posexplode(F.expr(r"regexp_extract_all(html, '(?s)<h([1-4])[^>]*>(.*?)</h', 0)")).alias("pos", "raw"))
    rows = found.select("page_id", "pos", F.regexp_extract("raw", "<h([1-4])", 1).cast("int").alias("level"), F.trim(F.regexp_replace(F.regexp_extract("raw", "(?s)<h[1-4][^>]*>(.*?)</h", 1), "<[^>]+>", "")).alias("title"))
    upto = Window.partitionBy("page_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    last = {k: F.last(F.when(F.col("level") == k, F.struct("pos", "title")), ignorenulls=True).over(upto) for k in range(1, 5)}
    above = {k: F.max(F.when(F.col("level") < k, F.col("pos"))).over(upto) for k in range(1, 5)}
    trail = [F.when((F.col("level") >= k) & (last[k]["pos"] > F.coalesce(above[k], F.lit(-1))), last[k]["title"]) for k in range(1, 5)]
    return rows.select("page_id", "pos", "level", "title", F.concat_ws(" > ", *trail).alias("trail"))


def template(rows: DataFrame, title: str, *lines: tuple[str, str]) -> DataFrame:
    """A document for each row: labelled lines, those without a value left out."""
    text = F.concat_ws("\n", F.col(title).cast("string"), *[F.concat(F.lit(f"{label}: "), F.col(c).cast("string")) for label, c in lines])
    return rows.select(F.col(title).cast("string").alias("doc"), text.alias("text"), content_hash(text).alias("source_hash"))


def headline(text: Column, most: int = 130) -> Column:
    first = F.regexp_extract(text, r"(?s)^(.*?[.!?])(?:\s|$)", 1)
    own = F.when(first == "", text).otherwise(first)
    return F.when(F.length(own) > most, F.concat(F.substring(own, 1, most - 3), F.lit("..."))).otherwise(own)


def markdown_sections(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Sections of Markdown texts between headings of levels 1 to 4, with the trail
    of headings above; lines in fences are no headings; empty sections drop out."""
    lines = docs.select(key, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)).alias("line", "t"))
    upto = Window.partitionBy(key).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    fence = F.ltrim("t").startswith("```")
    lines = lines.withColumn("fenced", F.sum(fence.cast("int")).over(upto) % 2 == 1)
    level = F.when(~F.col("fenced") & F.col("t").rlike(r"^#{1,4}\s"), F.length(F.regexp_extract("t", "^(#+)", 1)))
    lines = lines.withColumn("level", level).withColumn("title", F.when(F.col("level").isNotNull(), tidy(F.regexp_extract("t", r"^#+\s+(.*)$", 1))))
    lines = lines.withColumn("section", F.count("level").over(upto))
    heads = {k: F.last(F.when(F.col("level") == k, F.struct("line", "title")), ignorenulls=True).over(upto) for k in range(1, 5)}
    above = {k: F.max(F.when(F.col("level") < k, F.col("line"))).over(upto) for k in range(1, 5)}
    deepest = F.last("level", ignorenulls=True).over(upto)
    trail = [F.when((deepest >= k) & (heads[k]["line"] > F.coalesce(above[k], F.lit(-1))) & (heads[k]["title"] != ""), heads[k]["title"]) for k in range(1, 5)]
    rows = lines.withColumn("trail", F.concat_ws(" > ", *trail)).where("level is null")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "t"))), lambda x: x["t"]), "\n")
    return rows.groupBy(key, "section", "trail").agg(tidy(body).alias("body")).where("body <> ''")


def link_edges(*parts: tuple[DataFrame, str, str, str]) -> DataFrame:
    """Edges (source, target, kind) of several tables; each part is a table, the
    columns of both ends and the kind. Repeated edges are one."""
    out = None
    for df, source, target, kind in parts:
        own = df.where(F.col(source).isNotNull() & F.col(target).isNotNull()).select(F.col(source).cast("string").alias("source"), F.col(target).cast("string").alias("target"), F.lit(kind).alias("kind"))
        out = own if out is None else out.unionByName(own)
    return out.distinct()
