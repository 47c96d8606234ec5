"""Hybrid retrieval as a batch: questions against chunks, with abstention."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import shared
from ..sources.shared import sendable, sent, written

#: Words that carry no meaning.
STOP_WORDS = ("a an and are as at be been being but by for from had has have if in into is it its of on or over that the their them then there these they this those "
              "to was were with i we you me my our your do does did can could would should will shall may might must am so than too very just about any all each more "
              "most other some such only own same").split()  # fmt: skip
K1, B, SCALE = 1.2, 0.75, 9.0
FLOOR, MODERATE, HIGH = 0.23, 0.29, 0.42
PER_DOC = 2


def normalise(text: Column) -> Column:
    plain = F.translate(F.lower(text), "‘’“”–—", "''\"\"--")
    return F.trim(F.regexp_replace(plain, "(?U)\\s+", " "))


def stem(t: Column) -> Column:
    def cut(n: int) -> Column:
        return F.left(t, F.length(t) - n)

    return (
        F.when((F.length(t) <= 3) | t.contains("_"), t)
        .when(t.endswith("ies") & (F.length(t) > 4), F.concat(cut(3), F.lit("y")))
        .when(t.endswith("sses"), cut(2))
        .when(t.endswith("ss"), t)
        .when(t.endswith("s") & ~t.endswith("us") & ~t.endswith("is"), cut(1))
        .when(t.endswith("ing") & (F.length(t) > 5), cut(3))
        .when(t.endswith("ed") & (F.length(t) > 4), cut(2))
        .otherwise(t)
    )


def tokenise(text: Column) -> Column:
    """Words of [a-z0-9_]; snake_case whole and split; short and stop words out."""
    raw = F.split(F.regexp_replace(normalise(text), "[^a-z0-9_]+", " "), " ")
    parts = F.flatten(F.transform(raw, lambda t: F.when(t.contains("_"), F.concat(F.array(t), F.split(t, "_"))).otherwise(F.array(t))))
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    kept = F.filter(parts, lambda t: (t != "") & ((F.length(t) > 1) | t.rlike("^[0-9]$")) & ~F.array_contains(stop, t))
    return F.transform(kept, stem)


def terms(rows: DataFrame, key: str, text: str) -> DataFrame:
    """``tokenise`` as rows (key, term), so that filters and stems are plain columns. What
    ``normalise`` does to blanks, quotes and dashes changes no word: none is part of one."""
    t = F.col("t")
    raw = rows.select(key, F.explode(F.split(F.lower(F.col(text)), "[^a-z0-9_]+")).alias("t")).where(t != "")
    parts = raw.select(key, F.explode(F.when(t.contains("_"), F.concat(F.array(t), F.split(t, "_"))).otherwise(F.array(t))).alias("t"))
    kept = parts.where((t != "") & ((F.length(t) > 1) | t.between("0", "9")) & ~t.isin(*STOP_WORDS))
    return kept.select(key, stem(t).alias("term"))


def postings(chunks: DataFrame, key: str, text: str) -> DataFrame:
    """(term, key, tf). Texts are dealt by document, so that the words of one are counted where it is."""
    return terms(chunks.select(key, text).repartition(key), key, text).groupBy("term", key).agg(F.count(F.lit(1)).alias("tf"))


def with_lengths(post: DataFrame, key: str) -> DataFrame:
    """Postings with ``len``, the number of their document's words, unless they have it."""
    return post if "len" in post.columns else post.withColumn("len", F.sum("tf").over(Window.partitionBy(key)))


def by_term(post: DataFrame, table: DataFrame) -> DataFrame:
    """Postings with the row of their term from ``table`` (term, df, ...). The most frequent
    terms are sent to every executor, ``SENT`` at most; of the others none has more than one
    in ``SENT`` of the postings, so that no task gets a term that most documents have."""
    table = written(table, "terms")
    common = F.broadcast(written(table.orderBy(F.col("df").desc(), "term").limit(shared.SENT), "common"))
    rest = post.join(common.select("term"), "term", "left_anti").join(table.hint("merge"), "term")
    return post.join(common, "term").unionByName(rest)


def bm25(chunks: DataFrame, queries: DataFrame, key: str, text: str, post: DataFrame | None = None) -> DataFrame:
    """(query_id, key, score, overlap): score in [0, 1), rounded to four places.

    Statistics are over the whole corpus; each typed term counts once. ``post``:
    the postings, if they are kept as a table already.
    """
    post = written(postings(chunks, key, text), "postings") if post is None else post
    typed = written(terms(queries, "query_id", "question").distinct(), "typed")
    few = sendable(typed)
    size = typed.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_typed"))
    # documents stay where they are: pairs of questions and documents are made and summed in one place
    by = by_document(_weights(chunks, typed, post, key), key).join(sent(typed, few), "term").groupBy("query_id", key).agg(F.sum("w").alias("s"), F.count(F.lit(1)).alias("hits"))
    return by.join(sent(size, few), "query_id").select("query_id", key, round4(F.col("s") / (F.col("s") + SCALE)).alias("score"), (F.col("hits") / F.col("n_typed")).alias("overlap"), "hits", "n_typed")


def by_document(df: DataFrame, key: str) -> DataFrame:
    """Dealt by document over as many tasks as there are: few rows here become many."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _weights(chunks: DataFrame, typed: DataFrame, post: DataFrame, key: str) -> DataFrame:
    """(term, key, w): what the postings of typed terms add to a score."""
    post = with_lengths(post, key)
    stats = chunks.agg(F.count(F.lit(1)).alias("n_docs")).crossJoin(post.agg(F.sum("tf").alias("n_terms")))
    own = post.join(typed.select("term").distinct(), "term", "left_semi")  # the index is touched only where a question asks
    df = own.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n = F.col("n_docs").cast("double")
    idf = F.log1p((n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / (F.col("n_terms") / n)))
    return by_term(own, df).crossJoin(F.broadcast(stats)).select("term", key, weight.alias("w"))


EXPANDED = 0.45


def expanded(queries: DataFrame, expansions: DataFrame) -> DataFrame:
    """(query_id, term, weight): typed terms weigh 1, those that an expansion adds
    0.45; the larger counts. ``expansions``: trigger and term; a trigger of one word
    is met by a typed term of the same stem, one of several by standing in the text."""
    typed = terms(queries, "query_id", "question").distinct()
    stems = expansions.where(~F.col("trigger").contains(" ")).select(stem(F.lower("trigger")).alias("met"), stem(F.lower("term")).alias("term"))
    by_word = typed.join(stems, typed["term"] == F.col("met")).select("query_id", stems["term"])
    phrases = expansions.where(F.col("trigger").contains(" ")).select(normalise(F.col("trigger")).alias("phrase"), stem(F.lower("term")).alias("term"))
    own = queries.select("query_id", F.concat(F.lit(" "), normalise(F.col("question")), F.lit(" ")).alias("q"))
    first = own.withColumn("word", F.explode(F.array_distinct(F.split(F.trim("q"), " "))))
    by_phrase = first.join(phrases.withColumn("word", F.substring_index("phrase", " ", 1)), "word").where(F.col("q").contains(F.col("phrase"))).select("query_id", "term")
    added = by_word.unionByName(by_phrase).select("query_id", "term", F.lit(EXPANDED).alias("weight"))
    return typed.withColumn("weight", F.lit(1.0)).unionByName(added).groupBy("query_id", "term").agg(F.max("weight").alias("weight"))


def tfidf(post: DataFrame, key: str, n_docs: DataFrame) -> DataFrame:
    """(term, key, w, df): (1 + ln tf) (ln((N + 1) / (df + 1)) + 1), of length 1 by key.
    ``n_docs``: one row with N."""
    df = post.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = (1 + F.log("tf")) * (F.log((F.col("n_docs") + 1) / (F.col("df") + 1)) + 1)
    raw = by_term(post, df).crossJoin(F.broadcast(n_docs)).select("term", key, weight.alias("w"), "df")
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return raw.select("term", key, (F.col("w") / norm).alias("w"), "df")


def cosine(a: Column, b: Column) -> Column:
    """Dot product of two arrays, at least 0."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    return F.greatest(dot, F.lit(0.0))


def alias_scores(queries: DataFrame, aliases: DataFrame, key: str) -> DataFrame:
    """(query_id, key, alias): the best of min(1, .6 + length / 40) over aliases of
    three letters or more that stand in the question as whole phrases. Joined by
    hash on the first word, then compared in full."""
    own = queries.select("query_id", F.trim(F.regexp_replace(normalise(F.col("question")), "[^a-z0-9_]+", " ")).alias("q"))
    known = aliases.select(key, F.trim(F.regexp_replace(normalise(F.col("alias")), "[^a-z0-9_]+", " ")).alias("a")).where(F.length("a") >= 3).withColumn("word", F.substring_index("a", " ", 1))
    met = own.withColumn("word", F.explode(F.array_distinct(F.split("q", " ")))).join(known, "word")
    hit = F.concat(F.lit(" "), F.col("q"), F.lit(" ")).contains(F.concat(F.lit(" "), F.col("a"), F.lit(" ")))
    return met.where(hit).groupBy("query_id", key).agg(F.max(F.least(F.lit(1.0), 0.6 + F.length("a") / 40)).alias("alias"))


def title_scores(queries: DataFrame, titles: DataFrame, key: str, vocabulary: DataFrame) -> DataFrame:
    """(query_id, key, title): known query terms in the title / known query terms."""
    known = terms(queries, "query_id", "question").distinct().join(vocabulary.select("term").distinct(), "term", "left_semi")
    size = known.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    found = known.join(terms(titles, key, "title").distinct(), "term").groupBy("query_id", key).agg(F.count(F.lit(1)).alias("m"))
    return found.join(size, "query_id").select("query_id", key, (F.col("m") / F.col("n")).alias("title"))


def hybrid(chunks: DataFrame, queries: DataFrame, aliases: DataFrame, post: DataFrame, key: str, text: str = "text", semantic: DataFrame | None = None, types: tuple[str, list[str]] | None = None, least: float | None = None, best: int | None = None) -> DataFrame:
    """(query_id, key, score, ...): the five signals of each chunk that any of them
    finds, fused and damped. ``semantic``: (query_id, key, sem), if there is a latent
    space. ``types``: column and values that candidates must have; statistics are
    over all chunks. ``least``: only what scores as much or holds a run of the question's
    words is asked for; ``best``: only so many of each question, by score, then key."""
    typed = written(terms(queries, "query_id", "question").distinct(), "typed")
    vocabulary = post.join(typed.select("term").distinct(), "term", "left_semi").select("term").distinct()
    ground = written(typed.join(vocabulary.withColumn("known", F.lit(1)), "term", "left").groupBy("query_id").agg(F.count(F.lit(1)).alias("typed"), F.count("known").alias("known")), "ground")
    # facts of documents by what asks for them: a term, an alias, a run of words, or a question itself
    runs = queries.select("query_id", F.explode(phrase_runs(F.col("question"))).alias("run"))
    named, alias_facts = _alias_facts(queries, aliases, key)
    asks = [typed.select("query_id", "term"), named.select("query_id", _ask("a", "a")), runs.select("query_id", _ask("r", "run")), queries.select("query_id", _ask("q", "query_id"))]
    asks = written(reduce(DataFrame.unionByName, asks).distinct(), "asks")
    titles = terms(chunks.select(key, "title"), key, "title").distinct().join(vocabulary, "term", "left_semi")
    parts = [
        _weights(chunks, typed, post, key).withColumn("hit", F.lit(1)), titles.withColumn("in_title", F.lit(1)), alias_facts.select(key, _ask("a", "a"), "alias"),
        _run_facts(chunks, runs.select("run").distinct(), key, text).select(key, _ask("r", "run"), F.lit(1.0).alias("phrase")),
    ]
    if semantic is not None:
        parts.append(semantic.select(key, _ask("q", "query_id"), "sem"))
    facts = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if "sem" not in facts.columns:
        facts = facts.withColumn("sem", F.lit(None).cast("double"))
    facts = by_document(facts, key)
    if types:
        facts = facts.join(chunks.where(F.col(types[0]).isin(*types[1])).select(key).hint("merge"), key, "left_semi")
    if not types and asks.limit(ASKS * shared.SENT + 1).count() <= ASKS * shared.SENT:
        return _kept(summed(facts, asks, ground, key, least, best), key, best)
    few = sendable(asks)
    found = facts.join(sent(asks, few), "term").groupBy("query_id", key).agg(F.sum("w").alias("s"), F.count("hit").alias("hits"), F.count("in_title").alias("m"), F.max("alias").alias("alias"), F.max("phrase").alias("phrase"), F.max("sem").alias("sem"))
    # a run of words tells of documents that something else finds
    found = found.where((F.col("hits") > 0) | (F.col("m") > 0) | F.col("alias").isNotNull() | F.col("sem").isNotNull()).join(sent(ground, few), "query_id")
    none = lambda c: F.coalesce(c, F.lit(0.0))
    signals = {"lex": round4(none(F.col("s")) / (none(F.col("s")) + SCALE)), "sem": none(F.col("sem")), "alias": none(F.col("alias")), "title": F.when(F.col("m") > 0, F.col("m") / F.col("known")).otherwise(0.0), "overlap": F.col("hits") / F.col("typed"), "phrase": none(F.col("phrase"))}
    found = found.select("query_id", key, "known", "typed", *[c.alias(n) for n, c in signals.items()])
    score = fuse(*[F.col(c) for c in ("lex", "sem", "alias", "title", "phrase", "overlap", "known", "typed")])
    out = found.select("query_id", key, score.alias("score"), "lex", "sem", "alias", "title", "overlap", "phrase", "known", "typed")
    return _kept(out if least is None else out.where((F.col("score") >= least) | (F.col("phrase") == 1)), key, best)


def _kept(found: DataFrame, key: str, best: int | None) -> DataFrame:
    return found if best is None else top(found, key, key, best, 0.0).drop("rank")


#: Facts that a task holds at once; the last document of a part goes on to the next. What
#: questions ask for is held in every task up to ``ASKS`` times ``SENT`` rows (some 20 MB).
PART, ASKS = 400_000, 20


def summed(facts: DataFrame, asks: DataFrame, ground: DataFrame, key: str, least: float | None, best: int | None) -> DataFrame:
    """The pairs of ``hybrid`` with their score, for questions that ask for a bounded
    number of facts: facts by document are added up question by question, over the documents of a part
    at once. Only what is asked for leaves the task; no row is made of any other pair."""
    kinds, session = dict(facts.dtypes) | dict(asks.dtypes), facts.sparkSession
    wants = asks.toPandas().merge(ground.toPandas(), on="query_id").sort_values("query_id")  # counted: few
    shared_wants = session.sparkContext.broadcast(wants)
    numbers = ("score", "lex", "sem", "alias", "title", "overlap", "phrase")

    def run(batches):
        import pandas as pd

        own, held = shared_wants.value, []
        names = pd.Index(own["term"].unique())
        own = [(q, names.get_indexer(g["term"]), int(g["known"].iloc[0]), int(g["typed"].iloc[0])) for q, g in own.groupby("query_id")]
        for pdf in batches:
            held.append(pdf)
            if sum(map(len, held)) >= PART:
                rows = pd.concat(held, ignore_index=True)
                cut = int((rows[key] == rows[key].iloc[-1]).to_numpy().argmax())
                held = [rows.iloc[cut:]]
                yield from _pairs(rows.iloc[:cut], own, names, key, least, best)
        if held:
            yield from _pairs(pd.concat(held, ignore_index=True), own, names, key, least, best)

    schema = f"query_id {kinds['query_id']}, `{key}` {kinds[key]}, " + ", ".join(f"{c} double" for c in numbers) + ", known long, typed long"
    return facts.sortWithinPartitions(key).mapInPandas(run, schema)


def _pairs(rows, own: list, names, key: str, least: float | None, best: int | None):
    """Frames of the pairs that are asked for, of whole documents sorted by key."""
    import numpy as np
    import pandas as pd

    if not len(rows):
        return
    ids = rows[key].to_numpy()
    first = np.r_[True, ids[1:] != ids[:-1]]
    doc, n = np.cumsum(first) - 1, int(first.sum())
    ids, ask = ids[first], names.get_indexer(rows["term"])

    def facts(column: str):
        """Documents and values by what asks for them."""
        value = rows[column].to_numpy(dtype=float, na_value=np.nan)
        at = np.flatnonzero(~np.isnan(value) & (ask >= 0))
        at = at[np.argsort(ask[at], kind="stable")]
        return doc[at], value[at], np.searchsorted(ask[at], np.arange(len(names) + 1))

    parts = {c: facts(c) for c in ("w", "hit", "in_title", "alias", "phrase", "sem")}

    def of(column: str, wanted, largest: bool = False):
        docs, values, starts = parts[column]
        spans = [slice(starts[a], starts[a + 1]) for a in wanted[starts[wanted] < starts[wanted + 1]]]
        if largest:
            out = np.full(n, -np.inf)
            for span in spans:
                np.maximum.at(out, docs[span], values[span])
            return out
        if not spans:
            return np.zeros(n)
        return np.bincount(np.concatenate([docs[x] for x in spans]), np.concatenate([values[x] for x in spans]), n)

    def frame():
        return pd.DataFrame({c: np.concatenate([x[c] for x in made]) for c in made[0]})

    def rounded(x):
        return np.floor(np.minimum(x, 1.0) * 10000 + 0.5) / 10000

    made, size = [], 0
    for query, wanted, known, typed in own:
        s, hits, m = of("w", wanted), of("hit", wanted), of("in_title", wanted)
        alias, phrase, sem = (of(c, wanted, True) for c in ("alias", "phrase", "sem"))
        at = np.flatnonzero((hits > 0) | (m > 0) | (alias > -np.inf) | (sem > -np.inf))
        if not len(at):
            continue
        s, hits, m = s[at], hits[at], m[at]
        alias, phrase, sem = (np.where(x[at] > -np.inf, x[at], 0.0) for x in (alias, phrase, sem))
        lex, overlap, title = rounded(s / (s + SCALE)), hits / typed, np.where(m > 0, m / max(known, 1), 0.0)
        score = 0.42 * lex + 0.24 * np.maximum(sem, 0.0) + 0.14 * alias + 0.12 * title + 0.08 * phrase
        score = rounded(np.where((overlap == 0) & (alias == 0), score * 0.3, score) * (known / typed) ** 1.5)
        good = np.arange(len(at)) if least is None else np.flatnonzero((score >= least) | (phrase == 1))
        if best is not None and len(good) > best:
            good = good[np.lexsort((ids[at[good]], -score[good]))[:best]]
        if len(good):
            columns = {"score": score, "lex": lex, "sem": sem, "alias": alias, "title": title, "overlap": overlap, "phrase": phrase}
            made.append({"query_id": np.full(len(good), query), key: ids[at[good]], **{c: v[good] for c, v in columns.items()}, "known": np.full(len(good), known), "typed": np.full(len(good), typed)})
            size += len(good)
        if size > 100_000:
            yield frame()
            made, size = [], 0
    if made:
        yield frame()


def _ask(kind: str, column: str) -> Column:
    """What asks for a fact, apart from terms by a sign that no term has."""
    return F.concat(F.lit(f"{kind}:"), F.col(column).cast("string")).alias("term")


def _alias_facts(queries: DataFrame, aliases: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(query_id, a): aliases that stand in a question, and (key, a, alias): the documents
    of these with the score, as in ``alias_scores``."""
    own = queries.select("query_id", F.trim(F.regexp_replace(normalise(F.col("question")), "[^a-z0-9_]+", " ")).alias("q"))
    known = aliases.select(key, F.trim(F.regexp_replace(normalise(F.col("alias")), "[^a-z0-9_]+", " ")).alias("a")).where(F.length("a") >= 3)
    met = own.withColumn("word", F.explode(F.array_distinct(F.split("q", " ")))).join(known.select("a").distinct().withColumn("word", F.substring_index("a", " ", 1)), "word")
    hit = F.concat(F.lit(" "), F.col("q"), F.lit(" ")).contains(F.concat(F.lit(" "), F.col("a"), F.lit(" ")))
    met = written(met.where(hit).select("query_id", "a").distinct(), "named")
    return met, known.join(met.select("a").distinct(), "a", "left_semi").select(key, "a", F.least(F.lit(1.0), 0.6 + F.length("a") / 40).alias("alias"))


def _run_facts(chunks: DataFrame, runs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, run): runs of two words that stand in a text: the first ends a word of it, the
    second begins the next. Joined by hash on the three letters either side of the blank,
    which all words of runs have; texts go nowhere."""
    runs = written(runs.withColumn("first", F.substring_index("run", " ", 1)).withColumn("second", F.substring_index("run", " ", -1)), "runs")
    runs = runs.withColumn("around", F.concat_ws(" ", F.right("first", F.lit(3)), F.left("second", F.lit(3))))
    words = chunks.where(F.col(text).isNotNull()).select(key, F.split(normalise(F.col(text)), " ").alias("words")).where(F.size("words") > 1)
    pairs = words.select(key, F.explode(F.arrays_zip(F.slice("words", F.lit(1), F.size("words") - 1).alias("a"), F.slice("words", F.lit(2), F.size("words") - 1).alias("b"))).alias("p")).select(key, "p.a", "p.b")
    pairs = pairs.where((F.length("a") > 2) & (F.length("b") > 2)).withColumn("around", F.concat_ws(" ", F.right("a", F.lit(3)), F.left("b", F.lit(3))))
    met = pairs.join(sent(runs, sendable(runs)), "around").where(F.col("a").endswith(F.col("first")) & F.col("b").startswith(F.col("second")))
    return met.select(key, "run").distinct()


def answers(queries: DataFrame, ranked: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Every question once: band of its best score, or that it abstains, and a note
    with up to six of its terms that the corpus does not know."""
    unknown = terms(queries, "query_id", "question").distinct().join(vocabulary.select("term").distinct(), "term", "left_anti")
    notes = unknown.groupBy("query_id").agg(F.array_join(F.slice(F.array_sort(F.collect_set("term")), 1, 6), ", ").alias("unknown"))
    best = ranked.groupBy("query_id").agg(F.max("score").alias("best"), F.count(F.lit(1)).alias("n"))
    out = queries.select("query_id").join(best, "query_id", "left").join(notes, "query_id", "left")
    return out.select("query_id", F.coalesce("n", F.lit(0)).alias("n"), band(F.coalesce("best", F.lit(0.0))).alias("band"), F.col("n").isNull().alias("abstained"), F.coalesce("unknown", F.lit("")).alias("unknown"))


def citations(ranked: DataFrame, chunks: DataFrame, key: str) -> DataFrame:
    """Flat provenance of what was found: rank, chunk, title, source and score."""
    return ranked.select("query_id", "rank", key, "score").join(chunks.select(key, "title", "source"), key).select("query_id", "rank", key, "title", "source", "score", band(F.col("score")).alias("band"))


def round4(x: Column) -> Column:
    return F.floor(F.least(x, F.lit(1.0)) * 10000 + 0.5) / 10000


def fuse(lex: Column, sem: Column, alias: Column, title: Column, phrase: Column, overlap: Column, known: Column, typed: Column) -> Column:
    """Weighted signals, less if nothing typed is there, damped by unknown words."""
    s = 0.42 * lex + 0.24 * F.greatest(sem, F.lit(0.0)) + 0.14 * alias + 0.12 * title + 0.08 * phrase
    s = F.when((overlap == 0) & (alias == 0), s * 0.3).otherwise(s)
    return round4(s * F.pow(F.when(typed > 0, known / typed).otherwise(0.0), F.lit(1.5)))


def band(score: Column) -> Column:
    return F.when(score >= HIGH, "high").when(score >= MODERATE, "moderate").when(score >= FLOOR, "low").otherwise("none")


def top(scored: DataFrame, key: str, doc: str, k: int = 5, floor: float = FLOOR, per_doc: int = PER_DOC) -> DataFrame:
    """At most ``per_doc`` of a document, then the best k above the floor."""
    best = [F.col("score").desc(), F.col(key).asc()]
    # a document that is its own chunk has one row a question
    capped = scored if key == doc and per_doc else scored.withColumn("_d", F.row_number().over(Window.partitionBy("query_id", doc).orderBy(*best))).where(F.col("_d") <= per_doc)
    kept = capped.where(F.col("score") >= floor).withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*best)))
    return kept.where(F.col("rank") <= k).drop("_d")


def phrase_runs(question: Column) -> Column:
    """Runs of two words over two letters. A longer run stands in a text only if its
    first two words do, so these decide for runs of up to four words as well."""
    words = F.filter(F.split(normalise(question), " "), lambda w: F.length(w) > 2)
    pairs = F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i)))
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def phrase_hit(question: Column, text: Column) -> Column:
    """Whether any run of 2 to 4 words over two letters stands in the text."""
    plain = normalise(text)
    return F.exists(phrase_runs(question), lambda r: plain.contains(r))


def evaluate(ranked: DataFrame, expected: DataFrame, doc: str, unanswerable: DataFrame | None = None) -> DataFrame:
    """Precision at 1, 3 and 5 (strict, and by what there is to find), hit at 1, 3 and 5,
    mean reciprocal rank; with ``unanswerable`` (query_id) also their number, the share
    of them that was refused and how many were answered all the same.

    Documents count once, at their best rank. ``expected``: query_id and document; a
    question of it that has no ranked row counts as missed."""
    first = ranked.groupBy("query_id", doc).agg(F.min("rank").alias("r"))
    place = first.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("r", doc)))
    marked = place.join(expected.withColumn("hit", F.lit(1)), ["query_id", doc], "left")
    per = marked.groupBy("query_id").agg(
        *[F.sum(F.when((F.col("rank") <= k) & F.col("hit").isNotNull(), 1).otherwise(0)).alias(f"h{k}") for k in (1, 3, 5)],
        F.min(F.when(F.col("hit").isNotNull(), F.col("rank"))).alias("first"),
    )
    asked = expected.groupBy("query_id").agg(F.count(F.lit(1)).alias("relevant")).join(per, "query_id", "left").fillna(0, ["h1", "h3", "h5"])
    mean = lambda x: round4(F.avg(x))
    out = asked.agg(
        F.count(F.lit(1)).alias("questions"),
        *[mean(F.col(f"h{k}") / k).alias(f"p{k}") for k in (1, 3, 5)],
        *[mean(F.col(f"h{k}") / F.least(F.lit(k), F.col("relevant"))).alias(f"np{k}") for k in (3, 5)],
        *[mean((F.col(f"h{k}") > 0).cast("double")).alias(f"hit{k}") for k in (1, 3, 5)],
        mean(F.coalesce(1 / F.col("first"), F.lit(0.0))).alias("mrr"),
    )
    if unanswerable is None:
        return out
    answered = unanswerable.select("query_id").distinct().join(ranked.select("query_id", F.lit(1).alias("any")).distinct(), "query_id", "left")
    refused = answered.agg(F.count(F.lit(1)).alias("controls"), round4(F.avg(F.col("any").isNull().cast("double"))).alias("abstention"), F.count("any").alias("false_answers"))
    return out.crossJoin(refused)  # one row each
