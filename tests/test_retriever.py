"""The retriever's signals against loops, and what its plan must not do."""

from pyspark.sql import functions as F

from terrafold.operators import retrieval
from terrafold.sources import shared

DOCS = [(1, "src1 The old roof house", "the old roof house stands by the river", "en"), (2, "src2 permits", "open permits for roofs and breathe catalog", "de"), (3, "src1 nothing", "", "en"), (4, "src3", None, "en"), (5, "src2 river bank", "rivers of bank notes; old roofing", "fr")]
ASKED = [(1, "old roof of the house"), (2, "the cat permits"), (3, "unknownword"), (4, None), (5, "river bank")]


def signals(spark, **given):
    docs = spark.createDataFrame(DOCS, "doc_id long, title string, text string, lang string")
    asked = spark.createDataFrame(ASKED, "query_id long, question string")
    aliases = spark.createDataFrame([(1, "old roof"), (3, "Permits"), (5, "river-bank"), (4, None)], "doc_id long, alias string")
    return docs, asked, aliases, retrieval.hybrid(docs, asked, aliases, retrieval.postings(docs, "doc_id", "text"), "doc_id", **given)


def test_signals_are_those_of_each_alone(spark, monkeypatch):
    for few in (20_000, 0):
        monkeypatch.setattr(shared, "SENT", few)
        docs, asked, aliases, found = signals(spark)
        post = retrieval.postings(docs, "doc_id", "text")
        pick = lambda df, c: {(r["query_id"], r["doc_id"]): round(r[c], 9) for r in df.collect() if r[c]}
        lexical = retrieval.bm25(docs, asked, "doc_id", "text", post)
        assert pick(found, "lex") == pick(lexical, "score") and pick(found, "overlap") == pick(lexical, "overlap")
        assert pick(found, "alias") == pick(retrieval.alias_scores(asked, aliases, "doc_id"), "alias")
        assert pick(found, "title") == pick(retrieval.title_scores(asked, docs, "doc_id", post), "title")
        met = found.select("query_id", "doc_id", "phrase").join(asked, "query_id").join(docs.select("doc_id", "text"), "doc_id")
        assert met.where((F.col("phrase") == 1) != F.coalesce(retrieval.phrase_hit(F.col("question"), F.col("text")), F.lit(False))).count() == 0
        assert met.where("phrase = 1").count() > 0
        # found by its alias alone: no lexical score
        assert found.where("doc_id = 3 and alias > 0 and lex = 0").count() == 1
        assert not found.where("doc_id in (2, 5)").exceptAll(signals(spark, types=("lang", ["de", "fr"]))[3]).count()


def test_pairs_stay_with_their_documents(spark):
    plan = signals(spark)[3]._jdf.queryExecution().sparkPlan().toString()
    assert "normalise" not in plan and plan.count("REPARTITION_BY_NUM") == 1
    executed = signals(spark)[3]
    executed.collect()
    final = executed._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert "hashpartitioning(query_id" not in final


def test_only_pairs_asked_for_are_made(spark, monkeypatch):
    rows = lambda df: sorted(map(tuple, df.select("query_id", "doc_id", "score", "phrase", "known", "typed").collect()))
    everything = rows(signals(spark)[3])
    asked_for = [r for r in everything if r[2] >= 0.3 or r[3] == 1]
    two = sorted(r for q in range(1, 6) for r in sorted((r for r in everything if r[0] == q), key=lambda r: (-r[2], r[1]))[:2])
    assert asked_for != everything != two
    monkeypatch.setattr(retrieval, "PART", 3)
    found = signals(spark, least=0.3)[3]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan and "keys=[query_id" not in plan.partition("MapInPandas")[0]
    assert rows(found) == asked_for and rows(signals(spark, best=2)[3]) == two
