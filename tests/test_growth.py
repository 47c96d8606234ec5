"""What must not grow faster than the tables: stored columns."""

import numpy as np
from pyspark.sql import functions as F

from terrafold import contract
from terrafold.operators import impact, latent, retrieval
from terrafold.plans import consolidate as plan
from terrafold.sources import publish

SF = "/root/testdata/sf0.001"


def test_names_of_a_group_are_stored_once(spark, tmp_path):
    rows, names = plan.stored(spark, SF)
    assert plan.SHARED not in rows.columns and names.count() == names.select("nation").distinct().count()
    t = plan.properties(spark, SF)
    assert t.columns == [f.name for f in contract.SCHEMA]
    assert t.count() == rows.count() and t.where(f"{plan.SHARED} is not null").count() == t.where("has_business_account").count() > 0
    path = f"file://{tmp_path}/t"
    assert publish.publish(rows, path, "property_id", finish=lambda r: plan.named(r, names))["rows"] == t.count()
    assert not spark.read.parquet(path).exceptAll(t).count()


def test_vectors_of_terms_stay_where_they_are(spark):
    """X X'y sends a row a document and block of terms, however many words there are."""
    rows = [(f"w{d}-{k}" if k else "common", d, 1.0 + k) for d in range(30) for k in range(40)]
    weights, y = spark.createDataFrame(rows, "term string, doc long, w double"), spark.createDataFrame([(d, [float(d), 1.0]) for d in range(30)], "doc long, v array<double>")
    found = latent._through(weights, y, "doc", len(rows))
    got = {r["doc"]: r["v"] for r in found.collect()}
    own, common = sum((1.0 + k) ** 2 for k in range(1, 40)), np.array([sum(range(30)), 30.0])
    assert all(np.allclose(got[d], common + own * np.array([d, 1.0])) for d in range(30)) and len(got) == 30
    assert "term, " not in found._jdf.queryExecution().executedPlan().toString().partition("FlatMapCoGroupsInPandas")[0]


def test_no_task_gets_a_term_that_most_documents_have(spark):
    post = spark.createDataFrame([("common" if k % 2 else f"w{k % 90}", k, 1 + k % 3) for k in range(400)], "term string, doc long, tf long")
    plan = retrieval.tfidf(post, "doc", spark.createDataFrame([(400,)], "n_docs long"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_no_task_holds_the_vectors_of_all_documents(spark, monkeypatch):
    """Documents pass a block of terms chunk by chunk; chunks, blocks, kinds of keys and a missing key change nothing."""
    rng = np.random.default_rng(2)
    rows = [(f"t{j}", None if i == 7 else i, float(rng.random() + 0.1)) for i in range(120) for j in {0, *rng.integers(0, 60, 9), 1000 + i}]
    found = []
    for chunk, terms, kind in ((2048, 200_000, "long"), (16, 4, "long"), (16, 4, "string")):
        monkeypatch.setattr(latent, "CHUNK", chunk)
        monkeypatch.setattr(latent, "TERMS", terms)
        weights = spark.createDataFrame(rows, "term string, doc long, w double").withColumn("doc", F.col("doc").cast(kind))
        words, docs, sigma = latent.latent_space(weights, "doc", 5, 10, 12)
        held = {str(r["doc"]): np.array(r["v"]) for r in docs.collect()}
        assert len(held) == 120 and words.count() == len({r[0] for r in rows})
        found.append((sigma, held))
        laid = latent._laid(latent._with_df(weights), "doc", 8, 8 if chunk == 16 else 1, 8).where("block is null")
        assert laid.agg(F.max(F.size("keys"))).first()[0] <= (30 if chunk == 16 else 119) and laid.agg(F.sum(F.size("keys"))).first()[0] == 120
    for sigma, held in found[1:]:
        assert np.allclose(sigma, found[0][0], rtol=1e-6)
        assert all(np.allclose(held[k] @ held["3"], found[0][1][k] @ found[0][1]["3"], atol=1e-4) for k in held)


def test_equal_questions_are_ranked_once(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"roof {'tile ' * (k % 4)} house w{k % 5}") for k in range(40)], "doc_id long, text string")
    asked = spark.createDataFrame([(q, [f"tile w{q % 3}", "house roof", None, "unheard"][q % 4]) for q in range(24)], "query_id long, question string")
    post = retrieval.postings(docs, "doc_id", "text")
    rows = impact.laid_out(impact.blocks(impact.weighted(post, spark.createDataFrame([(40,)], "n_docs long"), "doc_id"), "doc_id", 4), "doc_id")
    index, whole, seen = (rows, impact.heads_of(rows)), impact.best, []
    want = sorted(map(tuple, whole(*index, asked, "doc_id", 2).collect()))
    monkeypatch.setattr(impact, "best", lambda rows, heads, queries, *more: seen.append(queries.count()) or whole(rows, heads, queries, *more))
    got = impact.best_of_texts(*index, asked, "doc_id", 2).select("query_id", "doc_id", "score", "overlap", "rank")
    assert sorted(map(tuple, got.collect())) == want and len(want) == 24 and seen == [5]
