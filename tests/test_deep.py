"""Containment, early stop, nearest vectors, incremental state, publishing, questions."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrafold import contract
from terrafold.operators import corpus, filters, impact, interpret, latent, nearest, retrieval, spatial
from terrafold.plans.consolidate import latest, permit_rollup
from terrafold.sources import publish
from terrafold.streaming import buckets, feeds
from terrafold.streaming.rollups import PERMIT, PermitRollups


def test_points_in_polygons_equal_ray_casting(spark):
    rnd = random.Random(1)
    rings = {}
    for k in range(12):
        x, y, n = rnd.uniform(-3, 3), rnd.uniform(-3, 3), rnd.randint(3, 9)
        rings[k] = [(x + rnd.uniform(0.05, 2) * math.cos(a), y + rnd.uniform(0.05, 2) * math.sin(a)) for a in sorted(rnd.uniform(0, 6.28) for _ in range(n))]
    rings[12] = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    points = [(k, rnd.uniform(-5, 5), rnd.uniform(-5, 5)) for k in range(2000)] + [(3000, 0.0, 0.0), (3001, 1.0, 0.5), (3002, 0.5, 0.0), (3003, None, 1.0), (3004, 0.0, 0.5)]

    def inside(px, py, ring):
        odd = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (y1 <= py) != (y2 <= py) and px < x1 + (py - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
        return odd

    areas = spark.createDataFrame([*rings.items(), (90, []), (91, None), (92, [(0.0, 0.0), (1.0, 1.0)])], "area int, ring array<struct<x:double,y:double>>")
    df = spark.createDataFrame([(*p, 7) for p in points], "id int, lon double, lat double, mixed int")
    got = spatial.contained(df, areas, "lon", "lat", "area", "ring", cell=0.3)
    want = {(i, k) for i, x, y in points if x is not None for k, ring in rings.items() if inside(x, y, ring)}
    assert {(r["id"], r["area"]) for r in got.collect()} == want and got.count() == len(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert spatial.covering_cells(areas, "area", "ring", 0.3).where("whole and size(edges) > 0").count() == 0


def test_early_stop_equals_the_full_computation(spark):
    rnd = random.Random(2)
    words = [f"w{k}" for k in range(120)]
    docs = [(k, " ".join(["common"] * rnd.randint(0, 3) + rnd.choices(words, [1 / (j + 1) for j in range(120)], k=rnd.randint(0, 40)))) for k in range(400)] + [(900, None), (901, "")]
    asked = [(q, " ".join(["common", *rnd.choices(words, k=rnd.randint(1, 5))])) for q in range(25)] + [(90, "nothing known here"), (91, None), (92, "common")]
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(asked, "query_id long, question string")
    post = retrieval.postings(d, "doc_id", "text")
    full = retrieval.top(retrieval.bm25(d, q, "doc_id", "text", post).select("query_id", "doc_id", "score"), "doc_id", "doc_id", 5, 0.0)
    rows = impact.laid_out(impact.blocks(impact.weighted(post, d.agg(F.count(F.lit(1)).alias("n_docs")), "doc_id"), "doc_id", 16), "doc_id")
    got = impact.best(rows, impact.heads_of(rows), q, "doc_id", 5)
    pick = lambda df: sorted((r["query_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect())
    assert pick(got) == pick(full)


@pytest.mark.parametrize("shape", ["spread", "clustered"])
def test_nearest_is_exact(spark, shape, monkeypatch):
    monkeypatch.setattr(nearest, "GROUP", 50)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 12)) if shape == "spread" else rng.normal(size=(6, 12))[rng.integers(0, 6, 600)] + rng.normal(size=(600, 12)) * 0.1
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[200:330] = x[200]  # one vector of many rows: ties go to the smaller id
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)] + [(700, [0.0] * 12), (701, None)], "id long, v array<double>")
    asked = rows.where("id % 20 = 0").withColumnRenamed("id", "query_id")
    got = {}
    for r in nearest.nearest(rows, asked, 10, cells=16).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["id"]
    full = np.round(np.vstack([x, np.zeros((1, 12))]) @ np.vstack([x, np.zeros((1, 12))]).T, 9)
    ids = np.array([*range(600), 700])
    for q in ids[ids % 20 == 0]:
        line = full[list(ids).index(q)]
        assert [got[q][k] for k in range(1, 11)] == ids[np.lexsort((ids, -line))[:10]].tolist()
    assert nearest.nearest(rows.where("false"), asked, 3).count() == 0


def test_a_chunk_without_a_typed_word_is_found(spark):
    """Cars and automobiles share the words around them, not a word of the question."""
    rnd = random.Random(5)
    one, other = "engine wheel brake clutch motor gear".split(), "dough flour oven yeast crust loaf".split()
    docs = [(k, " ".join([("car" if k % 2 else "automobile"), *rnd.choices(one, k=12)])) for k in range(40)] + [(100 + k, " ".join(["bread", *rnd.choices(other, k=12)])) for k in range(40)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    post = retrieval.postings(d, "doc_id", "text")
    terms, rows, _ = latent.latent_space(retrieval.tfidf(post, "doc_id", d.agg(F.count(F.lit(1)).alias("n_docs"))), "doc_id", k=2, extra=4)
    asked = retrieval.expanded(spark.createDataFrame([(1, "car")], "query_id long, question string"), spark.createDataFrame([], "trigger string, term string"))
    found = nearest.nearest(rows.select(F.col("doc_id").alias("id"), "v"), latent.folded(asked, terms, 2), 40)
    ids = {r["id"] for r in found.collect()}
    assert ids == set(range(40)) and any(k % 2 == 0 for k in ids)


def _permits(rows):
    return [(n, k, dt.date(2000, 1, 1) + dt.timedelta(days=d), t, s, dt.date(2000, 1, 1) + dt.timedelta(days=m)) for n, k, d, t, s, m in rows]


def test_rollups_by_batches_equal_a_rebuild(spark, tmp_path):
    rnd = random.Random(6)
    rows = _permits((rnd.randint(0, 25), rnd.randint(0, 9), rnd.randint(0, 300), rnd.choice(["RF", "ROR", "BLD"]), rnd.choice(["ISSUED", "INSPECT", "COMPLETE"]), rnd.randint(0, 60)) for _ in range(90))
    everything = spark.createDataFrame(rows, PERMIT)
    state = PermitRollups(spark, f"file://{tmp_path}/state", buckets=4)
    cuts = [rows[:30], rows[20:55], rows[55:]]  # some arrive twice, many late, permits move between parcels
    for k, part in enumerate(cuts):
        state.merge(spark.createDataFrame(part, PERMIT), k)
    state.merge(spark.createDataFrame(cuts[2], PERMIT), 2)  # the last batch again, as after a restart
    state.merge(spark.createDataFrame([], PERMIT), 3)
    full = permit_rollup(latest(everything, "number", "modified"))
    assert sorted(map(tuple, state.rollups().collect()), key=str) == sorted(map(tuple, full.collect()), key=str)
    assert sorted(map(tuple, state.permits().collect())) == sorted(map(tuple, latest(everything, "number", "modified").collect()))


def test_a_stream_of_permits_keeps_the_rollups(spark, tmp_path):
    rows = _permits([(1, 1, 0, "RF", "ISSUED", 1), (1, 1, 0, "RF", "COMPLETE", 5), (2, 1, 3, "BLD", "ISSUED", 2), (2, 3, 3, "BLD", "ISSUED", 4), (1, 1, 0, "RF", "ISSUED", 1)])
    schema = PERMIT.replace("modified date", "modified timestamp")
    stamped = [(*r[:5], dt.datetime.combine(r[5], dt.time())) for r in rows]
    for k in range(3):
        spark.createDataFrame(stamped[k::3], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    state = PermitRollups(spark, f"file://{tmp_path}/state", buckets=3)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    feeds.permit_feed(stream, state.follow(), f"{tmp_path}/cp").awaitTermination(120)
    full = permit_rollup(latest(spark.createDataFrame(rows, PERMIT), "number", "modified"))
    assert sorted(map(tuple, state.rollups().collect()), key=str) == sorted(map(tuple, full.collect()), key=str)


def _loop(events, capacity, per_minute):
    """One caller at a time, in fractions."""
    from fractions import Fraction

    rate, out, held = Fraction(per_minute).limit_denominator(1000) / 60_000_000, {}, {}
    for e, u, at in sorted(events, key=lambda r: (r[1], r[2], r[0])):
        left, before = held.get(u, (Fraction(capacity), at))
        left = min(Fraction(capacity), left + (at - before) * rate)
        out.setdefault(e, []).append((left < 1, round(float(max(0, 1 - left) / rate / 1_000_000), 6)))
        held[u] = (left - 1 if left >= 1 else left), at
    return {e: sorted(x) for e, x in out.items()}


def _stamp(us):
    return dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=us)


@pytest.mark.parametrize("capacity,per_minute", [(5, 10.0), (1, 7.3), (3, 600.0)])
def test_token_bucket_equals_a_loop_with_a_hot_caller(spark, capacity, per_minute):
    rnd = random.Random(capacity)
    events = [(k, 1 if rnd.random() < 0.7 else rnd.randint(2, 6), rnd.randint(0, 600) * 500_000) for k in range(700)] + [(3, 9, 5), (3, 9, 5)]
    df = spark.createDataFrame([(e, u, _stamp(at), "x") for e, u, at in events] + [(999, None, _stamp(1), "x"), (998, 1, None, "x")], "event_id long, user_id long, ts timestamp, wait string")
    got = {}
    for r in buckets.token_bucket(df, capacity, per_minute, partitions=9).collect():
        got.setdefault(r["event_id"], []).append((r["refused"], round(r["wait"], 6)))
    assert {e: sorted(x) for e, x in got.items()} == _loop(events, capacity, per_minute)
    assert buckets.token_bucket(df.where("false")).count() == 0


def test_token_bucket_as_a_stream(spark, tmp_path):
    rnd = random.Random(8)
    events = sorted(((k, rnd.randint(1, 3), rnd.randint(0, 900) * 1_000_000) for k in range(120)), key=lambda r: r[2])
    for k in range(3):  # each file later than the one before
        spark.createDataFrame([(e, u, _stamp(at)) for e, u, at in events[k * 40 : k * 40 + 40]], "event_id long, user_id long, ts timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("event_id long, user_id long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        query = buckets.token_bucket_stream(stream, 3, 12.0).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
        query.awaitTermination(180)
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    got = {r["event_id"]: [(r["refused"], round(r["wait"], 6))] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == _loop(events, 3, 12.0)


def test_composed_buckets_are_small():
    rnd, policy, t, times = random.Random(9), buckets.Policy(5, 10.0), 0, []
    for _ in range(400):
        t += rnd.choice([0, 1, 1_000_000, 6_000_000, 60_000_000])
        times.append(t)
    pieces = policy.function(times)
    assert len(pieces) <= 20
    for x in range(0, policy.full + 1, 777_777):
        assert policy.value(pieces, x) == policy.run(times, x)[1]


def test_gate_refuses_before_anything_is_published(spark, tmp_path):
    good = spark.createDataFrame([(k, f"p{k}") for k in range(50)], "n int, folio string")
    path = f"file://{tmp_path}/table"
    for bad, said in ((good.union(good.limit(1)), "2 rows of one folio"), (good.union(spark.createDataFrame([(1, None)], good.schema)), "without folio"), (good.where("false"), "0 rows")):
        with pytest.raises(publish.Refused, match=said):
            publish.publish(bad, path, "folio")
        assert not publish.there(spark, path) and not list(tmp_path.iterdir())
    assert publish.publish(good, path, "folio") == {"rows": 50, "nulls": 0, "most": 1}
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == sorted(map(tuple, good.collect()))
    with pytest.raises(publish.Refused, match="already"):
        publish.publish(good, path, "folio")


def test_newest_run_reads_one_partition(spark, tmp_path):
    path = f"file://{tmp_path}/runs"
    assert publish.newest_run(spark, path) is None
    for run in ("20240101", "20240103", "20240102"):
        publish.write_run(spark.range(5).withColumn("v", F.lit(run)), path, run)
    (tmp_path / "runs" / "run_id=20240109").mkdir()  # a run that never ended
    got = publish.newest_run(spark, path, "id bigint, v string")
    assert {(r["v"], r["run_id"]) for r in got.collect()} == {("20240103", "20240103")}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan
    assert len(got.inputFiles()) >= 1 and got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_changed_or_torn_index_is_refused(spark, tmp_path):
    folder = f"file://{tmp_path}/index"
    with pytest.raises(publish.Refused, match="no index"):
        publish.load_index(spark, folder)
    post = spark.createDataFrame([("a", 1, 2), ("b", 1, 1), ("b", 2, 3)], "term string, doc_id long, tf long")
    publish.save_index({"postings": post, "lengths": post.groupBy("doc_id").agg(F.sum("tf").alias("len"))}, folder, "0001")
    held = publish.load_index(spark, folder)
    assert sorted(map(tuple, held["postings"].collect())) == sorted(map(tuple, post.collect()))
    publish.save_index({"postings": post}, folder, "0002")
    post.limit(2).write.mode("overwrite").parquet(f"{folder}/0002/postings")
    with pytest.raises(publish.Refused, match="changed"):
        publish.load_index(spark, folder)
    assert set(publish.load_index(spark, folder, "0001")) == {"postings", "lengths"}
    (tmp_path / "index" / "0001" / "lengths" / "_SUCCESS").unlink()
    with pytest.raises(publish.Refused, match="torn"):
        publish.load_index(spark, folder, "0001")
    post.select("term", F.col("doc_id").cast("int"), "tf").write.mode("overwrite").parquet(f"{folder}/0002/postings")
    with pytest.raises(publish.Refused, match="schema"):
        publish.load_index(spark, folder, "0002")


@pytest.mark.parametrize("sort,descending", [("v", True), ("v", False), (None, True)])
def test_pages_by_key_are_the_sorted_table(spark, sort, descending):
    rnd = random.Random(10)
    rows = [(f"p{k:03d}", rnd.choice([None, 1.0, 2.0, 2.0, 3.5, 9.0])) for k in range(97)]
    df = spark.createDataFrame(rows, "property_id string, v double")
    got, token = [], None
    while True:
        page = filters.page_after(df, sort, descending, limit=9, token=token)
        own = [tuple(r) for r in page.collect()]
        if not own:
            break
        got += own
        token = filters.page_token(page, sort)
    sign = -1 if descending else 1
    assert got == sorted(rows, key=lambda r: (r[1] is None, sign * (r[1] or 0), r[0]) if sort else r[0])


def test_reasons_travel_with_their_columns(spark, tmp_path):
    row = {f.name: None for f in contract.SCHEMA} | {"property_id": "p1"}
    view = contract.annotated(spark.createDataFrame([tuple(row.values())], contract.SCHEMA)).where("property_id = 'p1'").select("bbb_rating", "property_id")
    view.write.parquet(f"file://{tmp_path}/t")
    back = contract.schema_listing(spark.read.parquet(f"file://{tmp_path}/t")).collect()
    assert [(r["name"], r["always_null"], r["reason"]) for r in back] == [("bbb_rating", True, contract.REASONS["bbb_rating"]), ("property_id", False, None)]


ASKED = {
    "older roofs in Clermont": {"city": "CLERMONT", "min_roof_age": 15},
    "find out which homes in Clermont have aged roofs": {"city": "CLERMONT", "min_roof_age": 15},
    "sold out homes": {},
    "worth more than 250 k": {"min_market_value": 250_000.0},
    "worth under 250,000": {"max_market_value": 250_000.0},
    "roofing permits still open more than five years": {"min_open_permit_days": 1825, "has_open_roofing_permit": True},
    "absentee owners outside the county": {"owner_out_of_county": True},
    "aged roofs outside Clermont": None,
    "parcels other than Clermont": None,
    "aged roofs not in Clermont": None,
    "roofs 20 years or older in Mount Dora": {"city": "MOUNT DORA", "min_roof_age": 20},
    "never sold single family homes built after 1980": {"property_type": "SingleFamily", "no_recorded_sale": True, "min_built_year": 1981},
    "XY parcels with a permit": {"property_type": "XY", "has_permits": True},
    "out-of-state owners with no recorded sale": {"owner_out_of_state": True, "no_recorded_sale": True},
}


def test_questions_by_concepts(spark):
    entries = lambda *x: spark.createDataFrame([(e,) for e in x], "entry string")
    asked = spark.createDataFrame([*enumerate(ASKED), (90, None), (91, "")], "query_id long, question string")
    got = {r["question"]: r for r in interpret.interpret_questions(asked, entries("CLERMONT", "MOUNT DORA", None, ""), entries("SingleFamily", "XY", None)).collect()}
    for question, want in ASKED.items():
        found = {n: got[question][n] for n in interpret.FILTERS if got[question][n] is not None}
        assert found == (want or {}), question
        assert got[question]["declined"] == (want is None), question
        assert got[question]["about_parcels"] == bool(want), question
    assert got["older roofs in Clermont"]["q"] is None and got["worth under 250,000"]["q"] is None


def test_chunks_of_sections_carry_their_trail(spark):
    text = "# One\n" + "a" * 50 + "\n## Two\nshort\n## Three\n" + "\n\n".join(["b" * 900, "c" * 900]) + "\n# Four\n" + "d" * 45
    sections = corpus.markdown_sections(spark.createDataFrame([(7, text, "Guide")], "doc_id long, text string, title string"), "doc_id", "text").withColumn("title", F.lit("Guide"))
    got = sorted(map(tuple, corpus.section_chunks(sections, "doc_id", "title").select("chunk_id", "chunk_count", "trail", "text").collect()))
    assert [(g[0], g[1], g[2]) for g in got] == [("7#0", 4, "Guide > One"), ("7#1", 4, "Guide > One > Three"), ("7#2", 4, "Guide > One > Three"), ("7#3", 4, "Guide > Four")]
    assert got[0][3] == "Guide > One\n\n" + "a" * 50 and got[2][3].endswith("b" * 200 + "\n\n" + "c" * 900)


def test_evaluation_counts_refusals(spark):
    ranked = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (2, 12, 1), (9, 13, 1)], "query_id long, doc_id long, rank int")
    expected = spark.createDataFrame([(1, 11), (2, 12), (3, 5)], "query_id long, doc_id long")
    controls = spark.createDataFrame([(8,), (9,)], "query_id long")
    r = retrieval.evaluate(ranked, expected, "doc_id", controls).first()
    assert (r["questions"], r["p1"], r["hit3"], r["mrr"], r["controls"], r["abstention"], r["false_answers"]) == (3, 0.3333, 0.6667, 0.5, 2, 0.5, 1)


def test_kept_tables_follow_their_inputs_and_can_be_deleted(spark, tmp_path):
    from terrafold.sources import shared

    folder, built = f"file://{tmp_path}", []

    def build():
        built.append(1)
        return spark.read.parquet(f"{folder}/t.parquet").agg(F.count(F.lit(1)).alias("n"))

    ask = lambda: shared.kept(spark, "counted", (folder,), build).first()["n"]
    spark.range(5).write.parquet(f"{folder}/t.parquet")
    assert (ask(), ask(), len(built)) == (5, 5, 1)
    spark.range(2).write.mode("append").parquet(f"{folder}/t.parquet")
    assert (ask(), len(built)) == (7, 2)
    assert shared.clean(spark) >= 2
    assert (ask(), len(built)) == (7, 3)  # gone, so built again
