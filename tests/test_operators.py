"""Filters, gates, lifecycle, chunks, retrieval, questions and streams on small frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from terrafold.contract import SCHEMA, schema_gate
from terrafold.operators import corpus, interpret, provenance, retrieval, runs
from terrafold.operators.filters import matching, predicates, search
from terrafold.sources import readers
from terrafold.streaming import buckets, feeds


def properties(spark, *rows):
    names = [f.name for f in SCHEMA]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], SCHEMA)


@pytest.fixture
def table(spark):
    return properties(
        spark,
        {"property_id": "a", "address_city": "Mount Dora", "roof_age_years": 20, "owner_out_of_state": True, "has_permits": True, "open_roofing_permit_count": 1, "latitude": 28.8, "longitude": -81.6, "market_value": 5e5, "address_street": "1 Oak_St"},
        {"property_id": "b", "address_city": None, "roof_age_years": None, "owner_out_of_state": None, "has_permits": None, "open_roofing_permit_count": None, "longest_open_permit_days": None},
        {"property_id": "c", "address_city": "mount dora", "roof_age_years": 5, "owner_out_of_state": False, "has_permits": False, "open_roofing_permit_count": 0, "latitude": 29.8, "longitude": -81.6},
    )


def ids(df):
    return [r["property_id"] for r in df.orderBy("property_id").collect()]


def test_nulls_in_filters(table):
    assert ids(matching(table, has_permits=False)) == ["b", "c"]
    assert ids(matching(table, owner_out_of_state=False)) == ["c"]
    assert ids(matching(table, has_open_roofing_permit=False)) == ["b", "c"]
    assert ids(matching(table, min_open_permit_days=0)) == ["a", "b", "c"]
    assert ids(matching(table, city=" MOUNT dora ")) == ["a", "c"]
    assert ids(matching(table, q="oak\\_")) == []
    assert ids(matching(table, q="oak_s%")) == ["a"]
    assert ids(matching(table, lat=28.8, lon=-81.6, radius_miles=1.0)) == ["a"]


def test_filters_are_validated(table):
    for bad in ({"colour": "red"}, {"lat": 1.0}, {"min_roof_age": 501}, {"q": " "}, {"roof_age_basis": "guess"}, {"lat": 0.0, "lon": 0.0, "radius_miles": 0}):
        with pytest.raises(ValueError):
            predicates(**bad)
    with pytest.raises(ValueError):
        search(table, "no_such_column")


def test_pages_put_nulls_last(table):
    assert [r["property_id"] for r in search(table, "roof_age_years").collect()] == ["a", "c", "b"]
    assert [r["property_id"] for r in search(table, "roof_age_years", descending=False).collect()] == ["c", "a", "b"]
    assert search(table, limit=0).count() == 1 and search(table, offset=2).count() == 1


def test_gate(table):
    assert schema_gate(table) is table
    with pytest.raises(ValueError):
        schema_gate(table.withColumnRenamed("owner_name", "owner"))


def test_sources(spark, table, tmp_path):
    path = str(tmp_path / "t")
    table.write.parquet(path)
    assert readers.register(spark, path).count() == 3 and readers.relation(spark, "properties").count() == 3
    found, df = readers.first_readable(spark, [str(tmp_path / "none"), path])
    assert found == path and df.count() == 3
    with pytest.raises(OSError):
        readers.first_readable(spark, [str(tmp_path / "none")])
    assert readers.run_record(spark, str(tmp_path / "none.json")) is None
    (tmp_path / "c.json").write_text('{"county": "X", "permits": {"jurisdictions": [{"name": "j", "supported": true, "certified": null}]}}')
    assert readers.jurisdictions(readers.run_record(spark, str(tmp_path / "c.json"), readers.CATALOG)).first()["harvested"] is False
    readers.write_shards(table.select("property_id"), str(tmp_path / "s"), "property_id", 2)
    assert spark.read.json(str(tmp_path / "s")).count() == 3
    assert readers.manifest(spark, path).where("name like 'part%'").count() >= 1
    rows, more = readers.bounded(spark, "SELECT * FROM properties", 2)
    assert rows.count() == 2 and more


def test_provenance(spark, table):
    df = properties(spark, {"property_id": "a", "source_systems": " fl_dor_nal_2026p || odd ", "enrichment_status": "bbb_gated_403;new_token"})
    assert [r["label"] for r in provenance.source_rows(df).orderBy("pos").collect()] == ["FL DOR NAL 2026 preliminary tax roll", "odd"]
    assert [r["severity"] for r in provenance.notice_rows(df).orderBy("pos").collect()] == ["gated", "unknown"]
    assert provenance.metric_record(spark.sql("SELECT 1 AS a, cast(null as int) AS b, '2024-01-01' AS c, '7' AS d")).count() == 2


def test_runs(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "id string, x int")
    new = spark.createDataFrame([("a", 1), ("b", 3), ("d", 4)], "id string, x int")
    assert {r["status"]: r["n"] for r in runs.row_delta(old, new, "id").collect()} == {"unchanged": 1, "updated": 1, "removed": 1, "inserted": 1}
    h = spark.createDataFrame([("r1", "x"), ("r2", "y")], "run_id string, v string")
    assert runs.history_breaches(h, h).count() == 0 and runs.history_breaches(h, h.where("run_id = 'r1'")).count() == 1
    pairs = spark.createDataFrame([("q", "5", "q", "5"), ("q", "5", "w", "4"), ("q", "5", "w", "6"), ("q", "5", "w", None)], "root string, run string, new_root string, new_run string")
    assert [r["action"] for r in runs.upgrade(pairs).collect()] == ["current", "keep", "upgrade", "keep"]
    counts = runs.count_delta(spark.createDataFrame([("t", 5)], "name string, n long"), spark.createDataFrame([("t", 7), ("u", 1)], "name string, n long"))
    assert {r["name"]: r["delta"] for r in counts.collect()} == {"t": 2, "u": None}


def test_windows_overlap(spark):
    text = "\n".join(f"{k}" * 400 for k in range(8))
    docs = spark.createDataFrame([(1, text), (2, "x" * 7000), (3, None), (4, "short")], "doc_id long, text string")
    got = corpus.chunks(docs).orderBy("chunk_id").collect()
    one = [r["body"] for r in got if r["doc_id"] == 1]
    assert all(len(b) <= 1500 + 201 for b in one) and one[1].startswith(one[0][-200:])
    assert {r["doc_id"] for r in got} == {1, 2}
    assert [r["chunk_id"] for r in got if r["doc_id"] == 1] == [f"1#{k}" for k in range(len(one))]


def test_heading_trail(spark):
    html = "<h1>A</h1><h2>B</h2><h3>C</h3><h2>D</h2><h4>E</h4>"
    got = corpus.heading_sections(spark.createDataFrame([(1, html)], "page_id long, html string")).orderBy("pos").collect()
    assert [r["trail"] for r in got] == ["A", "A > B", "A > B > C", "A > D", "A > D > E"]


def test_terms(spark):
    df = spark.createDataFrame([("The roof_age columns: running ‘copies’ classes is 7 x addressed",)], "t string")
    assert df.select(retrieval.tokenise(F.col("t")).alias("x")).first()["x"] == ["roof_age", "roof", "age", "column", "runn", "copy", "class", "7", "address"]


def test_retrieval_ranks_and_abstains(spark):
    docs = spark.createDataFrame([(k, f"filler words number {k} common text") for k in range(30)] + [(99, "zebra crossing permits in lakeside")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "zebra crossing"), (2, "unknown terms only")], "query_id long, question string")
    ranked = retrieval.top(retrieval.bm25(docs, asked, "doc_id", "text"), "doc_id", "doc_id", 3)
    assert [(r["query_id"], r["doc_id"]) for r in ranked.where("rank = 1").collect()] == [(1, 99)]
    scores = retrieval.evaluate(ranked, spark.createDataFrame([(1, 99)], "query_id long, doc_id long"), "doc_id").first()
    assert scores["p1"] == 1.0 and scores["mrr"] == 1.0


def test_questions(spark):
    asked = [
        "Homes in Mount Dora with roofs older than 20 years?",
        "roofing permits still open more than five years",
        "single family worth over $300k outside the county",
        "parcels not in Mount Dora",
        "why is contractor_name empty",
        "absentee owners, built before 1980, no recorded sale",
    ]
    q = spark.createDataFrame(list(enumerate(asked)), "query_id long, question string")
    cities = spark.createDataFrame([("Mount Dora",), ("Dora",), (None,)], "entry string")
    types = spark.createDataFrame([("SingleFamily",)], "entry string")
    r = {x["query_id"]: x for x in interpret.interpret_questions(q, cities, types).collect()}
    assert (r[0]["city"], r[0]["min_roof_age"]) == ("Mount Dora", 20)
    assert (r[1]["min_open_permit_days"], r[1]["has_open_roofing_permit"]) == (1825, True)
    assert (r[2]["property_type"], r[2]["min_market_value"], r[2]["owner_out_of_county"]) == ("SingleFamily", 300000.0, True)
    assert r[3]["declined"] and not r[3]["about_parcels"]
    assert not r[4]["about_parcels"]
    assert (r[5]["owner_out_of_county"], r[5]["max_built_year"], r[5]["no_recorded_sale"], r[5]["q"]) == (True, 1979, True, None)


FIXED = [  # question, filters that it sets, what is left as q
    ("Which homes in Mount Dora have roofs older than 20 years?", {"city": "Mount Dora", "min_roof_age": 20}, None),
    ("roofs 15 years or older in Dora", {"city": "Dora", "min_roof_age": 15}, None),
    ("18 year old roofs", {"min_roof_age": 18}, None),
    ("aging roofs with a permit", {"min_roof_age": 15, "has_permits": True}, None),
    ("roofing permits", {"has_permits": True}, None),
    ("outstanding roofing permits", {"has_open_roofing_permit": True}, "outstanding"),
    ("permits open for more than three years", {"min_open_permit_days": 1095}, None),
    ("more than 2 years open, roofing permit", {"min_open_permit_days": 730, "has_open_roofing_permit": True}, None),
    ("out-of-state owners", {"owner_out_of_state": True}, None),
    ("owners outside the county", {"owner_out_of_county": True}, None),
    ("absentee owners out of state", {"owner_out_of_state": True}, None),
    ("never sold, business account", {"no_recorded_sale": True, "has_business_account": True}, None),
    ("single family worth at least $1.5m", {"property_type": "SingleFamily", "min_market_value": 1500000.0}, None),
    ("value under 250k", {"max_market_value": 250000.0}, None),
    ("value under 250,000", {"max_market_value": 250000.0}, None),  # a comma within a number
    ("worth over 900", {}, None),
    ("built after 1999 and built before 2005", {"min_built_year": 2000, "max_built_year": 2004}, None),
    ("homes of Smith in Mount Dora", {"city": "Mount Dora"}, "smith"),
    ("parcels with no permits in Dora", {"city": "Dora"}, None),
    ("buildings near me", {"property_type": "Building"}, "near"),
    ("anything in Narnia", {}, "anything narnia"),
]


def test_fixed_questions(spark):
    q = spark.createDataFrame([(k, f[0]) for k, f in enumerate(FIXED)], "query_id long, question string")
    cities = spark.createDataFrame([("Mount Dora",), ("Dora",)], "entry string")
    types = spark.createDataFrame([("SingleFamily",), ("Building",)], "entry string")
    found = {r["query_id"]: r for r in interpret.interpret_questions(q, cities, types).collect()}
    for k, (text, want, rest) in enumerate(FIXED):
        r = found[k]
        assert {n: r[n] for n in interpret.FILTERS if r[n] is not None} == want, text
        assert (r["q"], r["declined"], r["about_parcels"]) == (rest, False, bool(want)), text


@pytest.mark.parametrize("text", ["parcels not in Dora", "homes outside of Dora", "other than Dora", "everything except Dora", "away from Dora", "houses that aren't in Dora"])
def test_exclusions_are_declined(spark, text):
    q = spark.createDataFrame([(1, text)], "query_id long, question string")
    r = interpret.interpret_questions(q, spark.createDataFrame([("Dora",)], "entry string"), spark.createDataFrame([], "entry string")).first()
    assert r["declined"] and not r["about_parcels"] and r["q"] is None


def test_answers_are_those_of_loops(spark, table):
    asked = spark.createDataFrame([(1, "roofs older than 10 years in Mount Dora"), (2, "out of state owners"), (3, "open roofing permits in Mount Dora, out of state owners"), (4, "worth over $1k"), (5, "worth over $1k")], "query_id long, question string")
    vocabulary = spark.createDataFrame([("Mount Dora",)], "entry string"), spark.createDataFrame([], "entry string")
    got = {r["query_id"]: (r["n"], r["first_id"]) for r in interpret.answer(interpret.interpret_questions(asked, *vocabulary), table).collect()}
    assert got == {1: (1, "a"), 2: (1, "a"), 3: (1, "a"), 4: (1, "a"), 5: (1, "a")}


def test_latent_space_is_that_of_a_dense_svd(spark):
    import numpy as np

    from terrafold.operators import latent

    rng = np.random.default_rng(3)
    x = rng.random((40, 30)) * (rng.random((40, 30)) < 0.3) + np.outer(rng.random(40), rng.random(30))
    rows = [(f"t{j}", i, float(x[i, j])) for i in range(40) for j in range(30) if x[i, j]]
    terms, docs, sigma = latent.latent_space(spark.createDataFrame(rows, "term string, doc long, w double"), "doc", 4, 12, 12)
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(sigma, s[:4], rtol=1e-3)
    mine = np.array([r["v"] for r in docs.orderBy("doc").collect()])
    want = u[:, :4] * s[:4]
    want /= np.linalg.norm(want, axis=1, keepdims=True)
    assert np.allclose(mine @ mine.T, want @ want.T, atol=1e-2)
    asked = spark.createDataFrame([(1, "t3", 1.0), (1, "t7", 0.45)], "query_id long, term string, weight double")
    q = np.array(latent.folded(asked, terms, 4).first()["v"])
    plain = vt[:4, 3] + 0.45 * vt[:4, 7]
    assert abs(abs(mine[5] @ q) - abs(want[5] @ plain / np.linalg.norm(plain))) < 1e-2


def test_expansion_and_aliases(spark):
    asked = spark.createDataFrame([(1, "old shingles on my house"), (2, "cost of a new roof deck")], "query_id long, question string")
    expansions = spark.createDataFrame([("shingle", "roofing"), ("roof deck", "permit"), ("shingle", "house")], "trigger string, term string")
    got = {(r["query_id"], r["term"]): r["weight"] for r in retrieval.expanded(asked, expansions).collect()}
    assert got[1, "roof"] == 0.45 and got[2, "permit"] == 0.45 and got[1, "house"] == 1.0 and got[1, "shingle"] == 1.0
    aliases = spark.createDataFrame([(7, "Roof Deck"), (7, "new"), (8, "decks")], "doc_id long, alias string")
    assert [(r["query_id"], r["doc_id"], round(r["alias"], 4)) for r in retrieval.alias_scores(asked, aliases, "doc_id").collect()] == [(2, 7, 0.825)]


def test_paragraph_windows(spark):
    text = "\n\n".join(["a" * 900, "b" * 900, "c" * 3500])
    got = [len(w) for w in spark.createDataFrame([(text,)], "t string").select(corpus.paragraph_windows(F.col("t")).alias("w")).first()["w"]]
    assert got[0] == 900 and got[1] == 1102 and len(got) == 5 and got[2] == 1500


def test_incremental_feed_equals_full_rebuild(spark, tmp_path):
    day = dt.datetime(2024, 1, 1)
    rows = [(k % 7, "ISSUED" if k < 7 else "COMPLETE", day + dt.timedelta(hours=k)) for k in range(14)] + [(1, "ISSUED", day + dt.timedelta(hours=1))]
    schema = "number long, status string, modified timestamp"
    for k in range(3):
        spark.createDataFrame(rows[k::3], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    state = {"rows": spark.createDataFrame([], schema)}

    def merge(batch, _):
        merged = runs.merge_window(state["rows"], batch, "number", "modified").collect()
        state["rows"] = spark.createDataFrame(merged, schema)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    feeds.permit_feed(stream, merge, str(tmp_path / "cp")).awaitTermination(120)
    full = runs.merge_window(spark.createDataFrame([], schema), spark.createDataFrame(rows, schema), "number", "modified")
    assert sorted(map(tuple, state["rows"].collect())) == sorted(map(tuple, full.collect()))


def test_token_bucket(spark):
    day = dt.datetime(2024, 1, 1)
    events = spark.createDataFrame([(k, 1, day) for k in range(7)] + [(9, 1, day + dt.timedelta(minutes=1))], "event_id long, user_id long, ts timestamp")
    got = {r["event_id"]: r["refused"] for r in buckets.token_bucket(events).collect()}
    assert sum(got.values()) == 2 and not got[9]
