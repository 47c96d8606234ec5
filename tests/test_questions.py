"""Questions meet their vocabulary and the parcels by counted sides, not by sizes of files."""

import pytest
from pyspark.sql import functions as F

from terrafold.operators import interpret
from terrafold.plans import consolidate as plan
from terrafold.sources import shared

SF = "/root/testdata/sf0.001"


def planned(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_questions_are_not_sent_to_every_task(spark):
    df = spark.range(50).select(F.col("id").alias("query_id"), F.lit("roofs in mount dora").alias("text"))
    words = spark.createDataFrame([("Mount Dora", "mount dora")], "entry string, needle string")
    got = interpret._best(df, words, F.split("text", " "), F.substring_index("needle", " ", 1), F.col("text").contains(F.col("needle")), "city")
    assert "SortMergeJoin [query_id" in planned(got) and "BuildLeft" not in planned(got)
    assert got.where("city = 'Mount Dora'").count() == 50


@pytest.mark.parametrize("sent", [0, 20_000])
def test_answers_without_small_sides(spark, monkeypatch, sent):
    monkeypatch.setattr(shared, "SENT", sent)
    t = plan.properties(spark, SF)
    asked = spark.createDataFrame([(1, "roofs older than 10 years in nation_7"), (2, "out of state owners"), (3, "building parcels, out of state owners"), (4, "building parcels in nation_7 worth over $1k")], "query_id long, question string")
    found = interpret.interpret_questions(asked, t.select(F.col("address_city").alias("entry")), t.select(F.col("property_type").alias("entry")))
    got = {r["query_id"]: r["n"] for r in interpret.answer(found, t).collect()}
    want = {1: "address_city = 'NATION_7' and roof_age_years >= 10", 2: "owner_out_of_state", 3: "property_type = 'BUILDING' and owner_out_of_state", 4: "address_city = 'NATION_7' and property_type = 'BUILDING' and market_value >= 1000"}
    assert got == {k: n for k, w in want.items() if (n := t.where(w).count())}
