"""Queries against the independent engine, and invariants of the table."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from terrafold import catalog, catalog_deep, catalog_functions, catalog_more, catalog_views  # noqa: F401

SF = "/root/testdata/sf0.001"
CHECKED = ["a1_properties", "b5_source_systems", "b6_notices", "c9_open_days_zero", "c10_in_county", "c17_radius", "d6_unmatched_permits", "e1_dataset_stats", "e3_facets", "e7_permit_posture", "e9_roof_age_bands", "f5_latest_permit", "g1_ascending_page", "g9_radius_leads", "p6_attribution", "r1_row_delta", "r6_verified", "s_numeric", "s_dates", "m1_filters", "t3_sessions",
           "s_numeric_more", "s_conditional", "s_text_more", "s_dates_more", "s_times", "s_json_more", "s_aggregates_more", "s_histogram", "s_range", "v2_detail", "v10_dataset_info", "v11_schema", "r2_count_delta", "r3_history_breaches", "r5_manifest",
           "r9_upgrade", "r11_served_run", "a7_run_record", "a9_jurisdictions", "g5_bounded", "k1_markdown_sections", "k7_link_edges", "l2_terms", "l7_tfidf", "l11_alias", "l13_phrases", "p18_permits_by_area", "l9_nearest", "l5_early_stop", "l4_expansion", "l21_fused_evaluation", "t1_rolled_by_batches", "t2_refusals", "a10_newest_run", "a11_stored_index", "g4_keyset_pages", "p2_published", "b8_annotated_schema", "v2_lookup", "v13_near_city"]


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(rows):
    def value(v):
        if v is None or v != v:
            return "~"
        if isinstance(v, bool):
            return str(v)
        return repr(round(float(v), 9)) if isinstance(v, (int, float)) else str(v)

    return sorted(tuple(map(value, r)) for r in rows)


@pytest.mark.parametrize("name", CHECKED)
def test_same_rows(spark, engine, name):
    df, sql = catalog.QUERIES[name](spark, SF), engine.sql(catalog.SQL[name])
    order = sorted(df.columns)
    assert sorted(sql.columns) == order
    got = df.select(*order).collect()
    want = engine.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in order)} FROM ({catalog.SQL[name]})").fetchall()
    assert plain(got) == plain(want)


def test_every_query_has_sql_or_is_known_to_have_none():
    assert set(catalog.QUERIES) - set(catalog.SQL) == {"k2_chunks", "k3_section_chunks", "l8_latent_space", "l14_hybrid", "l18_answers", "l20_citations", "l21_evaluation", "m_interpret", "v12_hybrid_answer"}


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_answers_to_all_kinds(spark, engine):
    got = catalog.QUERIES["m2_answers"](spark, SF).collect()
    assert plain(got) == plain(engine.sql(f"SELECT query_id, n FROM ({catalog.SQL['m2_answers']})").fetchall())
    assert {r["query_id"] % 6 for r in got} - {0, 1}


def test_terms_and_phrases_of_all_languages(spark):
    from terrafold.operators import retrieval

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    terms = docs.select(retrieval.tokenise(docs["text"]).alias("t")).collect()
    tf, df = Counter(t for r in terms for t in r["t"] or []), Counter(t for r in terms for t in set(r["t"] or []))
    assert docs.where("lang <> 'en'").count() > 0
    assert {r["term"]: (r["tf"], r["df"]) for r in catalog.QUERIES["l2_terms"](spark, SF).collect()} == {t: (n, df[t]) for t, n in tf.items()}
    assert sorted(r["doc_id"] for r in catalog.QUERIES["l13_phrases"](spark, SF).collect()) == sorted(r["doc_id"] for r in docs.collect())
