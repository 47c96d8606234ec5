"""Every query by name, with the SQL that an independent engine checks it by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import aggregates as agg
from .operators import corpus, provenance, retrieval, runs
from .operators.filters import haversine_miles, lookup, matching, search
from .oracle import over_permits, over_properties
from .plans import consolidate as plan
from .sources.shared import kept

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def add(name: str, query: Query, sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(name)
    QUERIES[name] = query
    if sql:
        SQL[name] = sql


def over(name: str, of_properties: Callable[[DataFrame], DataFrame], select: str) -> None:
    add(name, lambda s, d: of_properties(plan.properties(s, d)), over_properties(select))


_PAGE = ["property_id", "address_city", "roof_age_years", "market_value"]
_PAGE_SQL = ", ".join(_PAGE)
_N = "SELECT count(*) AS n FROM properties WHERE "


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


# scans and the consolidated table
over("a1_properties", lambda p: p, "SELECT * FROM properties")
over("a12_row_count", _count, "SELECT count(*) AS n FROM properties")
add("a8_documents", lambda s, d: plan.table(s, d, "documents").select("doc_id", "source", F.length("text").alias("n")), "SELECT doc_id, source, length(text) AS n FROM documents")
add("a10_newest_part", lambda s, d: (lambda e: e.join(e.agg(F.max(F.to_date("ts")).alias("day")), F.to_date("ts") == F.col("day")).groupBy(F.col("day").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n")))(plan.table(s, d, "events")), "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) GROUP BY 1")

# projections
over("b2_distance", lambda p: p.where("latitude is not null").select("property_id", F.round(haversine_miles(28.8, -81.6), 6).alias("miles")), "SELECT property_id, round(2 * 3958.7613 * asin(sqrt(pow(sin((radians(latitude) - radians(CAST(28.8 AS DOUBLE))) / 2), 2) + cos(radians(CAST(28.8 AS DOUBLE))) * cos(radians(latitude)) * pow(sin(radians(longitude - CAST(-81.6 AS DOUBLE)) / 2), 2))), 6) AS miles FROM properties WHERE latitude IS NOT NULL")
over("b4_roof_band", lambda p: p.select("property_id", agg.roof_band().alias("band")), "SELECT property_id, CASE WHEN roof_age_years IS NULL THEN 'unknown' WHEN roof_age_years < 5 THEN '0-4' WHEN roof_age_years < 10 THEN '5-9' WHEN roof_age_years < 15 THEN '10-14' WHEN roof_age_years < 20 THEN '15-19' WHEN roof_age_years < 30 THEN '20-29' WHEN roof_age_years < 50 THEN '30-49' ELSE '50+' END AS band FROM properties")
_LABEL = "CASE token WHEN 'fl_dor_nal_2026p' THEN 'FL DOR NAL 2026 preliminary tax roll' WHEN 'fl_gio_parcel_centroid_2025' THEN 'FL GIO parcel centroids 2025' WHEN 'lake_cdplus_permits' THEN 'Lake County CD Plus permit layer' WHEN 'fl_dor_sdf_2026p' THEN 'FL DOR SDF 2026 preliminary sales file' WHEN 'fl_dor_tpp_2026p' THEN 'FL DOR TPP 2026 preliminary tangible personal property roll' ELSE token END"
_TOKENS = "SELECT property_id, unnest(string_split(source_systems, '|')) AS token FROM properties"
over("b5_source_systems", lambda p: provenance.source_rows(p).select("property_id", "token", "label"), f"SELECT property_id, token, {_LABEL} AS label FROM ({_TOKENS})")
_NOTICE = "SELECT property_id, token, CASE token WHEN 'contractor_gated_403' THEN 'contractor_name' WHEN 'bbb_gated_403' THEN 'bbb_rating' END AS field, CASE token WHEN 'permits_loaded' THEN 'present' WHEN 'no_permits_in_source' THEN 'absent' ELSE 'gated' END AS severity FROM (SELECT property_id, unnest(string_split(enrichment_status, ';')) AS token FROM properties)"
over("b6_notices", lambda p: provenance.notice_rows(p).select("property_id", "token", "field", "severity"), _NOTICE)
over("b7_gated", lambda p: provenance.gated(p).select("property_id", "token", "field"), f"SELECT property_id, token, field FROM ({_NOTICE}) WHERE severity = 'gated'")
over("b10_provenance", provenance.provenance, f"SELECT string_agg(DISTINCT {_LABEL}, '; ' ORDER BY {_LABEL}) AS sources FROM ({_TOKENS})")
over("b12_point_features", lambda p: provenance.point_features(p).select("id", "label"), "SELECT coalesce(request_identifier, property_id) AS id, address_street AS label FROM properties WHERE latitude IS NOT NULL")
over("b13_radius_ring", lambda p: provenance.radius_ring(p.where("latitude is not null and open_roofing_permit_count > 0").select("property_id", "latitude", "longitude"), "latitude", "longitude", 1.0).select("property_id", "vertex", "ring_lat", "ring_lon"), "SELECT property_id, v AS vertex, round(degrees(phi), 6) AS ring_lat, round(degrees(radians(longitude) + atan2(sin(t) * sin(d) * cos(radians(latitude)), cos(d) - sin(radians(latitude)) * sin(phi))), 6) AS ring_lon FROM (SELECT *, asin(sin(radians(latitude)) * cos(d) + cos(radians(latitude)) * sin(d) * cos(t)) AS phi FROM (SELECT property_id, latitude, longitude, CAST(v AS INTEGER) AS v, radians(v * CAST(360.0 AS DOUBLE) / 96) AS t, CAST(1.0 AS DOUBLE) / 3958.7613 AS d FROM properties, generate_series(0, 96) g(v) WHERE latitude IS NOT NULL AND open_roofing_permit_count > 0))")
over("b14_parcel_id", lambda p: p.select(F.coalesce("request_identifier", "property_id").alias("id")), "SELECT coalesce(request_identifier, property_id) AS id FROM properties")

# filters: name, arguments, predicate
for name, given, where in (
    ("c1_q", {"q": "building 0"}, "1 = 0 OR upper(coalesce(address_street, '')) LIKE '%BUILDING 0%' OR upper(coalesce(owner_name, '')) LIKE '%BUILDING 0%'"),
    ("c1_q_wildcard", {"q": "00%7 "}, "upper(coalesce(request_identifier, '')) LIKE '%00%7%' OR upper(coalesce(address_street, '')) LIKE '%00%7%' OR upper(coalesce(owner_name, '')) LIKE '%00%7%' OR upper(coalesce(owners_text, '')) LIKE '%00%7%'"),
    ("c2_city", {"city": "china"}, "upper(coalesce(address_city, '')) = 'CHINA'"),
    ("c3_zip", {"zip": "32017"}, "coalesce(address_zip, '') = '32017'"),
    ("c4_property_type", {"property_type": "BUILDING"}, "property_type = 'BUILDING'"),
    ("c5_roof_age_basis", {"roof_age_basis": "year_built"}, "roof_age_basis = 'year_built'"),
    ("c6_roof_age", {"min_roof_age": 10, "max_roof_age": 60}, "roof_age_years >= 10 AND roof_age_years <= 60"),
    ("c7_has_permits", {"has_permits": True}, "coalesce(has_permits, FALSE)"),
    ("c7_no_permits", {"has_permits": False}, "NOT coalesce(has_permits, FALSE)"),
    ("c8_open_roofing", {"has_open_roofing_permit": True}, "coalesce(open_roofing_permit_count, 0) > 0"),
    ("c8_no_open_roofing", {"has_open_roofing_permit": False}, "coalesce(open_roofing_permit_count, 0) = 0"),
    ("c9_open_days", {"min_open_permit_days": 1000}, "coalesce(longest_open_permit_days, 0) >= 1000"),
    ("c9_open_days_zero", {"min_open_permit_days": 0}, "TRUE"),
    ("c10_out_of_county", {"owner_out_of_county": True}, "owner_out_of_county"),
    ("c10_in_county", {"owner_out_of_county": False}, "NOT owner_out_of_county"),
    ("c11_out_of_state", {"owner_out_of_state": True}, "owner_out_of_state"),
    ("c11_in_state", {"owner_out_of_state": False}, "NOT owner_out_of_state"),
    ("c12_no_recorded_sale", {"no_recorded_sale": True}, "coalesce(no_recorded_sale_in_dor_window, FALSE)"),
    ("c13_business", {"has_business_account": True}, "coalesce(business_account_count, 0) > 0"),
    ("c13_no_business", {"has_business_account": False}, "coalesce(business_account_count, 0) = 0"),
    ("c14_market_value", {"min_market_value": 1000, "max_market_value": 5000}, "market_value >= 1000 AND market_value <= 5000"),
    ("c15_built_year", {"min_built_year": 1950, "max_built_year": 1980}, "built_year >= 1950 AND built_year <= 1980"),
    ("c16_coordinates", {"require_coordinates": True}, "latitude IS NOT NULL AND longitude IS NOT NULL"),
    ("c17_radius", {"lat": 28.8, "lon": -81.6, "radius_miles": 12.0}, "2 * 3958.7613 * asin(sqrt(pow(sin(radians(latitude - CAST(28.8 AS DOUBLE)) / 2), 2) + cos(radians(CAST(28.8 AS DOUBLE))) * cos(radians(latitude)) * pow(sin(radians(longitude + CAST(81.6 AS DOUBLE)) / 2), 2))) <= 12"),
):
    over(name, lambda p, given=given: matching(p, **given).select(*_PAGE), f"SELECT {_PAGE_SQL} FROM properties WHERE {where}")
over("c19_lookup", lambda p: lookup(p, "00000042").select(*_PAGE), f"SELECT {_PAGE_SQL} FROM properties WHERE request_identifier = '00000042' OR property_id = '00000042' LIMIT 1")

# joins
add("d2_permits_on_roll", lambda s, d: plan.roll(s, d).join(plan.permit_rollup(plan.latest(plan.permits(s, d), "number", "modified")), "key", "left").agg(F.count(F.lit(1)).alias("n"), F.count("permit_count").alias("matched")), over_permits("SELECT count(*) AS n, count(k) AS matched FROM customer LEFT JOIN (SELECT DISTINCT key AS k FROM permits) ON k = c_custkey"))
over("d3_centroids_on_roll", lambda p: p.agg(F.count_if(F.col("latitude").isNull()).alias("unmatched")), "SELECT count(*) FILTER (WHERE latitude IS NULL) AS unmatched FROM properties")
over("d4_sales_on_roll", lambda p: p.select("property_id", "last_sale_date", "last_sale_price", "prior_sale_date", "prior_sale_price"), "SELECT property_id, last_sale_date, last_sale_price, prior_sale_date, prior_sale_price FROM properties")
add("d6_unmatched_permits", lambda s, d: plan.latest(plan.permits(s, d), "number", "modified").join(plan.roll(s, d), "key", "left_anti").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("key").alias("keys")), over_permits("SELECT count(*) AS n, count(DISTINCT key) AS keys FROM permits WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = key)"))

# aggregates
_STATS = """SELECT count(*) AS parcels, count(latitude) AS with_coordinates, count(roof_age_years) AS roof_age_known, count(*) FILTER (WHERE roof_age_years >= 15) AS aged_roofs,
count(*) FILTER (WHERE roof_age_basis = 'roofing_permit_completed') AS basis_roofing_permit_completed, count(*) FILTER (WHERE roof_age_basis = 'roofing_permit_issued') AS basis_roofing_permit_issued,
count(*) FILTER (WHERE roof_age_basis = 'year_built') AS basis_year_built, count(*) FILTER (WHERE has_permits) AS with_permits, CAST(sum(coalesce(permit_count, 0)) AS BIGINT) AS permits,
CAST(sum(coalesce(roofing_permit_count, 0)) AS BIGINT) AS roofing_permits, count(*) FILTER (WHERE open_roofing_permit_count > 0) AS open_roofing_parcels,
count(*) FILTER (WHERE longest_open_permit_days > 1825) AS stalled, count(*) FILTER (WHERE owner_out_of_county) AS out_of_county, count(*) FILTER (WHERE owner_out_of_state) AS out_of_state,
count(*) FILTER (WHERE no_recorded_sale_in_dor_window) AS no_recorded_sale, count(*) FILTER (WHERE business_account_count > 0) AS with_business,
CAST(sum(coalesce(business_account_count, 0)) AS BIGINT) AS business_accounts, count(DISTINCT owner_name) AS owners FROM properties"""
over("e1_dataset_stats", agg.dataset_stats, _STATS)
over("e2_facet_city", lambda p: agg.facet(p, "address_city"), "SELECT address_city AS value, count(*) AS n FROM properties WHERE address_city IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100")
over("e3_facets", agg.facets, " UNION ALL ".join(f"SELECT * FROM (SELECT {c} AS value, count(*) AS n, '{n}' AS facet FROM properties WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {k})" for n, c, k in (("city", "address_city", 100), ("type", "property_type", 50), ("basis", "roof_age_basis", 10), ("zip", "address_zip", 100))))
_BUSINESS = "SELECT {v} AS value, count(*) FILTER (WHERE business_account_count > 0) AS parcels, CAST(sum(coalesce(business_account_count, 0)) AS BIGINT) AS accounts FROM properties GROUP BY 1 HAVING sum(coalesce(business_account_count, 0)) > 0"
over("e4_business_by_city", lambda p: agg.business_by(p, "address_city"), _BUSINESS.format(v="address_city"))
over("e5_business_by_type", lambda p: agg.business_by(p, "property_usage_type", "unclassified"), _BUSINESS.format(v="coalesce(property_usage_type, 'unclassified')"))
over("e6_business_totals", agg.business_totals, "SELECT count(*) FILTER (WHERE business_account_count > 0) AS parcels, CAST(sum(coalesce(business_account_count, 0)) AS BIGINT) AS accounts, max(coalesce(business_account_count, 0)) AS most_at_one, CAST(sum(coalesce(roofing_business_count, 0)) AS BIGINT) AS roofing_accounts, count(*) FILTER (WHERE has_sunbiz_tenant) AS tenants FROM properties")
over("e7_permit_posture", agg.permit_posture, """SELECT count(*) FILTER (WHERE has_permits) AS with_permits, CAST(sum(permit_count) AS BIGINT) AS permits, CAST(sum(roofing_permit_count) AS BIGINT) AS roofing, CAST(sum(open_permit_count) AS BIGINT) AS open_permits,
CAST(sum(open_roofing_permit_count) AS BIGINT) AS open_roofing, count(*) FILTER (WHERE open_permit_count > 0) AS open_parcels, count(*) FILTER (WHERE open_roofing_permit_count > 0) AS open_roofing_parcels,
count(*) FILTER (WHERE longest_open_permit_days BETWEEN 1 AND 89) AS open_1_89, count(*) FILTER (WHERE longest_open_permit_days BETWEEN 90 AND 364) AS open_90_364, count(*) FILTER (WHERE longest_open_permit_days BETWEEN 365 AND 1824) AS open_365_1824,
count(*) FILTER (WHERE longest_open_permit_days >= 1825) AS open_1825, max(longest_open_permit_days) AS longest, max(latest_permit_date) AS latest, count(contractor_name) AS contractors, count(bbb_rating) AS rated FROM properties""")
over("e8_owner_posture", agg.owner_posture, "SELECT count(DISTINCT owner_name) AS owners, count(*) FILTER (WHERE owner_out_of_county) AS out_of_county, count(*) FILTER (WHERE owner_out_of_state) AS out_of_state, count(*) FILTER (WHERE owner_out_of_state IS NULL) AS locality_unknown, count(*) FILTER (WHERE owner_count > 1) AS several_owners, count(*) FILTER (WHERE no_recorded_sale_in_dor_window) AS no_recorded_sale, count(last_sale_price) AS with_sale FROM properties")
_BAND = SQL["b4_roof_band"].rpartition("SELECT property_id, ")[2].partition(" AS band")[0]
over("e9_roof_age_bands", agg.roof_age_bands, f"SELECT {_BAND} AS band, count(*) AS total, count(*) FILTER (WHERE roof_age_basis = 'roofing_permit_completed') AS completed, count(*) FILTER (WHERE roof_age_basis = 'roofing_permit_issued') AS issued, count(*) FILTER (WHERE roof_age_basis = 'year_built') AS built FROM properties GROUP BY 1")
over("e10_city_centroid", lambda p: agg.city_centroid(p, "China"), "SELECT round(avg(latitude), 9) AS lat, round(avg(longitude), 9) AS lon, count(*) AS n FROM properties WHERE upper(address_city) = 'CHINA' AND latitude IS NOT NULL")
over("e11_out_of_state", agg.out_of_state_ranking, "SELECT owner_mailing_state AS state, count(*) AS n FROM properties WHERE owner_out_of_state AND owner_mailing_state IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
over("e13_matching_total", lambda p: _count(matching(p, min_roof_age=15, has_permits=True)), _N + "roof_age_years >= 15 AND has_permits")
add("e14_corpus_summary", lambda s, d: plan.table(s, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("docs")), "SELECT source, count(*) AS n, count(DISTINCT doc_id) AS docs FROM documents GROUP BY 1")

# windows
add("f1_ranks", lambda s, d: (lambda o, w: o.select("o_orderkey", F.row_number().over(w).alias("rn"), F.rank().over(w).alias("rk"), F.dense_rank().over(w).alias("dr"), F.round(F.percent_rank().over(w), 9).alias("pr"), F.round(F.cume_dist().over(w), 9).alias("cd"), F.ntile(4).over(w).alias("nt")))(plan.table(s, d, "orders"), plan.Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")), "SELECT o_orderkey, row_number() OVER w AS rn, rank() OVER w AS rk, dense_rank() OVER w AS dr, round(percent_rank() OVER w, 9) AS pr, round(cume_dist() OVER w, 9) AS cd, ntile(4) OVER w AS nt FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
add("f2_analytic", lambda s, d: (lambda o, w: o.select("o_orderkey", F.lag("o_totalprice").over(w).alias("before"), F.lead("o_totalprice").over(w).alias("after"), F.nth_value("o_totalprice", 2).over(w.rowsBetween(plan.Window.unboundedPreceding, plan.Window.unboundedFollowing)).alias("second"), F.first("o_totalprice").over(w).alias("first"), F.last("o_totalprice").over(w).alias("last")))(plan.table(s, d, "orders"), plan.Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")), "SELECT o_orderkey, lag(o_totalprice) OVER w AS before, lead(o_totalprice) OVER w AS after, nth_value(o_totalprice, 2) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second, first_value(o_totalprice) OVER w AS first, last_value(o_totalprice) OVER w AS last FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)".replace("(w ROWS", "(PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS"))
add("f3_frames", lambda s, d: plan.table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.sum("l_quantity").over(plan.Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").rowsBetween(-1, 1)).alias("near"), F.count(F.lit(1)).over(plan.Window.partitionBy("l_orderkey").orderBy("l_linenumber").rangeBetween(-2, 0)).alias("upto")), "SELECT l_orderkey, l_linenumber, sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS near, count(*) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber RANGE BETWEEN 2 PRECEDING AND CURRENT ROW) AS upto FROM lineitem")
add("f5_latest_permit", lambda s, d: plan.latest(plan.permits(s, d), "number", "modified").select("number", "key", F.col("modified").cast("string").alias("modified")), over_permits("SELECT number, key, CAST(modified AS VARCHAR) AS modified FROM permits"))

# order and limit
for name, given, order in (("g1_sorted_page", {"sort": "roof_age_years"}, "roof_age_years DESC NULLS LAST, property_id"), ("g1_ascending_page", {"sort": "last_sale_price", "descending": False}, "last_sale_price ASC NULLS LAST, property_id"), ("g3_default_page", {}, "property_id")):
    over(name, lambda p, given=given: search(p, **given).select(*_PAGE), f"SELECT {_PAGE_SQL} FROM properties ORDER BY {order} LIMIT 50")
over("g4_offset_page", lambda p: search(p, "market_value", limit=1000, offset=25).select(*_PAGE), f"SELECT {_PAGE_SQL} FROM properties ORDER BY market_value DESC NULLS LAST, property_id LIMIT 500 OFFSET 25")
_MILES = SQL["b2_distance"].rpartition("SELECT property_id, round(")[2].partition(", 6) AS miles")[0]
over("g2_radius_page", lambda p: search(p, lat=28.8, lon=-81.6, radius_miles=20.0).select("property_id", F.round("distance_miles", 6).alias("miles")), f"SELECT property_id, round(m, 6) AS miles FROM (SELECT property_id, {_MILES} AS m FROM properties) WHERE m <= 20 ORDER BY m, property_id LIMIT 50")
over("g7_aged_roof_leads", lambda p: search(p, "roof_age_years", min_roof_age=15, city="china", limit=25).select(*_PAGE), f"SELECT {_PAGE_SQL} FROM properties WHERE roof_age_years >= 15 AND upper(address_city) = 'CHINA' ORDER BY roof_age_years DESC NULLS LAST, property_id LIMIT 25")
over("g8_open_roofing_leads", lambda p: search(p, "longest_open_permit_days", has_open_roofing_permit=True, limit=25).select("property_id", "longest_open_permit_days"), "SELECT property_id, longest_open_permit_days FROM properties WHERE open_roofing_permit_count > 0 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 25")
over("g9_radius_leads", lambda p: search(p, lat=28.8, lon=-81.6, radius_miles=15.0, min_roof_age=15, limit=25).select("property_id", F.round("distance_miles", 6).alias("miles")), f"SELECT property_id, round(m, 6) AS miles FROM (SELECT property_id, roof_age_years, {_MILES} AS m FROM properties) WHERE m <= 15 AND roof_age_years >= 15 ORDER BY m, property_id LIMIT 25")
over("g10_citations", lambda p: p.withColumn("k", F.row_number().over(plan.Window.partitionBy("address_city").orderBy("request_identifier"))).where("k <= 25").groupBy("address_city").agg(F.array_join(F.array_sort(F.collect_list("request_identifier")), ",").alias("ids")), "SELECT address_city, array_to_string(list_slice(list_sort(list(request_identifier)), 1, 25), ',') AS ids FROM properties GROUP BY 1")

# set operations
over("h1_union", lambda p: p.select("address_city").union(p.select("owner_mailing_city")).distinct(), "SELECT address_city FROM properties UNION SELECT owner_mailing_city FROM properties")
over("h2_except", lambda p: p.where("has_permits").select("property_id").exceptAll(p.where("roof_age_years >= 15").select("property_id")), "SELECT property_id FROM properties WHERE has_permits EXCEPT SELECT property_id FROM properties WHERE roof_age_years >= 15")
over("h2_intersect", lambda p: p.where("has_permits").select("property_id").intersect(p.where("owner_out_of_state").select("property_id")), "SELECT property_id FROM properties WHERE has_permits INTERSECT SELECT property_id FROM properties WHERE owner_out_of_state")
over("h3_distinct", lambda p: p.select("property_type", "roof_age_basis").distinct(), "SELECT DISTINCT property_type, roof_age_basis FROM properties")

# consolidation
add("p3_permit_rollup", lambda s, d: plan.permit_rollup(plan.latest(plan.permits(s, d), "number", "modified")).drop("roof_completed", "roof_issued"), over_permits("SELECT key, CAST(count(*) AS INTEGER) AS permit_count, CAST(count(*) FILTER (WHERE type IN ('RF','ROR')) AS INTEGER) AS roofing_permit_count, CAST(count(*) FILTER (WHERE status <> 'COMPLETE') AS INTEGER) AS open_permit_count, CAST(count(*) FILTER (WHERE type IN ('RF','ROR') AND status <> 'COMPLETE') AS INTEGER) AS open_roofing_permit_count, CAST(max(date_diff('day', issued, DATE '2001-09-01')) FILTER (WHERE status <> 'COMPLETE') AS INTEGER) AS longest_open_permit_days, CAST(max(issued) AS VARCHAR) AS latest_permit_date FROM permits GROUP BY key"))
over("p2_row_gate", lambda p: p.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("property_id").alias("ids"), F.count_if(F.col("property_id").isNull()).alias("nulls")), "SELECT count(*) AS n, count(DISTINCT property_id) AS ids, count(*) FILTER (WHERE property_id IS NULL) AS nulls FROM properties")
over("p4_roof_age", lambda p: p.select("property_id", "roof_age_years", "roof_age_basis", "roof_last_permit_date"), "SELECT property_id, roof_age_years, roof_age_basis, roof_last_permit_date FROM properties")
add("p6_attribution", lambda s, d: plan.properties(s, d).agg(F.sum("business_account_count").alias("attributed"), F.count("business_account_count").alias("parcels")).crossJoin(plan.accounts(s, d).agg(F.sum("business_account_count").alias("accounts"), F.count(F.lit(1)).alias("groups"))), over_properties("SELECT (SELECT CAST(sum(business_account_count) AS BIGINT) FROM properties) AS attributed, (SELECT count(business_account_count) FROM properties) AS parcels, CAST(count(*) AS BIGINT) AS accounts, count(DISTINCT s_nationkey) AS groups FROM supplier WHERE s_suppkey % 4 = 0"))
over("p7_address_key", lambda p: p.select("property_id", plan.normalised_address(F.col("address_street"), F.col("address_zip")).alias("k")), "SELECT property_id, trim(regexp_replace(upper(coalesce(address_street, '')), '[^A-Z0-9]+', ' ', 'g')) || '|' || left(coalesce(address_zip, ''), 5) AS k FROM properties")
over("p13_coverage", lambda p: p.agg(F.count(F.lit(1)).alias("assessed"), F.count_if("has_permits").alias("with_permits"), F.count("latitude").alias("with_coordinates"), F.count("sale_records_in_window").alias("with_sales")), "SELECT count(*) AS assessed, count(*) FILTER (WHERE has_permits) AS with_permits, count(latitude) AS with_coordinates, count(sale_records_in_window) AS with_sales FROM properties")
over("p14_limitation", lambda p: p.agg(F.format_string("%d of %d parcels have no coordinates", F.count_if(F.col("latitude").isNull()), F.count(F.lit(1))).alias("limitation")), "SELECT count(*) FILTER (WHERE latitude IS NULL) || ' of ' || count(*) || ' parcels have no coordinates' AS limitation FROM properties")
over("p15_pilot_sample", lambda p: p.orderBy((F.col("property_type") == "BUILDING").desc(), "property_id").limit(200).select("property_id", "property_type"), "SELECT property_id, property_type FROM properties ORDER BY property_type = 'BUILDING' DESC, property_id LIMIT 200")
over("p17_oldest_roofs", lambda p: search(p, "roof_age_years", require_coordinates=True, limit=100).select(*_PAGE), f"SELECT {_PAGE_SQL} FROM properties WHERE latitude IS NOT NULL ORDER BY roof_age_years DESC NULLS LAST, property_id LIMIT 100")


# runs: the run before is the roll without every 9th parcel and other values for every 13th
def _previous(p: DataFrame) -> DataFrame:
    k = F.col("alt_key").cast("long")
    return p.where(k % 9 != 0).withColumn("market_value", F.when(k % 13 == 0, F.col("market_value") + 1).otherwise(F.col("market_value")))


over("r1_row_delta", lambda p: runs.row_delta(_previous(p), p.where("cast(alt_key as long) % 17 <> 0"), "property_id"), "SELECT CASE WHEN k % 9 = 0 THEN 'inserted' WHEN k % 17 = 0 THEN 'removed' WHEN k % 13 = 0 AND market_value IS NOT NULL THEN 'updated' ELSE 'unchanged' END AS status, count(*) AS n FROM (SELECT CAST(alt_key AS BIGINT) AS k, market_value FROM properties) WHERE NOT (k % 9 = 0 AND k % 17 = 0) GROUP BY 1")
add("r4_incremental_window", lambda s, d: runs.merge_window(plan.permits(s, d).where("modified < '1999-01-01'"), plan.permits(s, d).where("modified >= '1999-01-01'"), "number", "modified").select("number", F.col("modified").cast("string").alias("modified"), "status"), over_permits("SELECT number, CAST(modified AS VARCHAR) AS modified, status FROM permits"))
_HOSTS = "SELECT l_orderkey, l_suppkey % 5 AS host, l_returnflag <> 'R' AS ok FROM lineitem"
add("r6_verified", lambda s, d: runs.verified(plan.table(s, d, "lineitem").select(F.col("l_orderkey").alias("name"), (F.col("l_suppkey") % 5).cast("string").alias("host"), (F.col("l_returnflag") != "R").alias("ok"), F.lit(1).alias("bytes"), F.lit(1).alias("size"), F.lit("x").alias("digest"), F.lit("x").alias("sha256"))), f"SELECT l_orderkey AS name, count(DISTINCT CASE WHEN ok THEN host END) AS good_hosts, count(DISTINCT CASE WHEN ok THEN host END) >= 2 AS verified, coalesce(string_agg(DISTINCT CASE WHEN ok THEN CAST(host AS VARCHAR) END, ',' ORDER BY CASE WHEN ok THEN CAST(host AS VARCHAR) END), '') AS hosts FROM ({_HOSTS}) GROUP BY 1")
add("r8_newest_pointer", lambda s, d: runs.newest_pointer(plan.table(s, d, "events").select((F.col("user_id") % 50).alias("pointer"), F.when(F.col("event_id") % 7 != 0, F.date_format("ts", "yyyyMMdd")).alias("run_id"), F.col("event_id").alias("pref"))), "SELECT pointer, run_id, pref FROM (SELECT user_id % 50 AS pointer, CASE WHEN event_id % 7 <> 0 THEN strftime(ts, '%Y%m%d') END AS run_id, event_id AS pref, row_number() OVER (PARTITION BY user_id % 50 ORDER BY CASE WHEN event_id % 7 <> 0 THEN strftime(ts, '%Y%m%d') END DESC NULLS LAST, event_id) AS n FROM events) WHERE n = 1")

# documents and retrieval
add("k4_content_hash", lambda s, d: plan.table(s, d, "documents").select("doc_id", corpus.content_hash(corpus.tidy(F.col("text"))).alias("h")), "SELECT doc_id, left(sha256(trim(regexp_replace(regexp_replace(text, '[ \\t]+', ' ', 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), ' ')), 16) AS h FROM documents")
add("k2_chunks", lambda s, d: corpus.chunks(plan.table(s, d, "documents")).select("chunk_id", "doc_id", "chunk_count", "n_chars", "source_hash"))
_AT = "OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_LEVELS = ", ".join(f"last_value(CASE WHEN level = {k} THEN pos END IGNORE NULLS) {_AT} AS p{k}, last_value(CASE WHEN level = {k} THEN title END IGNORE NULLS) {_AT} AS t{k}, max(CASE WHEN level < {k} THEN pos END) {_AT} AS a{k}" for k in range(1, 5))
_TRAIL = ", ".join(f"CASE WHEN level >= {k} AND p{k} > coalesce(a{k}, -1) THEN t{k} END" for k in range(1, 5))
add(
    "k1_heading_sections",
    lambda s, d: corpus.heading_sections(plan.table(s, d, "pages")),
    f"SELECT page_id, pos, level, title, concat_ws(' > ', {_TRAIL}) AS trail FROM (SELECT *, {_LEVELS} FROM (SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, CAST(regexp_extract(raw, '<h([1-4])', 1) AS INTEGER) AS level, trim(regexp_replace(regexp_extract(raw, '(?s)<h[1-4][^>]*>(.*?)</h', 1), '<[^>]+>', '', 'g'), ' ') AS title FROM (SELECT page_id, unnest(x) AS raw, unnest(generate_series(1, len(x))) AS i FROM (SELECT page_id, regexp_extract_all(html, '(?s)<h([1-4])[^>]*>(.*?)</h', 0) AS x FROM pages))))",
)
_FIRST = r"regexp_extract(text, '(?s)^(.*?[.!?])(?:\s|$)', 1)"
_HEAD = f"CASE WHEN {_FIRST} = '' THEN text ELSE {_FIRST} END"
add("k9_headline", lambda s, d: plan.table(s, d, "documents").select("doc_id", corpus.headline(F.col("text")).alias("headline")), f"SELECT doc_id, CASE WHEN length(h) > 130 THEN left(h, 127) || '...' ELSE h END AS headline FROM (SELECT doc_id, {_HEAD} AS h FROM documents)")
_STOP = ", ".join(f"'{w}'" for w in retrieval.STOP_WORDS)
_STEM = "CASE WHEN length(t) <= 3 OR contains(t, '_') THEN t WHEN t LIKE '%ies' AND length(t) > 4 THEN left(t, -3) || 'y' WHEN t LIKE '%sses' THEN left(t, -2) WHEN t LIKE '%ss' THEN t WHEN t LIKE '%s' AND t NOT LIKE '%us' AND t NOT LIKE '%is' THEN left(t, -1) WHEN t LIKE '%ing' AND length(t) > 5 THEN left(t, -3) WHEN t LIKE '%ed' AND length(t) > 4 THEN left(t, -2) ELSE t END"


def normal_sql(text: str) -> str:
    return f"trim(regexp_replace(translate(lower({text}), '‘’“”–—', '\'\'\'\'\"\"--'), '[\\s\\x0B\\x85\\p{{Z}}]+', ' ', 'g'))"


def terms_sql(table: str, key: str, text: str) -> str:
    raw = f"SELECT {key}, unnest(string_split(regexp_replace({normal_sql(text)}, '[^a-z0-9_]+', ' ', 'g'), ' ')) AS r FROM {table}"
    parts = f"SELECT {key}, unnest(CASE WHEN contains(r, '_') THEN list_concat([r], string_split(r, '_')) ELSE [r] END) AS t FROM ({raw}) WHERE r <> ''"
    return f"SELECT {key}, {_STEM} AS term FROM ({parts}) WHERE t <> '' AND (length(t) > 1 OR t BETWEEN '0' AND '9') AND t NOT IN ({_STOP})"


def document_postings(s: SparkSession, d: str) -> DataFrame:
    """Postings of all documents with their lengths, kept as a table."""
    return kept(s, "postings", (d,), lambda: retrieval.with_lengths(retrieval.postings(plan.table(s, d, "documents"), "doc_id", "text"), "doc_id"))


def benchmark_questions(s: SparkSession, d: str) -> DataFrame:
    return plan.table(s, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))


add("l2_terms", lambda s, d: document_postings(s, d).groupBy("term").agg(F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("df")), f"SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM ({terms_sql('documents', 'doc_id', 'text')}) GROUP BY 1")
add("l5_bm25", lambda s, d: retrieval.top(retrieval.bm25(plan.table(s, d, "documents").select("doc_id", "text"), benchmark_questions(s, d), "doc_id", "text", document_postings(s, d)).select("query_id", "doc_id", "score", "overlap"), "doc_id", "doc_id", 5, 0.0))
