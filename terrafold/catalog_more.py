"""Queries over dialect functions, questions, streams and views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import _STATS, SQL, add, normal_sql, over
from .functions import dialect as d
from .operators import aggregates as agg
from .operators import interpret, provenance, retrieval
from .operators.filters import matching, search
from .oracle import over_properties
from .plans import consolidate as plan
from .sources.shared import kept
from .streaming import feeds

# numbers, text, dates and lists: one query a family, a column a function
add(
    "s_numeric",
    lambda s, p: plan.table(s, p, "lineitem").select(
        "l_orderkey", "l_linenumber", d.trunc(-F.col("l_extendedprice")).cast("double").alias("trunc"), F.round(d.log(F.col("l_quantity")), 9).alias("log"), d.even(F.col("l_quantity")).cast("double").alias("even"),
        d.gcd(F.col("l_partkey"), F.col("l_suppkey")).alias("gcd"), d.lcm(F.col("l_linenumber").cast("long"), F.col("l_suppkey")).alias("lcm"), F.round(F.cbrt("l_quantity"), 9).alias("cbrt"), F.bit_count("l_partkey").alias("bits"), F.col("l_partkey") % 7,
    ).withColumnRenamed("(l_partkey % 7)", "mod"),
    "SELECT l_orderkey, l_linenumber, trunc(-l_extendedprice) AS trunc, round(log(l_quantity), 9) AS log, even(l_quantity) AS even, gcd(l_partkey, l_suppkey) AS gcd, lcm(CAST(l_linenumber AS BIGINT), l_suppkey) AS lcm, round(cbrt(l_quantity), 9) AS cbrt, bit_count(l_partkey) AS bits, l_partkey % 7 AS mod FROM lineitem",
)
add(
    "s_text",
    lambda s, p: plan.table(s, p, "customer").select(
        "c_custkey", d.substr(F.col("c_name"), 0, 3).alias("sub0"), d.concat(F.col("c_name"), F.lit(None), F.col("c_mktsegment")).alias("joined"), d.strpos(F.col("c_name"), "#").alias("pos"), d.sha256(F.col("c_name")).alias("sha"),
        d.format_("{}/{}", F.col("c_mktsegment"), F.col("c_custkey")).alias("formatted"), d.regexp_replace(F.col("c_name"), "0", "x").alias("once"), d.regexp_matches(F.col("c_name"), "0+7").alias("hit"), F.size(d.string_split(F.col("c_name"), "#")).alias("parts"),
        F.round(d.jaccard(F.lower("c_mktsegment"), F.lit("building")), 9).alias("jac"), F.levenshtein("c_mktsegment", F.lit("BUILDING")).alias("lev"), F.split_part("c_name", F.lit("#"), F.lit(2)).alias("part2"), d.strip_accents(F.lit("é").cast("string")).alias("bare"), d.nfc_normalize(F.lit("é")).alias("nfc"),
    ),
    "SELECT c_custkey, substr(c_name, 0, 3) AS sub0, concat(c_name, NULL, c_mktsegment) AS joined, strpos(c_name, '#') AS pos, sha256(c_name) AS sha, format('{}/{}', c_mktsegment, c_custkey) AS formatted, regexp_replace(c_name, '0', 'x') AS once, regexp_matches(c_name, '0+7') AS hit, len(string_split(c_name, '#')) AS parts, round(jaccard(lower(c_mktsegment), 'building'), 9) AS jac, levenshtein(c_mktsegment, 'BUILDING') AS lev, split_part(c_name, '#', 2) AS part2, strip_accents('é') AS bare, nfc_normalize('e' || chr(769)) AS nfc FROM customer",
)
_t = lambda: F.col("o_orderdate")  # noqa: E731 - columns need a session, which imports do not have
add(
    "s_dates",
    lambda s, p: plan.table(s, p, "orders").select(
        "o_orderkey", d.date_diff("day", _t(), F.lit("2001-09-01").cast("date")).alias("dd"), d.date_diff("month", _t(), F.lit("2001-09-01").cast("date")).alias("dm"), d.date_sub("month", _t(), F.lit("2001-09-01").cast("timestamp")).alias("ds"), d.dayname(_t()).alias("dn"), d.monthname(_t()).alias("mn"), d.dayofweek(_t()).alias("dow"), d.isodow(_t()).alias("isodow"),
        d.isoyear(_t()).alias("isoyear"), d.week(_t()).alias("week"), d.yearweek(_t()).alias("yw"), d.century(_t()).alias("century"), d.epoch(_t()).alias("epoch"), d.epoch_ms(_t()).alias("ms"), d.strftime(_t(), "%Y/%m-%d %H").alias("text"), F.date_format(d.strptime(d.strftime(_t(), "%d.%m.%Y"), "%d.%m.%Y"), "yyyy-MM-dd").alias("again"),
    ),
    "SELECT o_orderkey, date_diff('day', o_orderdate, TIMESTAMP '2001-09-01') AS dd, date_diff('month', o_orderdate, TIMESTAMP '2001-09-01') AS dm, datesub('month', o_orderdate, TIMESTAMP '2001-09-01') AS ds, dayname(o_orderdate) AS dn, monthname(o_orderdate) AS mn, dayofweek(o_orderdate) AS dow, isodow(o_orderdate) AS isodow, isoyear(o_orderdate) AS isoyear, week(o_orderdate) AS week, yearweek(o_orderdate) AS yw, century(o_orderdate) AS century, epoch(o_orderdate) AS epoch, epoch_ms(o_orderdate) AS ms, strftime(o_orderdate, '%Y/%m-%d %H') AS text, strftime(strptime(strftime(o_orderdate, '%d.%m.%Y'), '%d.%m.%Y'), '%Y-%m-%d') AS again FROM orders",
)
add(
    "s_lists",
    lambda s, p: plan.table(s, p, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list("o_orderstatus")).alias("x")).select("o_custkey", d.list_position(F.col("x"), "P").alias("at"), F.array_join(d.list_distinct(F.col("x")), ",").alias("kinds"), F.size("x").alias("n"), F.array_contains("x", "F").alias("has")),
    "SELECT o_custkey, list_position(x, 'P') AS at, array_to_string(list_sort(list_distinct(x)), ',') AS kinds, len(x) AS n, list_contains(x, 'F') AS has FROM (SELECT o_custkey, list_sort(list(o_orderstatus)) AS x FROM orders GROUP BY 1)",
)
add(
    "s_aggregates",
    lambda s, p: plan.table(s, p, "lineitem").groupBy("l_returnflag").agg(
        F.median("l_quantity").alias("median"), F.percentile("l_quantity", 0.3).alias("q3"), F.expr("percentile_disc(0.3) WITHIN GROUP (ORDER BY l_quantity)").alias("disc"), F.round(F.stddev("l_quantity"), 6).alias("sd"), F.round(F.var_pop("l_quantity"), 6).alias("vp"), F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("corr"),
        F.min_by("l_orderkey", F.struct("l_extendedprice", "l_orderkey")).alias("argmin"), F.bool_or(F.col("l_tax") > 0.05).alias("any"), F.bool_and(F.col("l_tax") >= 0).alias("every"), F.countDistinct("l_suppkey").alias("suppliers"),
    ),
    "SELECT l_returnflag, median(l_quantity) AS median, quantile_cont(l_quantity, 0.3) AS q3, quantile_disc(l_quantity, 0.3) AS disc, round(stddev(l_quantity), 6) AS sd, round(var_pop(l_quantity), 6) AS vp, round(corr(l_quantity, l_extendedprice), 6) AS corr, arg_min(l_orderkey, (l_extendedprice, l_orderkey)) AS argmin, bool_or(l_tax > 0.05) AS any, bool_and(l_tax >= 0) AS every, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1",
)
add("s_entropy", lambda s, p: d.entropy(plan.table(s, p, "orders"), "o_orderpriority").select(F.round("entropy", 9).alias("entropy")), "SELECT round(entropy(o_orderpriority), 9) AS entropy FROM orders")
add("s_json", lambda s, p: plan.table(s, p, "events").select("event_id", d.json_extract_string(F.col("props"), "$.k").alias("k"), F.array_join(F.array_sort(F.json_object_keys("props")), ",").alias("keys")), "SELECT event_id, json_extract_string(props, '$.k') AS k, array_to_string(list_sort(json_keys(props)), ',') AS keys FROM events")
add("s_series", lambda s, p: plan.table(s, p, "region").select("r_regionkey", F.explode(F.sequence(F.lit(1), F.col("r_regionkey") + 1)).alias("k")), "SELECT r_regionkey, CAST(unnest(generate_series(1, r_regionkey + 1)) AS INTEGER) AS k FROM region")


# questions, made of the table's own words
def _questions(s, p) -> DataFrame:
    t = plan.properties(s, p)
    k = F.col("alt_key").cast("long")
    text = (
        F.when(k % 6 == 0, F.concat(F.lit("Which homes in "), F.col("address_city"), F.lit(" have roofs older than "), (k % 40).cast("string"), F.lit(" years?")))
        .when(k % 6 == 1, F.concat(F.lit("open roofing permits in "), F.col("address_city")))
        .when(k % 6 == 2, F.concat(F.lit("properties worth more than $"), (k % 9 + 1).cast("string"), F.lit("k, out of state owners, no recorded sale")))
        .when(k % 6 == 3, F.concat(F.lit("permits not in "), F.col("address_city")))
        .when(k % 6 == 4, F.concat(F.lit("absentee owners built before 19"), (k % 80 + 10).cast("string")))
        .otherwise(F.concat(F.lower("property_type"), F.lit(" parcels with permits open for more than five years")))
    )
    return t.select(k.alias("query_id"), text.alias("question"))


def _interpreted(s, p) -> DataFrame:
    """What the questions ask, kept as a table for the queries over it."""
    t = plan.properties(s, p)
    return kept(s, "interpreted", (p,), lambda: interpret.interpret_questions(_questions(s, p), t.select(F.col("address_city").alias("entry")), t.select(F.col("property_type").alias("entry"))))


_ASKED = """SELECT CAST(alt_key AS BIGINT) AS query_id, CAST(alt_key AS BIGINT) % 6 AS kind, CAST(alt_key AS BIGINT) AS k, address_city, property_type FROM properties"""
add("m_interpret", _interpreted)
add("m1_filters", lambda s, p: _interpreted(s, p).select("query_id", "declined", "city", "min_roof_age", "has_open_roofing_permit", "owner_out_of_state", "owner_out_of_county", "no_recorded_sale", "min_market_value", "max_built_year", "min_open_permit_days"), over_properties(f"SELECT query_id, kind = 3 AS declined, CASE WHEN kind IN (0, 1) THEN address_city END AS city, CASE WHEN kind = 0 THEN CAST(k % 40 AS INTEGER) END AS min_roof_age, CASE WHEN kind = 1 THEN TRUE END AS has_open_roofing_permit, CASE WHEN kind = 2 THEN TRUE END AS owner_out_of_state, CASE WHEN kind = 4 THEN TRUE END AS owner_out_of_county, CASE WHEN kind = 2 THEN TRUE END AS no_recorded_sale, CASE WHEN kind = 2 THEN (k % 9 + 1) * CAST(1000 AS DOUBLE) END AS min_market_value, CASE WHEN kind = 4 THEN CAST(1909 + k % 80 AS INTEGER) END AS max_built_year, CASE WHEN kind = 5 THEN 1825 END AS min_open_permit_days FROM ({_ASKED})"))
add("m2_answers", lambda s, p: interpret.answer(_interpreted(s, p), plan.properties(s, p)).select("query_id", "n"), over_properties(f"SELECT query_id, count(*) AS n FROM ({_ASKED}) q JOIN properties p ON (kind IN (0, 1) AND p.address_city = q.address_city AND ((kind = 0 AND p.roof_age_years >= k % 40) OR (kind = 1 AND p.open_roofing_permit_count > 0))) OR (kind = 2 AND p.market_value >= (k % 9 + 1) * 1000 AND p.owner_out_of_state AND p.no_recorded_sale_in_dor_window) OR (kind = 4 AND p.owner_out_of_county AND p.built_year <= 1909 + k % 80) OR (kind = 5 AND p.property_type = q.property_type AND p.longest_open_permit_days >= 1825) GROUP BY 1"))

# streams as tables
add("t3_hourly", lambda s, p: feeds.event_counts(plan.table(s, p, "events")).select(F.date_format("start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n", F.round("value", 6).alias("value")), "SELECT strftime(ts, '%Y-%m-%d %H') AS hour, event_type, count(*) AS n, round(sum(value), 6) AS value FROM events GROUP BY 1, 2")
add("t3_sessions", lambda s, p: feeds.sessions(plan.table(s, p, "events")).groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"), F.sum("n").alias("n")), "SELECT user_id, count(*) FILTER (WHERE fresh) AS sessions, count(*) AS n FROM (SELECT user_id, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 30 MINUTE, TRUE) AS fresh FROM events) GROUP BY 1")

# views of several parts
over("v1_search", lambda t: search(t, "roof_age_years", min_roof_age=20, has_permits=True).select("property_id", "roof_age_years").crossJoin(F.broadcast(matching(t, min_roof_age=20, has_permits=True).agg(F.count(F.lit(1)).alias("total")))), "SELECT property_id, roof_age_years, (SELECT count(*) FROM properties WHERE roof_age_years >= 20 AND has_permits) AS total FROM properties WHERE roof_age_years >= 20 AND has_permits ORDER BY roof_age_years DESC NULLS LAST, property_id LIMIT 50")
over("v3_metrics", lambda t: provenance.metric_record(agg.dataset_stats(t)), "SELECT metric, CAST(value AS DOUBLE) AS value FROM (UNPIVOT (" + _STATS + ") ON COLUMNS(*) INTO NAME metric VALUE value)")
over("v5_tenant", lambda t: agg.out_of_state_ranking(t).crossJoin(F.broadcast(agg.owner_posture(t))), SQL["e11_out_of_state"].rpartition("\n")[2].replace("SELECT owner_mailing_state", "SELECT * FROM (SELECT owner_mailing_state") + ") CROSS JOIN (" + SQL["e8_owner_posture"].rpartition("\n")[2] + ")")
add("l13_phrases", lambda s, p: plan.table(s, p, "documents").select("doc_id", retrieval.phrase_hit(F.lit("the heed and thatnd this was"), F.col("text")).alias("hit")), "SELECT doc_id, contains(t, 'the heed') OR contains(t, 'heed and') OR contains(t, 'and thatnd') OR contains(t, 'thatnd this') OR contains(t, 'this was') AS hit FROM (SELECT doc_id, " + normal_sql("text") + " AS t FROM documents)")
add("l1_normalised", lambda s, p: plan.table(s, p, "benchmark").select("item_id", retrieval.normalise(F.col("text")).alias("t")), "SELECT item_id, trim(regexp_replace(lower(text), '\\s+', ' ', 'g')) AS t FROM benchmark")
add("l18_bands", lambda s, p: plan.table(s, p, "embeddings").select("vec_id", retrieval.band(F.abs(F.col("embedding")[0]).cast("double")).alias("band")), "SELECT vec_id, CASE WHEN x >= 0.42 THEN 'high' WHEN x >= 0.29 THEN 'moderate' WHEN x >= 0.23 THEN 'low' ELSE 'none' END AS band FROM (SELECT vec_id, CAST(abs(embedding[1]) AS DOUBLE) AS x FROM embeddings)")
