"""Queries over spatial containment, stored indexes, nearest vectors, incremental state and published tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import add, benchmark_questions, document_postings, over, terms_sql
from .contract import COLUMNS, REASONS, annotated, schema_listing
from .operators import aggregates as agg
from .operators import impact, latent, nearest, provenance, retrieval, spatial
from .operators.filters import lookup, matching, near_city, page_after, page_token, search
from .oracle import over_permits, over_properties
from .plans import consolidate as plan
from .sources import publish
from .sources.shared import kept, shared_folder
from .streaming import buckets
from .streaming.rollups import PermitRollups


CITY = "NATION_7"  # a city of the tables


def _folder(s: SparkSession, name: str) -> str:
    return f"{shared_folder(s)}/{name}-{uuid.uuid4().hex}"


# spatial containment: an area with a notch for each nation, over the parcels' points
_NOTCHED = ((0.0, 0.0), (0.30, 0.05), (0.28, 0.30), (0.15, 0.12), (0.02, 0.28))


def _areas(s: SparkSession, d: str) -> DataFrame:
    k = F.col("n_nationkey")
    x0, y0, size = F.lit(-82.0) + (k % 5) * F.lit(0.18), F.lit(28.3) + F.floor(k / 5) * F.lit(0.19), F.lit(1.0) + (k % 3) * F.lit(0.5)
    ring = F.array(*[F.struct((x0 + F.lit(dx) * size).alias("x"), (y0 + F.lit(dy) * size).alias("y")) for dx, dy in _NOTCHED])
    return plan.table(s, d, "nation").select(F.col("n_name").alias("area"), ring.alias("ring"))


_AREA_SQL = "SELECT n_name AS area, CAST(-82.0 AS DOUBLE) + (n_nationkey % 5) * CAST(0.18 AS DOUBLE) + CAST({ax} AS DOUBLE) * z AS x1, CAST(28.3 AS DOUBLE) + (n_nationkey // 5) * CAST(0.19 AS DOUBLE) + CAST({ay} AS DOUBLE) * z AS y1, CAST(-82.0 AS DOUBLE) + (n_nationkey % 5) * CAST(0.18 AS DOUBLE) + CAST({bx} AS DOUBLE) * z AS x2, CAST(28.3 AS DOUBLE) + (n_nationkey // 5) * CAST(0.19 AS DOUBLE) + CAST({by} AS DOUBLE) * z AS y2 FROM (SELECT *, CAST(1.0 AS DOUBLE) + (n_nationkey % 3) * CAST(0.5 AS DOUBLE) AS z FROM nation)"
_SIDES_SQL = " UNION ALL ".join(_AREA_SQL.format(ax=a[0], ay=a[1], bx=b[0], by=b[1]) for a, b in zip(_NOTCHED, (*_NOTCHED[1:], _NOTCHED[0]), strict=True))
_INSIDE_SQL = f"SELECT property_id, area, any_value(permit_count) AS permit_count FROM properties, ({_SIDES_SQL}) WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND y1 <> y2 AND (y1 <= latitude) <> (y2 <= latitude) AND longitude < x1 + (latitude - y1) * (x2 - x1) / (y2 - y1) GROUP BY 1, 2 HAVING count(*) % 2 = 1"


def _contained(s: SparkSession, d: str) -> DataFrame:
    points = plan.properties(s, d).select("property_id", "latitude", "longitude", "permit_count")
    return spatial.contained(points, _areas(s, d), "longitude", "latitude", "area", "ring")


add("p18_in_areas", lambda s, d: _contained(s, d).select("property_id", "area"), over_properties(f"SELECT property_id, area FROM ({_INSIDE_SQL})"))
add("p18_permits_by_area", lambda s, d: _contained(s, d).where("permit_count > 0").groupBy("area").agg(F.count(F.lit(1)).alias("parcels"), F.sum("permit_count").alias("permits")), over_properties(f"SELECT area, count(*) AS parcels, CAST(sum(permit_count) AS BIGINT) AS permits FROM ({_INSIDE_SQL}) WHERE permit_count > 0 GROUP BY 1"))


# nearest vectors, exactly, for every twentieth row against all rows
def _units(s: SparkSession, d: str) -> DataFrame:
    return plan.table(s, d, "embeddings").select(F.col("vec_id").alias("id"), latent.unit(F.col("embedding").cast("array<double>")).alias("v"))


add(
    "l9_nearest",
    lambda s, d: nearest.nearest(_units(s, d), _units(s, d).where("id % 20 = 0").withColumnRenamed("id", "query_id"), 10).select("query_id", "id", "rank", F.round("sim", 6).alias("sim")),
    "WITH u AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS v FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)), s AS (SELECT q.vec_id AS query_id, r.vec_id AS id, round(list_dot_product(q.v, r.v), 9) AS sim FROM u q, u r WHERE q.vec_id % 20 = 0) SELECT query_id, id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, id) AS INTEGER) AS rank, round(sim, 6) AS sim FROM s QUALIFY rank <= 10",
)

# BM25: in full by SQL, with early stop, and from a stored index without the texts
BM25_SQL = f"""
WITH p AS (SELECT term, doc_id, count(*) AS tf FROM ({terms_sql('documents', 'doc_id', 'text')}) GROUP BY 1, 2),
q AS (SELECT DISTINCT item_id AS query_id, term FROM ({terms_sql('benchmark', 'item_id', 'text')})),
len AS (SELECT doc_id, sum(tf) AS len FROM p GROUP BY 1),
df AS (SELECT term, count(*) AS df FROM p GROUP BY 1),
n AS (SELECT CAST((SELECT count(*) FROM documents) AS DOUBLE) AS n, (SELECT sum(tf) FROM p) AS all_terms),
w AS (SELECT term, doc_id, ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len / (all_terms / n))) AS w FROM p JOIN df USING (term) JOIN len USING (doc_id) CROSS JOIN n),
s AS (SELECT query_id, doc_id, sum(w) AS s, count(*) AS hits FROM q JOIN w USING (term) GROUP BY 1, 2),
size AS (SELECT query_id, count(*) AS typed FROM q GROUP BY 1),
scored AS (SELECT query_id, doc_id, floor(least(s / (s + 9), 1) * 10000 + 0.5) / 10000 AS score, round(CAST(hits AS DOUBLE) / typed, 9) AS overlap FROM s JOIN size USING (query_id))"""
BEST_SQL = BM25_SQL + " SELECT query_id, doc_id, score, overlap, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored QUALIFY rank <= 5"


def _n_docs(s: SparkSession, d: str) -> DataFrame:
    return plan.table(s, d, "documents").agg(F.count(F.lit(1)).alias("n_docs"))


def impact_index(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The documents' postings in blocks and the table of blocks, kept as tables."""
    rows = kept(s, "blocks", (d,), lambda: impact.laid_out(impact.blocks(impact.weighted(document_postings(s, d), _n_docs(s, d), "doc_id"), "doc_id"), "doc_id"))
    return rows, kept(s, "heads", (d,), lambda: impact.heads_of(rows))


def _early_stop(s: SparkSession, d: str) -> DataFrame:
    return impact.best(*impact_index(s, d), benchmark_questions(s, d), "doc_id").select("query_id", "doc_id", "score", F.round("overlap", 9).alias("overlap"), "rank")


def _from_index(s: SparkSession, d: str) -> DataFrame:
    folder = _folder(s, "index")
    post = document_postings(s, d)
    lengths = plan.table(s, d, "documents").select("doc_id").join(post.groupBy("doc_id").agg(F.sum("tf").alias("len")), "doc_id", "left")
    publish.save_index({"postings": post.repartition("term").sortWithinPartitions("term"), "lengths": lengths}, folder, "0001")
    held = publish.load_index(s, folder)
    scored = retrieval.bm25(held["lengths"], benchmark_questions(s, d), "doc_id", "text", held["postings"])
    return retrieval.top(scored.select("query_id", "doc_id", "score", F.round("overlap", 9).alias("overlap")), "doc_id", "doc_id", 5, 0.0)


add("l5_early_stop", _early_stop, BEST_SQL)
add("a11_stored_index", _from_index, BEST_SQL)
add("l6_overlap", lambda s, d: retrieval.bm25(plan.table(s, d, "documents"), benchmark_questions(s, d), "doc_id", "text", document_postings(s, d)).groupBy("query_id").agg(F.count(F.lit(1)).alias("docs"), F.round(F.max("overlap"), 9).alias("most"), F.max("n_typed").alias("typed")), BM25_SQL + " SELECT query_id, count(*) AS docs, max(overlap) AS most, any_value(typed) AS typed FROM scored JOIN size USING (query_id) GROUP BY 1")


# chunks that share meaning with a question and none of its words
def latent_vectors(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(term, v) and (doc_id, v) of the documents' space."""
    post = document_postings(s, d)
    size = _n_docs(s, d).first()[0], post.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where("df > 1").count()
    return latent.latent_space(retrieval.tfidf(post, "doc_id", _n_docs(s, d)), "doc_id", size=size)[:2]


def _latent(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(term, v) and (doc_id, v) of the documents' space, kept as tables."""
    made: list = []

    def build() -> tuple[DataFrame, DataFrame]:
        if not made:
            made.extend(latent_vectors(s, d))
        return made

    return kept(s, "latent-terms", (d,), lambda: build()[0]), kept(s, "latent-rows", (d,), lambda: build()[1])


def semantic_candidates(s: SparkSession, d: str, queries: DataFrame, expansions: DataFrame, k: int = 50) -> DataFrame:
    """(query_id, doc_id, sem): the k documents nearest to each question in the latent
    space, whether they share a word with it or not."""
    terms, rows = _latent(s, d)
    asked = latent.folded(retrieval.expanded(queries, expansions), terms)
    found = nearest.nearest(rows.select(F.col("doc_id").alias("id"), "v"), asked, k)
    return found.where("sim > 0").select("query_id", F.col("id").alias("doc_id"), F.col("sim").alias("sem"))


# incremental rollups: the permits in three batches, late and repeated ones among them
def _rolled(s: SparkSession, d: str) -> DataFrame:
    permits = plan.permits(s, d)
    state = PermitRollups(s, _folder(s, "rollups"))
    for batch, where in enumerate(("number % 3 = 1 or modified >= '1997-01-01'", "modified < '1996-01-01'", "number % 5 <> 0 or modified < '1997-06-01'")):
        state.merge(permits.where(where), batch)
    return state.rollups().drop("roof_completed", "roof_issued")


add("t1_rolled_by_batches", _rolled, over_permits("SELECT key, CAST(count(*) AS INTEGER) AS permit_count, CAST(count(*) FILTER (WHERE type IN ('RF','ROR')) AS INTEGER) AS roofing_permit_count, CAST(count(*) FILTER (WHERE status <> 'COMPLETE') AS INTEGER) AS open_permit_count, CAST(count(*) FILTER (WHERE type IN ('RF','ROR') AND status <> 'COMPLETE') AS INTEGER) AS open_roofing_permit_count, CAST(max(date_diff('day', issued, DATE '2001-09-01')) FILTER (WHERE status <> 'COMPLETE') AS INTEGER) AS longest_open_permit_days, CAST(max(issued) AS VARCHAR) AS latest_permit_date FROM permits GROUP BY key"))

# token buckets: in whole numbers (a token is 6,000,000 units, a microsecond adds one), so that the scan equals the recursion
_BUCKET_SQL = """
WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
r AS (
  SELECT user_id, k, us, CAST(30000000 AS BIGINT) AS found, event_id FROM e WHERE k = 1
  UNION ALL
  SELECT e.user_id, e.k, e.us, least(30000000, CASE WHEN r.found >= 6000000 THEN r.found - 6000000 ELSE r.found END + e.us - r.us), e.event_id FROM r JOIN e ON e.user_id = r.user_id AND e.k = r.k + 1)"""
add("t2_token_bucket", lambda s, d: buckets.token_bucket(plan.table(s, d, "events")).groupBy("user_id").agg(F.count_if("refused").alias("refused"), F.round(F.max("wait"), 3).alias("wait")), _BUCKET_SQL + " SELECT user_id, count(*) FILTER (WHERE found < 6000000) AS refused, round(max(greatest(0, 6000000 - found)) / CAST(1000000 AS DOUBLE), 3) AS wait FROM r GROUP BY 1")
add("t2_refusals", lambda s, d: buckets.token_bucket(plan.table(s, d, "events")).select("event_id", "user_id", "refused", F.round("wait", 6).alias("wait")), _BUCKET_SQL + " SELECT event_id, user_id, found < 6000000 AS refused, round(greatest(0, 6000000 - found) / CAST(1000000 AS DOUBLE), 6) AS wait FROM r")


# runs in partitions, pages by key, a gate in flight, reasons in the schema
def _runs(s: SparkSession, d: str) -> DataFrame:
    events, path = plan.table(s, d, "events"), _folder(s, "runs")
    events.select("event_id", "event_type", F.date_format("ts", "yyyyMMdd").alias("run_id")).write.partitionBy("run_id").parquet(path)
    for run in [r["run_id"] for r in events.select(F.date_format("ts", "yyyyMMdd").alias("run_id")).distinct().orderBy(F.desc("run_id")).limit(2).collect()]:
        publish.write_run(events.where(F.date_format("ts", "yyyyMMdd") == run).select("event_id", "event_type"), path, run)
    return publish.newest_run(s, path, "event_id bigint, event_type string")


add("a10_newest_run", lambda s, d: _runs(s, d).groupBy("run_id", "event_type").agg(F.count(F.lit(1)).alias("n")), "SELECT strftime(ts, '%Y%m%d') AS run_id, event_type, count(*) AS n FROM events WHERE strftime(ts, '%Y%m%d') = (SELECT max(strftime(ts, '%Y%m%d')) FROM events) GROUP BY 1, 2")


def _pages(s: SparkSession, d: str) -> DataFrame:
    """Four pages of 150 rows, each found from the last row of the one before."""
    out, token = None, None
    for page in range(4):
        rows = page_after(plan.properties(s, d), "last_sale_price", limit=150, token=token)
        token = page_token(rows, "last_sale_price")
        own = rows.select(F.lit(page).alias("page"), "property_id", "last_sale_price")
        out = own if out is None else out.unionByName(own)
        if token is None:  # the last page has been seen
            break
    return out


add("g4_keyset_pages", _pages, over_properties("SELECT CAST((k - 1) // 150 AS INTEGER) AS page, property_id, last_sale_price FROM (SELECT property_id, last_sale_price, row_number() OVER (ORDER BY last_sale_price DESC NULLS LAST, property_id) AS k FROM properties) WHERE k <= 600"))


def _published(s: SparkSession, d: str) -> DataFrame:
    path = _folder(s, "published")
    rows, names = plan.stored(s, d)
    publish.publish(rows, path, "property_id", finish=lambda counted: plan.named(counted, names))
    return s.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("property_id").alias("ids"), F.sum("permit_count").alias("permits"))


add("p2_published", _published, over_properties("SELECT count(*) AS n, count(DISTINCT property_id) AS ids, CAST(sum(permit_count) AS BIGINT) AS permits FROM properties"))
_KIND = {"s": "string", "d": "double", "i": "int", "b": "boolean"}
_REASON_SQL = " UNION ALL ".join(f"SELECT '{c}' AS name, '{_KIND[k]}' AS kind, {n} AS place, {c in REASONS} AS always_null, {chr(39) + REASONS[c] + chr(39) if c in REASONS else 'CAST(NULL AS VARCHAR)'} AS reason, count({c}) AS filled FROM properties" for n, (c, k) in enumerate(COLUMNS))


def _annotated(t: DataFrame) -> DataFrame:
    """The listing of a view over the annotated table, with how many rows each column fills."""
    view = annotated(t).where("property_id is not null").select("*")
    filled = t.agg(*[F.count(c).alias(c) for c in t.columns]).unpivot([], t.columns, "name", "filled")
    return schema_listing(view).join(filled, "name")


over("b8_annotated_schema", _annotated, _REASON_SQL)

# a lookup with its sources and notices, a radius around a city
_KEYS = ("00000042", "prop-77", "no such parcel")


def _details(s: SparkSession, d: str) -> DataFrame:
    """One row a key that was asked for: the parcel with its sources and gated fields, or not found."""
    t, out = plan.properties(s, d), None
    for key in _KEYS:
        one = lookup(t, key)
        sources = provenance.source_rows(one).agg(F.array_join(F.array_sort(F.collect_set("label")), "; ").alias("sources"))
        gated = provenance.gated(one).agg(F.array_join(F.array_sort(F.collect_set("field")), ",").alias("gated"))
        found = one.agg(F.max("property_id").alias("property_id"), F.max("address_city").alias("address_city"), F.max("roof_age_years").alias("roof_age_years"))
        own = found.crossJoin(sources).crossJoin(gated).select(F.lit(key).alias("asked"), F.col("property_id").isNotNull().alias("found"), "*")
        out = own if out is None else out.unionByName(own)
    return out


_LABEL = "CASE token WHEN 'fl_dor_nal_2026p' THEN 'FL DOR NAL 2026 preliminary tax roll' WHEN 'fl_gio_parcel_centroid_2025' THEN 'FL GIO parcel centroids 2025' WHEN 'lake_cdplus_permits' THEN 'Lake County CD Plus permit layer' WHEN 'fl_dor_sdf_2026p' THEN 'FL DOR SDF 2026 preliminary sales file' WHEN 'fl_dor_tpp_2026p' THEN 'FL DOR TPP 2026 preliminary tangible personal property roll' ELSE token END"
add(
    "v2_lookup",
    _details,
    over_properties(f"SELECT asked, p.property_id IS NOT NULL AS found, p.property_id, address_city, roof_age_years, coalesce((SELECT string_agg(DISTINCT {_LABEL}, '; ' ORDER BY {_LABEL}) FROM (SELECT unnest(string_split(p.source_systems, '|')) AS token)), '') AS sources, CASE WHEN p.property_id IS NULL THEN '' ELSE 'bbb_rating,contractor_name' END AS gated FROM (SELECT unnest(['{_KEYS[0]}', '{_KEYS[1]}', '{_KEYS[2]}']) AS asked) LEFT JOIN properties p ON p.request_identifier = asked OR p.property_id = asked"),
)
over("v13_near_city", lambda t: near_city(t, agg.city_centroid(t, CITY), 12.0).select("property_id", F.round("distance_miles", 6).alias("miles")), "SELECT * FROM (WITH c AS (SELECT round(avg(latitude), 9) AS lat, round(avg(longitude), 9) AS lon FROM properties WHERE upper(address_city) = '" + CITY + "' AND latitude IS NOT NULL) SELECT property_id, round(m, 6) AS miles FROM (SELECT property_id, 2 * 3958.7613 * asin(sqrt(pow(sin((radians(latitude) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(latitude)) * pow(sin(radians(longitude - lon) / 2), 2))) AS m FROM properties, c WHERE latitude IS NOT NULL) WHERE m <= 12)")
over("e10_city_of_the_table", lambda t: agg.city_centroid(t, CITY), f"SELECT round(avg(latitude), 9) AS lat, round(avg(longitude), 9) AS lon, count(*) AS n FROM properties WHERE upper(address_city) = '{CITY}' AND latitude IS NOT NULL")
over("c2_city_of_the_table", lambda t: matching(t, city=CITY.lower()).select("property_id", "address_city"), f"SELECT property_id, address_city FROM properties WHERE address_city = '{CITY}'")
over("g7_leads_in_a_city", lambda t: search(t, "roof_age_years", min_roof_age=15, city=CITY, limit=25).select("property_id", "roof_age_years"), f"SELECT property_id, roof_age_years FROM properties WHERE roof_age_years >= 15 AND address_city = '{CITY}' ORDER BY roof_age_years DESC NULLS LAST, property_id LIMIT 25")
