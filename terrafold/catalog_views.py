"""Composed views, run records, sources and the hybrid retriever as checked queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import _NOTICE, _STATS, _STEM, SQL, add, benchmark_questions, document_postings, normal_sql, over, terms_sql
from .catalog_deep import BM25_SQL, BEST_SQL, impact_index, latent_vectors, semantic_candidates
from .catalog_more import _interpreted
from .contract import COLUMNS, schema_gate
from .operators import aggregates as agg
from .operators import corpus, impact, interpret, provenance, retrieval, runs
from .oracle import over_properties
from .plans import consolidate as plan
from .sources import readers
from .sources.shared import kept, shared_folder, written

# composed views
_DETAIL = f"SELECT property_id, string_agg(DISTINCT label, '; ' ORDER BY label) AS sources FROM ({SQL['b5_source_systems'].partition('SELECT property_id, token, CASE')[1]}{SQL['b5_source_systems'].partition('SELECT property_id, token, CASE')[2]}) GROUP BY 1"
over(
    "v2_detail",
    lambda t: t.select("property_id", "address_city", "roof_age_years")
    .join(provenance.source_rows(t).groupBy("property_id").agg(F.array_join(F.array_sort(F.collect_set("label")), "; ").alias("sources")), "property_id", "left")
    .join(provenance.gated(t).groupBy("property_id").agg(F.array_join(F.array_sort(F.collect_set("field")), ",").alias("gated")), "property_id", "left"),
    f"SELECT p.property_id, address_city, roof_age_years, sources, gated FROM properties p LEFT JOIN ({_DETAIL}) s ON s.property_id = p.property_id LEFT JOIN (SELECT property_id, string_agg(DISTINCT field, ',' ORDER BY field) AS gated FROM ({_NOTICE}) WHERE severity = 'gated' GROUP BY 1) g ON g.property_id = p.property_id",
)
over("v7_contractors", lambda t: provenance.gated(t).groupBy("token", "field").agg(F.count(F.lit(1)).alias("parcels")).crossJoin(F.broadcast(agg.permit_posture(t).select("permits", "contractors", "open_permits"))), f"SELECT token, field, count(*) AS parcels, any_value(permits) AS permits, any_value(contractors) AS contractors, any_value(open_permits) AS open_permits FROM ({_NOTICE}) CROSS JOIN (SELECT CAST(sum(permit_count) AS BIGINT) AS permits, count(contractor_name) AS contractors, CAST(sum(open_permit_count) AS BIGINT) AS open_permits FROM properties) WHERE severity = 'gated' GROUP BY 1, 2")


def dataset_info(s: SparkSession, d: str) -> DataFrame:
    t = plan.properties(s, d)
    run = plan.table(s, d, "events").agg(F.date_format(F.max("ts"), "yyyyMMdd").alias("value")).select(F.lit("run_id").alias("name"), "value")
    stats = provenance.metric_record(agg.dataset_stats(t)).select(F.col("metric").alias("name"), F.col("value").cast("long").cast("string").alias("value"))
    limits = t.agg(F.format_string("%d parcels have no coordinates", F.count_if(F.col("latitude").isNull())).alias("value")).select(F.lit("limitation").alias("name"), "value")
    return run.unionByName(stats).unionByName(limits)


add("v10_dataset_info", dataset_info, over_properties("SELECT 'run_id' AS name, (SELECT strftime(max(ts), '%Y%m%d') FROM events) AS value UNION ALL SELECT metric, CAST(CAST(value AS BIGINT) AS VARCHAR) FROM (UNPIVOT (" + _STATS + ") ON COLUMNS(*) INTO NAME metric VALUE value) UNION ALL SELECT 'limitation', count(*) FILTER (WHERE latitude IS NULL) || ' parcels have no coordinates' FROM properties"))
_KIND = {"s": "string", "d": "double", "i": "int", "b": "boolean"}
over(
    "v11_schema",
    lambda t: t.agg(*[F.count(c).alias(c) for c, _ in COLUMNS]).unpivot([], [c for c, _ in COLUMNS], "name", "filled").join(F.broadcast(t.sparkSession.createDataFrame([(c, _KIND[k], n) for n, (c, k) in enumerate(COLUMNS)], "name string, kind string, place int")), "name"),
    " UNION ALL ".join(f"SELECT '{c}' AS name, '{_KIND[k]}' AS kind, {n} AS place, count({c}) AS filled FROM properties" for n, (c, k) in enumerate(COLUMNS)),
)

# run records
_DAY = "CAST(CAST(ts AS DATE) AS VARCHAR)"


def _days(s, d):
    return plan.table(s, d, "events").groupBy(F.to_date("ts").cast("string").alias("run_id")).agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last"))


def _half(s, d):
    return _days(s, d).agg(F.min("run_id").alias("a"), F.max("run_id").alias("b"))


add(
    "r2_count_delta",
    lambda s, d: runs.count_delta(*[plan.table(s, d, "events").where(c).groupBy(F.col("event_type").alias("name")).agg(F.count(F.lit(1)).alias("n")) for c in ("event_type <> 'view' and hour(ts) < 12", "true")]),
    "SELECT e.event_type AS name, count(*) AS rows, any_value(b.n) AS previous, count(*) - any_value(b.n) AS delta FROM events e LEFT JOIN (SELECT event_type, count(*) AS n FROM events WHERE event_type <> 'view' AND hour(ts) < 12 GROUP BY 1) b ON b.event_type = e.event_type GROUP BY 1",
)
add(
    "r3_history_breaches",
    lambda s, d: runs.history_breaches(_days(s, d), _days(s, d).crossJoin(F.broadcast(_half(s, d))).where("run_id <> a").withColumn("n", F.when(F.col("run_id") == F.col("b"), F.col("n") + 1).otherwise(F.col("n"))).drop("a", "b")).select(F.col("key").alias("run_id")),
    f"SELECT {_DAY} AS run_id FROM events WHERE CAST(ts AS DATE) IN (SELECT unnest([min(CAST(ts AS DATE)), max(CAST(ts AS DATE))]) FROM events) GROUP BY 1",
)
_PAIRS = "SELECT event_id, 'r' || user_id % 3 AS root, 'r' || event_id % 3 AS new_root, user_id % 7 AS run, CASE WHEN event_id % 5 <> 0 THEN event_id % 7 END AS new_run FROM events"
add(
    "r9_upgrade",
    lambda s, d: runs.upgrade(plan.table(s, d, "events").selectExpr("event_id", "concat('r', user_id % 3) as root", "concat('r', event_id % 3) as new_root", "user_id % 7 as run", "if(event_id % 5 <> 0, event_id % 7, null) as new_run")).select("event_id", "action"),
    f"SELECT event_id, CASE WHEN root = new_root THEN 'current' WHEN new_run IS NULL OR new_run <= run THEN 'keep' ELSE 'upgrade' END AS action FROM ({_PAIRS})",
)
add(
    "r10_trusted",
    lambda s, d: runs.trusted(plan.table(s, d, "events").selectExpr("event_id", "user_id % 4 as root", "event_id % 4 as read_back", "event_type as name", "if(user_id % 3 = 0, 'other', event_type) as asked")).select("event_id"),
    "SELECT event_id FROM events WHERE user_id % 4 = event_id % 4 AND user_id % 3 <> 0",
)
add(
    "r11_served_run",
    lambda s, d: runs.served(_days(s, d), _days(s, d).join(F.broadcast(_half(s, d)), F.col("run_id") < F.col("b")).select("run_id", F.col("last").alias("bundled"))).select("run_id", "n", "bundled"),
    f"SELECT run_id, n, CASE WHEN run_id < (SELECT max({_DAY}) FROM events) THEN last END AS bundled FROM (SELECT {_DAY} AS run_id, count(*) AS n, max(event_id) AS last FROM events GROUP BY 1)",
)


def _manifest(s: SparkSession, d: str) -> DataFrame:
    path = f"{shared_folder(s)}/names-{s.sparkContext.applicationId}-{abs(hash(d))}"
    plan.table(s, d, "nation").orderBy("n_nationkey").select("n_name").coalesce(1).write.mode("overwrite").text(path)
    return readers.manifest(s, path).where("name like 'part-%'").select("size", "sha256")


add("r5_manifest", _manifest, "SELECT CAST(sum(length(n_name) + 1) AS BIGINT) AS size, sha256(string_agg(n_name || chr(10), '' ORDER BY n_nationkey)) AS sha256 FROM nation")

# sources
add("a2_relation", lambda s, d: (readers.relation(s, f"{d}/orders.parquet").createOrReplaceTempView("orders_by_path"), readers.relation(s, "orders_by_path").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")))[1], "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
add("a4_first_readable", lambda s, d: readers.first_readable(s, [f"{d}/no_such_table.parquet", f"{d}/orders.parquet", f"{d}/customer.parquet"], f"{d}/neither.parquet")[1].groupBy("o_orderstatus").agg(F.sum("o_orderkey").alias("keys")), "SELECT o_orderstatus, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1")
over("a5_gated_schema", lambda t: schema_gate(t).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("property_type").alias("types")), "SELECT count(*) AS n, count(DISTINCT property_type) AS types FROM properties")


def _coverage(s: SparkSession, d: str) -> DataFrame:
    t = plan.properties(s, d)
    made = t.agg(F.count(F.lit(1)).alias("assessedParcelCount"), F.count("latitude").alias("points")).selectExpr("'run' as runId", "named_struct('basis', 'roll', 'source', 'nal', 'assessedParcelCount', assessedParcelCount) as denominator", "map('points', named_struct('rows', points, 'source', 'gio')) as tables", "array('no coordinates') as limitations")
    path = f"{shared_folder(s)}/coverage-{s.sparkContext.applicationId}-{abs(hash(d))}"
    made.coalesce(1).write.mode("overwrite").json(path)
    assert readers.run_record(s, path + "-missing") is None
    return readers.run_record(s, path).select("runId", F.col("denominator.assessedParcelCount").alias("assessed"), F.col("tables")["points"]["rows"].alias("points"), F.col("limitations")[0].alias("limitation"))


add("a7_run_record", _coverage, over_properties("SELECT 'run' AS runId, count(*) AS assessed, count(latitude) AS points, 'no coordinates' AS limitation FROM properties"))


def _jurisdictions(s: SparkSession, d: str) -> DataFrame:
    n, r = plan.table(s, d, "nation"), plan.table(s, d, "region")
    rows = n.join(r, n["n_regionkey"] == r["r_regionkey"]).groupBy(F.col("r_name").alias("county")).agg(F.collect_list(F.expr("named_struct('name', n_name, 'supported', n_nationkey % 2 = 0, 'certified', if(n_nationkey % 3 = 0, null, n_nationkey % 5 > 0))")).alias("j")).select("county", F.struct(F.col("j").alias("jurisdictions")).alias("permits"))
    path = f"{shared_folder(s)}/catalog-{s.sparkContext.applicationId}-{abs(hash(d))}"
    rows.write.mode("overwrite").json(path)
    return readers.jurisdictions(s.read.schema(readers.CATALOG).json(path)).select("county", "name", "harvested")


add("a9_jurisdictions", _jurisdictions, "SELECT r_name AS county, n_name AS name, n_nationkey % 2 = 0 AND coalesce(CASE WHEN n_nationkey % 3 <> 0 THEN n_nationkey % 5 > 0 END, FALSE) AS harvested FROM nation JOIN region ON n_regionkey = r_regionkey")


def _bounded(s: SparkSession, d: str) -> DataFrame:
    plan.properties(s, d).createOrReplaceTempView("properties_now")
    out = None
    for limit in (10, 1000):
        rows, more = readers.bounded(s, "select property_id from properties_now order by property_id", limit)
        own = rows.agg(F.count(F.lit(1)).alias("n"), F.max("property_id").alias("last")).withColumn("truncated", F.lit(more))
        out = own if out is None else out.unionByName(own)
    return out


add("g5_bounded", _bounded, over_properties(" UNION ALL ".join(f"SELECT count(*) AS n, max(property_id) AS last, (SELECT count(*) FROM properties) > {k} AS truncated FROM (SELECT property_id FROM properties ORDER BY 1 LIMIT {k})" for k in (10, 1000))))


def _shards(s: SparkSession, d: str) -> DataFrame:
    path = f"{shared_folder(s)}/shards-{s.sparkContext.applicationId}-{abs(hash(d))}-{id(object())}"
    readers.write_shards(plan.properties(s, d).select("property_id", "permit_count"), path, "property_id", 500)
    return s.read.schema("property_id string, permit_count int, shard int").json(path).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("property_id").alias("ids"), F.sum("permit_count").alias("permits"))


add("p16_shards", _shards, over_properties("SELECT count(*) AS n, count(DISTINCT property_id) AS ids, CAST(sum(permit_count) AS BIGINT) AS permits FROM properties"))



def _accounts_at(s: SparkSession, d: str) -> DataFrame:
    """Suppliers at the addresses of the parcels with their numbers, spelled otherwise."""
    at = plan.properties(s, d).select(F.col("alt_key").cast("long").alias("s_suppkey"), F.lower(F.regexp_replace("address_street", " ", " .")).alias("street"), F.concat("address_zip", F.lit("-0001")).alias("zip"))
    return plan.table(s, d, "supplier").join(at, "s_suppkey").select(F.col("s_name").alias("account"), "street", "zip")


add(
    "p6_by_address",
    lambda s, d: plan.attributed(plan.properties(s, d), _accounts_at(s, d)).select("property_id", "accounts", "names"),
    over_properties("SELECT property_id, count(*) AS accounts, string_agg(DISTINCT s_name, '; ' ORDER BY s_name) AS names FROM properties p JOIN (SELECT s_name, address_street AS street, address_zip AS zip FROM supplier JOIN properties ON CAST(alt_key AS BIGINT) = s_suppkey) a ON a.street = p.address_street AND a.zip = p.address_zip GROUP BY 1"),
)
add(
    "p6_shared",
    lambda s, d: plan.attributed(plan.properties(s, d), _accounts_at(s, d)).groupBy("address").agg(F.max("accounts").alias("accounts"), F.count(F.lit(1)).alias("parcels")).agg(F.sum("accounts").alias("matched"), F.count_if(F.col("parcels") > 1).alias("shared"), F.sum(F.col("accounts") * F.col("parcels")).alias("attributed")),
    over_properties("SELECT CAST(sum(accounts) AS BIGINT) AS matched, count(*) FILTER (WHERE parcels > 1) AS shared, CAST(sum(accounts * parcels) AS BIGINT) AS attributed FROM (SELECT p.address_street, p.address_zip, count(DISTINCT s_suppkey) AS accounts, count(DISTINCT p.property_id) AS parcels FROM properties p JOIN (SELECT s_suppkey, address_street AS street, address_zip AS zip FROM supplier JOIN properties ON CAST(alt_key AS BIGINT) = s_suppkey) a ON a.street = p.address_street AND a.zip = p.address_zip GROUP BY 1, 2)"),
)

# joins of the ad-hoc surface, links, sections
add("d1_joins", lambda s, d: [plan.table(s, d, t).createOrReplaceTempView(f"now_{t}") for t in ("customer", "orders")] and s.sql("select c_mktsegment, o_orderstatus, count(*) as n, count(o_orderkey) as o, count(c_custkey) as c from now_customer full join now_orders on c_custkey = o_custkey + 20 group by all"), "SELECT c_mktsegment, o_orderstatus, count(*) AS n, count(o_orderkey) AS o, count(c_custkey) AS c FROM customer FULL JOIN orders ON c_custkey = o_custkey + 20 GROUP BY ALL")
add("d8_verified_before", lambda s, d: plan.table(s, d, "customer").join(plan.table(s, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi").select("c_custkey"), "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
add(
    "k7_link_edges",
    lambda s, d: corpus.link_edges((plan.table(s, d, "documents").withColumn("doc", F.concat(F.lit("doc:"), "doc_id")), "doc", "source", "derived_from"), (plan.table(s, d, "labels").withColumn("doc", F.concat(F.lit("doc:"), "doc_id")).withColumn("limit", F.when(F.col("toxic") == 1, "toxic")), "doc", "limit", "limits"), (provenance.source_rows(plan.properties(s, d)), "token", "label", "documents")),
    over_properties(f"SELECT DISTINCT * FROM (SELECT 'doc:' || doc_id AS source, source AS target, 'derived_from' AS kind FROM documents UNION ALL SELECT 'doc:' || doc_id, 'toxic', 'limits' FROM labels WHERE toxic = 1 UNION ALL SELECT token, label, 'documents' FROM ({SQL['b5_source_systems'][SQL['b5_source_systems'].index('SELECT property_id, token, CASE'):]})) WHERE source IS NOT NULL AND target IS NOT NULL"),
)
_MD = "'# ' || source || chr(10) || '```' || chr(10) || '# no heading' || chr(10) || '```' || chr(10) || '### ' || coalesce(lang, '') || chr(10) || 'one' || chr(10) || '## two' || chr(10) || coalesce(replace(text, chr(35), '-'), '')"
_TIDY = "trim(regexp_replace(regexp_replace({}, '[ \\t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), ' ')"
add(
    "k1_markdown_sections",
    lambda s, d: corpus.markdown_sections(plan.table(s, d, "documents").withColumn("md", F.expr(_MD.replace("chr(35)", "'#'"))), "doc_id", "md").select("doc_id", "section", "trail", F.sha2("body", 256).alias("body")),
    "SELECT doc_id, CAST(section AS BIGINT) AS section, trail, sha256(body) AS body FROM (SELECT doc_id, 1 AS section, source AS trail, '```' || chr(10) || '# no heading' || chr(10) || '```' AS body FROM documents UNION ALL SELECT doc_id, 2, source || CASE WHEN coalesce(lang, '') <> '' THEN ' > ' || lang ELSE '' END, 'one' FROM documents UNION ALL SELECT doc_id, 3, source || ' > two', " + _TIDY.format("coalesce(replace(text, chr(35), '-'), '')") + " FROM documents) WHERE body <> ''",
)


def _sectioned(s: SparkSession, d: str) -> DataFrame:
    docs = plan.table(s, d, "documents")
    sections = corpus.markdown_sections(docs.withColumn("md", F.expr(_MD.replace("chr(35)", "'#'"))), "doc_id", "md")
    return corpus.section_chunks(sections.join(docs.select("doc_id", "lang"), "doc_id"), "doc_id", "lang")


add("k3_section_chunks", lambda s, d: _sectioned(s, d).select("chunk_id", "doc_id", "chunk_count", "trail", "source_hash"))


# the hybrid retriever
_Q = "(SELECT item_id AS query_id, text AS question FROM benchmark)"


def _titled(s: SparkSession, d: str) -> DataFrame:
    return plan.table(s, d, "documents").select("doc_id", "text", "lang", "source", F.concat_ws(" ", "source", F.substring_index(F.col("text"), " ", 3)).alias("title"))


def _aliases(s: SparkSession, d: str) -> DataFrame:
    return plan.table(s, d, "documents").select("doc_id", F.substring_index("text", " ", 2).alias("alias"))


def _expansions(s: SparkSession, d: str) -> DataFrame:
    """From each document: its first word adds its source."""
    return plan.table(s, d, "documents").where("source is not null").select(F.substring_index("text", " ", 1).alias("trigger"), F.col("source").alias("term"))


_OWN = f"SELECT DISTINCT item_id AS query_id, term FROM ({terms_sql('benchmark', 'item_id', 'text')})"
_STEMMED = lambda c: f"(SELECT {_STEM} FROM (SELECT lower({c}) AS t))"
add(
    "l4_expansion",
    lambda s, d: retrieval.expanded(benchmark_questions(s, d), _expansions(s, d)).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("weight") == 1).alias("typed")),
    f"WITH q AS ({_OWN}), x AS (SELECT DISTINCT {_STEMMED('w')} AS met, {_STEMMED('source')} AS term FROM (SELECT DISTINCT string_split(text, ' ')[1] AS w, source FROM documents WHERE source IS NOT NULL)), a AS (SELECT query_id, term, 1.0 AS weight FROM q UNION ALL SELECT query_id, x.term, 0.45 FROM q JOIN x ON q.term = x.met), m AS (SELECT query_id, term, max(weight) AS weight FROM a GROUP BY 1, 2) SELECT query_id, count(*) AS n, count(*) FILTER (WHERE weight = 1) AS typed FROM m GROUP BY 1",
)
SQL["l5_bm25"] = BEST_SQL.replace("round(CAST(hits AS DOUBLE) / typed, 9)", "CAST(hits AS DOUBLE) / typed")
add(
    "l7_tfidf",
    lambda s, d: retrieval.tfidf(document_postings(s, d), "doc_id", plan.table(s, d, "documents").agg(F.count(F.lit(1)).alias("n_docs"))).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("w"), 6).alias("most"), F.round(F.sum(F.col("w") * F.col("w")), 6).alias("norm")),
    f"WITH p AS (SELECT term, doc_id, count(*) AS tf FROM ({terms_sql('documents', 'doc_id', 'text')}) GROUP BY 1, 2), d AS (SELECT term, count(*) AS df FROM p GROUP BY 1), w AS (SELECT doc_id, (1 + ln(tf)) * (ln(((SELECT count(*) FROM documents) + 1) / (df + 1)) + 1) AS w FROM p JOIN d USING (term)) SELECT doc_id, count(*) AS n, round(max(w) / sqrt(sum(w * w)), 6) AS most, CAST(1 AS DOUBLE) AS norm FROM w GROUP BY 1",
)
add("l10_cosine", lambda s, d: plan.table(s, d, "embeddings").select("vec_id", F.round(retrieval.cosine(F.col("embedding"), F.reverse("embedding")), 6).alias("sim")), "SELECT vec_id, round(greatest(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(list_reverse(embedding) AS DOUBLE[])), 0), 6) AS sim FROM embeddings")
_PLAIN_Q = "trim(regexp_replace(lower({}), '[^a-z0-9_]+', ' ', 'g'))"
add(
    "l11_alias",
    lambda s, d: retrieval.alias_scores(benchmark_questions(s, d), _aliases(s, d), "doc_id").select("query_id", "doc_id", F.round("alias", 9).alias("alias")),
    f"SELECT query_id, doc_id, round(max(least(1, 0.6 + CAST(length(a) AS DOUBLE) / 40)), 9) AS alias FROM (SELECT query_id, {_PLAIN_Q.format('question')} AS q FROM {_Q}) JOIN (SELECT doc_id, {_PLAIN_Q.format('array_to_string(string_split(text, chr(32))[1:2], chr(32))')} AS a FROM documents) ON length(a) >= 3 AND contains(' ' || q || ' ', ' ' || a || ' ') GROUP BY 1, 2",
)


def _hybrid(s: SparkSession, d: str, semantic: bool = False, types=None, asked: DataFrame | None = None, **given) -> DataFrame:
    docs, post = _titled(s, d), document_postings(s, d)
    asked = benchmark_questions(s, d) if asked is None else asked
    sem = semantic_candidates(s, d, asked, _expansions(s, d)) if semantic else None
    return retrieval.hybrid(docs, asked, _aliases(s, d), post, "doc_id", semantic=sem, types=types, **given)


def _found(s: SparkSession, d: str) -> DataFrame:
    """What the retriever finds, kept as a table for the views over it: these ask for what is
    over the floor or holds a run of the question's words."""
    return kept(s, "hybrid", (d,), lambda: _hybrid(s, d, semantic=True, least=retrieval.FLOOR))


add("l8_latent_space", lambda s, d: latent_vectors(s, d)[1].select("doc_id", F.size("v").alias("k"), F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x), 6).alias("norm")))
add("l14_hybrid", lambda s, d: retrieval.top(_found(s, d), "doc_id", "doc_id").select("query_id", "doc_id", "rank", "score"))


# the signals but for the latent one, fused: these SQL can express. Half of the questions are reversed, so that the corpus knows none of their words
def _controls(s: SparkSession, d: str) -> DataFrame:
    own = benchmark_questions(s, d)
    return own.unionByName(own.select((F.col("query_id") + 1_000_000).alias("query_id"), F.reverse("question").alias("question")))


def _fused(s: SparkSession, d: str) -> DataFrame:
    return kept(s, "fused", (d,), lambda: _hybrid(s, d, asked=_controls(s, d), least=retrieval.FLOOR))


_CONTROLS = "(SELECT item_id, text FROM benchmark UNION ALL SELECT item_id + 1000000, reverse(text) FROM benchmark)"
_TITLED = "(SELECT doc_id, text, lang, source, concat_ws(' ', source, array_to_string(string_split(text, ' ')[1:3], ' ')) AS title FROM documents)"
FUSED_SQL = f"""{BM25_SQL.replace("round(CAST(hits AS DOUBLE) / typed, 9)", "CAST(hits AS DOUBLE) / typed").replace(terms_sql('benchmark', 'item_id', 'text'), terms_sql(_CONTROLS, 'item_id', 'text'))},
alias AS (SELECT query_id, doc_id, max(least(1, 0.6::DOUBLE + CAST(length(a) AS DOUBLE) / 40)) AS alias FROM (SELECT item_id AS query_id, {_PLAIN_Q.format('text')} AS q FROM {_CONTROLS}) JOIN (SELECT doc_id, {_PLAIN_Q.format('array_to_string(string_split(text, chr(32))[1:2], chr(32))')} AS a FROM documents) ON length(a) >= 3 AND contains(' ' || q || ' ', ' ' || a || ' ') GROUP BY 1, 2),
vocabulary AS (SELECT DISTINCT term FROM p),
ground AS (SELECT query_id, count(*) AS typed, count(v.term) AS known FROM q LEFT JOIN vocabulary v USING (term) GROUP BY 1),
titles AS (SELECT DISTINCT doc_id, term FROM ({terms_sql(_TITLED, 'doc_id', 'title')})),
title AS (SELECT query_id, doc_id, CAST(count(*) AS DOUBLE) / any_value(known) AS title FROM q JOIN vocabulary USING (term) JOIN titles USING (term) JOIN ground USING (query_id) GROUP BY 1, 2),
met AS (SELECT query_id, doc_id FROM scored UNION SELECT query_id, doc_id FROM alias UNION SELECT query_id, doc_id FROM title),
long_words AS (SELECT item_id AS query_id, list_filter(string_split({normal_sql('text')}, ' '), lambda w: length(w) > 2) AS w FROM {_CONTROLS}),
runs AS (SELECT query_id, CASE WHEN len(w) > 1 THEN list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]) ELSE [] END AS runs FROM long_words),
plain AS (SELECT doc_id, lang, {normal_sql('text')} AS plain FROM documents),
signals AS (SELECT query_id, doc_id, lang, coalesce(score, 0) AS lex, coalesce(alias, 0) AS alias, coalesce(title, 0) AS title, coalesce(overlap, 0) AS overlap, CASE WHEN len(list_filter(runs, lambda r: contains(plain, r))) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS phrase, known, typed
  FROM met LEFT JOIN scored USING (query_id, doc_id) LEFT JOIN alias USING (query_id, doc_id) LEFT JOIN title USING (query_id, doc_id) JOIN plain USING (doc_id) JOIN runs USING (query_id) JOIN ground USING (query_id)),
mixed AS (SELECT *, 0.42::DOUBLE * lex + 0.24::DOUBLE * 0 + 0.14::DOUBLE * alias + 0.12::DOUBLE * title + 0.08::DOUBLE * phrase AS m FROM signals),
fused AS (SELECT query_id, doc_id, lang, phrase, floor(least(CASE WHEN overlap = 0 AND alias = 0 THEN m * 0.3::DOUBLE ELSE m END * pow(CAST(known AS DOUBLE) / typed, 1.5::DOUBLE), 1) * 10000 + 0.5) / 10000 AS score FROM mixed)"""
_RANKED_SQL = "ranked AS (SELECT query_id, doc_id, phrase, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM fused WHERE score >= 0.23 QUALIFY rank <= 5)"
_BAND_SQL = "CASE WHEN {0} >= 0.42 THEN 'high' WHEN {0} >= 0.29 THEN 'moderate' WHEN {0} >= 0.23 THEN 'low' ELSE 'none' END"
_MEAN = "floor(least(avg({}), 1) * 10000 + 0.5) / 10000"


def _best(s: SparkSession, d: str) -> DataFrame:
    return retrieval.top(_fused(s, d), "doc_id", "doc_id")


add("l14_fused", lambda s, d: _best(s, d).select("query_id", "doc_id", "rank", "score"), FUSED_SQL + ", " + _RANKED_SQL + " SELECT query_id, doc_id, rank, score FROM ranked")
add(
    "l17_of_a_type",
    lambda s, d: retrieval.top(_hybrid(s, d, types=("lang", ["en", "de"]), best=5), "doc_id", "doc_id", floor=0.0).select("query_id", "doc_id", "rank", "score"),
    FUSED_SQL + " SELECT query_id, doc_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, score FROM fused WHERE lang IN ('en', 'de') AND query_id < 1000000 QUALIFY rank <= 5",
)
add(
    "l18_fused_answers",
    lambda s, d: retrieval.answers(_controls(s, d), _best(s, d), document_postings(s, d)),
    FUSED_SQL + ", " + _RANKED_SQL + ", notes AS (SELECT query_id, array_to_string(list_sort(list(DISTINCT term))[1:6], ', ') AS unknown FROM q WHERE term NOT IN (SELECT term FROM vocabulary) GROUP BY 1), best AS (SELECT query_id, max(score) AS best, count(*) AS n FROM ranked GROUP BY 1) SELECT item_id AS query_id, coalesce(n, 0) AS n, " + _BAND_SQL.format("coalesce(best, 0)") + f" AS band, n IS NULL AS abstained, coalesce(unknown, '') AS unknown FROM {_CONTROLS} c LEFT JOIN best ON best.query_id = item_id LEFT JOIN notes ON notes.query_id = item_id",
)
add("l20_fused_citations", lambda s, d: retrieval.citations(_best(s, d), _titled(s, d), "doc_id"), FUSED_SQL + ", " + _RANKED_SQL + " SELECT query_id, rank, doc_id, title, source, score, " + _BAND_SQL.format("score") + f" AS band FROM ranked JOIN {_TITLED} USING (doc_id)")
add(
    "l21_fused_evaluation",
    lambda s, d: retrieval.evaluate(_best(s, d).select("query_id", "doc_id", "rank"), _fused(s, d).where("phrase = 1 and query_id < 1000000 and score >= 0.3").select("query_id", "doc_id"), "doc_id", _controls(s, d).where("query_id >= 1000000").select("query_id")),
    FUSED_SQL + ", " + _RANKED_SQL + ", expected AS (SELECT query_id, doc_id FROM fused WHERE phrase = 1 AND query_id < 1000000 AND score >= 0.3), per AS (SELECT e.query_id, count(*) AS relevant, " + ", ".join(f"count(*) FILTER (WHERE rank <= {k}) AS h{k}" for k in (1, 3, 5)) + ", min(rank) AS first FROM expected e LEFT JOIN ranked USING (query_id, doc_id) GROUP BY 1), refused AS (SELECT count(*) AS controls, " + _MEAN.format("CASE WHEN r.query_id IS NULL THEN 1.0 ELSE 0.0 END") + f" AS abstention, count(r.query_id) AS false_answers FROM {_CONTROLS} LEFT JOIN (SELECT DISTINCT query_id FROM ranked) r ON r.query_id = item_id WHERE item_id >= 1000000) SELECT * FROM (SELECT count(*) AS questions, " + ", ".join([*(f"{_MEAN.format(f'CAST(h{k} AS DOUBLE) / {k}')} AS p{k}" for k in (1, 3, 5)), *(f"{_MEAN.format(f'CAST(h{k} AS DOUBLE) / least({k}, relevant)')} AS np{k}" for k in (3, 5)), *(f"{_MEAN.format(f'CASE WHEN h{k} > 0 THEN 1.0 ELSE 0.0 END')} AS hit{k}" for k in (1, 3, 5))]) + ", " + _MEAN.format("coalesce(1 / CAST(first AS DOUBLE), 0)") + " AS mrr FROM per) CROSS JOIN refused",
)
add("l18_answers", lambda s, d: retrieval.answers(benchmark_questions(s, d), retrieval.top(_found(s, d), "doc_id", "doc_id"), document_postings(s, d)))
add("l20_citations", lambda s, d: retrieval.citations(retrieval.top(_found(s, d), "doc_id", "doc_id"), _titled(s, d), "doc_id"))
add("l21_evaluation", lambda s, d: retrieval.evaluate(retrieval.top(_found(s, d), "doc_id", "doc_id").select("query_id", "doc_id", "rank"), _found(s, d).where("phrase = 1").select("query_id", "doc_id").distinct(), "doc_id"))


def _hybrid_answer(s: SparkSession, d: str) -> DataFrame:
    """For each question about parcels: the matching parcels and, if the documents know it, the best of them."""
    asked = written(_interpreted(s, d), "asked")
    parcels = interpret.answer(asked, plan.properties(s, d))
    docs = impact.best_of_texts(*impact_index(s, d), asked, "doc_id", 1)
    return asked.select("query_id", "about_parcels", "declined").join(parcels, "query_id", "left").join(docs.select("query_id", "doc_id", "score"), "query_id", "left")


add("v12_hybrid_answer", _hybrid_answer)
