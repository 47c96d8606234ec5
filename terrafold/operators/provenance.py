"""Where values come from, and why some are missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import NOTICES, SOURCE_LABELS


def tokens(column: str, separator: str) -> Column:
    """Trimmed, non-empty parts of a multi-value string; null gives none."""
    parts = F.transform(F.split(F.coalesce(F.col(column), F.lit("")), separator), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def _label(token: Column) -> Column:
    labels = F.create_map(*[F.lit(x) for kv in SOURCE_LABELS.items() for x in kv])
    return F.coalesce(F.try_element_at(labels, token), token)


def source_rows(df: DataFrame, key: str = "property_id") -> DataFrame:
    return df.select(key, F.posexplode(tokens("source_systems", "\\|")).alias("pos", "token")).withColumn("label", _label(F.col("token")))


def notice_rows(df: DataFrame, key: str = "property_id") -> DataFrame:
    """One row a token; unknown tokens keep their name and have no severity."""
    spark = df.sparkSession
    known = spark.createDataFrame([(t, *v) for t, v in NOTICES.items()], "token string, field string, severity string, headline string")
    rows = df.select(key, F.posexplode(tokens("enrichment_status", ";")).alias("pos", "token"))
    return rows.join(F.broadcast(known), "token", "left").select(key, "pos", "token", "field", F.coalesce("severity", F.lit("unknown")).alias("severity"), F.coalesce("headline", "token").alias("headline"))


def gated(df: DataFrame) -> DataFrame:
    return notice_rows(df).where("severity = 'gated'")


def provenance(df: DataFrame) -> DataFrame:
    """The distinct source labels of a result, sorted, in one row."""
    return source_rows(df).agg(F.array_join(F.array_sort(F.collect_set("label")), "; ").alias("sources"))


def metric_record(stats: DataFrame) -> DataFrame:
    """A row of aggregates as (metric, value); what is no number drops out."""
    numbers = [F.col(c).cast("string").try_cast("double").alias(c) for c in stats.columns]
    long = stats.select(*numbers).unpivot([], stats.columns, "metric", "value")
    return long.where(F.col("value").isNotNull())


def json_safe(df: DataFrame) -> DataFrame:
    """Integers beyond 2^53 - 1 as text, dates as ISO text; for JSON sinks."""
    def safe(name: str, kind: str) -> Column:
        c = F.col(name)
        if kind == "bigint":
            return F.when(F.abs(c) > 9007199254740991, F.concat(F.lit('"'), c.cast("string"), F.lit('"'))).otherwise(c.cast("string")).alias(name)
        if kind.startswith(("date", "timestamp")):
            return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias(name)
        return c
    return df.select(*[safe(n, k) for n, k in df.dtypes])


def point_features(df: DataFrame) -> DataFrame:
    """GeoJSON points of rows with coordinates: id, label (street, else id)."""
    label = F.coalesce(F.when(F.trim("address_street") != "", F.col("address_street")), F.coalesce("request_identifier", "property_id"))
    point = F.struct(F.lit("Point").alias("type"), F.array("longitude", "latitude").alias("coordinates"))
    own = df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return own.select(F.coalesce("request_identifier", "property_id").alias("id"), label.alias("label"), F.to_json(F.struct(F.lit("Feature").alias("type"), point.alias("geometry"))).alias("feature"))


def radius_ring(df: DataFrame, lat: str, lon: str, miles: float) -> DataFrame:
    """97 vertices of the circle around each point."""
    d, a, b = F.lit(miles / 3958.7613), F.radians(F.col(lat)), F.radians(F.col(lon))
    rows = df.withColumn("vertex", F.explode(F.sequence(F.lit(0), F.lit(96))))
    turn = F.radians(F.col("vertex") * 360.0 / 96)
    phi = F.asin(F.sin(a) * F.cos(d) + F.cos(a) * F.sin(d) * F.cos(turn))
    lam = b + F.atan2(F.sin(turn) * F.sin(d) * F.cos(a), F.cos(d) - F.sin(a) * F.sin(phi))
    return rows.withColumn("ring_lat", F.round(F.degrees(phi), 6)).withColumn("ring_lon", F.round(F.degrees(lam), 6))
