"""Statistics over the wide table; each is one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

AGED, STALLED_DAYS = 15, 1825


def _n(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def _is(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(False))


def dataset_stats(df: DataFrame) -> DataFrame:
    age = F.col("roof_age_years")
    return df.agg(
        F.count(F.lit(1)).alias("parcels"),
        F.count("latitude").alias("with_coordinates"),
        F.count("roof_age_years").alias("roof_age_known"),
        F.count_if(age >= AGED).alias("aged_roofs"),
        *[F.count_if(F.col("roof_age_basis") == b).alias(f"basis_{b}") for b in ("roofing_permit_completed", "roofing_permit_issued", "year_built")],
        F.count_if(_is("has_permits")).alias("with_permits"),
        F.sum(_n("permit_count")).alias("permits"),
        F.sum(_n("roofing_permit_count")).alias("roofing_permits"),
        F.count_if(_n("open_roofing_permit_count") > 0).alias("open_roofing_parcels"),
        F.count_if(_n("longest_open_permit_days") > STALLED_DAYS).alias("stalled"),
        F.count_if(_is("owner_out_of_county")).alias("out_of_county"),
        F.count_if(_is("owner_out_of_state")).alias("out_of_state"),
        F.count_if(_is("no_recorded_sale_in_dor_window")).alias("no_recorded_sale"),
        F.count_if(_n("business_account_count") > 0).alias("with_business"),
        F.sum(_n("business_account_count")).alias("business_accounts"),
        F.countDistinct("owner_name").alias("owners"),
    )


def facet(df: DataFrame, column: str, limit: int = 100) -> DataFrame:
    known = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return known.orderBy(F.desc("n"), F.asc("value")).limit(min(500, max(1, limit)))


#: Facets with their columns and how many values each shows.
FACETS = (("city", "address_city", 100), ("type", "property_type", 50), ("basis", "roof_age_basis", 10), ("zip", "address_zip", 100))


def facets(df: DataFrame) -> DataFrame:
    """City, type, basis and zip in one pass over the table and one shuffle."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("facet"), F.col(c).cast("string").alias("value")) for n, c, _ in FACETS]))
    counts = df.select(pairs.alias("p")).select("p.*").where("value is not null").groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))
    most = F.create_map(*[x for n, _, k in FACETS for x in (F.lit(n), F.lit(k))])
    rank = F.row_number().over(Window.partitionBy("facet").orderBy(F.desc("n"), F.asc("value")))
    return counts.withColumn("_r", rank).where(F.col("_r") <= 100).where(F.col("_r") <= most[F.col("facet")]).select("value", "n", "facet")


def business_by(df: DataFrame, column: str, null: str | None = None) -> DataFrame:
    value = F.coalesce(F.col(column), F.lit(null)) if null else F.col(column)
    out = df.groupBy(value.alias("value")).agg(F.count_if(_n("business_account_count") > 0).alias("parcels"), F.sum(_n("business_account_count")).alias("accounts"))
    return out.where("accounts > 0").orderBy(F.desc("accounts"), F.asc_nulls_last("value"))


def business_totals(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count_if(_n("business_account_count") > 0).alias("parcels"),
        F.sum(_n("business_account_count")).alias("accounts"),
        F.max(_n("business_account_count")).alias("most_at_one"),
        F.sum(_n("roofing_business_count")).alias("roofing_accounts"),
        F.count_if(_is("has_sunbiz_tenant")).alias("tenants"),
    )


def permit_posture(df: DataFrame) -> DataFrame:
    days = F.col("longest_open_permit_days")
    return df.agg(
        F.count_if(_is("has_permits")).alias("with_permits"),
        F.sum(_n("permit_count")).alias("permits"),
        F.sum(_n("roofing_permit_count")).alias("roofing"),
        F.sum(_n("open_permit_count")).alias("open_permits"),
        F.sum(_n("open_roofing_permit_count")).alias("open_roofing"),
        F.count_if(_n("open_permit_count") > 0).alias("open_parcels"),
        F.count_if(_n("open_roofing_permit_count") > 0).alias("open_roofing_parcels"),
        F.count_if(days.between(1, 89)).alias("open_1_89"),
        F.count_if(days.between(90, 364)).alias("open_90_364"),
        F.count_if(days.between(365, 1824)).alias("open_365_1824"),
        F.count_if(days >= STALLED_DAYS).alias("open_1825"),
        F.max("longest_open_permit_days").alias("longest"),
        F.max("latest_permit_date").alias("latest"),
        F.count("contractor_name").alias("contractors"),
        F.count("bbb_rating").alias("rated"),
    )


def owner_posture(df: DataFrame) -> DataFrame:
    return df.agg(
        F.countDistinct("owner_name").alias("owners"),
        F.count_if(_is("owner_out_of_county")).alias("out_of_county"),
        F.count_if(_is("owner_out_of_state")).alias("out_of_state"),
        F.count_if(F.col("owner_out_of_state").isNull()).alias("locality_unknown"),
        F.count_if(_n("owner_count") > 1).alias("several_owners"),
        F.count_if(_is("no_recorded_sale_in_dor_window")).alias("no_recorded_sale"),
        F.count("last_sale_price").alias("with_sale"),
    )


def roof_band(age: str = "roof_age_years") -> Column:
    out = F.when(F.col(age).isNull(), "unknown")
    for top, name in ((5, "0-4"), (10, "5-9"), (15, "10-14"), (20, "15-19"), (30, "20-29"), (50, "30-49")):
        out = out.when(F.col(age) < top, name)
    return out.otherwise("50+")


def roof_age_bands(df: DataFrame) -> DataFrame:
    basis = F.col("roof_age_basis")
    out = df.groupBy(roof_band().alias("band")).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(basis == "roofing_permit_completed").alias("completed"),
        F.count_if(basis == "roofing_permit_issued").alias("issued"),
        F.count_if(basis == "year_built").alias("built"),
        F.min(F.coalesce("roof_age_years", F.lit(100_000))).alias("_at"),
    )
    return out.orderBy("_at").drop("_at")


def city_centroid(df: DataFrame, city: str) -> DataFrame:
    own = df.where((F.upper(F.coalesce("address_city", F.lit(""))) == city.strip().upper()) & F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return own.agg(F.round(F.avg("latitude"), 9).alias("lat"), F.round(F.avg("longitude"), 9).alias("lon"), F.count(F.lit(1)).alias("n"))


def out_of_state_ranking(df: DataFrame, limit: int = 15) -> DataFrame:
    own = df.where(F.col("owner_out_of_state") & F.col("owner_mailing_state").isNotNull())
    return own.groupBy(F.col("owner_mailing_state").alias("state")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "state").limit(limit)
