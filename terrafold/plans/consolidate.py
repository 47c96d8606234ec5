"""Consolidation: the roll joined with aggregated permits, sales and accounts.

Each side is aggregated to one row a parcel before it is joined, so the roll is
never multiplied. ``as_of`` is a parameter; nothing reads the clock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..contract import OPEN_STATUSES, ROOFING_TYPES, SCHEMA
from ..sources.shared import kept

AS_OF = "2001-09-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def normalised_address(street, zip_code):
    """Our rule for the address key: upper case, punctuation to one space, zip5."""
    return F.concat_ws("|", F.trim(F.regexp_replace(F.upper(F.coalesce(street, F.lit(""))), "[^A-Z0-9]+", " ")), F.substring(F.coalesce(zip_code, F.lit("")), 1, 5))


def roll(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    home = n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_nationkey").alias("home"), F.col("n_name").alias("address_city"), F.col("r_name").alias("state_code"))
    mail = home.select(F.col("home").alias("mail"), F.col("address_city").alias("owner_mailing_city"), F.col("state_code").alias("owner_mailing_state"))
    k = F.col("c_custkey")
    out = c.withColumn("home", F.col("c_nationkey")).withColumn("mail", ((k * 3) % 25).cast("int"))
    out = out.join(home, "home", "left").join(mail, "mail", "left")
    known = k % 11 != 0
    return out.select(
        k.alias("key"),
        F.col("home").alias("nation"),
        F.concat(F.lit("prop-"), k.cast("string")).alias("property_id"),
        F.lpad(k.cast("string"), 8, "0").alias("request_identifier"),
        k.cast("string").alias("alt_key"),
        F.concat((k % 400).cast("string"), F.lit(" "), F.col("c_mktsegment"), F.lit(" St")).alias("address_street"),
        "address_city",
        "state_code",
        F.lpad((k % 90 + 32000).cast("string"), 5, "0").alias("address_zip"),
        F.col("c_mktsegment").alias("property_type"),
        ((k % 5000) + 1000).cast("double").alias("lot_area_sqft"),
        F.when(k % 5 != 0, (k * 7 % 98 + 1900).cast("int")).alias("built_year"),
        (k % 3 + 1).cast("int").alias("building_count"),
        F.col("c_acctbal").alias("market_value"),
        F.col("c_name").alias("owner_name"),
        F.when(k % 3 == 0, F.concat(F.col("c_name"), F.lit("; Trust "), k.cast("string"))).otherwise(F.col("c_name")).alias("owners_text"),
        "owner_mailing_city",
        "owner_mailing_state",
        F.when(known, F.col("owner_mailing_city") != F.col("address_city")).alias("owner_out_of_county"),
        F.when(known, F.col("owner_mailing_state") != F.col("state_code")).alias("owner_out_of_state"),
    )


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").where(k % 34 != 0).select(k.alias("key"), (F.lit(28.3) + (k % 97) / 100.0).alias("latitude"), (F.lit(-82.0) + (k % 89) / 100.0).alias("longitude"))


def permits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Permit features as they come, with later copies of some of them."""
    o = table(spark, sf_dir, "orders").where("o_orderkey % 7 = 0")
    base = o.select(
        F.col("o_orderkey").alias("number"),
        (F.col("o_custkey") + 10).alias("key"),
        F.to_date("o_orderdate").alias("issued"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "RF").when(F.col("o_orderpriority") == "2-HIGH", "ROR").otherwise("BLD").alias("type"),
        F.when(F.col("o_orderstatus") == "O", "ISSUED").when(F.col("o_orderstatus") == "P", "INSPECT").otherwise("COMPLETE").alias("status"),
        F.to_date("o_orderdate").alias("modified"),
    )
    return base.unionByName(base.where("number % 21 = 0").withColumn("modified", F.date_add("modified", 1)))


def latest(df: DataFrame, key: str, by: str) -> DataFrame:
    """One row for each key, the one modified last; of several, the largest in its
    other columns. Aggregated on both sides of the shuffle, so no key is sorted."""
    rest = [c for c in df.columns if c not in (key, by)]
    best = df.groupBy(key).agg(F.max(F.struct(by, *rest)).alias("best"))
    return best.select(*[F.col(key) if c == key else F.col(f"best.{c}").alias(c) for c in df.columns])


def permit_rollup(deduped: DataFrame, as_of: str = AS_OF) -> DataFrame:
    roofing, open_ = F.col("type").isin(*ROOFING_TYPES), F.col("status").isin(*OPEN_STATUSES)
    days = F.datediff(F.lit(as_of).cast("date"), F.col("issued"))
    return deduped.groupBy("key").agg(
        F.count(F.lit(1)).cast("int").alias("permit_count"),
        F.count_if(roofing).cast("int").alias("roofing_permit_count"),
        F.count_if(open_).cast("int").alias("open_permit_count"),
        F.count_if(roofing & open_).cast("int").alias("open_roofing_permit_count"),
        F.max(F.when(open_, days)).alias("longest_open_permit_days"),
        F.max("issued").cast("string").alias("latest_permit_date"),
        F.max(F.when(roofing & ~open_, F.col("issued"))).alias("roof_completed"),
        F.max(F.when(roofing & open_, F.col("issued"))).alias("roof_issued"),
    )


def sales(spark: SparkSession, sf_dir: str, since: str = "1998-01-01") -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("key"))
    line = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") >= F.lit(since).cast("timestamp"))
    rows = line.join(o, line.l_orderkey == o.o_orderkey).select("key", F.to_date("l_shipdate").cast("string").alias("d"), F.col("l_extendedprice").alias("p"), "l_orderkey", "l_linenumber")
    # each task sends at most two sales a parcel: the limit by rank is applied before the shuffle
    order = Window.partitionBy("key").orderBy(F.col("d").desc(), F.col("p").desc(), "l_orderkey", "l_linenumber")
    two = rows.withColumn("n", F.row_number().over(order)).where("n <= 2")
    last = two.groupBy("key").agg(*[F.max(F.when(F.col("n") == n, F.col(c))).alias(f"{name}_{what}") for n, name in ((1, "last"), (2, "prior")) for c, what in (("d", "sale_date"), ("p", "sale_price"))])
    return rows.groupBy("key").agg(F.count(F.lit(1)).cast("int").alias("sale_records_in_window")).join(last, "key")


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business accounts at an address group; every parcel of it gets them all."""
    s = table(spark, sf_dir, "supplier").where("s_suppkey % 4 = 0")
    naics = F.when(F.col("s_suppkey") % 8 == 0, "238160").otherwise("531110")
    return s.groupBy(F.col("s_nationkey").alias("nation")).agg(
        F.count(F.lit(1)).cast("int").alias("business_account_count"),
        F.concat_ws("; ", F.array_sort(F.collect_set(naics))).alias("business_naics_codes"),
        F.concat_ws("; ", F.array_sort(F.collect_set("s_name"))).alias("business_names"),
        F.count_if(naics == "238160").cast("int").alias("roofing_business_count"),
    )


def attributed(parcels: DataFrame, accounts_at: DataFrame) -> DataFrame:
    """Parcels with the accounts at their normalised street and zip: an account is
    credited to every parcel of its address. ``parcels``: property_id, address_street,
    address_zip; ``accounts_at``: account, street, zip. Accounts are aggregated by
    address before the join; parcels without a street have none."""
    by_address = accounts_at.groupBy(normalised_address(F.col("street"), F.col("zip")).alias("address")).agg(F.count(F.lit(1)).alias("accounts"), F.concat_ws("; ", F.array_sort(F.collect_set("account"))).alias("names"))
    keyed = parcels.where(F.trim("address_street") != "").withColumn("address", normalised_address(F.col("address_street"), F.col("address_zip")))
    return keyed.join(by_address, "address").select("property_id", "address", "accounts", "names")


def consolidate(base: DataFrame, points: DataFrame, permit: DataFrame, sale: DataFrame, business: DataFrame, as_of: str = AS_OF, extra: tuple[str, ...] = ()) -> DataFrame:
    """The contract's 62 columns, and ``extra`` ones of the inputs; unmatched parcels keep their row."""
    year = F.year(F.lit(as_of).cast("date"))
    p = base.join(points, "key", "left").join(permit, "key", "left").join(sale, "key", "left").join(business, "nation", "left")
    completed, issued = F.col("roof_completed"), F.col("roof_issued")
    basis = F.when(completed.isNotNull(), "roofing_permit_completed").when(issued.isNotNull(), "roofing_permit_issued").when(F.col("built_year").isNotNull(), "year_built")
    derived = {
        "source_system": F.lit("fl_dor_nal_2026p"),
        "county_name": F.lit("Sample"),
        "parcel_identifier": F.col("request_identifier"),
        "lot_size_acre": F.col("lot_area_sqft") / 43560.0,
        "owner_count": F.size(F.split("owners_text", "; ")),
        "assessed_value": F.col("market_value") * 0.5,
        "no_recorded_sale_in_dor_window": F.col("sale_records_in_window").isNull(),
        "roof_age_years": (year - F.coalesce(F.year(completed), F.year(issued), F.col("built_year"))).cast("int"),
        "roof_age_basis": basis,
        "roof_last_permit_date": F.coalesce(completed, issued).cast("string"),
        "has_permits": F.col("permit_count").isNotNull(),
        "has_business_account": F.col("business_account_count").isNotNull(),
        "enrichment_status": F.concat_ws(";", F.when(F.col("permit_count").isNotNull(), "permits_loaded").otherwise("no_permits_in_source"), F.lit("contractor_gated_403"), F.lit("bbb_gated_403")),
        "source_systems": F.concat_ws(
            "|",
            F.lit("fl_dor_nal_2026p"),
            F.when(F.col("latitude").isNotNull(), "fl_gio_parcel_centroid_2025"),
            F.when(F.col("permit_count").isNotNull(), "lake_cdplus_permits"),
            F.when(F.col("sale_records_in_window").isNotNull(), "fl_dor_sdf_2026p"),
            F.when(F.col("business_account_count").isNotNull(), "fl_dor_tpp_2026p"),
        ),
    }
    zero = ("permit_count", "roofing_permit_count", "open_permit_count", "open_roofing_permit_count")
    have = set(p.columns)

    def value(f):
        if f.name in derived:
            return derived[f.name]
        if f.name in zero:
            return F.coalesce(F.col(f.name), F.lit(0))
        return F.col(f.name) if f.name in have else F.lit(None)

    return p.select(*[value(f).cast(f.dataType).alias(f.name) for f in SCHEMA], *extra)


#: What every parcel of an address group has in common and what grows with the group's accounts.
SHARED = "business_names"


def consolidated(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    """The table but for the shared names, with the key of the group that has them."""
    deduped = latest(permits(spark, sf_dir), "number", "modified")
    rows = consolidate(roll(spark, sf_dir), centroids(spark, sf_dir), permit_rollup(deduped, as_of), sales(spark, sf_dir), accounts(spark, sf_dir).drop(SHARED), as_of, ("nation",))
    return rows.drop(SHARED)


def named(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Rows of ``consolidated`` with their group's names, in the order of the contract."""
    return rows.join(names, "nation", "left").select(*[f.name for f in SCHEMA])


def laid_out(df: DataFrame, cells: int = 10) -> DataFrame:
    """Rows near each other on the map together, so that a box filter skips row
    groups by their statistics; a crowded cell is dealt over several files."""
    cell = [F.floor(F.col(c) * cells) for c in ("latitude", "longitude")]
    return df.repartition(*cell, F.pmod(F.hash("property_id"), F.lit(16))).sortWithinPartitions(*cell, "property_id")


def properties(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    """The consolidated table: built once an application, then read. A group's names stand
    once in a table of their own and meet the rows as they are read: accounts times
    parcels is never shuffled or stored."""
    return named(*stored(spark, sf_dir, as_of))


def stored(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> tuple[DataFrame, DataFrame]:
    """The two tables of ``properties``: rows, and names by group."""
    rows = kept(spark, "properties", (sf_dir, as_of), lambda: laid_out(consolidated(spark, sf_dir, as_of)))
    return rows, kept(spark, "names", (sf_dir,), lambda: accounts(spark, sf_dir).select("nation", SHARED))
