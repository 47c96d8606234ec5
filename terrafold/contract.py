"""The contract of the wide table: columns in order, types, labels, fixed words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KINDS = {"s": T.StringType(), "d": T.DoubleType(), "i": T.IntegerType(), "b": T.BooleanType()}

#: The published columns, in their order, with their types.
COLUMNS = [
    ("property_id", "s"), ("property_cid", "s"), ("request_identifier", "s"), ("parcel_identifier", "s"), ("alt_key", "s"), ("source_system", "s"),
    ("county_name", "s"), ("state_code", "s"), ("address_street", "s"), ("address_city", "s"), ("address_zip", "s"), ("latitude", "d"), ("longitude", "d"),
    ("lot_area_sqft", "d"), ("lot_size_acre", "d"), ("property_type", "s"), ("property_usage_type", "s"), ("dor_use_code", "s"), ("built_year", "i"),
    ("effective_built_year", "i"), ("livable_floor_area", "d"), ("building_count", "i"), ("residential_units", "i"), ("assessed_value", "d"),
    ("market_value", "d"), ("land_value", "d"), ("taxable_value", "d"), ("owner_name", "s"), ("owners_text", "s"), ("owner_count", "i"),
    ("owner_mailing_city", "s"), ("owner_mailing_state", "s"), ("owner_mailing_zip", "s"), ("owner_out_of_county", "b"), ("owner_out_of_state", "b"),
    ("last_sale_date", "s"), ("last_sale_price", "d"), ("prior_sale_date", "s"), ("prior_sale_price", "d"), ("sale_records_in_window", "i"),
    ("no_recorded_sale_in_dor_window", "b"), ("roof_age_years", "i"), ("roof_age_basis", "s"), ("roof_last_permit_date", "s"), ("has_permits", "b"),
    ("permit_count", "i"), ("roofing_permit_count", "i"), ("open_permit_count", "i"), ("open_roofing_permit_count", "i"), ("longest_open_permit_days", "i"),
    ("latest_permit_date", "s"), ("contractor_name", "s"), ("bbb_rating", "s"), ("has_bbb_contractor", "b"), ("has_sunbiz_tenant", "b"),
    ("has_business_account", "b"), ("business_account_count", "i"), ("business_naics_codes", "s"), ("business_names", "s"), ("roofing_business_count", "i"),
    ("enrichment_status", "s"), ("source_systems", "s"),
]

#: Columns that are null on every row, each with the reason.
REASONS = {
    "contractor_name": "Gated at source: county permit detail pages answer HTTP 403.",
    "bbb_rating": "Gated at source: the rating pages answer HTTP 403.",
    "has_bbb_contractor": "Always null: the ratings are gated at source, so absence was never established.",
    "has_sunbiz_tenant": "Always null: corporate data was not ingested, so absence was never established.",
    "property_cid": "Not populated: the run publishes one columnar table, not an id for each property.",
}
ALWAYS_NULL = list(REASONS)

#: Source tokens and their labels.
SOURCE_LABELS = {
    "fl_dor_nal_2026p": "FL DOR NAL 2026 preliminary tax roll",
    "fl_gio_parcel_centroid_2025": "FL GIO parcel centroids 2025",
    "lake_cdplus_permits": "Lake County CD Plus permit layer",
    "fl_dor_sdf_2026p": "FL DOR SDF 2026 preliminary sales file",
    "fl_dor_tpp_2026p": "FL DOR TPP 2026 preliminary tangible personal property roll",
}

#: Enrichment tokens with the column they concern and severity.
NOTICES = {
    "permits_loaded": (None, "present", "Permits loaded"),
    "no_permits_in_source": (None, "absent", "No permits in source"),
    "contractor_gated_403": ("contractor_name", "gated", "Contractor of record is gated at the source"),
    "bbb_gated_403": ("bbb_rating", "gated", "BBB rating is gated at the source"),
}

#: Legal roof-age bases, roofing permit types, open statuses.
ROOF_BASES = ("roofing_permit_completed", "roofing_permit_issued", "year_built")
ROOFING_TYPES = ("RF", "RFC", "RFR", "ROC", "ROR")
OPEN_STATUSES = ("APPLY", "INSPECT", "ISSUED", "READY", "RENEWED")

SCHEMA = T.StructType([T.StructField(n, _KINDS[k], n != "property_id", {"always_null": n in REASONS} | ({"reason": REASONS[n]} if n in REASONS else {})) for n, k in COLUMNS])


def schema_gate(df: DataFrame) -> DataFrame:
    """``df`` if its columns are the contract's by name, order and type."""
    found, wanted = [(f.name, f.dataType) for f in df.schema], [(f.name, f.dataType) for f in SCHEMA]
    if found != wanted:
        odd = [f"{a} is not {b}" for a, b in zip(found, wanted, strict=False) if a != b] or [f"{len(found)} columns, not {len(wanted)}"]
        raise ValueError("not the published schema: " + "; ".join(odd[:5]))
    return df


def annotated(df: DataFrame) -> DataFrame:
    """The columns of ``df``, those of the contract with its metadata: a reason travels with
    its column through selections, filters, joins and written tables."""
    known = {f.name: f.metadata for f in SCHEMA}
    return df.select(*[F.col(f"`{c}`").alias(c, metadata=known[c]) if c in known else F.col(f"`{c}`") for c in df.columns])


def schema_listing(df: DataFrame) -> DataFrame:
    """One row a column of ``df``: name, kind, place, always_null and the reason that its
    metadata carries."""
    rows = [(f.name, f.dataType.simpleString(), n, bool(f.metadata.get("always_null")), f.metadata.get("reason")) for n, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "name string, kind string, place int, always_null boolean, reason string")


def require_columns(df: DataFrame, *names: str) -> None:
    unknown = [n for n in names if n not in df.columns]
    if unknown:
        raise ValueError(f"unknown columns: {unknown}")
