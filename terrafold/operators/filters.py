"""Search filters as columns; one list serves the page and the count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import ROOF_BASES, require_columns

EARTH_MILES, MILES_PER_DEGREE = 3958.7613, 69.047
_RANGES = {"min_roof_age": (0, 500), "max_roof_age": (0, 500), "min_open_permit_days": (0, 100_000), "min_built_year": (1700, 2100), "max_built_year": (1700, 2100), "lat": (-90, 90), "lon": (-180, 180), "radius_miles": (0, 200)}
NAMES = ("q", "city", "zip", "property_type", "roof_age_basis", "min_roof_age", "max_roof_age", "has_permits", "has_open_roofing_permit", "min_open_permit_days", "owner_out_of_county", "owner_out_of_state", "no_recorded_sale", "has_business_account", "min_market_value", "max_market_value", "min_built_year", "max_built_year", "require_coordinates", "lat", "lon", "radius_miles")


def haversine_miles(lat: float, lon: float) -> Column:
    a, b = F.radians(F.col("latitude")), F.radians(F.lit(float(lat)))
    d = F.radians(F.col("longitude") - F.lit(float(lon)))
    s = F.pow(F.sin((a - b) / 2), 2) + F.cos(b) * F.cos(a) * F.pow(F.sin(d / 2), 2)
    return F.lit(2 * EARTH_MILES) * F.asin(F.sqrt(s))


def _validate(f: dict) -> None:
    unknown = set(f) - set(NAMES)
    if unknown:
        raise ValueError(f"unknown filters: {sorted(unknown)}")
    for name, (low, high) in _RANGES.items():
        if f.get(name) is not None and not low <= f[name] <= high:
            raise ValueError(f"{name} is outside {low} to {high}")
    if f.get("q") is not None and not 1 <= len(f["q"].strip()) <= 200:
        raise ValueError("q has 1 to 200 characters")
    if f.get("roof_age_basis") is not None and f["roof_age_basis"] not in ROOF_BASES:
        raise ValueError(f"roof_age_basis is one of {ROOF_BASES}")
    given = [f.get(k) is not None for k in ("lat", "lon", "radius_miles")]
    if any(given) and not all(given):
        raise ValueError("lat, lon and radius_miles come together")
    if all(given) and f["radius_miles"] <= 0:
        raise ValueError("radius_miles is over 0")


def predicates(**f) -> list[Column]:
    """One column for each filter given; they are and-ed."""
    import math

    f = {k: v for k, v in f.items() if v is not None}
    _validate(f)
    col, out = F.col, []

    def text(name: str) -> Column:
        return F.coalesce(col(name), F.lit(""))

    if "q" in f:
        pattern = f"%{f['q'].strip().upper()}%"
        # an escape character that the text does not have: % and _ stay wildcards
        escape = next(c for c in "\x01\x02\x03" if c not in pattern)
        hits = [F.like(F.upper(text(c)), F.lit(pattern), F.lit(escape)) for c in ("request_identifier", "address_street", "owner_name", "owners_text")]
        out.append(hits[0] | hits[1] | hits[2] | hits[3])
    if "city" in f:
        out.append(F.upper(text("address_city")) == f["city"].strip().upper())
    if "zip" in f:
        out.append(text("address_zip") == f["zip"].strip())
    for name in ("property_type", "roof_age_basis", "owner_out_of_county", "owner_out_of_state"):
        if name in f:
            out.append(col(name) == f[name])
    for name, column, null in (("has_permits", "has_permits", False), ("no_recorded_sale", "no_recorded_sale_in_dor_window", False)):
        if name in f:
            out.append(F.coalesce(col(column), F.lit(null)) == f[name])
    for name, column in (("has_open_roofing_permit", "open_roofing_permit_count"), ("has_business_account", "business_account_count")):
        if name in f:
            n = F.coalesce(col(column), F.lit(0))
            out.append(n > 0 if f[name] else n == 0)
    if "min_open_permit_days" in f:
        out.append(F.coalesce(col("longest_open_permit_days"), F.lit(0)) >= f["min_open_permit_days"])
    for name, column in (("roof_age", "roof_age_years"), ("market_value", "market_value"), ("built_year", "built_year")):
        if f"min_{name}" in f:
            out.append(col(column) >= f[f"min_{name}"])
        if f"max_{name}" in f:
            out.append(col(column) <= f[f"max_{name}"])
    if f.get("require_coordinates"):
        out.append(col("latitude").isNotNull() & col("longitude").isNotNull())
    if "radius_miles" in f:
        lat, lon, r = f["lat"], f["lon"], f["radius_miles"]
        dlat = r / MILES_PER_DEGREE
        dlon = r / (MILES_PER_DEGREE * max(math.cos(math.radians(lat)), 1e-6))
        out += [col("latitude").between(lat - dlat, lat + dlat), col("longitude").between(lon - dlon, lon + dlon), haversine_miles(lat, lon) <= r]
    return out


def matching(df: DataFrame, **f) -> DataFrame:
    for p in predicates(**f):
        df = df.where(p)
    return df


def search(df: DataFrame, sort: str | None = None, descending: bool = True, limit: int = 50, offset: int = 0, **f) -> DataFrame:
    """A page: nulls last either way, ties by id, at most 500 rows."""
    out = matching(df, **f)
    if f.get("radius_miles") is not None:
        out = out.withColumn("distance_miles", haversine_miles(f["lat"], f["lon"]))
    key = F.col("property_id").asc_nulls_last()
    if sort:
        require_columns(df, sort)
        order = [F.col(sort).desc_nulls_last() if descending else F.col(sort).asc_nulls_last(), key]
    elif f.get("radius_miles") is not None:
        order = [F.col("distance_miles").asc_nulls_last(), key]
    else:
        order = [key]
    return out.orderBy(*order).offset(max(0, offset)).limit(min(500, max(1, limit)))


def page_after(df: DataFrame, sort: str | None = None, descending: bool = True, limit: int = 50, token: tuple | None = None, **f) -> DataFrame:
    """The page that follows the row a token names: its sort value and its id.

    Rows are in the order of ``search``. Unlike an offset, a page costs the same however
    deep it is: what comes before is filtered out, at the scan where the sort column
    allows, and rows that arrive in between move no page. ``token``: (value, property_id)
    of the last row seen (see ``page_token``), None for the first page; a null value stands
    in the last rows, which go on by id. Without ``sort`` the order is by id."""
    out = matching(df, **f)
    key = F.col("property_id")
    if sort:
        require_columns(df, sort)
    if token is not None:
        value, last = token
        if not sort:
            out = out.where(key > F.lit(last))
        elif value is None:
            out = out.where(F.col(sort).isNull() & (key > F.lit(last)))
        else:
            own = F.col(sort)
            beyond = own < F.lit(value) if descending else own > F.lit(value)
            out = out.where(beyond | ((own == F.lit(value)) & (key > F.lit(last))) | own.isNull())
    order = ([F.col(sort).desc_nulls_last() if descending else F.col(sort).asc_nulls_last()] if sort else []) + [key.asc_nulls_last()]
    return out.orderBy(*order).limit(min(500, max(1, limit)))


def page_token(page: DataFrame, sort: str | None = None) -> tuple | None:
    """The token of a page of at most 500 rows; None if it is empty."""
    last = page.select(*[F.col(sort).alias("value") if sort else F.lit(None).alias("value"), F.col("property_id").alias("id")]).tail(1)
    return (last[0]["value"], last[0]["id"]) if last else None


def near_city(df: DataFrame, centre: DataFrame, radius_miles: float) -> DataFrame:
    """Rows within a radius of a city's centre, with ``distance_miles``. ``centre``: one
    row (lat, lon, n), as ``city_centroid`` gives it; a city without coordinates has no
    neighbours. The centre reaches the driver as two numbers, so the box is at the scan."""
    at = centre.first()
    if at is None or at["lat"] is None or at["lon"] is None:
        return df.where(F.lit(False)).withColumn("distance_miles", F.lit(None).cast("double"))
    lat, lon = float(at["lat"]), float(at["lon"])
    return matching(df, lat=lat, lon=lon, radius_miles=radius_miles).withColumn("distance_miles", haversine_miles(lat, lon))


def lookup(df: DataFrame, key: str) -> DataFrame:
    """The parcel of an id, at most one row; none if it is not there."""
    return df.where((F.col("request_identifier") == key) | (F.col("property_id") == key)).limit(1)
