"""The fixture view in plain SQL for the independent engine that checks queries."""

PERMITS = """
raw_permits AS (
  SELECT o_orderkey AS number, o_custkey + 10 AS key, CAST(o_orderdate AS DATE) AS issued,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'RF' WHEN '2-HIGH' THEN 'ROR' ELSE 'BLD' END AS type,
         CASE o_orderstatus WHEN 'O' THEN 'ISSUED' WHEN 'P' THEN 'INSPECT' ELSE 'COMPLETE' END AS status,
         CAST(o_orderdate AS DATE) AS modified
  FROM orders WHERE o_orderkey % 7 = 0),
features AS (
  SELECT * FROM raw_permits UNION ALL
  SELECT number, key, issued, type, status, CAST(modified + INTERVAL 1 DAY AS DATE) FROM raw_permits WHERE number % 21 = 0),
permits AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY number ORDER BY modified DESC) AS rn FROM features) WHERE rn = 1)"""

PROPERTIES = f"""
{PERMITS},
flagged AS (SELECT *, type IN ('RF','RFC','RFR','ROC','ROR') AS roofing, status IN ('APPLY','INSPECT','ISSUED','READY','RENEWED') AS is_open FROM permits),
rollup_p AS (
  SELECT key, count(*) AS permit_count, count(*) FILTER (WHERE roofing) AS roofing_permit_count, count(*) FILTER (WHERE is_open) AS open_permit_count,
         count(*) FILTER (WHERE roofing AND is_open) AS open_roofing_permit_count,
         max(date_diff('day', issued, DATE '2001-09-01')) FILTER (WHERE is_open) AS longest_open_permit_days,
         CAST(max(issued) AS VARCHAR) AS latest_permit_date,
         max(issued) FILTER (WHERE roofing AND NOT is_open) AS roof_completed, max(issued) FILTER (WHERE roofing AND is_open) AS roof_issued
  FROM flagged GROUP BY key),
sale_rows AS (
  SELECT o_custkey AS key, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS d, l_extendedprice AS p,
         row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(l_shipdate AS DATE) DESC, l_extendedprice DESC, l_orderkey, l_linenumber) AS n
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate >= TIMESTAMP '1998-01-01'),
rollup_s AS (
  SELECT key, count(*) AS sale_records_in_window, max(d) FILTER (WHERE n = 1) AS last_sale_date, max(p) FILTER (WHERE n = 1) AS last_sale_price,
         max(d) FILTER (WHERE n = 2) AS prior_sale_date, max(p) FILTER (WHERE n = 2) AS prior_sale_price
  FROM sale_rows GROUP BY key),
acct AS (SELECT *, CASE WHEN s_suppkey % 8 = 0 THEN '238160' ELSE '531110' END AS naics FROM supplier WHERE s_suppkey % 4 = 0),
rollup_b AS (
  SELECT s_nationkey AS nation, count(*) AS business_account_count, string_agg(DISTINCT naics, '; ' ORDER BY naics) AS business_naics_codes,
         string_agg(DISTINCT s_name, '; ' ORDER BY s_name) AS business_names, count(*) FILTER (WHERE naics = '238160') AS roofing_business_count
  FROM acct GROUP BY s_nationkey),
places AS (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
properties AS (
  SELECT 'prop-' || c_custkey AS property_id, CAST(NULL AS VARCHAR) AS property_cid, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS request_identifier,
    lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS parcel_identifier, CAST(c_custkey AS VARCHAR) AS alt_key, 'fl_dor_nal_2026p' AS source_system,
    'Sample' AS county_name, h.r_name AS state_code, (c_custkey % 400) || ' ' || c_mktsegment || ' St' AS address_street, h.n_name AS address_city,
    lpad(CAST(c_custkey % 90 + 32000 AS VARCHAR), 5, '0') AS address_zip,
    CASE WHEN c_custkey % 34 <> 0 THEN CAST(28.3 AS DOUBLE) + (c_custkey % 97) / CAST(100.0 AS DOUBLE) END AS latitude,
    CASE WHEN c_custkey % 34 <> 0 THEN CAST(-82.0 AS DOUBLE) + (c_custkey % 89) / CAST(100.0 AS DOUBLE) END AS longitude,
    CAST(c_custkey % 5000 + 1000 AS DOUBLE) AS lot_area_sqft, CAST(c_custkey % 5000 + 1000 AS DOUBLE) / CAST(43560.0 AS DOUBLE) AS lot_size_acre,
    c_mktsegment AS property_type, CAST(NULL AS VARCHAR) AS property_usage_type, CAST(NULL AS VARCHAR) AS dor_use_code,
    CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey * 7 % 98 + 1900 AS INTEGER) END AS built_year, CAST(NULL AS INTEGER) AS effective_built_year,
    CAST(NULL AS DOUBLE) AS livable_floor_area, CAST(c_custkey % 3 + 1 AS INTEGER) AS building_count, CAST(NULL AS INTEGER) AS residential_units,
    c_acctbal * 0.5 AS assessed_value, c_acctbal AS market_value, CAST(NULL AS DOUBLE) AS land_value, CAST(NULL AS DOUBLE) AS taxable_value,
    c_name AS owner_name, CASE WHEN c_custkey % 3 = 0 THEN c_name || '; Trust ' || c_custkey ELSE c_name END AS owners_text,
    CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS owner_count, m.n_name AS owner_mailing_city, m.r_name AS owner_mailing_state,
    CAST(NULL AS VARCHAR) AS owner_mailing_zip, CASE WHEN c_custkey % 11 <> 0 THEN m.n_name <> h.n_name END AS owner_out_of_county,
    CASE WHEN c_custkey % 11 <> 0 THEN m.r_name <> h.r_name END AS owner_out_of_state,
    last_sale_date, last_sale_price, prior_sale_date, prior_sale_price, CAST(sale_records_in_window AS INTEGER) AS sale_records_in_window,
    sale_records_in_window IS NULL AS no_recorded_sale_in_dor_window,
    CAST(2001 - coalesce(year(roof_completed), year(roof_issued), CASE WHEN c_custkey % 5 <> 0 THEN c_custkey * 7 % 98 + 1900 END) AS INTEGER) AS roof_age_years,
    CASE WHEN roof_completed IS NOT NULL THEN 'roofing_permit_completed' WHEN roof_issued IS NOT NULL THEN 'roofing_permit_issued'
         WHEN c_custkey % 5 <> 0 THEN 'year_built' END AS roof_age_basis,
    CAST(coalesce(roof_completed, roof_issued) AS VARCHAR) AS roof_last_permit_date, permit_count IS NOT NULL AS has_permits,
    CAST(coalesce(permit_count, 0) AS INTEGER) AS permit_count, CAST(coalesce(roofing_permit_count, 0) AS INTEGER) AS roofing_permit_count,
    CAST(coalesce(open_permit_count, 0) AS INTEGER) AS open_permit_count, CAST(coalesce(open_roofing_permit_count, 0) AS INTEGER) AS open_roofing_permit_count,
    CAST(longest_open_permit_days AS INTEGER) AS longest_open_permit_days, latest_permit_date, CAST(NULL AS VARCHAR) AS contractor_name,
    CAST(NULL AS VARCHAR) AS bbb_rating, CAST(NULL AS BOOLEAN) AS has_bbb_contractor, CAST(NULL AS BOOLEAN) AS has_sunbiz_tenant,
    business_account_count IS NOT NULL AS has_business_account, CAST(business_account_count AS INTEGER) AS business_account_count,
    business_naics_codes, business_names, CAST(roofing_business_count AS INTEGER) AS roofing_business_count,
    concat_ws(';', CASE WHEN permit_count IS NOT NULL THEN 'permits_loaded' ELSE 'no_permits_in_source' END, 'contractor_gated_403', 'bbb_gated_403') AS enrichment_status,
    concat_ws('|', 'fl_dor_nal_2026p', CASE WHEN c_custkey % 34 <> 0 THEN 'fl_gio_parcel_centroid_2025' END,
      CASE WHEN permit_count IS NOT NULL THEN 'lake_cdplus_permits' END, CASE WHEN sale_records_in_window IS NOT NULL THEN 'fl_dor_sdf_2026p' END,
      CASE WHEN business_account_count IS NOT NULL THEN 'fl_dor_tpp_2026p' END) AS source_systems
  FROM customer LEFT JOIN places h ON h.n_nationkey = c_nationkey LEFT JOIN places m ON m.n_nationkey = c_custkey * 3 % 25
    LEFT JOIN rollup_p ON rollup_p.key = c_custkey LEFT JOIN rollup_s ON rollup_s.key = c_custkey LEFT JOIN rollup_b ON rollup_b.nation = c_nationkey)"""


def over_properties(select: str) -> str:
    return f"WITH {PROPERTIES}\n{select}"


def over_permits(select: str) -> str:
    return f"WITH {PERMITS}\n{select}"
