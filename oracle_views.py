"""SQL for the independent check: the views over the test tables, and one query per key."""

from __future__ import annotations

import re

# The column names are the published ones.
VIEWS = {
    "country_src": """
SELECT n_name AS id, n_name AS name, CAST(r_regionkey AS VARCHAR(10)) AS region_id,
       CASE WHEN r_name = 'MIDDLE EAST' THEN 'Aggregates' WHEN n_nationkey = 20 THEN NULL ELSE r_name END AS region_value,
       CASE WHEN n_nationkey % 5 = 0 THEN '' WHEN n_nationkey % 7 = 0 THEN 'n/a'
            ELSE CAST(n_nationkey AS VARCHAR(10)) END AS longitude,
       CAST(n_nationkey AS VARCHAR(10)) AS latitude, substring(n_name, 1, 2) AS iso2, n_name AS capital
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "country_dim": """
SELECT id AS country_iso3, name AS country_name, region_id AS region_code, region_value AS region_name,
       iso2 AS country_iso2, capital AS capital_city, TRY_CAST(longitude AS DOUBLE) AS longitude, TRY_CAST(latitude AS DOUBLE) AS latitude, COALESCE(region_value = 'Aggregates', FALSE) AS is_aggregate
FROM country_src""",
    "traffic_src": """
SELECT n_name AS countryiso3code, n_nationkey AS country_id, n_name AS country_value,
       CAST(year(o_orderdate) AS VARCHAR(10)) AS date,
       CASE WHEN (n_nationkey + year(o_orderdate)) % 11 = 0 THEN NULL
            ELSE CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) END AS value
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
GROUP BY n_name, n_nationkey, year(o_orderdate)""",
    "traffic": """
SELECT countryiso3code AS country_iso3, country_id, country_value AS country_name,
       CAST(date AS INT) AS traffic_year, CAST(floor(value) AS BIGINT) AS teu
FROM traffic_src
WHERE value IS NOT NULL
  AND EXISTS (SELECT 1 FROM country_dim d WHERE d.country_iso3 = countryiso3code AND NOT d.is_aggregate)""",
    "ports": """
SELECT s_suppkey AS portid, s_name AS portname, n_name AS country, n_name AS country_iso3, r_name AS continent
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "daily_calls": """
SELECT l_suppkey AS portid, CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS portcalls_container,
       CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END AS portcalls_dry_bulk,
       CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END AS portcalls_general_cargo,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1 ELSE 0 END AS portcalls_roro,
       CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS portcalls_tanker,
       1 AS portcalls
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "calls_monthly": """
SELECT portid, year AS calls_year, month AS calls_month,
       CAST(sum(portcalls_container) AS BIGINT) AS calls_container,
       CAST(sum(portcalls_dry_bulk) AS BIGINT) AS calls_dry_bulk,
       CAST(sum(portcalls_general_cargo) AS BIGINT) AS calls_general_cargo,
       CAST(sum(portcalls_roro) AS BIGINT) AS calls_roro,
       CAST(sum(portcalls_tanker) AS BIGINT) AS calls_tanker,
       CAST(sum(portcalls) AS BIGINT) AS calls_total
FROM daily_calls GROUP BY portid, year, month""",
    "connections": """
SELECT s_nationkey AS from_portid, fn.n_name AS from_portname,
       CASE WHEN s_nationkey = 24 THEN NULL ELSE CAST(fn.n_regionkey AS VARCHAR(10)) END AS from_iso3,
       c_nationkey AS to_portid, tn.n_name AS to_portname, CAST(tn.n_regionkey AS VARCHAR(10)) AS to_iso3,
       CAST(min(l_linenumber) - 1 AS DOUBLE) AS average_transit_days,
       CASE WHEN (s_nationkey * 25 + c_nationkey) % 50 = 7 THEN NULL ELSE CAST(sum(l_quantity) AS BIGINT) END AS daily_capacity_at_risk
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation fn ON fn.n_nationkey = s_nationkey JOIN nation tn ON tn.n_nationkey = c_nationkey
GROUP BY s_nationkey, fn.n_name, fn.n_regionkey, c_nationkey, tn.n_name, tn.n_regionkey""",
    "raw_traffic": """
SELECT t.country_iso3, t.country_name, t.traffic_year, t.teu, d.region_code, d.region_name, d.longitude, d.latitude
FROM traffic t JOIN country_dim d ON d.country_iso3 = t.country_iso3 WHERE d.is_aggregate = FALSE""",
    "totals": """
SELECT region_code, region_name, traffic_year, CAST(sum(teu) AS BIGINT) AS total_teu,
       CAST(count(*) AS BIGINT) AS countries_reporting, CAST(round(avg(teu)) AS BIGINT) AS mean_teu
FROM raw_traffic GROUP BY region_code, region_name, traffic_year""",
    "summary": """
SELECT country_iso3, country_name, region_code, region_name, longitude, latitude, latest_year, latest_teu, teu_cmp, teu_base,
       CAST(round(power(CAST(teu_cmp AS DOUBLE) / CAST(teu_base AS DOUBLE), CAST(1 AS DOUBLE) / 4) - 1, 4) AS DOUBLE) AS cagr,
       CASE WHEN teu_cmp IS NOT NULL THEN CAST(rank() OVER (ORDER BY teu_cmp DESC NULLS LAST) AS BIGINT) END AS rank_cmp
FROM (SELECT country_iso3, country_name, region_code, region_name, longitude, latitude, max(traffic_year) AS latest_year, max_by(teu, traffic_year) AS latest_teu,
             max(CASE WHEN traffic_year = 2000 THEN teu END) AS teu_cmp,
             max(CASE WHEN traffic_year = 1996 THEN teu END) AS teu_base
      FROM raw_traffic GROUP BY country_iso3, country_name, region_code, region_name, longitude, latitude) a""",
    "calls_mart": """
SELECT p.portid, p.portname, p.country, p.country_iso3, p.continent, c.calls_year, c.calls_month,
       make_date(c.calls_year, c.calls_month, 1) AS month_start, c.calls_container, c.calls_dry_bulk,
       c.calls_general_cargo, c.calls_roro, c.calls_tanker, c.calls_total
FROM calls_monthly c JOIN ports p ON p.portid = c.portid""",
    "connection_ranks": """
SELECT c.from_portid, c.from_portname, c.from_portname AS from_country, c.from_iso3,
       c.to_portid, c.to_portname, c.to_portname AS to_country, c.to_iso3, t.continent AS to_continent,
       c.average_transit_days, c.daily_capacity_at_risk,
       c.daily_capacity_at_risk / CAST(100 AS DOUBLE) AS relative_capacity_at_risk, (c.from_iso3 = c.to_iso3) AS is_domestic,
       CAST(row_number() OVER (PARTITION BY c.from_portid ORDER BY c.daily_capacity_at_risk DESC NULLS LAST, c.to_portid) AS BIGINT) AS rank_from_port,
       CAST(row_number() OVER (PARTITION BY c.to_portid ORDER BY c.daily_capacity_at_risk DESC NULLS LAST, c.from_portid) AS BIGINT) AS rank_to_port
FROM connections c LEFT JOIN ports t ON t.portid = c.to_portid""",
    "event_bodies": """
SELECT CAST(event_id AS VARCHAR(20)) AS source, props,
       CASE event_type WHEN 'error' THEN 'error body' WHEN 'signup' THEN 'not an object' END AS problem
FROM events""",
}


def _count(view: str, condition: str) -> str:
    return f"CAST(count(CASE WHEN {condition} THEN 1 END) AS BIGINT) FROM {view}"


def _suite(view: str, checks) -> str:
    """One SELECT per check: (name, kind, what it looks at)."""
    parts = []
    for name, kind, what in checks:
        if kind == "rows":
            parts.append(f"SELECT '{name}' AS check_name, count(*) > 0 AS passed, CAST(count(*) AS BIGINT) AS bad FROM {view}")
        elif kind == "unique":
            parts.append(
                f"SELECT '{name}' AS check_name, count(*) = 0 AS passed, CAST(COALESCE(sum(n), 0) AS BIGINT) AS bad "
                f"FROM (SELECT count(*) - 1 AS n FROM {view} GROUP BY {what} HAVING count(*) > 1) q"
            )
        else:
            parts.append(
                f"SELECT '{name}' AS check_name, count(*) = 0 AS passed, CAST(count(*) AS BIGINT) AS bad "
                f"FROM {view} WHERE {what}"
            )
    return " UNION ALL ".join(parts)


def _metrics(asset: str, view: str, columns: str, landed=(), span: str = "") -> str:
    """(asset_key, metric, value): the rows of a view, the nulls of its columns, and counts of the landing."""
    parts = [f"SELECT 'rows_written' AS metric, count(*) AS value FROM {view}"]
    parts += [f"SELECT 'nulls.{c}', count(*) - count({c}) FROM {view}" for c in columns.split()]
    if landed:
        records, bodies = landed
        parts += [f"SELECT 'landed_records', count(*) FROM {records}", f"SELECT 'landed_bodies', {bodies} FROM {records}" if "(" in bodies else f"SELECT 'landed_bodies', {bodies}",
                  "SELECT 'landed_unreadable', 0"]
    if span:
        parts += [f"SELECT '{end}.{span}', {end}({span}) FROM {view}" for end in ("min", "max")]
    return f"SELECT '{asset}' AS asset_key, metric, CAST(value AS BIGINT) AS value FROM ({' UNION ALL '.join(parts)}) m"


QUERIES = {
    "country_dim_derive": "SELECT * FROM country_dim",
    "country_dim_stats": """
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(CASE WHEN is_aggregate THEN 1 END) AS BIGINT) AS aggregates FROM country_dim""",
    "clean_traffic": "SELECT country_iso3, country_id, country_name, traffic_year, teu FROM traffic",
    "clean_traffic_stats": """
SELECT CAST((SELECT count(*) FROM traffic_src) AS BIGINT) AS rows_in,
       CAST((SELECT count(*) FROM traffic_src WHERE value IS NOT NULL) AS BIGINT) AS after_nulls,
       CAST(count(*) AS BIGINT) AS after_aggregates, CAST(count(DISTINCT country_iso3) AS BIGINT) AS countries,
       min(traffic_year) AS min_year, max(traffic_year) AS max_year
FROM traffic""",
    "raw_traffic_join": "SELECT * FROM raw_traffic",
    "region_totals": "SELECT * FROM totals",
    "country_summary": "SELECT * FROM summary",
    "country_summary_stats": """
SELECT CAST(count(*) AS BIGINT) AS countries, CAST(count(teu_cmp) AS BIGINT) AS with_figure,
       CAST(count(cagr) AS BIGINT) AS with_growth,
       CAST(count(CASE WHEN teu_cmp IS NOT NULL AND teu_base IS NOT NULL AND cagr IS NULL THEN 1 END) AS BIGINT) AS growth_undefined
FROM summary""",
    "rank_global": """
SELECT o_orderkey, CAST(floor(o_totalprice / 100) AS BIGINT) AS spend,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(rank() OVER (ORDER BY CASE WHEN o_orderstatus <> 'P'
            THEN CAST(floor(o_totalprice / 100) AS BIGINT) END DESC NULLS LAST) AS BIGINT) END AS spend_rank
FROM orders""",
    "rank_hot_groups": """
SELECT flag, orderkey, quantity,
       CAST(row_number() OVER (PARTITION BY flag ORDER BY quantity DESC NULLS LAST, orderkey) AS BIGINT) AS place
FROM (SELECT l_returnflag AS flag, l_orderkey AS orderkey, CAST(sum(l_quantity) AS BIGINT) AS quantity
      FROM lineitem GROUP BY l_returnflag, l_orderkey) q""",
    "calls_max_year": "SELECT max(year) AS max_year FROM daily_calls",
    "calls_monthly_rollup": "SELECT * FROM calls_monthly WHERE calls_year >= (SELECT max(year) - 1 FROM daily_calls)",
    "union_years": """
SELECT portid, calls_year, calls_month, calls_total FROM calls_monthly WHERE calls_year = 2000
UNION ALL SELECT portid, calls_year, calls_month, calls_total FROM calls_monthly WHERE calls_year = 2001""",
    "mart_port_calls": "SELECT * FROM calls_mart",
    "mart_connections": "SELECT * FROM connection_ranks",
    "mart_row_parity": """
SELECT (SELECT count(*) FROM calls_mart) = count(*) AS passed, CAST(count(*) AS BIGINT) AS raw_rows FROM calls_monthly""",
    "quality_country_dim": _suite("country_dim", [
        ("has_rows", "rows", ""), ("unique_entity", "unique", "country_iso3"),
        ("key_fields_present", "where", "country_iso3 IS NULL OR country_name IS NULL OR is_aggregate IS NULL"),
    ]),
    "quality_traffic": _suite("traffic", [
        ("has_rows", "rows", ""), ("unique_country_year", "unique", "country_iso3, traffic_year"),
        ("key_fields_present", "where", "country_iso3 IS NULL OR traffic_year IS NULL OR teu IS NULL"),
        ("teu_non_negative", "where", "teu < 0"),
    ]),
    "quality_country_summary": _suite("summary", [
        ("has_rows", "rows", ""), ("unique_country", "unique", "country_iso3"),
        ("key_fields_present", "where", "country_iso3 IS NULL"),
        ("teu_2000_non_negative", "where", "teu_cmp < 0"),
    ]),
    "quality_region_totals": _suite("totals", [
        ("has_rows", "rows", ""), ("unique_region_year", "unique", "region_code, traffic_year"),
        ("key_fields_present", "where", "region_code IS NULL OR region_name IS NULL OR traffic_year IS NULL"),
        ("total_teu_non_negative", "where", "total_teu < 0"),
    ]),
    "quality_ports": _suite("ports", [
        ("has_rows", "rows", ""), ("unique_port", "unique", "portid"),
        ("key_fields_present", "where", "portid IS NULL OR portname IS NULL"),
    ]),
    "quality_calls": _suite("calls_monthly", [
        ("has_rows", "rows", ""), ("unique_port_month", "unique", "portid, calls_year, calls_month"),
        ("key_fields_present", "where", "portid IS NULL OR calls_year IS NULL OR calls_month IS NULL"),
        ("calls_non_negative", "where", "calls_total < 0"),
    ]),
    "quality_connections": _suite("connections", [
        ("has_rows", "rows", ""), ("unique_pair", "unique", "from_portid, to_portid"),
        ("key_fields_present", "where", "from_portid IS NULL OR to_portid IS NULL"),
        ("no_self_legs", "where", "from_portid = to_portid"),
        ("capacity_non_negative", "where", "daily_capacity_at_risk < 0"),
        ("transit_days_positive", "where", "average_transit_days <= 0"),
    ]),
    "quality_with_a_crash": """
SELECT 'has_rows' AS check_name, count(*) > 0 AS passed, CAST(count(*) AS BIGINT) AS bad, concat(count(*), ' rows') AS detail FROM ports
UNION ALL SELECT 'port_name_is_a_number', FALSE, NULL, 'check crashed'
UNION ALL SELECT 'one_port_a_country', n = 0, n, concat(n, ' repeated on (country)')
FROM (SELECT CAST(count(*) - count(DISTINCT country) AS BIGINT) AS n FROM ports) q
UNION ALL SELECT 'key_fields_present', TRUE, CAST(0 AS BIGINT), 'complete: portid, portname'
UNION ALL SELECT 'portid_non_negative', TRUE, CAST(0 AS BIGINT), '0 below zero in portid'""",
    "quality_duplicates": """
SELECT CAST(COALESCE(sum(n - 1), 0) AS BIGINT) AS dupes
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) q""",
    "key_violations": """
SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
    "quality_null_counts": " UNION ALL ".join(
        f"SELECT '{c}' AS field_name, " + _count("connections", f"{c} IS NULL").replace("BIGINT)", "BIGINT) AS nulls", 1)
        for c in ("from_iso3", "daily_capacity_at_risk", "to_portid")
    ),
    "profile_fields": " UNION ALL ".join(
        f"SELECT '{c}' AS field_name, count(CASE WHEN {c} IS NULL THEN 1 END) > 0 AS is_nullable FROM connections"
        for c in ("from_iso3", "to_iso3", "daily_capacity_at_risk")
    ),
    "upsert_calls": """
WITH src AS (SELECT l_suppkey AS portid, CAST(year(o_orderdate) AS INT) AS calls_year,
                    CAST(month(o_orderdate) AS INT) AS calls_month,
                    CAST(count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS BIGINT) AS calls_container,
                    CAST(count(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 END) AS BIGINT) AS calls_dry_bulk,
                    CAST(count(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 END) AS BIGINT) AS calls_general_cargo,
                    CAST(count(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1 END) AS BIGINT) AS calls_roro,
                    CAST(count(CASE WHEN o_orderpriority = '5-LOW' THEN 1 END) AS BIGINT) AS calls_tanker,
                    CAST(count(*) AS BIGINT) AS calls_total
             FROM lineitem JOIN orders ON l_orderkey = o_orderkey
             WHERE year(o_orderdate) >= (SELECT max(year(o_orderdate)) - 1 FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
             GROUP BY ALL)
SELECT * FROM src
UNION ALL
SELECT t.* FROM calls_monthly t
WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.portid = t.portid AND s.calls_year = t.calls_year AND s.calls_month = t.calls_month)""",
    "upsert_last_wins": """
WITH src AS (SELECT c_nationkey AS portid, c_name AS portname, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey DESC) AS rn FROM customer),
     nw AS (SELECT portid, portname FROM src WHERE rn = 1)
SELECT CAST(portid AS BIGINT) AS portid, portname FROM nw
UNION ALL SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey NOT IN (SELECT portid FROM nw)""",
    "registry_partial_upsert": """
SELECT COALESCE(t.k, u.k) AS asset_key,
       CASE WHEN t.k IS NULL THEN u.description ELSE t.description END AS description,
       CASE WHEN u.k IS NULL THEN t.n ELSE u.n END AS last_row_count
FROM (SELECT l_orderkey AS k, CAST(NULL AS VARCHAR(20)) AS description, count(*) AS n FROM lineitem WHERE l_returnflag <> 'A' GROUP BY l_orderkey) t
FULL OUTER JOIN (SELECT l_orderkey AS k, max(l_linestatus) AS description, count(*) AS n FROM lineitem WHERE l_returnflag <> 'R' GROUP BY l_orderkey) u ON t.k = u.k""",
    "edges_insert_ignore": """
SELECT DISTINCT l_suppkey AS from_asset, l_partkey AS to_asset, 'feeds' AS edge_type
FROM lineitem""",
    "wb_pages_flatten": "SELECT countryiso3code, country_id, country_value, date, value FROM traffic_src",
    "feature_pages_flatten": "SELECT portid, portname, country, country_iso3, continent FROM ports",
    "page_audit": """
WITH landed AS (SELECT CASE WHEN portid % 11 <> 6 THEN portid END AS page FROM ports),
     kept AS (SELECT page, count(*) AS n, CASE WHEN page % 7 = 1 THEN 2 ELSE 1 END AS bodies FROM landed
              WHERE page IS NULL OR page % 5 <> 3 GROUP BY page),
     bounds AS (SELECT max(page) AS newest, (SELECT max(page) FROM landed) AS announced FROM kept)
SELECT CAST(page AS INT) AS page, CAST(bodies AS BIGINT) AS bodies, CAST(bodies * n AS BIGINT) AS records,
       CASE WHEN page IS NULL THEN 'no page number' WHEN bodies > 1 THEN 'repeated'
            WHEN page = newest AND page < announced THEN 'cut off: more was announced' END AS issue
FROM kept, bounds
UNION ALL
SELECT CAST(p AS INT), 0, 0, 'missing' FROM (SELECT unnest(range(1, newest + 1)) AS p FROM bounds) q
WHERE p NOT IN (SELECT page FROM kept WHERE page IS NOT NULL)""",
    "page_audit_indicator": """
WITH landed AS (SELECT country_id + 1 AS page, count(*) AS n FROM traffic_src GROUP BY country_id),
     kept AS (SELECT page, n, CASE WHEN page % 6 = 1 THEN 2 ELSE 1 END AS bodies FROM landed WHERE page % 4 <> 2 OR page = 1)
SELECT CAST(page AS INT) AS page, CAST(bodies AS BIGINT) AS bodies, CAST(bodies * n AS BIGINT) AS records,
       CASE WHEN bodies > 1 THEN 'repeated' END AS issue
FROM kept
UNION ALL
SELECT CAST(p AS INT), 0, 0, 'missing' FROM (SELECT unnest(range(1, (SELECT max(page) FROM landed) + 1)) AS p) q
WHERE p NOT IN (SELECT page FROM kept)""",
    "page_gaps": """
WITH numbers AS (SELECT CAST((s_suppkey - 1) * 1000 AS BIGINT) AS page FROM supplier WHERE s_suppkey % 5 <> 3 AND s_suppkey % 7 > 1
                 UNION ALL SELECT 2000000000 UNION ALL SELECT -1000),
     ordered AS (SELECT page, lead(page) OVER (ORDER BY page) AS following FROM numbers)
SELECT page + 1000 AS first_page, following - 1000 AS last_page, CAST((following - page) / 1000 - 1 AS BIGINT) AS pages
FROM ordered WHERE following - page > 1000""",
    "unlisted_fields": """
SELECT 'fullname' AS field, 'STRING' AS data_type, count(*) AS records FROM ports
UNION ALL SELECT 'open', 'BOOLEAN', count(*) FROM ports
UNION ALL SELECT 'berths', 'BIGINT', count(*) FROM ports WHERE portid % 3 = 0
UNION ALL SELECT 'lines', 'ARRAY', count(*) FROM ports WHERE portid % 4 = 1
UNION ALL SELECT 'rating', 'OBJECT', count(*) FROM ports WHERE portid % 5 = 2""",
    "unlisted_kept": """
SELECT portid, portname, concat('Port of ', portname) AS fullname, CASE WHEN portid % 3 = 0 THEN portid * 10 END AS berths,
       portid % 2 = 0 AS is_open, CASE WHEN portid % 4 = 1 THEN country END AS second_line,
       CASE WHEN portid % 5 = 2 THEN portid END AS grade
FROM ports""",
    "check_details": """
WITH broken AS (SELECT CASE WHEN from_portid % 4 <> 1 THEN from_iso3 END AS f, to_iso3, from_portid,
                       daily_capacity_at_risk - 6000 AS margin, average_transit_days AS days FROM connections),
     n AS (SELECT count(*) AS total, count(CASE WHEN f IS NULL THEN 1 END) AS gaps, count(CASE WHEN to_iso3 IS NULL THEN 1 END) AS far_gaps,
                  count(CASE WHEN margin < 0 THEN 1 END) AS below, count(CASE WHEN days <= 0 THEN 1 END) AS still,
                  count(CASE WHEN f = to_iso3 THEN 1 END) AS domestic, count(*) - count(DISTINCT from_portid) AS again FROM broken)
SELECT 'has_rows' AS check_name, total > 0 AS passed, total AS bad, concat(total, ' rows') AS detail FROM n
UNION ALL SELECT 'countries_present', gaps + far_gaps = 0, gaps, concat('missing: from_iso3=', gaps) FROM n
UNION ALL SELECT 'margin_non_negative', below = 0, below, concat(below, ' below zero in margin') FROM n
UNION ALL SELECT 'days_positive', still = 0, still, concat(still, ' zero or below in average_transit_days') FROM n
UNION ALL SELECT 'no_domestic_legs', domestic = 0, domestic, concat(domestic, ' with from_iso3 equal to to_iso3') FROM n
UNION ALL SELECT 'one_leg_a_port', again = 0, again, concat(again, ' repeated on (from_portid)') FROM n""",
    "lazy_checks": """
SELECT 'has_rows' AS check_name, count(*) > 0 AS passed, count(*) AS bad, concat(count(*), ' rows') AS detail FROM calls_monthly
UNION ALL SELECT 'ports_known', count(*) = 0, count(*), concat(count(*), ' without a port') FROM calls_monthly
WHERE portid NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'whole_years', count(*) = 0, count(*), concat('short years: ', COALESCE(string_agg(CAST(calls_year AS VARCHAR(10)), ', ' ORDER BY CAST(calls_year AS VARCHAR(10))), ''))
FROM (SELECT calls_year FROM calls_monthly GROUP BY calls_year HAVING count(DISTINCT calls_month) < 12) y
UNION ALL SELECT 'tankers_common', sum(calls_tanker) * 100 >= sum(calls_total) * 10, CAST(sum(calls_tanker) AS BIGINT), 'tankers are a tenth or more' FROM calls_monthly""",
    "orphan_calls": "SELECT portid, calls_year, calls_month, calls_total FROM calls_monthly WHERE portid % 7 = 0",
    "lost_row_parity": """
SELECT count(CASE WHEN portid % 7 = 0 THEN 1 END) = 0 AS passed, count(*) AS raw_rows, count(CASE WHEN portid % 7 <> 0 THEN 1 END) AS mart_rows,
       concat(count(CASE WHEN portid % 7 <> 0 THEN 1 END), ' of ', count(*), ' raw rows joined') AS detail
FROM calls_monthly""",
    "distinct_sketches": """
SELECT CAST(year(o_orderdate) AS INT) AS year, count(DISTINCT o_custkey) AS customers, TRUE AS within_two_percent
FROM orders GROUP BY year(o_orderdate)
UNION ALL SELECT NULL, count(DISTINCT o_custkey), TRUE FROM orders""",
    "body_quarantine": "SELECT source, problem FROM event_bodies WHERE problem IS NOT NULL",
    "body_features": "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM event_bodies WHERE problem IS NULL",
    "lenient_numbers": """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS number FROM events""",
    "sink_replace": "SELECT * FROM ports",
    "sink_reload": "SELECT * FROM ports",
    "sink_csv": "SELECT * FROM ports",
    "job_region_totals": "SELECT * FROM totals",
    "job_country_summary": "SELECT * FROM summary",
    "job_edges": """
SELECT 'port_raw.country_port_traffic' AS from_asset, 'port_mart.country_traffic_summary' AS to_asset, 'feeds' AS edge_type
UNION ALL SELECT 'port_raw.country_dim', 'port_mart.country_traffic_summary', 'feeds'
UNION ALL SELECT 'port_raw.country_port_traffic', 'port_mart.traffic_by_region_year', 'feeds'
UNION ALL SELECT 'port_raw.country_dim', 'port_mart.traffic_by_region_year', 'feeds'""",
    "job_port_calls": "SELECT * FROM calls_mart WHERE calls_year >= (SELECT max(year) - 1 FROM daily_calls)",
    "job_connections": "SELECT * FROM connection_ranks",
    "job_asset_rows": """
SELECT 'port_raw.country_dim' AS asset_key, 'raw' AS layer, CAST(count(*) AS BIGINT) AS last_row_count FROM country_dim
UNION ALL SELECT 'port_raw.country_port_traffic', 'raw', CAST(count(*) AS BIGINT) FROM traffic
UNION ALL SELECT 'port_mart.traffic_by_region_year', 'mart', CAST(count(*) AS BIGINT) FROM totals""",
    "job_check_results": " UNION ALL ".join(
        f"SELECT '{asset}' AS asset_key, c.* FROM ({suite}) c"
        for asset, suite in (
            ("port_raw.portwatch_ports", _suite("ports", [
                ("has_rows", "rows", ""), ("unique_port", "unique", "portid"),
                ("key_fields_present", "where", "portid IS NULL OR portname IS NULL")])
             + " UNION ALL SELECT 'pages_complete', TRUE, CAST(0 AS BIGINT)"),
            ("port_raw.port_calls_monthly", _suite(
                "(SELECT * FROM calls_monthly WHERE calls_year >= (SELECT max(year) - 1 FROM daily_calls)) m", [
                    ("has_rows", "rows", ""), ("unique_port_month", "unique", "portid, calls_year, calls_month"),
                    ("key_fields_present", "where", "portid IS NULL OR calls_year IS NULL OR calls_month IS NULL"),
                    ("calls_non_negative", "where", "calls_total < 0")])),
            ("port_mart.port_calls_by_type_month", _suite(
                "(SELECT * FROM calls_mart WHERE calls_year >= (SELECT max(year) - 1 FROM daily_calls)) m",
                [("has_rows", "rows", "")]) + """
 UNION ALL SELECT 'every_row_has_a_named_port', a.n = b.n, CAST(abs(a.n - b.n) AS BIGINT)
 FROM (SELECT count(*) AS n FROM calls_mart WHERE calls_year >= (SELECT max(year) - 1 FROM daily_calls)) a,
      (SELECT count(*) AS n FROM calls_monthly WHERE calls_year >= (SELECT max(year) - 1 FROM daily_calls)) b"""),
        )
    ),
    "job_write_metrics": " UNION ALL ".join([
        _metrics("port_raw.country_dim", "country_dim",
                 "country_iso3 country_iso2 country_name region_code region_name capital_city longitude latitude is_aggregate",
                 landed=("country_src", "1")),
        _metrics("port_raw.country_port_traffic", "traffic", "country_iso3 country_id country_name traffic_year teu",
                 landed=("traffic_src", "count(DISTINCT country_id)"), span="traffic_year"),
        _metrics("port_mart.traffic_by_region_year", "totals",
                 "region_code region_name traffic_year total_teu countries_reporting mean_teu"),
    ]),
    "job_registered_names": """
SELECT traffic_year, count(*) AS countries, 'port_raw' AS schema_name, 'country_port_traffic' AS table_name, '2024-01-01' AS run_day
FROM traffic GROUP BY traffic_year""",
    "mart_from_text": """
SELECT continent, calls_year, CAST(sum(calls_total) AS BIGINT) AS calls, count(DISTINCT portid) AS ports,
       'port_raw.port_calls_monthly, port_raw.portwatch_ports' AS built_from
FROM calls_mart WHERE calls_month <= 6 AND calls_year >= (SELECT max(calls_year) - 2 FROM calls_monthly)
GROUP BY continent, calls_year""",
    "job_mart_edges": """
WITH n AS (SELECT 'port_raw.portwatch_ports' AS k, count(*) AS n FROM ports
           UNION ALL SELECT 'port_raw.port_connections', count(*) FROM connections
           UNION ALL SELECT 'port_mart.port_connection_summary', count(*) FROM connection_ranks
           UNION ALL SELECT 'port_raw.port_calls_monthly', count(*) FROM calls_monthly WHERE calls_year >= (SELECT max(year) - 1 FROM daily_calls)
           UNION ALL SELECT 'port_mart.port_calls_by_type_month', count(*) FROM calls_mart WHERE calls_year >= (SELECT max(year) - 1 FROM daily_calls))
SELECT a.k AS from_asset, b.k AS to_asset, 'feeds' AS edge_type, a.n AS from_rows, b.n AS to_rows FROM n a, n b
WHERE a.k LIKE 'port_raw%' AND b.k LIKE 'port_mart%'
  AND (a.k LIKE '%ports' OR (a.k LIKE '%connections') = (b.k LIKE '%connection_summary'))""",
    "job_offset_pages": """
WITH landed AS (SELECT portid, CAST(floor(portid / 10) AS BIGINT) AS page FROM ports),
     kept AS (SELECT * FROM landed WHERE page % 4 <> 2),
     bounds AS (SELECT max(page) AS newest, count(DISTINCT page) AS pages, (SELECT max(page) FROM landed) AS announced FROM kept),
     found AS (SELECT newest + 1 - pages AS missing, CASE WHEN newest < announced THEN 1 ELSE 0 END AS cut FROM bounds)
SELECT 'has_rows' AS check_name, count(*) > 0 AS passed, count(*) AS bad, concat(count(*), ' rows') AS detail FROM kept
UNION ALL SELECT 'unique_port', TRUE, CAST(0 AS BIGINT), '0 repeated on (portid)'
UNION ALL SELECT 'key_fields_present', TRUE, CAST(0 AS BIGINT), 'complete: portid, portname'
UNION ALL SELECT 'pages_complete', missing + cut = 0, CAST(missing + cut AS BIGINT),
  CASE WHEN missing + cut = 0 THEN 'all pages are there'
       ELSE concat_ws('; ', CASE WHEN cut > 0 THEN concat('cut off: more was announced: ', cut) END, CASE WHEN missing > 0 THEN concat('missing: ', missing) END) END
FROM found""",
    "job_field_profile": """
SELECT 'port_mart.traffic_by_region_year' AS asset_key, f.* FROM (
  SELECT 'region_code' AS field_name, 'string' AS data_type, CAST(NULL AS VARCHAR(10)) AS unit, count(*) > count(region_code) AS is_nullable FROM totals
  UNION ALL SELECT 'region_name', 'string', NULL, count(*) > count(region_name) FROM totals
  UNION ALL SELECT 'traffic_year', 'int', 'year', count(*) > count(traffic_year) FROM totals
  UNION ALL SELECT 'total_teu', 'bigint', 'TEU', count(*) > count(total_teu) FROM totals
  UNION ALL SELECT 'countries_reporting', 'bigint', 'count', count(*) > count(countries_reporting) FROM totals
  UNION ALL SELECT 'mean_teu', 'bigint', 'TEU', count(*) > count(mean_teu) FROM totals) f""",
}


def _needed(sql: str, found: dict[str, None]) -> dict[str, None]:
    for name, text in VIEWS.items():
        if name not in found and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
            _needed(text, found)
            found[name] = None
    return found


def compose(key: str) -> str:
    """Self-contained SQL: the views the query rests on, then the query."""
    sql = QUERIES[key].strip()
    views = ", ".join(f"{name} AS ({VIEWS[name].strip()})" for name in _needed(sql, {}))
    return f"WITH {views} SELECT * FROM ({sql}) z" if views else sql
