"""DuckDB statements that state, independently of Spark, what each registered query returns.

Every statement starts with the same chain of named tables: raw loads from the given tables,
staged loads, dimensions, fact.
"""

from __future__ import annotations

import re

from haulgrid.plans.breakdowns import BREAKDOWNS
from haulgrid.plans.models import FACT_COLUMNS, STAGED_COLUMNS
from haulgrid.plans.registry import (
    BREAKDOWN_QUERIES, MEASURE_QUERIES, PERIOD, PLACES, STATE, TREND,
)
from haulgrid.plans.suite import QUESTIONS
from haulgrid.sources.landing import RAW_COLUMNS


# What the checks cover, written out here so that a check missing in the library differs.
NOT_NULL = {
    "stg_loads": (
        "load_id lane pickup_city pickup_state "
        "delivery_city delivery_state book_price load_was_cancelled is_delivered"
    ).split(),
    "dim_shipper": "shipper_key".split(),
    "dim_carrier": "carrier_key".split(),
    "dim_lane": "lane_key lane pickup_state delivery_state haul_type".split(),
    "dim_date": "date_day month_start_date year_month".split(),
    "fct_loads": (
        "load_id shipper_key carrier_key lane_key quote_date booked_date pickup_date delivery_date "
        "book_price source_price pnl mileage equipment_type vip_carrier load_was_cancelled is_delivered haul_type"
    ).split(),
}
UNIQUE = {
    "stg_loads": "load_id",
    "dim_shipper": "shipper_key",
    "dim_carrier": "carrier_key",
    "dim_lane": "lane_key",
    "dim_date": "date_day",
    "fct_loads": "load_id",
}
RELATIONSHIPS = {
    "shipper_key": ("dim_shipper", "shipper_key"),
    "carrier_key": ("dim_carrier", "carrier_key"),
    "lane_key": ("dim_lane", "lane_key"),
    "quote_date": ("dim_date", "date_day"),
    "booked_date": ("dim_date", "date_day"),
    "sourced_date": ("dim_date", "date_day"),
    "pickup_date": ("dim_date", "date_day"),
    "delivery_date": ("dim_date", "date_day"),
}
ACCEPTED = {"dim_lane": "haul_type", "fct_loads": "haul_type"}


def _fmt(moment: str) -> str:
    return f"strftime({moment}, '%-m/%-d/%Y %-H:%M')"


def _stamp(text: str) -> str:
    return f"try_strptime({text}, '%m/%d/%Y %H:%M')"


RAW_NAMES = [c.replace(".", "_") for c in RAW_COLUMNS]

MODELS = f"""
WITH items AS (
  SELECT l_orderkey, min(l_suppkey) AS suppkey, min(l_shipdate) AS t0, max(l_shipdate) AS t1,
         max(l_extendedprice) AS max_price
  FROM lineitem GROUP BY l_orderkey
),
places AS (
  SELECT n_nationkey AS id, n_name AS city, substr(r_name, 1, 2) AS st
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
parties AS (
  SELECT o_orderkey AS k, o_totalprice AS price, o_orderdate AS ordered, o_orderpriority AS prio,
         c_name, s_name, t0, t1, coalesce(max_price, 0) AS max_price,
         c_nationkey AS pk, coalesce(s_nationkey, c_nationkey) AS dk
  FROM orders
  JOIN customer ON c_custkey = o_custkey
  LEFT JOIN items ON l_orderkey = o_orderkey
  LEFT JOIN supplier ON s_suppkey = suppkey
),
raw_once AS (
  SELECT k AS load_id,
    CASE WHEN k % 2500 = 7 THEN 'BADLANE'
         ELSE ' ' || p.city || ',' || p.st || ' -> ' || d.city || ',' || lower(d.st) || ' '
    END AS lane,
    {_fmt("ordered - INTERVAL 2 DAY")} AS quote_date,
    {_fmt("ordered")} AS book_date,
    {_fmt("t0 - INTERVAL 90 MINUTE")} AS source_date,
    {_fmt("t0")} AS pickup_date,
    CASE WHEN k % 101 = 50 THEN 'not a date'
         WHEN k % 19 = 0 THEN {_fmt("t0 - INTERVAL 1 DAY")}
         ELSE {_fmt("t1")} END AS delivery_date,
    CASE WHEN k % 10 = 0 THEN 0::DOUBLE ELSE price::DOUBLE END AS book_price,
    CASE WHEN k % 3001 = 5 THEN (-1)::DOUBLE WHEN k % 11 = 0 THEN 0::DOUBLE
         ELSE max_price::DOUBLE END AS source_price,
    round(price - max_price * 3, 2)::DOUBLE AS pnl,
    CASE WHEN k % 29 = 0 THEN 0::DOUBLE ELSE (abs(pk - dk) * 100)::DOUBLE END AS mileage,
    ' ' || lower(prio) || ' ' AS equipment_type,
    CASE WHEN k % 7 = 0 THEN (k % 6)::DOUBLE END AS carrier_rating,
    CASE WHEN k % 20 = 0 THEN 'api' ELSE '  ' END AS sourcing_channel,
    k % 3 = 0 AS vip_carrier,
    (k % 4)::INTEGER AS carrier_dropped_us_count,
    CASE WHEN k % 13 = 0 THEN ' ' ELSE s_name END AS carrier_name,
    c_name AS shipper_name,
    CASE WHEN k % 4 <> 0 THEN k % 5 <> 0 END AS carrier_on_time_to_pickup,
    CASE WHEN k % 4 <> 0 THEN k % 6 <> 0 END AS carrier_on_time_to_delivery,
    CASE WHEN k % 4 <> 0 THEN k % 5 <> 0 AND k % 6 <> 0 END AS carrier_on_time_overall,
    {_fmt("t0 + INTERVAL 3 HOUR")} AS pickup_appointment_time,
    {_fmt("t1 + INTERVAL 5 HOUR")} AS delivery_appointment_time,
    k % 2 = 0 AS has_mobile_app_tracking,
    k % 3 = 1 AS has_macropoint_tracking,
    k % 5 = 2 AS has_edi_tracking,
    k % 8 = 0 AS contracted_load,
    k % 9 = 0 AS load_booked_autonomously,
    k % 10 = 1 AS load_sourced_autonomously,
    k % 17 = 0 AS load_was_cancelled,
    false AS has_mobile_app_tracking_1
  FROM parties JOIN places p ON p.id = pk JOIN places d ON d.id = dk
),
raw_loads AS (
  SELECT * FROM raw_once UNION ALL SELECT * FROM raw_once WHERE load_id % 1000 = 0
),
typed_all AS (
  SELECT load_id, trim(lane) AS lane,
    {_stamp("quote_date")} AS quote_at, {_stamp("book_date")} AS booked_at,
    {_stamp("source_date")} AS sourced_at, {_stamp("pickup_date")} AS pickup_at,
    {_stamp("delivery_date")} AS delivered_at,
    {_stamp("pickup_appointment_time")} AS pickup_appointment_at,
    {_stamp("delivery_appointment_time")} AS delivery_appointment_at,
    book_price, source_price, pnl, mileage, carrier_rating,
    upper(trim(equipment_type)) AS equipment_type,
    nullif(trim(sourcing_channel), '') AS sourcing_channel,
    nullif(trim(carrier_name), '') AS carrier_name,
    nullif(trim(shipper_name), '') AS shipper_name,
    carrier_dropped_us_count, carrier_on_time_to_pickup, carrier_on_time_to_delivery,
    carrier_on_time_overall, has_mobile_app_tracking, has_macropoint_tracking,
    has_edi_tracking, contracted_load, load_booked_autonomously, load_sourced_autonomously,
    load_was_cancelled, vip_carrier, quote_date AS quote_text, book_date AS book_text
  FROM raw_loads
),
sides AS (
  SELECT DISTINCT ON (load_id) *,
    string_split(lane, ' -> ') AS ends
  FROM typed_all ORDER BY load_id, quote_text, book_text
),
geo AS (
  SELECT *,
    trim(split_part(ends[1], ',', 1)) AS pickup_city,
    upper(trim(split_part(ends[1], ',', 2))) AS pickup_state,
    trim(split_part(coalesce(ends[2], ''), ',', 1)) AS delivery_city,
    upper(trim(split_part(coalesce(ends[2], ''), ',', 2))) AS delivery_state
  FROM sides
),
stg_full AS (
  SELECT *, NOT load_was_cancelled AND delivered_at IS NOT NULL AS is_delivered,
    if(pickup_state = delivery_state, 'intrastate', 'interstate') AS haul_type
  FROM geo
),
stg_loads AS (SELECT {", ".join(STAGED_COLUMNS)} FROM stg_full),
dim_shipper AS (
  SELECT DISTINCT md5(coalesce(shipper_name, '__unknown__')) AS shipper_key, shipper_name
  FROM stg_loads
),
dim_carrier AS (
  SELECT DISTINCT md5(coalesce(carrier_name, '__unknown__')) AS carrier_key, carrier_name
  FROM stg_loads
),
dim_lane AS (
  SELECT DISTINCT md5(lane) AS lane_key, lane, pickup_city, pickup_state, delivery_city,
    delivery_state, haul_type
  FROM stg_loads
),
moments AS (
  SELECT unnest([quote_at, booked_at, sourced_at, pickup_at, delivered_at])::DATE AS d
  FROM stg_loads
),
dim_date AS (
  SELECT day::DATE AS date_day, date_trunc('month', day)::DATE AS month_start_date,
    year(day)::INTEGER AS year, quarter(day)::INTEGER AS quarter, month(day)::INTEGER AS month,
    strftime(day, '%Y-%m') AS year_month, dayofweek(day)::INTEGER AS day_of_week,
    dayname(day) AS day_name
  FROM (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS day FROM moments)
),
fct_all AS (
  SELECT *, md5(coalesce(shipper_name, '__unknown__')) AS shipper_key,
    md5(coalesce(carrier_name, '__unknown__')) AS carrier_key, md5(lane) AS lane_key,
    quote_at::DATE AS quote_date, booked_at::DATE AS booked_date,
    sourced_at::DATE AS sourced_date, pickup_at::DATE AS pickup_date,
    delivered_at::DATE AS delivery_date
  FROM stg_loads
),
fct_loads AS (SELECT {", ".join(FACT_COLUMNS)} FROM fct_all),
named AS (
  SELECT f.*, s.shipper_name, c.carrier_name, l.lane, l.pickup_city, l.pickup_state,
    l.delivery_city, l.delivery_state
  FROM fct_loads f
  LEFT JOIN dim_shipper s ON s.shipper_key = f.shipper_key
  LEFT JOIN dim_carrier c ON c.carrier_key = f.carrier_key
  LEFT JOIN dim_lane l ON l.lane_key = f.lane_key
)
"""

# Measure -> expression over the columns of a load.
MEASURE_SQL = {
    "total_loads": "count(*)",
    "delivered_loads": "count(*) FILTER (is_delivered)",
    "delivery_rate": "count(*) FILTER (is_delivered) / nullif(count(*), 0)",
    "total_book_price": "sum(book_price)",
    "avg_book_price": "avg(book_price)",
    "delivered_book_price": "sum(book_price) FILTER (is_delivered)",
    "delivered_avg_book_price": "avg(book_price) FILTER (is_delivered)",
    "total_pnl": "sum(pnl)",
    "delivered_pnl": "sum(pnl) FILTER (is_delivered)",
    "pnl_margin": "sum(pnl) / nullif(sum(book_price), 0)",
    "delivered_pnl_margin":
        "sum(pnl) FILTER (is_delivered) / nullif(sum(book_price) FILTER (is_delivered), 0)",
    "avg_carrier_rating": "avg(carrier_rating)",
    "on_time_pickup": "avg(carrier_on_time_to_pickup::INT)",
    "on_time_delivery": "avg(carrier_on_time_to_delivery::INT)",
    "on_time_overall": "avg(carrier_on_time_overall::INT)",
}

_CALENDAR = ("year", "year_month", "day_of_week", "day_name")


def _measures(measures, by, role="delivery_date", places=None) -> str:
    places = PLACES if places is None else places
    shown = [
        (f"round({MEASURE_SQL[m]}, {places[m]})" if places.get(m) else MEASURE_SQL[m]) + f" AS {m}"
        for m in measures
    ]
    source = "named"
    if any(b in _CALENDAR for b in by):
        source = f"named LEFT JOIN dim_date ON date_day = {role}"
    group = f" GROUP BY {', '.join(by)}" if by else ""
    return f"SELECT {', '.join([*by, *shown])} FROM {source}{group}"


_Q: dict[str, str] = {}

# --- sources and sinks ---
_Q["s1_csv_landing"] = (
    "SELECT * REPLACE (carrier_dropped_us_count::DOUBLE AS carrier_dropped_us_count) "
    "FROM raw_loads"
)
_Q["s2_raw_scan"] = f"SELECT {', '.join(RAW_NAMES)} FROM raw_loads"
_Q["s3_staging_view"] = (
    "SELECT equipment_type, count(*) AS loads, count(carrier_name) AS named_carriers "
    "FROM stg_loads GROUP BY ALL"
)
_PUBLISHED = {
    "dim_date": "date_day month_start_date year quarter month year_month day_of_week day_name",
    "dim_shipper": "shipper_key shipper_name",
    "dim_carrier": "carrier_key carrier_name",
    "dim_lane": "lane_key lane pickup_city pickup_state delivery_city delivery_state haul_type",
    "fct_loads": "load_id shipper_key carrier_key lane_key quote_date booked_date sourced_date "
                 "pickup_date delivery_date equipment_type haul_type is_delivered",
}
_Q["s4_published_tables"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, sum(CAST('0x' || substr(md5(concat_ws('|', "
    + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns.split())
    + f")), 1, 8) AS BIGINT))::BIGINT AS content FROM {t}"
    for t, columns in _PUBLISHED.items()
)
_Q["s5_mart_scan"] = "SELECT load_id, booked_date, book_price, is_delivered FROM fct_loads"

_EXPORT = """SELECT load_id, shipper_name, delivery_date, pickup_city, pickup_state,
  delivery_city, delivery_state, book_price, carrier_name
FROM named
WHERE is_delivered AND date_trunc('month', delivery_date) =
  (SELECT date_trunc('month', max(delivery_date)) FROM fct_loads)"""
_Q["s6_csv_export"] = _EXPORT
_Q["e3_latest_month_loads"] = _EXPORT
_Q["s7_csv_read_back"] = (
    f"SELECT true AS columns_equal, count(*) AS written_rows, true AS rows_equal FROM ({_EXPORT})"
)
_Q["e5_export_written"] = (
    "SELECT delivery_date, count(*) AS loads, round(sum(book_price), 2) AS book_price "
    f"FROM ({_EXPORT}) GROUP BY delivery_date"
)

# --- projections, filters, predicates ---
_Q["p1_typed_columns"] = "SELECT * EXCLUDE (quote_text, book_text) FROM typed_all"
_Q["p4_first_copy"] = (
    "SELECT load_id, quote_date, book_date, lane FROM raw_loads "
    "QUALIFY row_number() OVER (PARTITION BY load_id ORDER BY quote_date, book_date) = 1"
)
_Q["p5_delivered_loads"] = "SELECT load_id, delivery_date FROM fct_loads WHERE is_delivered"
_Q["p6_half_open_range"] = (
    "SELECT load_id, delivery_date, is_delivered FROM fct_loads "
    f"WHERE delivery_date >= DATE '{PERIOD[0]}' AND delivery_date < DATE '{PERIOD[1]}'"
)
_Q["p7_inclusive_range"] = (
    "SELECT date_day AS delivery_month FROM dim_date WHERE day(date_day) = 1 "
    f"AND date_day BETWEEN DATE '{TREND[0]}' AND DATE '{TREND[1]}'"
)
_Q["p8_not_null"] = (
    "SELECT load_id, carrier_rating FROM fct_loads WHERE carrier_rating IS NOT NULL"
)
_Q["p9_equals_literal"] = f"SELECT lane_key, lane FROM dim_lane WHERE delivery_state = '{STATE}'"
_Q["p10_inequality"] = (
    "SELECT lane, pickup_city, delivery_city FROM dim_lane WHERE pickup_city <> delivery_city"
)
_Q["p11_time_comparison"] = (
    "SELECT load_id, pickup_at, delivered_at FROM stg_loads WHERE delivered_at < pickup_at"
)
_Q["p14_case_flags"] = (
    "SELECT load_id, haul_type, (book_price = 0)::INT AS zero_book_price FROM stg_loads"
)
_Q["p15_delivered_flag"] = (
    "SELECT load_was_cancelled, delivered_at IS NOT NULL AS has_delivery, is_delivered, "
    "count(*) AS loads FROM stg_loads GROUP BY ALL"
)
_Q["p16_bound_parameters"] = (
    "SELECT count(*) AS loads, count(*) FILTER (is_delivered) AS delivered_loads FROM fct_loads "
    f"WHERE delivery_date >= DATE '{PERIOD[0]}' AND delivery_date < DATE '{PERIOD[1]}'"
)
_Q["p17_latest_month_loads"] = f"SELECT load_id, delivery_date FROM ({_EXPORT})"
_Q["p18_month_starts"] = (
    "SELECT date_day AS delivery_month FROM dim_date WHERE day(date_day) = 1"
)

# --- joins ---
_Q["j1_key_lookup"] = """SELECT load_id, s.shipper_key, c.carrier_key, l.lane_key
FROM stg_loads g
LEFT JOIN dim_shipper s ON g.shipper_name IS NOT DISTINCT FROM s.shipper_name
LEFT JOIN dim_carrier c ON g.carrier_name IS NOT DISTINCT FROM c.carrier_name
LEFT JOIN dim_lane l ON g.lane = l.lane"""
_Q["j2_carrier_totals"] = (
    "SELECT carrier_name, count(*) AS total_loads, round(sum(pnl), 2) AS total_pnl "
    "FROM fct_loads JOIN dim_carrier USING (carrier_key) GROUP BY carrier_name"
)
_Q["j3_carrier_by_state"] = (
    "SELECT carrier_name, delivery_state, count(*) AS delivered_loads FROM fct_loads "
    "JOIN dim_carrier USING (carrier_key) JOIN dim_lane USING (lane_key) "
    "WHERE is_delivered GROUP BY ALL"
)
_Q["j4_named_loads"] = (
    "SELECT load_id, shipper_name, carrier_name, lane, delivery_city FROM named"
)
_ACTIVITY = (
    "SELECT date_trunc('month', delivery_date)::DATE AS delivery_month, count(*) AS all_loads, "
    "count(*) FILTER (is_delivered) AS delivered_loads FROM fct_loads "
    "WHERE delivery_date IS NOT NULL GROUP BY 1"
)
_Q["e2_monthly_activity"] = _ACTIVITY
_Q["j6_latest_month_attached"] = (
    "SELECT a.*, (SELECT date_trunc('month', max(delivery_date))::DATE FROM fct_loads) "
    f"AS latest_available_month FROM ({_ACTIVITY}) a"
)
_BUSIEST = (
    "(SELECT shipper_key FROM fct_loads WHERE is_delivered GROUP BY shipper_key "
    "ORDER BY count(*) DESC, shipper_key LIMIT 1)"
)
_Q["j8_busiest_shipper_loads"] = (
    f"SELECT load_id, shipper_key FROM fct_loads WHERE is_delivered AND shipper_key = {_BUSIEST}"
)
_Q["j11_loads_by_role"] = " UNION ALL ".join(
    f"(SELECT year_month, count(*) AS total_loads, '{role}' AS date_role FROM fct_loads "
    f"LEFT JOIN dim_date ON date_day = {role} GROUP BY year_month)"
    for role in ("delivery_date", "booked_date", "pickup_date")
)

# --- aggregations, sorts, set operations ---
_Q["a1_row_count"] = "SELECT count(*) AS loads FROM fct_loads"
_Q["a3_loads_by_equipment"] = (
    "SELECT equipment_type, count(*) AS total_loads FROM fct_loads GROUP BY equipment_type"
)
_Q["a7_distinct_loads"] = (
    "SELECT count(DISTINCT load_id) AS distinct_loads FROM fct_loads"
)
_Q["a8_delivery_bounds"] = (
    "SELECT min(delivery_date) AS first_day, max(delivery_date) AS last_day FROM fct_loads"
)
_Q["a9_conditional_counts"] = (
    "SELECT haul_type, sum(CASE WHEN is_delivered THEN 1 ELSE 0 END)::BIGINT AS delivered_loads, "
    "count(*) FILTER (book_price = 0) AS zero_book_price FROM fct_loads GROUP BY haul_type"
)
_Q["a12_group_by_expression"] = (
    "SELECT year(booked_date)::INT AS booked_year, quarter(booked_date)::INT AS quarter, "
    "count(*) AS loads FROM fct_loads GROUP BY 1, 2"
)
_Q["a13_order_by_hidden_count"] = (
    "SELECT shipper_name FROM named WHERE is_delivered GROUP BY shipper_name "
    "ORDER BY count(*) DESC, shipper_name NULLS LAST LIMIT 10"
)
_Q["t5_nulls_last"] = (
    "SELECT load_id, carrier_rating, delivery_date FROM fct_loads ORDER BY carrier_rating "
    "NULLS LAST, delivery_date DESC NULLS LAST, load_id"
)
_Q["u1_lifecycle_dates"] = (
    "SELECT min(d) AS first_day, max(d) AS last_day, count(d) AS dates FROM moments"
)

# --- scalar functions ---
_Q["f3_parsed_stamps"] = (
    f"SELECT load_id, {_stamp('pickup_date')} AS pickup_at, "
    f"{_stamp('delivery_date')} AS delivered_at FROM raw_loads"
)
_Q["f4_clean_text"] = (
    "SELECT load_id, upper(trim(equipment_type)) AS equipment_type, "
    "lower(trim(lane)) AS lane_lower, nullif(trim(sourcing_channel), '') AS sourcing_channel, "
    "coalesce(nullif(trim(carrier_name), ''), '__unknown__') AS carrier_or_unknown "
    "FROM raw_loads"
)
_Q["f10_member_keys"] = "SELECT load_id, carrier_key, lane_key FROM fct_loads"
_Q["f14_weekday_counts"] = _measures(["total_loads"], ["day_of_week", "day_name"], "booked_date")
_Q["f19_price_per_mile"] = (
    "SELECT load_id, book_price / nullif(mileage, 0) AS price_per_mile FROM fct_loads"
)
_Q["f20_lane_parts"] = (
    "SELECT DISTINCT lane, pickup_city, pickup_state, delivery_city, delivery_state "
    "FROM stg_loads"
)

# --- models ---
_Q["m1_staged_loads"] = "SELECT * FROM stg_loads"
_Q["m2_shipper_dimension"] = "SELECT * FROM dim_shipper"
_Q["m3_carrier_dimension"] = "SELECT * FROM dim_carrier"
_Q["m4_lane_dimension"] = "SELECT * FROM dim_lane"
_Q["m5_calendar_dimension"] = "SELECT * FROM dim_date"
_Q["m6_load_facts"] = "SELECT * FROM fct_loads"

# --- data quality ---
LANE_OK = r"regexp_full_match(lane, '[^,]+,[A-Za-z]{2} -> [^,]+,[A-Za-z]{2}')"


def _check(name, model, column, severity, counted) -> str:
    return (
        f"(SELECT '{name}' AS check_name, '{model}' AS model, '{column}' AS column_name, "
        f"'{severity}' AS severity, ({counted})::BIGINT AS failing_rows)"
    )


_NOT_NULL = [
    _check("not_null", t, c, "error", f"SELECT count(*) FROM {t} WHERE {c} IS NULL")
    for t, columns in NOT_NULL.items()
    for c in columns
]


def _dups(table: str, column: str) -> str:
    return (
        f"SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING count(*) > 1)"
    )


_UNIQUE = [_check("unique", t, c, "error", _dups(t, c)) for t, c in UNIQUE.items()]
_RELATIONS = [
    _check(
        "relationships", "fct_loads", fk, "error",
        f"SELECT count(*) FROM fct_loads WHERE {fk} IS NOT NULL "
        f"AND {fk} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)",
    )
    for fk, (parent, key) in RELATIONSHIPS.items()
]
_ACCEPTED = [
    _check("accepted_values", t, c, "error",
           f"SELECT count(*) FROM {t} WHERE {c} NOT IN ('intrastate', 'interstate')")
    for t, c in ACCEPTED.items()
]
_Q["d1_not_null"] = " UNION ALL ".join(_NOT_NULL)
_Q["d2_unique"] = " UNION ALL ".join(_UNIQUE)
_Q["d3_relationships"] = " UNION ALL ".join(_RELATIONS)
_Q["d4_accepted_values"] = " UNION ALL ".join(_ACCEPTED)
_Q["d5_one_row_per_load"] = (
    "SELECT load_id, count(*) AS row_count FROM stg_loads GROUP BY load_id HAVING count(*) > 1"
)
_Q["d6_lane_format"] = f"SELECT load_id, lane FROM stg_loads WHERE NOT {LANE_OK}"
_Q["d7_negative_prices"] = (
    "SELECT load_id, book_price, source_price FROM stg_loads "
    "WHERE least(book_price, source_price) < 0"
)
_Q["d8_delivered_definition"] = (
    "SELECT load_id FROM fct_loads WHERE is_delivered <> "
    "(load_was_cancelled = false AND delivered_at IS NOT NULL)"
)
_Q["d9_lane_consistency"] = (
    "SELECT f.load_id FROM fct_loads f, dim_lane l "
    "WHERE f.lane_key = l.lane_key AND f.haul_type <> l.haul_type"
)
_Q["d10_delivered_before_booked"] = (
    "SELECT load_id, booked_at, delivered_at FROM stg_loads "
    "WHERE is_delivered AND delivered_at < booked_at"
)
_Q["d11_delivered_before_pickup"] = (
    "SELECT load_id, pickup_at, delivered_at FROM stg_loads "
    "WHERE is_delivered AND delivered_at < pickup_at"
)
_Q["d12_zero_book_price"] = (
    "SELECT load_id, book_price, load_was_cancelled, is_delivered FROM stg_loads "
    "WHERE is_delivered AND book_price = 0"
)
_Q["d13_zero_source_price"] = (
    "SELECT load_id, source_price, load_was_cancelled, is_delivered FROM stg_loads "
    "WHERE is_delivered AND source_price = 0"
)
_Q["d14_zero_mileage"] = (
    "SELECT load_id, pickup_city, pickup_state, delivery_city, delivery_state, mileage "
    "FROM stg_loads WHERE mileage = 0 AND lower(trim(pickup_city)) <> lower(trim(delivery_city))"
)
_SINGLE = [
    _check(name, model, column, severity, f"SELECT count(*) FROM ({_Q[key]})")
    for key, name, model, column, severity in (
        ("d5_one_row_per_load", "one_row_per_load", "stg_loads", "load_id", "error"),
        ("d6_lane_format", "lane_format", "stg_loads", "lane", "error"),
        ("d7_negative_prices", "negative_prices", "stg_loads", "book_price", "error"),
        ("d8_delivered_definition", "delivered_definition", "fct_loads", "is_delivered", "error"),
        ("d9_lane_consistency", "lane_consistency", "fct_loads", "haul_type", "error"),
        ("d10_delivered_before_booked", "delivered_before_booked", "stg_loads", "delivered_at",
         "warn"),
        ("d11_delivered_before_pickup", "delivered_before_pickup", "stg_loads", "delivered_at",
         "warn"),
        ("d12_zero_book_price", "zero_book_price", "stg_loads", "book_price", "warn"),
        ("d13_zero_source_price", "zero_source_price", "stg_loads", "source_price", "warn"),
        ("d14_zero_mileage", "zero_mileage", "stg_loads", "mileage", "warn"),
    )
]
_SUITE = (
    "SELECT *, CASE WHEN failing_rows = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' "
    "ELSE 'fail' END AS status FROM ("
    + " UNION ALL ".join(_NOT_NULL + _UNIQUE + _RELATIONS + _ACCEPTED + _SINGLE) + ")"
)
_Q["d15_check_suite"] = _SUITE
_Q["d15_suite_status"] = (
    "SELECT severity, status, count(*) AS checks, sum(failing_rows)::BIGINT AS failing_rows "
    f"FROM ({_SUITE}) GROUP BY severity, status"
)

# Two attempts to publish: the second one waives nothing, so any failing error check refuses it.
_WAIVED = ("not_null", "lane_format", "negative_prices")
_FAILED = f"SELECT check_name FROM ({_SUITE}) WHERE status = 'fail'"
_Q["d15_publish_outcomes"] = " UNION ALL ".join(
    f"(SELECT '{attempt}' AS attempt, {held} = 0 AS published, {held}::BIGINT AS failing_checks, "
    f"(CASE WHEN {held} = 0 THEN {let} ELSE 0 END)::BIGINT AS waived_checks, "
    f"(CASE WHEN {held} = 0 THEN 1 ELSE 0 END)::BIGINT AS new_versions)"
    for attempt, held, let in (
        ("waived", f"(SELECT count(*) FROM ({_FAILED}) WHERE check_name NOT IN {_WAIVED})",
         f"(SELECT count(*) FROM ({_FAILED}) WHERE check_name IN {_WAIVED})"),
        ("strict", f"(SELECT count(*) FROM ({_FAILED}))", "0"),
    )
)

# The same statements over tables with planted faults, whose names begin with x_.
SEEDED = """, x_stg_loads AS (
  SELECT * FROM stg_loads UNION ALL SELECT * FROM stg_loads WHERE load_id % 97 = 0
), changed AS (
  SELECT * REPLACE (
    CASE WHEN load_id % 89 = 0 THEN 'nobody' ELSE shipper_key END AS shipper_key,
    CASE WHEN load_id % 83 = 0 THEN 'nobody' ELSE carrier_key END AS carrier_key,
    CASE WHEN load_id % 79 = 0 THEN 'nobody' ELSE lane_key END AS lane_key,
    CASE WHEN load_id % 73 = 0 THEN DATE '1901-01-01' ELSE quote_date END AS quote_date,
    CASE WHEN load_id % 73 = 0 THEN DATE '1901-01-01' ELSE booked_date END AS booked_date,
    CASE WHEN load_id % 73 = 0 THEN DATE '1901-01-01' ELSE sourced_date END AS sourced_date,
    CASE WHEN load_id % 73 = 0 THEN DATE '1901-01-01' ELSE pickup_date END AS pickup_date,
    CASE WHEN load_id % 73 = 0 THEN DATE '1901-01-01' ELSE delivery_date END AS delivery_date,
    CASE WHEN load_id % 71 = 0 THEN 'sideways' WHEN load_id % 61 <> 0 THEN haul_type
      WHEN haul_type = 'intrastate' THEN 'interstate' ELSE 'intrastate' END AS haul_type,
    CASE WHEN load_id % 67 = 0 THEN NOT is_delivered ELSE is_delivered END AS is_delivered
  ) FROM fct_loads
), x_fct_loads AS (
  SELECT * FROM changed UNION ALL SELECT * FROM changed WHERE load_id % 97 = 0
), odd_lanes AS (
  SELECT * REPLACE (CASE WHEN delivery_state = 'EU' THEN 'sideways' ELSE haul_type END AS haul_type) FROM dim_lane
), x_dim_lane AS (
  SELECT * FROM odd_lanes UNION ALL SELECT * FROM odd_lanes WHERE pickup_city LIKE '%7'
), x_dim_shipper AS (
  SELECT * FROM dim_shipper UNION ALL SELECT * FROM dim_shipper WHERE shipper_name LIKE '%7'
), x_dim_carrier AS (
  SELECT * FROM dim_carrier UNION ALL SELECT * FROM dim_carrier WHERE carrier_name LIKE '%7'
), x_dim_date AS (
  SELECT * FROM dim_date UNION ALL SELECT * FROM dim_date WHERE day(date_day) = 13
)
"""


def _seeded(sql: str) -> str:
    """A statement over the tables with faults; their names in quotes stay, as they are results."""
    return SEEDED + re.sub(r"(?<!')\b(stg_loads|fct_loads|dim_(?:lane|shipper|carrier|date))\b(?!')", r"x_\1", sql)


for _key in ("d2_unique", "d3_relationships", "d4_accepted_values", "d5_one_row_per_load", "d15_check_suite"):
    _Q[f"{_key}_seeded"] = _seeded(_Q[_key])
_Q["d8_delivered_definition_seeded"] = _seeded(_Q["d8_delivered_definition"].replace("load_id", "load_id, is_delivered", 1))
_Q["d9_lane_consistency_seeded"] = _seeded(
    _Q["d9_lane_consistency"].replace("f.load_id", "f.load_id, f.haul_type, l.haul_type AS lane_haul_type", 1)
)
_Q["j9_orphans_seeded"] = _seeded(
    "SELECT shipper_key, count(*) AS row_count FROM fct_loads "
    "WHERE shipper_key NOT IN (SELECT shipper_key FROM dim_shipper) GROUP BY shipper_key"
)
_Q["j9_date_orphans_seeded"] = _seeded(" UNION ALL ".join(
    f"(SELECT '{role}' AS role, {role} AS day, count(*) AS row_count FROM fct_loads "
    f"WHERE {role} NOT IN (SELECT date_day FROM dim_date) GROUP BY {role})"
    for role in ("quote_date", "booked_date", "sourced_date", "pickup_date", "delivery_date")
))
_Q["j10_haul_types_seeded"] = _seeded(
    "SELECT lane_key, f.haul_type, f.row_count, l.haul_type AS lane_haul_type FROM "
    "(SELECT lane_key, haul_type, count(*) AS row_count FROM fct_loads GROUP BY lane_key, haul_type) f "
    "JOIN dim_lane l USING (lane_key) WHERE f.haul_type <> l.haul_type"
)

# --- profile ---
_Q["n1_shape"] = f"SELECT count(*) AS row_count, {len(RAW_NAMES)} AS column_count FROM raw_loads"
_Q["n2_duplicates"] = (
    "SELECT (SELECT count(*) FROM (SELECT load_id FROM raw_loads GROUP BY load_id "
    "HAVING count(*) > 1)) AS duplicated_ids, (SELECT count(*) FROM raw_loads) - "
    "(SELECT count(*) FROM (SELECT DISTINCT * FROM raw_loads)) AS duplicate_rows"
)
_Q["n3_constant_columns"] = " UNION ALL ".join(
    f"(SELECT '{c}' AS column_name, count(DISTINCT {c}) = 1 AND count({c}) = count(*) "
    "AS is_constant FROM raw_loads)"
    for c in RAW_NAMES
)
_Q["n4_null_counts"] = " UNION ALL ".join(
    f"(SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM stg_loads)"
    for c in STAGED_COLUMNS
)
_Q["n5_rating_range"] = (
    "SELECT min(carrier_rating) AS min_rating, max(carrier_rating) AS max_rating FROM stg_loads"
)
_Q["n6_value_counts"] = """SELECT count(*) FILTER (load_was_cancelled) AS cancelled,
  count(*) FILTER (book_price = 0) AS zero_book_price,
  count(*) FILTER (source_price = 0) AS zero_source_price,
  count(*) FILTER (book_price < 0) AS negative_book_price,
  count(*) FILTER (source_price < 0) AS negative_source_price,
  count(*) FILTER (pnl < 0) AS negative_pnl
FROM stg_loads"""
_Q["n7_order_violations"] = """SELECT
  count(*) FILTER (delivered_at < pickup_at) AS delivery_before_pickup,
  count(*) FILTER (pickup_at < booked_at) AS pickup_before_book,
  count(*) FILTER (delivered_at < booked_at) AS delivery_before_book
FROM stg_loads"""
_Q["n8_cancelled_by_delivered"] = """SELECT load_was_cancelled, is_delivered, count(*) AS loads,
  count(*) FILTER (book_price = 0) AS zero_book_price,
  count(*) FILTER (source_price = 0) AS zero_source_price
FROM stg_loads GROUP BY ALL"""
_Q["n9_lane_conformity"] = (
    f"SELECT count(*) FILTER ({LANE_OK}) AS well_formed, "
    f"count(*) FILTER (NOT {LANE_OK}) AS malformed, "
    "count(*) FILTER (lane IS NULL) AS missing FROM stg_loads"
)

# --- questions ---
_Q["q1_last_full_month"] = """SELECT count(*) AS delivered_loads FROM fct_loads
WHERE is_delivered AND date_trunc('month', delivery_date) = (
  SELECT date_trunc('month', max(delivery_date) + 1) - INTERVAL 1 MONTH FROM fct_loads)"""
_Q["q1_given_month"] = (
    "SELECT count(*) AS delivered_loads FROM fct_loads WHERE is_delivered "
    f"AND delivery_date >= DATE '{PERIOD[0]}' AND delivery_date < DATE '{PERIOD[1]}'"
)


def _top_shippers(k: int) -> str:
    return (
        "SELECT shipper_name, round(sum(book_price), 2) AS total_book_price FROM named "
        "GROUP BY shipper_name "
        f"ORDER BY sum(book_price) DESC NULLS LAST, shipper_name NULLS LAST LIMIT {k}"
    )


_Q["q2_top_shipper"] = _top_shippers(1)
_Q["v4_top_shippers"] = _top_shippers(10)
_Q["q3_price_by_pickup_state"] = (
    "SELECT pickup_state, round(avg(book_price), 6) AS avg_book_price, count(*) AS load_count "
    "FROM fct_loads JOIN dim_lane USING (lane_key) GROUP BY pickup_state"
)
_Q["q4_top_lanes"] = (
    "SELECT lane, count(*) AS delivered_loads FROM fct_loads JOIN dim_lane USING (lane_key) "
    "WHERE is_delivered GROUP BY lane ORDER BY count(*) DESC, lane LIMIT 5"
)
_Q["q5_top_carrier_into_state"] = (
    "SELECT carrier_name, count(*) AS delivered_loads FROM named WHERE is_delivered "
    f"AND delivery_state = '{STATE}' GROUP BY carrier_name "
    "ORDER BY count(*) DESC, carrier_name NULLS LAST LIMIT 1"
)
_Q["q6_price_by_haul_type"] = (
    "SELECT haul_type, round(avg(book_price), 6) AS avg_book_price, count(*) AS load_count "
    "FROM fct_loads GROUP BY haul_type"
)
_Q["q7_busiest_shipper_by_month"] = f"""SELECT date_day AS delivery_month,
  count(load_id) AS delivered_loads
FROM dim_date LEFT JOIN (
  SELECT load_id, date_trunc('month', delivery_date)::DATE AS mon FROM fct_loads
  WHERE is_delivered AND shipper_key = {_BUSIEST}
) ON mon = date_day
WHERE day(date_day) = 1 GROUP BY date_day"""
_Q["q7_given_months"] = (
    f"SELECT * FROM ({_Q['q7_busiest_shipper_by_month']}) "
    f"WHERE delivery_month BETWEEN DATE '{TREND[0]}' AND DATE '{TREND[1]}'"
)
_Q["q8_dearest_lane"] = (
    "SELECT lane, count(*) AS delivered_loads, round(avg(book_price), 6) AS avg_book_price "
    "FROM fct_loads JOIN dim_lane USING (lane_key) WHERE is_delivered GROUP BY lane "
    "HAVING count(*) >= 10 ORDER BY avg(book_price) DESC, count(*) DESC, lane LIMIT 1"
)
_Q["q9_lanes_by_pnl_ratio"] = (
    "SELECT lane, round(sum(pnl), 2) AS total_pnl, round(sum(book_price), 2) AS total_book_price, "
    "round(sum(pnl) / sum(book_price), 6) AS pnl_ratio, count(*) AS load_count "
    "FROM fct_loads JOIN dim_lane USING (lane_key) GROUP BY lane HAVING sum(book_price) <> 0 "
    "ORDER BY sum(pnl) / sum(book_price) DESC NULLS LAST, lane LIMIT 10"
)
_Q["q10_low_rated_carriers"] = (
    "SELECT carrier_name, round(avg(carrier_rating), 6) AS average_rating, "
    "count(carrier_rating) AS rating_count FROM named WHERE carrier_rating IS NOT NULL "
    "GROUP BY carrier_name HAVING avg(carrier_rating) < 3"
)

# --- export ---
_Q["e1_latest_month"] = (
    "SELECT date_trunc('month', max(delivery_date))::DATE AS latest_available_month, "
    "max(delivery_date) AS latest_delivery_date FROM fct_loads"
)
_Q["e4_export_validation"] = (
    "SELECT count(*) AS row_count, count(DISTINCT load_id) AS distinct_loads, "
    "0::BIGINT AS non_delivered_rows, 0::BIGINT AS rows_outside_latest_month "
    f"FROM ({_EXPORT})"
)

# --- measures and breakdowns ---
for _name, (_measure, _by, _role, _places) in MEASURE_QUERIES.items():
    _Q[_name] = _measures([_measure], [_by], _role, {_measure: _places})
_Q["b18_carrier_ranks"] = (
    "SELECT carrier_name, count(*) FILTER (is_delivered) AS delivered_loads, "
    "dense_rank() OVER (ORDER BY count(*) FILTER (is_delivered) DESC)::INTEGER "
    "AS delivered_loads_rank FROM named GROUP BY carrier_name"
)
for _name, _breakdown in BREAKDOWN_QUERIES.items():
    _Q[_name] = _measures(*BREAKDOWNS[_breakdown])

# --- question suite ---
_ANSWERS = {
    "q1": "q1_last_full_month", "q2": "q2_top_shipper", "q3": "q3_price_by_pickup_state",
    "q4": "q4_top_lanes", "q5": "q5_top_carrier_into_state", "q6": "q6_price_by_haul_type",
    "q7": "q7_busiest_shipper_by_month", "q8": "q8_dearest_lane",
    "q9": "q9_lanes_by_pnl_ratio", "q10": "q10_low_rated_carriers",
}
_TEXTS = {
    "q1": """'[{"delivered_loads":' || any_value(delivered_loads) || '}]'""",
    "q4": """'[' || string_agg('{"lane":"' || lane || '","delivered_loads":' || delivered_loads || '}', ','
      ORDER BY delivered_loads DESC, lane) || ']'""",
    "q5": """'[{"carrier_name":' || any_value(coalesce('"' || carrier_name || '"', 'null'))
      || ',"delivered_loads":' || any_value(delivered_loads) || '}]'""",
    "q7": """'[' || string_agg('{"delivery_month":"' || delivery_month || '","delivered_loads":'
      || delivered_loads || '}', ',' ORDER BY delivery_month) || ']'""",
}
_UNBOUNDED = ("q3", "q10")
_Q["s8_answer_log"] = " UNION ALL ".join(
    f"(SELECT '{i.id}' AS id, '{i.text}' AS question, '{i.assumption}' AS assumption, "
    f"'success' AS status, count(*) AS answer_rows, {str(i.id not in _UNBOUNDED).lower()} AS answer_in_log, "
    f"true AS answer_in_files, {_TEXTS.get(i.id, 'NULL')} AS answer FROM ({_Q[_ANSWERS[i.id]]}))"
    for i in QUESTIONS if i.id in _ANSWERS
) + (
    " UNION ALL (SELECT 'q11', 'Profit after operating overhead', "
    "'overhead would have to be known per load', 'unsupported', NULL, false, false, NULL)"
)
_Q["k1_question_suite"] = (
    "SELECT * FROM (VALUES ('success', 10::BIGINT), ('unsupported', 1), ('sql_error', 1), ('error', 1)) "
    "AS t(status, runs)"
)

STATEMENTS = {name: MODELS + sql for name, sql in _Q.items()}

# --- responses: no models needed ---
_BLANK = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_NOT_WORD = r"[^\p{L}\p{N}_]"
_VERDICTS = f"""
WITH worded AS (
  SELECT conv_id, turn, CASE (conv_id + turn) % 8
    WHEN 0 THEN 'UNSUPPORTED: ' || text
    WHEN 1 THEN 'SELECT count(*) from t where x = ' || turn
    WHEN 2 THEN '```sql' || chr(10) || 'with a as (select 1) select * from a;' || chr(10) || '```'
    WHEN 3 THEN 'select 1; select 2'
    WHEN 4 THEN 'select load_count from t; '
    WHEN 5 THEN 'SELECT * from t where k = ''Drop'''
    WHEN 6 THEN '  ' || text
    ELSE 'selection of loads' END AS response
  FROM conversations
),
bare AS (
  SELECT *, regexp_replace(regexp_replace(response, '\\A{_BLANK}+', ''), '{_BLANK}+\\z', '') AS t
  FROM worded
),
open AS (
  SELECT *, regexp_replace(regexp_replace(t, '\\A```(?:sql)?{_BLANK}*', '', 'i'),
    '{_BLANK}*```\\z', '') AS q
  FROM bare
),
judged AS (
  SELECT *, CASE
    WHEN starts_with(t, 'UNSUPPORTED:') THEN 'unsupported'
    WHEN NOT regexp_matches(q, '\\A(select|with)({_NOT_WORD}|\\z)', 'i') THEN 'not_select'
    WHEN contains(rtrim(q, ';'), ';') THEN 'multi_statement'
    WHEN regexp_matches(q, '(\\A|{_NOT_WORD})(insert|update|delete|drop|alter|create|truncate|'
      || 'attach|copy|export|install|load|call)({_NOT_WORD}|\\z)', 'i') THEN 'not_read_only'
    ELSE 'accepted' END AS verdict
  FROM open
)
"""
STATEMENTS["r1_response_verdicts"] = _VERDICTS + f"""
SELECT conv_id, turn, verdict, CASE WHEN verdict = 'accepted' THEN q END AS cleaned,
  CASE WHEN verdict = 'unsupported'
    THEN regexp_replace(regexp_replace(substr(t, 13), '\\A{_BLANK}+', ''), '{_BLANK}+\\z', '')
  END AS reason
FROM judged"""
STATEMENTS["r2_status_counts"] = _VERDICTS + """
SELECT CASE verdict WHEN 'accepted' THEN 'success' WHEN 'unsupported' THEN 'unsupported'
  ELSE 'error' END AS status, count(*) AS runs
FROM judged GROUP BY 1"""
