"""Equivalent ANSI SQL (DuckDB dialect) for the registered queries.

These are written independently of the Spark plans: the grid fill is an
``ASOF JOIN`` over a generated grid, keep-first is ``arg_min_null`` and the
pivot is a filtered aggregate. Only the fixed lookup values are shared.
Every text is a full query over the pre-registered driver views.
"""

from __future__ import annotations

from voltlake.constants import (BZN_TO_COUNTRY, CONDITIONS, ENERGY_CLASSES, ENERGY_TYPES,
                                GREEN_SOURCES, POLAND_EIC, PSR_TYPES, UNITS,
                                WEATHER_OPTIONS, WEATHER_UNIT_LITERALS, ZONES,
                                production_column)
from voltlake.sources.fixtures import ADAPTER_CONDITIONS, EVENT_PSR, QUARTER_HOUR_ZONE_IX


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def sql_case(expr: str, pairs, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v) if isinstance(v, str) else v}" for k, v in pairs)
    return f"CASE {expr} {whens} ELSE {default} END"


EICS = sql_list([z[1] for z in ZONES])
BZNS = sql_list([z[2] for z in ZONES])
COUNTRIES = sql_list([z[0] for z in ZONES])
QH = ", ".join(str(i) for i in QUARTER_HOUR_ZONE_IX)

# --- landed feeds over events ----------------------------------------------
FEEDS = f"""
pts0 AS (
  SELECT event_id AS ingest_order, CAST(user_id % 17 AS INTEGER) AS zix, ts, event_type, value
  FROM events),
pts1 AS (
  SELECT ingest_order, zix, {EICS}[zix + 1] AS eic_code,
         CASE WHEN zix IN ({QH}) THEN 15 ELSE 60 END AS res,
         CASE WHEN zix IN ({QH}) THEN 'PT15M' ELSE 'PT60M' END AS resolution,
         CAST(CAST(ts AS DATE) AS TIMESTAMP) AS period_start,
         event_type, value, ts
  FROM pts0),
pts AS (
  SELECT *, CAST(floor((hour(ts) * 60 + minute(ts)) / res) AS INTEGER) + 1 AS position
  FROM pts1),
production_data AS (
  SELECT eic_code, value AS quantity, 'MAW' AS unit,
         {sql_case(sql_case('event_type', EVENT_PSR), PSR_TYPES)} AS produced_energy_type,
         period_start + to_minutes(position * res) AS datetime, ingest_order
  FROM pts),
consumption_data AS (
  SELECT eic_code, value AS quantity, 'MAW' AS unit,
         period_start + to_minutes(position * res) AS datetime, ingest_order
  FROM pts),
price_data AS (
  SELECT eic_code, value AS price, 'EUR' AS currency_unit, 'MWH' AS price_measure_unit,
         period_start + to_minutes(position * res) AS datetime, ingest_order
  FROM pts WHERE event_type = 'purchase'),
weather_cleaned AS (
  SELECT {COUNTRIES}[zix + 1] AS country, {EICS}[zix + 1] AS eic_code, {BZNS}[zix + 1] AS bzn,
         CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_hours(hour(ts)) AS date_time,
         value - 2 AS minimum_temperature, value + 2 AS maximum_temperature,
         value AS temperature, value - 5 AS dew_point, value * 3 AS relative_humidity,
         value / 4 AS wind_speed, value * 10 AS wind_direction, value / 10 AS precipitation,
         value + 10 AS visibility, value / 100 AS solar_energy, value * 5 AS solar_radiation,
         value + 1000 AS sea_level_pressure,
         'st_' || {BZNS}[zix + 1] AS station_info,
         '{{"' || {BZNS}[zix + 1] || '":1}}' AS contributing_stations,
         {sql_list(ADAPTER_CONDITIONS)}[CAST(ingest_order % 5 AS INTEGER) + 1] AS conditions,
         ingest_order
  FROM pts0 WHERE event_type = 'view')"""

PROD_COLS = [production_column(t) for t in ENERGY_TYPES]
WEATHER_COLS = [
    "country", "bzn", "minimum_temperature", "maximum_temperature", "temperature",
    "dew_point", "relative_humidity", "wind_speed", "wind_direction", "precipitation",
    "visibility", "solar_energy", "solar_radiation", "sea_level_pressure",
    "station_info", "contributing_stations", "conditions",
]

PIVOT = ",\n    ".join(
    f"arg_min_null(quantity, ingest_order) FILTER (WHERE produced_energy_type = {q(t)}) AS {c}"
    for t, c in zip(ENERGY_TYPES, PROD_COLS))

FACT_PARTS = f"""
cons AS (
  SELECT eic_code, datetime,
         arg_min_null(quantity, ingest_order) AS consumption_quantity,
         arg_min_null(unit, ingest_order) AS electricity_unit
  FROM consumption_data GROUP BY eic_code, datetime),
prod AS (
  SELECT eic_code, datetime,
    {PIVOT}
  FROM production_data GROUP BY eic_code, datetime),
price_obs AS (
  SELECT eic_code, datetime,
         arg_min_null(price, ingest_order) AS price,
         arg_min_null(currency_unit, ingest_order) AS currency_unit,
         arg_min_null(price_measure_unit, ingest_order) AS price_measure_unit
  FROM price_data GROUP BY eic_code, datetime),
price_slots AS (
  SELECT eic_code, unnest(generate_series(time_bucket(INTERVAL 15 MINUTE, min(datetime)),
                                          time_bucket(INTERVAL 15 MINUTE, max(datetime)),
                                          INTERVAL 15 MINUTE)) AS slot
  FROM price_obs GROUP BY eic_code),
price_grid AS (
  SELECT s.eic_code, s.slot AS datetime, o.price, o.currency_unit, o.price_measure_unit
  FROM price_slots s ASOF JOIN price_obs o ON s.eic_code = o.eic_code AND s.slot >= o.datetime),
weather_obs AS (
  SELECT eic_code, date_time AS datetime,
         {", ".join(f"arg_min_null({c}, ingest_order) AS {c}" for c in WEATHER_COLS)}
  FROM weather_cleaned GROUP BY eic_code, date_time),
weather_slots AS (
  SELECT eic_code, unnest(generate_series(time_bucket(INTERVAL 15 MINUTE, min(datetime)),
                                          time_bucket(INTERVAL 15 MINUTE, max(datetime)),
                                          INTERVAL 15 MINUTE)) AS slot
  FROM weather_obs GROUP BY eic_code),
weather_grid AS (
  SELECT s.eic_code, s.slot AS datetime, {", ".join("o." + c for c in WEATHER_COLS)}
  FROM weather_slots s ASOF JOIN weather_obs o ON s.eic_code = o.eic_code AND s.slot >= o.datetime),
fact AS (
  SELECT w.eic_code, w.datetime,
         coalesce(c.consumption_quantity, 0) AS consumption_quantity, c.electricity_unit,
         {", ".join(f"coalesce(p.{c}, 0) AS {c}" for c in PROD_COLS)},
         coalesce(g.price, 0) AS price, g.currency_unit, g.price_measure_unit,
         {", ".join("w." + c for c in WEATHER_COLS)}
  FROM weather_grid w
  LEFT JOIN cons c ON w.eic_code = c.eic_code AND w.datetime = c.datetime
  LEFT JOIN prod p ON w.eic_code = p.eic_code AND w.datetime = p.datetime
  LEFT JOIN price_grid g ON w.eic_code = g.eic_code AND w.datetime = g.datetime
  WHERE w.bzn IS NOT NULL AND w.bzn <> '')"""


def with_feeds(*blocks: str) -> str:
    return "WITH " + ",".join([FEEDS, *blocks])


def with_fact(*blocks: str) -> str:
    return "WITH " + ",".join([FEEDS, FACT_PARTS, *blocks])


GREEN_COLS = [c for c in PROD_COLS if c in {production_column(s) for s in GREEN_SOURCES}]
OTHER_COLS = [c for c in PROD_COLS if c not in GREEN_COLS]


def _plus(cols) -> str:
    return " + ".join(cols) if cols else "0.0"


def green_share_sql(decimals: int = 4) -> str:
    return f"""
green_share AS (
  SELECT bzn, date_trunc('hour', datetime) AS hourly_datetime,
         sum({_plus(GREEN_COLS)}) AS g, sum({_plus(OTHER_COLS)}) AS o, sum({_plus(PROD_COLS)}) AS t
  FROM fact GROUP BY bzn, date_trunc('hour', datetime)),
green_share_out AS (
  SELECT bzn, hourly_datetime, round(g, {decimals}) AS green_energy,
         round(o, {decimals}) AS non_green_energy, round(t, {decimals}) AS total_energy,
         round(g / nullif(t, 0), {decimals + 2}) AS green_proportion
  FROM green_share)"""


def row_sum(cols) -> str:
    return " + ".join(f"coalesce({c}, 0)" for c in cols) if cols else "0.0"


ORACLE: dict[str, str] = {}

ORACLE["production_data"] = with_feeds() + "\nSELECT eic_code, quantity, unit, produced_energy_type, datetime FROM production_data"
ORACLE["consumption_data"] = with_feeds() + "\nSELECT eic_code, quantity, unit, datetime FROM consumption_data"
ORACLE["price_data"] = with_feeds() + "\nSELECT eic_code, price, currency_unit, price_measure_unit, datetime FROM price_data"
ORACLE["weather_cleaned"] = with_feeds() + "\nSELECT * EXCLUDE (ingest_order) FROM weather_cleaned"

ORACLE["consumption_keep_first"] = with_fact() + "\nSELECT eic_code, consumption_quantity, electricity_unit, datetime FROM cons"
ORACLE["production_wide"] = with_fact() + "\nSELECT * FROM prod"
ORACLE["price_grid_15min"] = with_fact() + "\nSELECT eic_code, price, currency_unit, price_measure_unit, datetime FROM price_grid"
ORACLE["weather_grid_15min"] = with_fact() + f"\nSELECT eic_code, datetime, {', '.join(WEATHER_COLS)} FROM weather_grid"
ORACLE["measurements_fact"] = with_fact() + "\nSELECT * FROM fact"
ORACLE["measurements_fact_full_outer"] = ORACLE["measurements_fact"]
ORACLE["green_share_zone_hour"] = with_fact(green_share_sql()) + "\nSELECT * FROM green_share_out"

# --- dashboard ---------------------------------------------------------------
WEATHER_MEASURES = [c for _, c, _ in WEATHER_OPTIONS]
SERIES_COLS = ["bzn", "datetime", "consumption_quantity", *PROD_COLS, "price", *WEATHER_MEASURES]

ORACLE["zone_list"] = with_fact() + "\nSELECT DISTINCT bzn FROM fact"
ORACLE["available_hours"] = with_fact() + """
SELECT DISTINCT date_trunc('hour', datetime) AS hourly_datetime FROM fact
WHERE date_trunc('hour', datetime) IS NOT NULL"""
ORACLE["zone_series"] = with_fact() + f"""
SELECT {', '.join(SERIES_COLS)} FROM fact WHERE consumption_quantity > 0"""
ORACLE["green_series"] = with_fact() + f"""
SELECT {', '.join(SERIES_COLS)},
       round({row_sum(GREEN_COLS)}, 4) AS green_energy,
       round({row_sum(OTHER_COLS)}, 4) AS non_green_energy
FROM fact WHERE consumption_quantity > 0"""

_OVERLAY = [("Price", "price", "EUR/MWH")] + list(WEATHER_OPTIONS)
ORACLE["overlay_measures"] = with_fact() + f"""
SELECT bzn, datetime, measure, value,
       {sql_case('measure', [(lbl, u) for lbl, _, u in _OVERLAY])} AS unit
FROM (
  UNPIVOT (SELECT bzn, datetime, {', '.join(f'CAST({c} AS DOUBLE) AS "{lbl}"' for lbl, c, _ in _OVERLAY)} FROM fact)
  ON {', '.join(f'"{lbl}"' for lbl, _, _ in _OVERLAY)}
  INTO NAME measure VALUE value)"""

ORACLE["green_share_zone_hour_parity"] = None  # filled below

_COUNTRY_OF = sql_case("bzn", BZN_TO_COUNTRY)
_COUNTRY_NAMES = list(dict.fromkeys(c for _, c in BZN_TO_COUNTRY))
_SHARE = f"""
share AS (
  SELECT hourly_datetime, {_COUNTRY_OF} AS country, g / nullif(t, 0) AS p FROM green_share),
hours AS (SELECT DISTINCT hourly_datetime FROM share)"""

ORACLE["green_share_country_hour"] = with_fact(green_share_sql(), _SHARE) + f"""
, avgs AS (SELECT hourly_datetime, country, avg(p) AS p FROM share GROUP BY hourly_datetime, country),
grid AS (SELECT hourly_datetime, unnest({sql_list(_COUNTRY_NAMES)}) AS country FROM hours)
SELECT grid.hourly_datetime, grid.country, round(coalesce(avgs.p, 0), 6) AS green_proportion
FROM grid LEFT JOIN avgs ON grid.hourly_datetime = avgs.hourly_datetime AND grid.country = avgs.country"""

ORACLE["green_share_country_fanout"] = with_fact(green_share_sql(), _SHARE) + f"""
, grid AS (SELECT hourly_datetime, unnest({sql_list([c for _, c in BZN_TO_COUNTRY])}) AS country FROM hours)
SELECT grid.hourly_datetime, grid.country, round(coalesce(share.p, 0), 6) AS green_proportion
FROM grid LEFT JOIN share ON grid.hourly_datetime = share.hourly_datetime AND grid.country = share.country"""


def _green_share_parity() -> str:
    from voltlake.constants import dashboard_column
    green = [c for c in PROD_COLS if c in {dashboard_column(s) for s in GREEN_SOURCES}]
    other = [c for c in PROD_COLS if c not in green]
    return f"""
gs AS (
  SELECT bzn, date_trunc('hour', datetime) AS hourly_datetime,
         sum({_plus(green)}) AS g, sum({_plus(other)}) AS o, sum({_plus(PROD_COLS)}) AS t
  FROM fact GROUP BY bzn, date_trunc('hour', datetime))
SELECT bzn, hourly_datetime, round(g, 4) AS green_energy, round(o, 4) AS non_green_energy,
       round(t, 4) AS total_energy, round(g / nullif(t, 0), 6) AS green_proportion FROM gs"""


ORACLE["green_share_zone_hour_parity"] = with_fact(_green_share_parity())

ORACLE["sampling_interval"] = with_fact() + """,
s AS (SELECT bzn, datetime FROM fact WHERE consumption_quantity > 0),
f AS (SELECT bzn, min(datetime) AS first_datetime FROM s GROUP BY bzn),
sec AS (SELECT s.bzn, min(s.datetime) AS second_datetime FROM s JOIN f ON s.bzn = f.bzn
        WHERE s.datetime > f.first_datetime GROUP BY s.bzn)
SELECT f.bzn, f.first_datetime, sec.second_datetime,
       date_diff('second', f.first_datetime, sec.second_datetime) / 3600.0 AS interval_hours,
       CAST(date_diff('second', f.first_datetime, sec.second_datetime) / 3600.0 <= 0.25 AS INTEGER)
         AS quarter_hourly
FROM f LEFT JOIN sec ON f.bzn = sec.bzn"""

# --- dimensions --------------------------------------------------------------

_UNIT_LITS = ", ".join(f"({q(u)}, 4, {i}, 0)" for i, u in enumerate(WEATHER_UNIT_LITERALS))
ORACLE["unit_dim"] = with_feeds() + f""",
cand AS (
  SELECT unit AS u, 1 AS src, ingest_order AS o, 0 AS col FROM consumption_data
  UNION ALL SELECT currency_unit, 2, ingest_order, 0 FROM price_data
  UNION ALL SELECT price_measure_unit, 2, ingest_order, 1 FROM price_data
  UNION ALL SELECT unit, 3, ingest_order, 0 FROM production_data
  UNION ALL SELECT * FROM (VALUES {_UNIT_LITS}) v(u, src, o, col)),
firsts AS (
  SELECT u, src, o, col FROM cand WHERE u IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY u ORDER BY src, o, col) = 1)
SELECT row_number() OVER (ORDER BY src, o, col) AS _id, u AS unit_short,
       {sql_case('u', [(u, lg) for u, _, lg in UNITS], "''")} AS unit_long,
       {sql_case('u', [(u, c) for u, c, _ in UNITS], "''")} AS unit_class
FROM firsts"""

_HEADERS = ["minimum_temperature", "maximum_temperature", "temperature", "dew_point",
            "relative_humidity", "wind_speed", "wind_direction", "precipitation", "visibility",
            "solar_energy", "solar_radiation", "sea_level_pressure"]
_HDR_ROWS = ", ".join(f"({q(h)}, 1, {i}, 0)" for i, h in enumerate(_HEADERS))
ORACLE["condition_dim"] = with_feeds() + f""",
split AS (SELECT string_split(conditions, ',') AS l, ingest_order FROM weather_cleaned),
terms AS (
  SELECT trim(unnest(l)) AS term, 0 AS src, ingest_order AS o, generate_subscripts(l, 1) AS pos FROM split
  UNION ALL SELECT * FROM (VALUES {_HDR_ROWS}) v(term, src, o, pos)),
firsts AS (
  SELECT term, src, o, pos FROM terms WHERE term IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY term ORDER BY src, o, pos) = 1),
mapped AS (
  SELECT src, o, pos,
         {sql_case('term', [(t, s) for t, s, _, _, _ in CONDITIONS], "''")} AS condition_short,
         {sql_case('term', [(t, lg) for t, _, lg, _, _ in CONDITIONS], "''")} AS condition_long,
         {sql_case('term', [(t, ty) for t, _, _, ty, _ in CONDITIONS], "''")} AS condition_type,
         CAST({sql_case('term', [(t, n) for t, _, _, _, n in CONDITIONS], "0")} AS INTEGER) AS numerical
  FROM firsts),
per_short AS (
  SELECT * FROM mapped QUALIFY row_number() OVER (PARTITION BY condition_short ORDER BY src, o, pos) = 1)
SELECT row_number() OVER (ORDER BY src, o, pos) AS _id, condition_short, condition_long,
       condition_type, numerical
FROM per_short"""

ORACLE["energy_type_dim"] = with_feeds() + f""",
firsts AS (
  SELECT produced_energy_type AS t, min(ingest_order) AS o FROM production_data
  WHERE produced_energy_type IS NOT NULL GROUP BY produced_energy_type)
SELECT row_number() OVER (ORDER BY o) AS _id, t AS energy_type_x,
       {sql_case('t', [(t, c) for t, c, _, _ in ENERGY_CLASSES], "''")} AS energy_type_class,
       CAST({sql_case('t', [(t, r) for t, _, r, _ in ENERGY_CLASSES], "0")} AS INTEGER) AS renewable,
       CAST({sql_case('t', [(t, k) for t, _, _, k in ENERGY_CLASSES], "0")} AS INTEGER) AS carbon
FROM firsts"""

_HOLS = ", ".join(f"DATE {q(h)}" for h in ["2024-12-24", "2024-12-25", "2024-12-26"])
ORACLE["timestamp_dim"] = f"""
WITH bounds AS (
  SELECT CAST(CAST(min(ts) AS DATE) AS TIMESTAMP) AS lo,
         CAST(CAST(max(ts) AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 15 MINUTE AS hi
  FROM events),
cal AS (SELECT unnest(generate_series(lo, hi, INTERVAL 15 MINUTE)) AS datetime FROM bounds),
typed AS (
  SELECT datetime, dayname(datetime) AS weekday,
         CASE WHEN CAST(datetime AS DATE) IN ({_HOLS}) THEN 'Holiday'
              WHEN isodow(datetime) >= 6 THEN 'Weekend' ELSE 'Working Day' END AS kind
  FROM cal)
SELECT row_number() OVER (ORDER BY datetime) AS _id, datetime, weekday,
       CAST(kind = 'Working Day' AS INTEGER) AS workingday,
       CAST(kind = 'Weekend' AS INTEGER) AS weekend,
       CAST(kind = 'Holiday' AS INTEGER) AS holiday
FROM typed"""

# --- checks ------------------------------------------------------------------

ORACLE["fact_duplicate_keys"] = with_fact() + """
SELECT eic_code, datetime, count(*) AS n_rows FROM fact GROUP BY eic_code, datetime HAVING count(*) > 1"""
ORACLE["production_duplicate_keys"] = with_feeds() + """
SELECT eic_code, datetime, produced_energy_type, count(*) AS n_rows FROM production_data
GROUP BY eic_code, datetime, produced_energy_type HAVING count(*) > 1"""
ORACLE["fact_null_counts"] = with_fact() + """
SELECT count(*) FILTER (WHERE eic_code IS NULL) AS eic_code_nulls,
       count(*) FILTER (WHERE datetime IS NULL) AS datetime_nulls,
       count(*) FILTER (WHERE bzn IS NULL) AS bzn_nulls,
       count(*) FILTER (WHERE consumption_quantity IS NULL) AS consumption_quantity_nulls,
       count(*) FILTER (WHERE price IS NULL) AS price_nulls,
       count(*) FILTER (WHERE temperature IS NULL) AS temperature_nulls
FROM fact"""

# --- documents ---------------------------------------------------------------

ORACLE["production_xml_roundtrip"] = ORACLE["production_data"]
ORACLE["price_xml_roundtrip"] = ORACLE["price_data"]
ORACLE["consumption_xml_roundtrip"] = ORACLE["consumption_data"]
ORACLE["weather_json_roundtrip"] = ORACLE["weather_cleaned"]
ORACLE["measurements_fact_from_documents"] = ORACLE["measurements_fact"]

_EIC_TO_BZN = sql_case("eic_code", [(z[1], z[2]) for z in ZONES])
_BREAKDOWN_COLS = ", ".join(f"{c} AS {c[len('production_quantity_'):]}" for c in PROD_COLS)
ORACLE["power_breakdown_production"] = with_fact() + f"""
SELECT {_EIC_TO_BZN} AS zone, datetime, {_BREAKDOWN_COLS} FROM prod"""
ORACLE["power_breakdown_range"] = with_fact() + f"""
SELECT {_EIC_TO_BZN} AS zone, min(datetime) AS start_datetime, max(datetime) AS end_datetime,
       count(*) AS n_entries
FROM prod GROUP BY {_EIC_TO_BZN}"""

ORACLE["price_day_report"] = with_feeds() + f""",
ppts AS (
  SELECT p.eic_code, p.period_start AS day, p.period_start + to_hours(p.position) AS datetime,
         p.value AS price, p.ingest_order
  FROM pts p WHERE p.event_type = 'purchase'),
firsts AS (
  SELECT eic_code, day, datetime, arg_min_null(price, ingest_order) AS price
  FROM ppts GROUP BY eic_code, day, datetime),
days AS (SELECT DISTINCT eic_code, day FROM ppts),
grid AS (
  SELECT eic_code, day, unnest(generate_series(day, day + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS datetime
  FROM days),
j AS (
  SELECT g.eic_code, g.day, g.datetime, f.price FROM grid g
  LEFT JOIN firsts f ON g.eic_code = f.eic_code AND g.day = f.day AND g.datetime = f.datetime)
SELECT {_EIC_TO_BZN} AS country, datetime,
       last_value(price IGNORE NULLS) OVER (PARTITION BY eic_code, day ORDER BY datetime
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price
FROM j"""

_ZONE_ROWS = ", ".join(f"({q(z[0])}, {q(z[2])})" for z in ZONES)
ORACLE["weather_missing_zones"] = with_feeds() + f""",
zones AS (SELECT * FROM (VALUES {_ZONE_ROWS}) v(country, bzn))
SELECT country, bzn FROM zones WHERE bzn NOT IN (SELECT DISTINCT bzn FROM weather_cleaned)"""

# --- clean layer and request planning ----------------------------------------


def _cleaned(table: str, cols: str) -> str:
    return with_feeds() + f"""
SELECT {cols},
       CASE WHEN t.eic_code = {q(POLAND_EIC)} THEN 'PL' ELSE w.bzn END AS bzn
FROM {table} t LEFT JOIN (SELECT DISTINCT eic_code, bzn FROM weather_cleaned) w ON t.eic_code = w.eic_code"""


ORACLE["price_cleaned"] = _cleaned(
    "price_data", "t.eic_code, t.price, t.currency_unit, t.price_measure_unit, t.datetime")
ORACLE["production_cleaned"] = _cleaned(
    "production_data", "t.eic_code, t.quantity, t.unit, t.produced_energy_type, t.datetime")
ORACLE["consumption_cleaned"] = _cleaned("consumption_data", "t.eic_code, t.quantity, t.unit, t.datetime")

_ZONE_REQ = ", ".join(f"({q(z[2])}, {q(z[1])}, {q(f'{z[3]},{z[4]}')})" for z in ZONES)
ORACLE["request_manifest"] = f"""
WITH run AS (SELECT min(CAST(ts AS DATE)) AS s, max(CAST(ts AS DATE)) AS e FROM events),
feeds AS (SELECT * FROM (VALUES
   ('production', 'A75', 'A16', NULL, 'in_Domain', 1),
   ('price', 'A44', NULL, 'A01', 'in_Domain', 0),
   ('consumption', 'A65', 'A16', NULL, 'outBiddingZone_Domain', 1))
   v(feed, document_type, process_type, contract_type, zone_param, incl)),
zones AS (SELECT * FROM (VALUES {_ZONE_REQ}) v(bzn, eic, coords)),
win AS (
  SELECT f.*, CAST(r.s AS TIMESTAMP) AS s, CAST(r.e AS TIMESTAMP) + to_days(f.incl) AS e_ex
  FROM run r CROSS JOIN feeds f),
ws AS (
  SELECT *, unnest(generate_series(s, e_ex - INTERVAL 1 DAY, INTERVAL 31 DAY)) AS ws FROM win WHERE s < e_ex)
SELECT feed, z.bzn, zone_param, z.eic AS zone_value, document_type, process_type, contract_type,
       strftime(ws, '%Y%m%d%H%M') AS period_start,
       strftime(least(ws + INTERVAL 31 DAY, e_ex), '%Y%m%d%H%M') AS period_end
FROM ws CROSS JOIN zones z
UNION ALL
SELECT 'weather', z.bzn, 'locations', z.coords, NULL, NULL, NULL,
       strftime(CASE WHEN CAST(r.e AS TIMESTAMP) - CAST(r.s AS TIMESTAMP) > INTERVAL 48 HOUR
                     THEN CAST(r.e AS TIMESTAMP) - INTERVAL 48 HOUR ELSE CAST(r.s AS TIMESTAMP) END,
                '%Y-%m-%d') || 'T00:00:00',
       strftime(r.e, '%Y-%m-%d') || 'T23:59:59'
FROM run r CROSS JOIN zones z"""

ORACLE["green_share_zone_hour_sql"] = ORACLE["green_share_zone_hour"]

_NULLABLE = [c for c in WEATHER_COLS if c not in ("country", "bzn")]
ORACLE["weather_all_null_columns"] = with_feeds() + "\nSELECT " + ", ".join(
    f"CAST(count({c}) = 0 AS INTEGER) AS {c}" for c in _NULLABLE) + " FROM weather_cleaned"
ORACLE["weather_zone_pairs"] = with_feeds() + "\nSELECT DISTINCT eic_code, bzn FROM weather_cleaned"

# --- lifecycle ------------------------------------------------------------------

ORACLE["stream_ingest_price"] = ORACLE["price_data"]
# deliveries arrive in the order 2, 0, 1 of ingest_order % 3; the first delivery of a point wins
ORACLE["stream_dedupe_price"] = with_feeds() + """
SELECT eic_code, datetime, price, currency_unit, price_measure_unit FROM price_data
QUALIFY row_number() OVER (PARTITION BY eic_code, datetime
  ORDER BY CASE ingest_order % 3 WHEN 2 THEN 0 WHEN 0 THEN 1 ELSE 2 END, ingest_order) = 1"""
ORACLE["unit_dim_from_documents"] = ORACLE["unit_dim"]
ORACLE["energy_type_dim_from_documents"] = ORACLE["energy_type_dim"]

# a weather document: zone, day and 5,000 ingest numbers; its number is its first point's
_WDOCS = """
wdocs AS (
  SELECT *, min(ingest_order) OVER (PARTITION BY bzn, CAST(date_time AS DATE), ingest_order // 5000) AS doc_seq
  FROM weather_cleaned)"""
_BY_DOCUMENT = """
weather_cleaned_docs AS (
  SELECT * EXCLUDE (ingest_order, doc_seq),
         doc_seq * 1048576 + row_number() OVER (PARTITION BY doc_seq ORDER BY date_time, ingest_order) - 1 AS ingest_order
  FROM wdocs)"""
ORACLE["condition_dim_from_documents"] = ORACLE["condition_dim"].replace(
    "\nsplit AS (", f"{_WDOCS},{_BY_DOCUMENT},\nsplit AS (").replace(
    "ingest_order FROM weather_cleaned)", "ingest_order FROM weather_cleaned_docs)")
ORACLE["fact_from_lake"] = ORACLE["measurements_fact"]
ORACLE["fact_written_by_days"] = ORACLE["measurements_fact"]
ORACLE["lake_production_duplicates"] = with_feeds() + """
SELECT eic_code, datetime, produced_energy_type, 2 * count(*) AS n_rows FROM production_data
GROUP BY eic_code, datetime, produced_energy_type"""
ORACLE["mart_price_appended"] = ORACLE["price_data"]
ORACLE["price_latest_delivery"] = ORACLE["price_data"]
ORACLE["price_staged"] = """
SELECT CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE E' a "b", \\n c ' END AS note, count(*) AS n,
       min(ts + INTERVAL 123 MICROSECOND) AS first_ts, max(ts + INTERVAL 123 MICROSECOND) AS last_ts,
       CAST(sum(CAST(value AS DECIMAL(30, 6))) AS DOUBLE) AS total
FROM events GROUP BY 1"""
ORACLE["weather_quarantine"] = with_feeds(_WDOCS) + """
SELECT DISTINCT CASE doc_seq % 5 WHEN 1 THEN 'FR' ELSE bzn END AS bzn, strftime(date_time, '%Y-%m-%d') AS window_start, doc_seq,
       CASE doc_seq % 5 WHEN 0 THEN 'broken body' ELSE 'unknown zone' END AS reason
FROM wdocs WHERE doc_seq % 5 IN (0, 1)"""
ORACLE["weather_without_quarantined"] = with_feeds(_WDOCS) + """
SELECT * EXCLUDE (ingest_order, doc_seq) FROM wdocs WHERE doc_seq % 5 NOT IN (0, 1)"""
ORACLE["breakdown_quarantine"] = with_fact() + f"""
SELECT DISTINCT {_EIC_TO_BZN} AS zone, CAST(datetime AS DATE) AS day FROM prod WHERE day(datetime) % 2 = 0"""
ORACLE["production_unmatched_types"] = with_feeds() + """
SELECT produced_energy_type, count(*) AS n_rows FROM production_data
WHERE produced_energy_type IS NULL OR produced_energy_type LIKE 'Fossil%' GROUP BY produced_energy_type"""
ORACLE["weather_zones_without_documents"] = with_feeds() + f""",
zones AS (SELECT * FROM (VALUES {_ZONE_ROWS}) v(country, bzn))
SELECT country, bzn FROM zones WHERE bzn NOT IN (
  SELECT DISTINCT bzn FROM weather_cleaned WHERE bzn LIKE 'NO%' OR bzn LIKE 'SE%')"""
ORACLE["price_prefixed_and_rejected"] = with_feeds() + """,
pdocs AS (
  SELECT *, min(ingest_order) OVER (PARTITION BY eic_code, resolution, period_start, ingest_order // 5000) AS doc_seq
  FROM pts WHERE event_type = 'purchase')
SELECT eic_code, value AS price, 'EUR' AS currency_unit, 'MWH' AS price_measure_unit,
       period_start + to_minutes(position * res) AS datetime
FROM pdocs WHERE doc_seq % 3 <> 0"""
ORACLE["weather_incomplete_columns"] = with_feeds(_WDOCS) + """
SELECT eic_code, date_time, CASE WHEN count(*) FILTER (WHERE ingest_order % 50 = 0) OVER (PARTITION BY doc_seq) = 0
       THEN temperature END AS temperature, dew_point
FROM wdocs"""
ORACLE["request_manifest_weekly"] = ORACLE["request_manifest"].replace("INTERVAL 31 DAY", "INTERVAL 7 DAY")
ORACLE["timestamp_dim_holidays"] = ORACLE["timestamp_dim"].replace(
    f"IN ({_HOLS})", "IN (SELECT CAST(lo AS DATE) + d FROM bounds, (VALUES (0), (7)) x(d))")
ORACLE["energy_type_dim_in_two_runs"] = ORACLE["energy_type_dim"].replace(
    "row_number() OVER (ORDER BY o)", "row_number() OVER (ORDER BY t IN ('Solar', 'Nuclear'), o)")
ORACLE["zone_days_in_two_runs"] = with_feeds() + """
SELECT eic_code, d AS day, row_number() OVER (ORDER BY day(d) > 10, d, eic_code) AS _id
FROM (SELECT DISTINCT eic_code, CAST(datetime AS DATE) AS d FROM consumption_data)"""
ORACLE["zone_series_first_zone"] = with_fact() + f"""
SELECT {', '.join(c for c in SERIES_COLS if c != 'bzn')} FROM fact
WHERE bzn = (SELECT min(bzn) FROM fact) AND datetime <= (SELECT min(datetime) + INTERVAL 7 DAY FROM fact)
  AND consumption_quantity > 0"""
ORACLE["green_share_last_hour"] = with_fact(green_share_sql()) + """
SELECT * FROM green_share_out WHERE hourly_datetime = (SELECT date_trunc('hour', max(datetime)) FROM fact)"""

# --- tables kept up to date ---------------------------------------------------------

ORACLE["weather_appended_widening"] = """
SELECT event_id, ts AS datetime,
       CASE event_id % 3 WHEN 1 THEN value ELSE trunc(value) END AS humidity,
       CASE event_id % 3 WHEN 2 THEN event_type ELSE CAST(CAST(trunc(value / 4) AS BIGINT) AS VARCHAR) END AS wind,
       CASE event_id % 3 WHEN 2 THEN 'st_' || user_id END AS station
FROM events"""
ORACLE["user_event_ids"] = """
SELECT user_id, ts, row_number() OVER (ORDER BY user_id, ts) AS _id FROM (SELECT DISTINCT user_id, ts FROM events)"""
ORACLE["price_filled_long"] = with_feeds() + """
SELECT eic_code, ts, ingest_order AS event_id,
       last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER w AS price,
       last_value(CASE WHEN event_type = 'signup' THEN event_type END IGNORE NULLS) OVER w AS mark
FROM pts WINDOW w AS (PARTITION BY eic_code ORDER BY ts, ingest_order ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
ORACLE["fact_updated_by_change"] = ORACLE["measurements_fact"]
# deliveries: on time in the first half of the month, in the second, and the rest whatever its age; the first one of a point wins
ORACLE["stream_late_price"] = with_feeds() + """
SELECT eic_code, datetime, price, currency_unit, price_measure_unit FROM price_data
QUALIFY row_number() OVER (PARTITION BY eic_code, datetime
  ORDER BY CASE WHEN ingest_order % 5 = 0 THEN 2 WHEN day(datetime) <= 15 THEN 0 ELSE 1 END, ingest_order) = 1"""

_GOOD = "SELECT eic_code, datetime, consumption_quantity AS quantity FROM cons"
_BAD = """bad AS (
  SELECT CASE WHEN ingest_order % 7 <> 0 THEN eic_code END AS eic_code, datetime FROM consumption_data WHERE day(datetime) <= 15)"""
ORACLE["checked_load_rows"] = with_fact() + "\n" + _GOOD
ORACLE["checked_load_verdicts"] = with_fact() + f""",
{_BAD},
good AS ({_GOOD}),
there AS (SELECT * FROM good WHERE day(datetime) <= 15),
n AS (
  SELECT '2' AS load, 'key' AS "check", 'eic_code,datetime' AS "column",
         (SELECT count(*) - count(DISTINCT (eic_code, datetime)) FROM bad ANTI JOIN there USING (eic_code, datetime)
          WHERE eic_code IS NOT NULL) AS violations
  UNION ALL
  SELECT '2', 'key is there', 'eic_code,datetime', (SELECT count(*) FROM bad SEMI JOIN there USING (eic_code, datetime))
  UNION ALL
  SELECT '2', 'not null', 'eic_code', (SELECT count(*) FROM bad WHERE eic_code IS NULL)
  UNION ALL
  SELECT '4', 'key is there', 'eic_code,datetime', (SELECT count(*) FROM there))
SELECT l AS load, c."check", c."column", coalesce(n.violations, 0) AS violations, CAST(l IN ('1', '3') AS INTEGER) AS accepted
FROM (VALUES ('1'), ('2'), ('3'), ('4')) loads(l)
CROSS JOIN (VALUES ('key', 'eic_code,datetime'), ('key is there', 'eic_code,datetime'), ('not null', 'eic_code'), ('not null', 'datetime')) c("check", "column")
LEFT JOIN n ON n.load = l AND n."check" = c."check" AND n."column" = c."column\""""
# half days that were asked for and didn't come, joined where they touch
ORACLE["price_request_gaps"] = with_feeds() + f""",
run AS (SELECT min(CAST(ts AS DATE)) AS s, max(CAST(ts AS DATE)) AS e FROM events),
half AS (
  SELECT z.eic AS eic_code, h FROM (SELECT unnest({EICS}) AS eic) z,
         (SELECT unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP) - INTERVAL 12 HOUR, INTERVAL 12 HOUR)) AS h FROM run)),
came AS (
  SELECT DISTINCT eic_code, period_start, unnest(CASE day(period_start) % 3 WHEN 0 THEN [0] ELSE [0, 12] END) AS hh
  FROM pts WHERE event_type = 'purchase' AND day(period_start) % 5 <> 1 AND day(period_start) % 7 <> 2),
free AS (SELECT half.* FROM half ANTI JOIN (SELECT eic_code, period_start + to_hours(hh) AS h FROM came) c ON c.eic_code = half.eic_code AND c.h = half.h),
island AS (SELECT *, h - to_hours(12 * row_number() OVER (PARTITION BY eic_code ORDER BY h)) AS g FROM free)
SELECT eic_code, min(h) AS start, max(h) + INTERVAL 12 HOUR AS "end" FROM island GROUP BY eic_code, g"""
ORACLE["weather_from_named_files"] = with_feeds() + """
SELECT * EXCLUDE (ingest_order) FROM weather_cleaned
WHERE (bzn LIKE 'NO%' OR bzn LIKE 'SE%') AND CAST(date_time AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'"""
ORACLE["fact_from_bucketed_marts"] = ORACLE["measurements_fact"]
ORACLE["green_share_from_partials"] = ORACLE["green_share_zone_hour"]
ORACLE["green_share_country_from_partials"] = ORACLE["green_share_country_hour"]
ORACLE["map_features"] = f"""
WITH map AS ({ORACLE["green_share_country_hour"]}),
hours AS (SELECT country, count(*) AS n_hours, max(green_proportion) AS most_green FROM map GROUP BY country),
n AS (
  SELECT CAST(n_nationkey AS BIGINT) AS k, coalesce({sql_list(_COUNTRY_NAMES)}[n_nationkey + 1], n_name) AS name FROM nation),
s AS (
  SELECT *, CASE k % 4 WHEN 1 THEN 2 ELSE 1 END AS p, CASE k % 3 WHEN 0 THEN 1 ELSE 0 END AS h, CASE k % 6 WHEN 5 THEN 0 ELSE 1 END AS c FROM n)
SELECT name, CASE p WHEN 2 THEN 'MultiPolygon' ELSE 'Polygon' END AS kind, p AS n_polygons, p + h AS n_rings,
       4 + c + 5 * (p - 1) + 4 * h AS n_positions, c AS closed,
       CAST(k * 7 - 90 AS DOUBLE) AS west, CAST(k * 3 - 30 AS DOUBLE) AS south, CAST(k * 7 - 86 + 5 * (p - 1) AS DOUBLE) AS east,
       CAST(k * 3 - 28 AS DOUBLE) AS north, 8.0 * p - 0.25 * h AS area, coalesce(n_hours, 0) AS n_hours, coalesce(most_green, 0.0) AS most_green
FROM s LEFT JOIN hours ON hours.country = s.name"""
