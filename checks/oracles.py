"""The queries of ``checks.queries`` as plain SQL over the given tables, written out independently."""

from __future__ import annotations

from checks.standins import CODES, PLANT_TYPES, SOURCES
from stationday.functions.text import WHITE_SPACE

DAY = "DATE '2024-01-05'"
MEASURES = {
    "precipitation": ("mm", False),
    "max_temperature": ("c", False),
    "min_temperature": ("c", False),
    "max_wind": ("speed_ms", True),
    "max_gust": ("speed_ms", True),
}
EVENT_OF = {source: event for event, source in SOURCES.items()}
VALUES = {name: f"{name}_{unit}" for name, (unit, _) in MEASURES.items()}
COLUMNS = [
    c
    for name, (unit, windy) in MEASURES.items()
    for c in (
        f"{name}_{unit}",
        f"{name}_quality",
        *((f"{name}_direction", f"{name}_direction_quality") if windy else ()),
    )
]
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _case(column: str, mapping: dict[str, str], otherwise: str | None = None) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {column} {whens}{'' if otherwise is None else f' ELSE {otherwise!r}'} END"


def _wide_measures() -> str:
    out = []
    for name, (unit, windy) in MEASURES.items():
        event = f"FILTER (WHERE event_type = '{EVENT_OF[name]}')"
        out += [f"max(value) {event} AS {name}_{unit}", f"max(k) {event} AS {name}_quality"]
        if windy:
            out += [
                f"max(props) {event} AS {name}_direction",
                f"max(k + 1) {event} AS {name}_direction_quality",
            ]
    return ", ".join(out)


EV = """ev AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS station_id, CAST(ts AS DATE) AS date, ts, event_type,
         value, props, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events)"""
LONG = f"""{EV}, lng AS (
  SELECT ev.*, s_name AS wmo_station_id, date_trunc('hour', ts) AS observed_at,
         {_case('event_type', SOURCES)} AS source,
         CASE WHEN event_type IN ('signup', 'error') THEN props END AS direction,
         CASE WHEN event_type IN ('signup', 'error') THEN k + 1 END AS direction_quality
  FROM ev LEFT JOIN supplier ON CAST(s_suppkey AS VARCHAR) = station_id)"""
WIDE = f"""{LONG}, wide AS (
  SELECT station_id, wmo_station_id, date, oldest AS observed_at, {", ".join(COLUMNS)}
  FROM (SELECT station_id, wmo_station_id, date, {_wide_measures()}
        FROM lng WHERE wmo_station_id IS NOT NULL GROUP BY 1, 2, 3)
  JOIN (SELECT date, min(observed_at) AS oldest FROM lng GROUP BY 1) USING (date))"""
DEGREES = """CAST(24 + c_custkey % 21 AS DOUBLE) + CAST(c_custkey * 7 % 60 AS DOUBLE) / CAST(60 AS DOUBLE) AS latitude,
         CAST(123 + c_custkey % 23 AS DOUBLE) + CAST(c_custkey * 13 % 60 AS DOUBLE) / CAST(60 AS DOUBLE) AS longitude"""
WEATHER = f"""{WIDE}, weather AS (
  SELECT station_id, date, observed_at, c_name AS station_name, {DEGREES}, {", ".join(COLUMNS)}
  FROM wide JOIN customer ON CAST(c_custkey AS VARCHAR) = station_id)"""


def _pollen(index_values: int) -> str:
    return f"""pol_types AS (
  SELECT station_id, date, CASE event_type WHEN 'click' THEN 'TREE' WHEN 'view' THEN 'GRASS' ELSE 'WEED' END AS type,
         max(CAST(floor(value) AS BIGINT) % {index_values}) AS v
  FROM ev WHERE event_type IN ('click', 'view', 'purchase') GROUP BY 1, 2, 3),
pol_plants AS (
  SELECT station_id, date, code, {_case('code', PLANT_TYPES, 'TREE')} AS type, max(CAST(floor(value) AS BIGINT) % {index_values}) AS v
  FROM (SELECT *, list_extract([{", ".join(repr(c) for c in CODES)}], CAST(k % {len(CODES)} AS INTEGER) + 1) AS code
        FROM ev)
  WHERE code NOT IN ('PLANT_UNSPECIFIED', 'BAMBOO') GROUP BY 1, 2, 3, 4),
pol_lists AS (
  SELECT station_id, date, type,
         string_agg('{{"code":"' || code || '","value":' || CAST(v AS VARCHAR) || '}}', ',' ORDER BY code) AS plants
  FROM pol_plants GROUP BY 1, 2, 3),
pol_groups AS (
  SELECT station_id, date, type,
         '{{"value":' || coalesce(CAST(v AS VARCHAR), 'null') || ',"plants":[' || coalesce(plants, '') || ']}}' AS info
  FROM pol_types FULL JOIN pol_lists USING (station_id, date, type)),
pol AS (
  SELECT s.station_id, s.date, max(info) FILTER (WHERE type = 'GRASS') AS grass_info,
         max(info) FILTER (WHERE type = 'TREE') AS tree_info, max(info) FILTER (WHERE type = 'WEED') AS weed_info
  FROM (SELECT DISTINCT station_id, date FROM ev) s LEFT JOIN pol_groups USING (station_id, date) GROUP BY 1, 2)"""


POLLEN = _pollen(7)
COND = "cond AS (SELECT * FROM weather JOIN pol USING (station_id, date))"
CONDITIONS = f"{WEATHER}, {POLLEN}, {COND}"
VALID_CONDITIONS = f"{WEATHER}, {_pollen(6)}, {COND}"


def _ts(column: str, alias: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {alias or column}"


def _date(column: str = "date") -> str:
    return f"CAST({column} AS VARCHAR) AS {column}"


_HEAD = f"station_id, {_date()}, {_ts('observed_at')}, station_name, latitude, longitude, {', '.join(COLUMNS)}"
_COND = f"{_HEAD}, grass_info, tree_info, weed_info"


def _extreme(pick: str, column: str, where: str = "TRUE") -> str:
    return f"""WITH {WEATHER}, day AS (SELECT * FROM weather WHERE {where})
SELECT {_HEAD.replace("date AS", "day.date AS", 0)} FROM day
JOIN (SELECT date AS d, {pick}({column}) AS bound FROM day GROUP BY 1) ON d = date AND bound = {column}"""


def _summary(where: str = "TRUE") -> str:
    named = {
        "highest_max_temperature": ("max", "max_temperature_c", "highest_max_temperature_c"),
        "lowest_min_temperature": ("min", "min_temperature_c", "lowest_min_temperature_c"),
        "maximum_precipitation": ("max", "precipitation_mm", "maximum_precipitation_mm"),
        "strongest_gust": ("max", "max_gust_speed_ms", "strongest_gust_speed_ms"),
    }
    columns = ", ".join(
        f"arg_{pick}(station_name, {column} ORDER BY station_id) AS {name}_station_name, {pick}({column}) AS {value}"
        for name, (pick, column, value) in named.items()
    )
    return f"""WITH {WEATHER}
SELECT CAST(date AS VARCHAR) AS date, strftime(max(observed_at), '%Y-%m-%d %H:%M:%S') AS observed_at, {columns}
FROM (SELECT * FROM weather WHERE {where}) GROUP BY weather.date""".replace("weather.date", "date")


def _nearest(where: str) -> str:
    return f"""WITH {WEATHER}, d AS (
  SELECT *, 2 * 6371.0e0 * asin(sqrt(
    pow(sin(radians(latitude - 35.0e0) / 2), 2)
    + cos(radians(35.0e0)) * cos(radians(latitude)) * pow(sin(radians(longitude - 139.0e0) / 2), 2))) AS km
  FROM weather WHERE {where})
SELECT {_date()}, station_id, station_name, round(km, 6) AS distance_km
FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY round(km, 9), station_id) AS r FROM d) WHERE r = 1"""


def _around_the_world(key: str, days: int) -> str:
    return (
        f"CAST({DAY} + CAST({key} % {days} AS INTEGER) AS DATE) AS date, "
        f"CAST({key} * 7919 % 180001 AS DOUBLE) / 1000.0e0 - 90.0e0 AS latitude, "
        f"CAST({key} * 104729 % 360001 AS DOUBLE) / 1000.0e0 - 180.0e0 AS longitude"
    )


def _nearest_many(points: str, stations: str) -> str:
    """All points with all stations of their day."""
    return f"""pairs AS (
  SELECT point_id, s.date, station_id, station_name, 2 * 6371.0e0 * asin(sqrt(least(1.0e0,
    pow(sin(radians(s.latitude - p.latitude) / 2), 2)
    + cos(radians(p.latitude)) * cos(radians(s.latitude)) * pow(sin(radians(s.longitude - p.longitude) / 2), 2)))) AS km
  FROM {points} p JOIN {stations} s ON p.date = s.date)
SELECT point_id, {_date()}, station_id, station_name, round(km, 6) AS distance_km
FROM (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY round(km, 9), station_id) AS r FROM pairs) WHERE r = 1"""


def _hour_text(date: str) -> str:
    return (
        f"strftime(CAST({date} AS TIMESTAMP) + to_hours(CAST(day({date}) % 25 AS INTEGER)), "
        "'%Y-%m-%dT%H:00:00+09:00')"
    )


RAW = f"""WITH {LONG}
SELECT {_date().replace("AS date", "AS snapshot_date")}, source, station_id, wmo_station_id, {_date()},
       {_hour_text('date')} AS observed_at, value, k AS quality, direction, direction_quality
FROM lng"""

ORACLES = {
    "wide_daily": f"WITH {WIDE} SELECT station_id, wmo_station_id, {_date()}, {_ts('observed_at')}, "
    f"{', '.join(COLUMNS)} FROM wide",
    "daily_summary_all": _summary(),
    "daily_summary_one": _summary(f"date = {DAY}"),
    "hottest_all": _extreme("max", "max_temperature_c"),
    "coldest_all": _extreme("min", "min_temperature_c"),
    "highest_precipitation_all": _extreme("max", "precipitation_mm"),
    "strongest_gust_all": _extreme("max", "max_gust_speed_ms"),
    "all_conditions": f"WITH {CONDITIONS} SELECT {_COND} FROM cond WHERE date = {DAY}",
    "nearest_one": _nearest(f"date = {DAY}"),
    "nearest_all": _nearest("TRUE"),
    "nearest_many": f"""WITH points AS (SELECT o_orderkey AS point_id, {_around_the_world("o_orderkey", 10)} FROM orders),
places AS (
  SELECT CAST(c_custkey AS VARCHAR) AS station_id, c_name AS station_name, {_around_the_world("(c_custkey + 17)", 7)} FROM customer),
{_nearest_many("points", "places")}""",
    "nearest_suppliers": f"""WITH {WEATHER}, points AS (
  SELECT s_suppkey AS point_id, {DAY} AS date, CAST(s_suppkey * 37 % 2100 AS DOUBLE) / 100.0e0 + 24.003e0 AS latitude,
    CAST(s_suppkey * 53 % 2300 AS DOUBLE) / 100.0e0 + 123.007e0 AS longitude FROM supplier),
{_nearest_many("points", "weather")}""",
    "sql_all_conditions": f"WITH {WEATHER} SELECT {_HEAD} FROM weather WHERE date = {DAY}",
    "sql_hottest": _extreme("max", "max_temperature_c", f"date = {DAY}"),
    "sql_coldest": _extreme("min", "min_temperature_c", f"date = {DAY}"),
    "sql_highest_precipitation": _extreme("max", "precipitation_mm", f"date = {DAY}"),
    "sql_strongest_gust": _extreme("max", "max_gust_speed_ms", f"date = {DAY}"),
    "sql_daily_summary": _summary(f"date = {DAY}"),
    "sql_nearest": _nearest(f"date = {DAY}"),
    "sql_adhoc": f"""WITH {WEATHER}
SELECT station_name, count(*) AS days, max(max_temperature_c) AS hottest FROM weather
WHERE max_temperature_c > 20 GROUP BY 1""",
    "dms_to_decimal": f"""SELECT station_id, round(latitude, 9) AS latitude, round(longitude, 9) AS longitude
FROM (SELECT CAST(c_custkey AS VARCHAR) AS station_id, {DEGREES} FROM customer)""",
    "strip_text": f"""SELECT page_id,
  sha256(nullif(trim(html, '{WHITE_SPACE}'), '')) AS html,
  CAST(NULL AS VARCHAR) AS blank FROM pages""",
    "lenient_cast": f"""SELECT page_id, part, CASE WHEN regexp_matches(part, '{NUMBER}') THEN TRY_CAST(part AS DOUBLE) END
  AS number FROM (SELECT page_id, regexp_extract(url, '/([^/?#]*)(?:[?#].*)?$', 1) AS part FROM pages)""",
    "strict_cast": "SELECT l_orderkey, l_linenumber, l_extendedprice AS price, l_partkey AS part FROM lineitem",
    "csv_line_fields": f"SELECT doc_id, CAST(4 AS BIGINT) AS width, lang, sha256(trim(text, '{WHITE_SPACE}')) AS text_sha256, "
    "source FROM documents",
    "observed_hour": f"SELECT event_id, {_ts('date_trunc(' + repr('hour') + ', ts)', 'hour')} FROM events",
    "hour24": """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date,
  strftime(date_trunc('day', o_orderdate) + to_hours(CAST(o_orderkey % 25 AS INTEGER)), '%Y-%m-%dT%H:00:00+09:00')
  AS observed_at FROM orders""",
    "snapshot_keys": """SELECT CAST(d AS VARCHAR) AS date, strftime(d, '%Y%m%d') AS key, count(*) AS n,
  CAST(d AS VARCHAR) AS back FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) GROUP BY d""",
    "json_values": f"WITH {EV} SELECT event_id, k, CAST(k BETWEEN 0 AND 5 AS INTEGER) AS in_range FROM ev",
    "key_check": f"""WITH {LONG}, part AS (SELECT * REPLACE (CASE WHEN k % 31 <> 0 THEN station_id END AS station_id) FROM lng), keyed AS (
  SELECT date, source, station_id, count(*) AS n FROM part GROUP BY 1, 2, 3),
dup AS (SELECT date, source, count(*) FILTER (WHERE n > 1) AS duplicates, CAST(coalesce(sum(n) FILTER (WHERE station_id IS NULL), 0) AS BIGINT) AS nulls
  FROM keyed GROUP BY 1, 2),
cnt AS (SELECT date, source, count(*) AS n, count(DISTINCT observed_at) AS hours FROM part GROUP BY 1, 2)
SELECT CAST(date AS VARCHAR) AS snapshot_date, source, nulls AS null_key_row_count,
  duplicates AS duplicate_key_count, CAST(1 AS BIGINT) AS date_count, hours AS observed_at_count, n AS row_count,
  CAST(nulls = 0 AND duplicates = 0 AND hours = 1 AS INTEGER) AS passed
FROM dup JOIN cnt USING (date, source)""",
    "source_profile": f"""WITH {LONG}, part AS (SELECT * REPLACE (CASE WHEN k % 31 <> 0 THEN station_id END AS station_id) FROM lng), keyed AS (
  SELECT date, source, station_id, count(*) AS n FROM part GROUP BY 1, 2, 3),
dup AS (SELECT date, source, count(*) FILTER (WHERE n > 1) AS duplicate_key_count,
  CAST(coalesce(sum(n) FILTER (WHERE station_id IS NULL), 0) AS BIGINT) AS null_key_row_count FROM keyed GROUP BY 1, 2),
cnt AS (SELECT date, source, count(*) AS row_count, count(*) FILTER (WHERE direction IS NULL) AS null_count, min(observed_at) AS a, max(observed_at) AS z,
  CAST(count(DISTINCT strftime(ts, '%Y %m %d %H %M')) > 1 AS INTEGER) AS several_times FROM part GROUP BY 1, 2)
SELECT CAST(date AS VARCHAR) AS snapshot_date, source, null_key_row_count, duplicate_key_count, row_count, null_count,
  {_ts('a', 'first_at')}, {_ts('z', 'last_at')}, CAST(date AS VARCHAR) AS first_date, CAST(date AS VARCHAR) AS last_date, several_times
FROM dup JOIN cnt USING (date, source)""",
    "duplicate_keys": f"""WITH {EV} SELECT station_id, {_date()}, n
FROM (SELECT station_id, date, count(*) AS n FROM ev GROUP BY 1, 2) WHERE n > 1""",
    "conflicting_ids": f"""WITH {LONG} SELECT station_id, {_date()}, n FROM (
  SELECT station_id, date, count(DISTINCT event_type = 'purchase') AS n
  FROM lng WHERE wmo_station_id IS NOT NULL GROUP BY 1, 2) WHERE n > 1""",
    "date_conflicts": f"""WITH {EV} SELECT CAST(CAST(w AS DATE) AS VARCHAR) AS snapshot_date, dates,
  CAST(f AS VARCHAR) AS first, CAST(l AS VARCHAR) AS last FROM (
  SELECT date_trunc('week', date) AS w, count(DISTINCT date) AS dates, min(date) AS f, max(date) AS l
  FROM ev GROUP BY 1) WHERE dates <> 1""",
    "time_conflicts": f"""WITH {LONG}, t AS (
  SELECT date, source, strftime(ts, '%Y %m %d %H %M') AS txt FROM lng)
SELECT CAST(date AS VARCHAR) AS snapshot_date, source, count(DISTINCT txt) AS times, min(txt) AS first, max(txt) AS last
FROM t GROUP BY date, source HAVING count(DISTINCT txt) > 1""",
    "source_times": f"""WITH {LONG}, s AS (SELECT date, source, min(observed_at) AS a FROM lng GROUP BY 1, 2)
SELECT CAST(date AS VARCHAR) AS snapshot_date, {_ts('min(a)', 'observed_at')}, {_ts('max(a)', 'newest_observed_at')},
  {", ".join(_ts(f"min(a) FILTER (WHERE source = '{n}')", f"{n}_observed_at") for n in MEASURES)},
  CAST(min(a) < max(a) AS INTEGER) AS differs FROM s GROUP BY date""",
    "null_counts": f"""WITH {WIDE} SELECT CAST(date AS VARCHAR) AS date, count(*) AS row_count,
  {", ".join(f"count(*) FILTER (WHERE {v} IS NULL) AS null_{v}_count" for v in VALUES.values())}
FROM wide GROUP BY wide.date""",
    "run_metrics": f"""WITH {LONG}, c AS (SELECT date, source, count(*) AS n,
  count(*) FILTER (WHERE wmo_station_id IS NULL) AS w, count(*) FILTER (WHERE direction IS NULL) AS d
  FROM lng GROUP BY 1, 2), u AS (
  SELECT date, source, 'row_count' AS metric, n AS v FROM c
  UNION ALL SELECT date, source, 'null_wmo_station_id_count', w FROM c
  UNION ALL SELECT date, source, 'null_direction_count', d FROM c)
SELECT CAST(date AS VARCHAR) AS snapshot_date, 'cleaned.' || source AS table_name, metric, CAST(v AS VARCHAR) AS value
FROM u""",
    "key_mismatches": f"""WITH {EV} SELECT station_id, {_date()}, left_rows, right_rows FROM (
  SELECT station_id, date, count(*) FILTER (WHERE event_type = 'click') AS left_rows,
         count(*) FILTER (WHERE event_type <> 'click') AS right_rows
  FROM ev GROUP BY 1, 2) WHERE left_rows <> 1 OR right_rows <> 1""",
    "missing_master": """SELECT DISTINCT CAST(user_id AS VARCHAR) AS station_id FROM events
WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)""",
    "first_duplicate": f"""WITH {EV}, f AS (SELECT station_id, min(event_id) AS event_id, count(*) AS n FROM ev GROUP BY 1)
SELECT ev.station_id, n, ev.event_id, event_type, value, k FROM ev JOIN f ON f.event_id = ev.event_id""",
    "station_dimension": f"""SELECT CAST(c_custkey AS VARCHAR) AS station_id, s_name AS wmo_station_id,
  c_name AS station_name, round(latitude, 9) AS latitude, round(longitude, 9) AS longitude, CAST(2 AS BIGINT) AS n
FROM (SELECT *, {DEGREES} FROM customer) JOIN supplier ON s_suppkey = c_custkey
WHERE c_custkey IN (SELECT user_id FROM events)""",
    "nested_groups": f"WITH {EV}, {POLLEN} SELECT station_id, {_date()}, grass_info, tree_info, weed_info FROM pol",
    "envelope_roundtrip": f"WITH {EV}, {POLLEN} SELECT station_id, {_date()}, grass_info, tree_info, weed_info FROM pol",
    "envelope_counts": f"""WITH {EV} SELECT CAST(date AS VARCHAR) AS snapshot_date,
  count(DISTINCT station_id) AS station_count, count(DISTINCT station_id) AS results FROM ev GROUP BY date""",
    "pollen_values": f"""WITH {EV}, {POLLEN}, t AS (
  SELECT date, count(*) FILTER (WHERE v > 5) AS n FROM pol_types GROUP BY 1),
p AS (SELECT date, count(*) FILTER (WHERE v > 5) AS n FROM pol_plants GROUP BY 1),
d AS (SELECT date, coalesce(t.n, 0) AS tn, coalesce(p.n, 0) AS pn
      FROM (SELECT DISTINCT date FROM ev) LEFT JOIN t USING (date) LEFT JOIN p USING (date))
SELECT {_date()}, tn AS invalid_pollen_value_count, pn AS invalid_plant_value_count,
  CAST(tn = 0 AND pn = 0 AS INTEGER) AS passed FROM d""",
    "forecast_dates": """SELECT CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INTEGER) AS VARCHAR) AS snapshot_date,
  CAST(o_orderkey AS VARCHAR) AS station_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS got
FROM orders WHERE o_orderkey % 3 <> 0""",
    "conditions": f"WITH {CONDITIONS} SELECT {_COND} FROM cond",
    "payload_manifest": "SELECT page_id, CAST(strlen(html) AS BIGINT) AS size, sha256(html) AS sha256 FROM pages",
    "publish_roundtrip": f"WITH {CONDITIONS} SELECT {_COND} FROM cond",
    "union_by_name": f"""WITH {EV} SELECT event_id, station_id, {_date()}, event_type, value, props,
  CASE WHEN event_type <> 'click' THEN k END AS k FROM ev""",
    "geojson_roundtrip": f"""WITH {CONDITIONS} SELECT 'Feature' AS feature_type, 'Point' AS geometry_type,
  round(longitude, 9) AS longitude, round(latitude, 9) AS latitude, station_id, {_date()},
  strftime(observed_at + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S+09:00') AS observed_at, station_name,
  {", ".join(COLUMNS)}, grass_info, tree_info, weed_info FROM cond""",
    "geojson_documents": f"""WITH {WEATHER} SELECT CAST(date AS VARCHAR) AS date, CAST(1 AS BIGINT) AS documents,
  count(*) AS features, count(DISTINCT station_id) AS stations FROM weather GROUP BY weather.date""",
    "raw_csv_roundtrip": RAW,
    "raw_csv_split_roundtrip": RAW,
    "full_rebuild": f"WITH {VALID_CONDITIONS} SELECT * REPLACE ({_hour_text('CAST(date AS DATE)')} AS observed_at) "
    f"FROM (SELECT {_COND} FROM cond)",
    "rebuild_with_bad_days": f"WITH {VALID_CONDITIONS} SELECT * REPLACE ({_hour_text('CAST(date AS DATE)')} AS observed_at) "
    f"FROM (SELECT {_COND} FROM cond WHERE day(date) NOT IN (4, 7, 10, 13, 16, 19, 22, 25))",
    "failed_snapshots": """WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events),
failures(day, source, "check") AS (VALUES (4, 'precipitation', 'raw_files'), (7, 'max_wind', 'raw_files'), (10, NULL, 'raw_objects'),
  (13, 'min_temperature', 'valid_daily_weather_key'), (16, NULL, 'pollen_payloads'), (19, NULL, 'valid_pollen_values'),
  (22, NULL, 'one_wmo_id'), (25, NULL, 'same_keys'))
SELECT CAST(date AS VARCHAR) AS snapshot_date, source, "check" FROM days JOIN failures ON day(date) = failures.day""",
    "refused_times": """WITH t AS (SELECT o_orderkey, strftime(o_orderdate, '%Y') AS y, strftime(o_orderdate, '%m') AS m,
  o_orderkey % 33 + 1 AS d, o_orderkey % 27 AS h, o_orderkey % 63 AS mi, day(last_day(o_orderdate)) AS days FROM orders)
SELECT o_orderkey, NULL::VARCHAR AS date, 'Invalid observation time: ' || concat_ws(' ', y, m, d, h, mi) AS failure FROM t
WHERE d > days OR h > 24 OR mi > 59 OR (h = 24 AND mi > 0)""",
    "refused_stations": f"""WITH {EV}, used AS (SELECT DISTINCT s_suppkey FROM ev JOIN supplier ON CAST(s_suppkey AS VARCHAR) = station_id)
SELECT CAST(s_suppkey AS VARCHAR) AS station_id, CASE WHEN s_suppkey % 5 = 0 OR c_custkey IS NULL
  THEN 'Missing station master rows for station ids' ELSE 'Invalid required station master fields for station ids' END AS reason
FROM used LEFT JOIN customer ON c_custkey = s_suppkey WHERE s_suppkey % 5 = 0 OR s_suppkey % 7 = 0 OR c_custkey IS NULL""",
    "missing_objects": f"""WITH {EV}, days AS (SELECT DISTINCT date FROM ev), wanted AS (
  SELECT date, filename FROM days, (VALUES ('precipitation'), ('max_temperature'), ('min_temperature'), ('max_wind'), ('max_gust'), ('pollen')) f(filename)),
has AS (SELECT DISTINCT date, {_case('event_type', SOURCES)} AS filename FROM ev)
SELECT CAST(date AS VARCHAR) AS snapshot_date, CASE filename WHEN 'pollen' THEN 'pollen.json' ELSE filename || '.csv' END AS filename
FROM wanted ANTI JOIN (SELECT * FROM has WHERE NOT (day(date) % 7 = 3 AND filename = 'max_gust')) h USING (date, filename)""",
    "repeated_codes": f"""WITH {EV}
SELECT DISTINCT CAST(date AS VARCHAR) AS snapshot_date, station_id FROM (
  SELECT date, station_id FROM ev WHERE event_type IN ('click', 'view', 'purchase') GROUP BY date, station_id, event_type HAVING count(*) > 1)""",
    "lenient_texts": f"""SELECT key, CASE WHEN regexp_matches(t, '{NUMBER}') THEN round(TRY_CAST(t AS DOUBLE), 6) END AS number FROM (
  SELECT 'd' || doc_id AS key, text AS t FROM documents UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CAST(o_totalprice AS VARCHAR) FROM orders
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CAST(CAST(o_orderdate AS DATE) AS VARCHAR) FROM orders)""",
    "union_undeclared": f"""WITH {EV} SELECT event_id, station_id, {_date()}, event_type, props, k,
  CASE WHEN day(date) % 2 = 1 THEN value END AS value FROM ev""",
}
