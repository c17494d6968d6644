"""The registered queries as plain SQL over the same tables."""

from __future__ import annotations

_OBS = """CASE WHEN event_id % 97 = 0 THEN 'N/A' WHEN event_id % 89 = 0 THEN 'Air quality'
 ELSE strftime(date_trunc('hour', ts), '%H:%M, %b %d') END"""
_PLACE = "' Region ' || (user_id % 5) || ' ' AS province, '  City ' || (user_id % 20) || ' ' AS city"
_INT = "CAST(CAST(floor(value) AS INTEGER) AS VARCHAR)"
_SCRAPED = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"

FA = f"""fa AS (SELECT {_PLACE}, {_INT} || '*' AS aqi, event_type AS aqi_status,
 CASE WHEN event_id % 3 = 0 THEN 'PM2.5' ELSE 'PM10' END AS main_pollutant,
 CASE WHEN event_id % 11 = 0 THEN '-' ELSE CAST(value AS VARCHAR) || ' µg/m³' END AS concentration,
 CASE WHEN event_id % 4 = 0 THEN 'Rain' ELSE 'Clear Sky' END AS weather,
 CAST(value AS VARCHAR) || '°' AS temperature, {_INT} || '%' AS humidity,
 CAST(value AS VARCHAR) || ' km/h' AS wind_speed,
 CASE WHEN event_id % 2 = 0 THEN 'North' ELSE 'South West' END AS wind_direction,
 'No Alert' AS alert, {_OBS} AS observation_ts, {_SCRAPED} AS scraped_ts
 FROM events WHERE event_type IN ('click', 'view', 'error'))"""

FF = f"""ff AS (SELECT {_PLACE}, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS forecast_ts,
 {_INT} AS aqi, CASE WHEN event_id % 4 = 0 THEN 'Rain' ELSE 'Clear Sky' END AS weather,
 CAST(value AS VARCHAR) || '°' AS temperature,
 CASE WHEN event_id % 13 = 0 THEN '-' ELSE CAST(value AS VARCHAR) || ' km/h' END AS wind_speed,
 {_INT} || '%' AS humidity, {_OBS} AS observation_ts, {_SCRAPED} AS scraped_ts
 FROM events WHERE event_type IN ('purchase', 'signup'))"""


def _trim(x):
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _num(x, kind="DOUBLE"):
    return f"TRY_CAST(regexp_replace({x}, '[^\\d.-]', '', 'g') AS {kind})"


_AT = "TRY_CAST(scraped_ts AS TIMESTAMP)"


def _clean_a(year=f"year({_AT})"):
    return f"try_strptime(observation_ts || ', ' || CAST({year} AS VARCHAR), '%H:%M, %b %d, %Y')"


_USABLE = "NOT (observation_ts = 'N/A' OR starts_with(observation_ts, 'Air'))"
_TEXT_ID = "upper(md5(city || strftime({time}, '%Y-%m-%d %H:%M:%S.%g')))"


def _typed(name, source, time, columns):
    """Rows with the given columns, and of each (city, time) the values that came with the last scrape."""
    listed = ", ".join(f"{expression} AS {column}" for column, expression in columns.items())
    packed = ", ".join(f"{column}: {column}" for column in columns if column not in ("city", time))
    key = _TEXT_ID.format(time=time)
    return f"""{name}0 AS (SELECT {listed} FROM {source} WHERE {_USABLE}),
 {name}_last AS (SELECT city, {time}, arg_max({{{packed}}}, scraped_ts) AS seen FROM {name}0 GROUP BY ALL),
 {name} AS (SELECT {key} AS id, city, {time}, unnest(seen) FROM {name}_last)"""


_PLACES = {c: f"lower({_trim(c)})" for c in ("province", "city")}
SA = f"{FA}, " + _typed("sa", "fa", "event_ts", _PLACES | {
    "event_ts": _clean_a(), "aqi_val": "TRY_CAST(regexp_replace(aqi, '[^\\d]', '', 'g') AS INTEGER)",
    "aqi_status": "aqi_status", "main_pollutant": "main_pollutant", "pollutant_val": _num("concentration"),
    "weather_condition": "weather", "temp_val": _num("temperature"), "humidity_val": _num("humidity", "INTEGER"),
    "wind_val": _num("wind_speed"), "wind_dir": "wind_direction", "alert": "alert", "scraped_ts": _AT})
SF = f"{FF}, " + _typed("sf", "ff", "forecast_ts", _PLACES | {
    "forecast_ts": "TRY_CAST(forecast_ts AS TIMESTAMP)",
    "observation_ts": f"try_strptime(strftime({_AT}, '%Y-%m-%d') || ' ' || split_part(observation_ts, ',', 1), '%Y-%m-%d %H:%M')",
    "aqi_val": "TRY_CAST(aqi AS INTEGER)", "weather_condition": "weather", "temp_val": _num("temperature"),
    "wind_val": _num("wind_speed"), "humidity_val": _num("humidity", "INTEGER"), "scraped_ts": _AT})

BOTH = f"{SA}, {SF}"
PRIOR = "scraped_ts < TIMESTAMP '2024-01-20 00:00:00'"


_SHARED = "province aqi_val weather_condition temp_val humidity_val wind_val scraped_ts".split()
_ACTUAL_ONLY = "aqi_status main_pollutant pollutant_val wind_dir alert".split()


def _folded(name, a, f, first):
    """Both feeds as one list of rows, folded to one row per city and time; side ``first`` wins."""
    second = {"a": "f", "f": "a"}[first]
    shared = ", ".join(f"coalesce(max({c}) FILTER (side = '{first}'), max({c}) FILTER (side = '{second}')) AS {c}" for c in _SHARED)
    only = ", ".join([*(f"max({c}) FILTER (side = 'a') AS {c}" for c in _ACTUAL_ONLY), "max(observation_ts) FILTER (side = 'f') AS observation_ts"])
    return f"""{name} AS (SELECT city, ts, {shared}, {only} FROM (
 SELECT 'a' AS side, event_ts AS ts, * EXCLUDE (id, event_ts) FROM {a}
 UNION ALL BY NAME SELECT 'f' AS side, forecast_ts AS ts, * EXCLUDE (id, forecast_ts) FROM {f})
 WHERE ts IS NOT NULL AND city IS NOT NULL GROUP BY city, ts)"""


def _fact(name, a="sa", f="sf", limit="TIMESTAMP '2020-01-01 00:00:00'"):
    return f"""{_folded(name + '_all', a, f, 'f')},
 {name} AS (SELECT upper(md5(city || strftime(ts, '%Y-%m-%d %H:%M:%S.%f'))) AS id, upper(md5(city)) AS city_id,
 upper(md5(aqi_status)) AS aqi_id, CAST(strftime(ts, '%Y%m%d%H') AS BIGINT) AS date_id, aqi_val AS aqi,
 * EXCLUDE (city, ts, province, aqi_val, aqi_status) FROM {name}_all WHERE ts >= {limit})"""


_PRIOR_SIDES = f"pa AS (SELECT * FROM sa WHERE {PRIOR}), pf AS (SELECT * FROM sf WHERE {PRIOR})"
_INCREMENT = f"""{BOTH}, {_PRIOR_SIDES}, {_fact('prior', 'pa', 'pf')},
 {_fact('delta', limit="(SELECT max(scraped_ts) - INTERVAL 2 DAY FROM prior)")}"""


def _stamps(first, second=None):
    return f"TIMESTAMP '{first}' AS created_at, TIMESTAMP '{second or first}' AS updated_at"


_T1, _T2 = "2024-01-20 07:00:00", "2024-02-01 07:00:00"

_DATE_PARTS = """CAST(strftime(ts, '%Y%m%d%H') AS BIGINT) AS id, ts AS full_date_time, CAST(ts AS DATE) AS full_date,
 year(ts) AS year_val, quarter(ts) AS quarter_val, 'Q' || quarter(ts) AS quarter_name,
 CASE WHEN month(ts) <= 6 THEN 1 ELSE 2 END AS semester_val,
 CASE WHEN month(ts) <= 6 THEN 'S1' ELSE 'S2' END AS semester_name, month(ts) AS month_val,
 monthname(ts) AS month_name, week(ts) AS week_of_year,
 CAST(floor((day(ts) - 1) / 7) + 1 AS INTEGER) AS week_of_month, day(ts) AS day_val,
 dayname(ts) AS day_name, hour(ts) AS hour_val, isodow(ts) >= 6 AS is_weekend"""


def _times(a="sa", f="sf", since=None):
    """The times in either feed; with a bound, those of pairs whose scrape, the forecast's first, is recent."""
    recent = f"WHERE seen >= {since}" if since else ""
    return f"""SELECT DISTINCT ts FROM (
 SELECT ts, coalesce(max(scraped_ts) FILTER (side = 'f'), max(scraped_ts) FILTER (side = 'a')) AS seen FROM (
 SELECT 'a' AS side, city, event_ts AS ts, scraped_ts FROM {a} UNION ALL SELECT 'f', city, forecast_ts, scraped_ts FROM {f})
 WHERE ts IS NOT NULL GROUP BY city, ts) {recent}"""


_ORDERS = """t AS (SELECT *, o_orderdate AS updated_ts FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
 s AS (SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice + 1000 AS o_totalprice, o_orderdate,
 o_orderpriority, TIMESTAMP '2024-01-01' AS updated_ts FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01')"""


def _upsert(changed):
    columns = "o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority updated_ts".split()
    picked = [
        f"CASE WHEN t.o_orderkey IS NULL{' OR s.o_orderkey IS NOT NULL' if c in changed else ''} THEN s.{c} ELSE t.{c} END AS {c}"
        for c in columns
    ]
    return (f"WITH {_ORDERS} SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, {', '.join(picked)} "
            "FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey")


def _unified(name, where="TRUE"):
    """All rows of both feeds, and of each (city, time) the one with the best rank as a text: source, then scrape."""
    actual = {
        "event_ts": _clean_a("2024"), "aqi_status": "aqi_status", "main_pollutant": "main_pollutant", "concentration": "concentration",
        "wind_direction": "wind_direction", "alert": "alert", "data_source": "'aqi_index'"}
    forecast = dict.fromkeys(actual, "NULL") | {"event_ts": "TRY_CAST(forecast_ts AS TIMESTAMP)", "data_source": "'forecast_weather'"}
    common = {
        "city": f"lower({_trim('city')})", "aqi": "TRY_CAST(aqi AS INTEGER)", "weather": "weather", "temp_c": _num("temperature"),
        "humidity_pct": _num("humidity", "INTEGER"), "wind_speed_kmh": _num("wind_speed"), "scraped_ts": _AT}

    def rows(own, source):
        return "SELECT " + ", ".join(f"{e} AS {c}" for c, e in (common | own).items()) + f" FROM {source} WHERE {where}"

    packed = ", ".join(f"{c}: {c}" for c in (common | actual) if c not in ("city", "event_ts"))
    rank = "CAST(data_source = 'aqi_index' AS INTEGER) || strftime(scraped_ts, '%Y-%m-%d %H:%M:%S.%f')"
    return f"""{name}_all AS ({rows(actual, 'fa')} UNION ALL {rows(forecast, 'ff')}),
 {name}_best AS (SELECT city, event_ts, max_by({{{packed}}}, {rank}) AS best FROM {name}_all GROUP BY ALL),
 {name} AS (SELECT {_TEXT_ID.format(time='event_ts')} AS silver_record_id, city, event_ts, unnest(best) FROM {name}_best)"""


_UNIFIED_COLUMNS = ("city event_ts aqi aqi_status main_pollutant concentration weather temp_c humidity_pct "
                    "wind_speed_kmh wind_direction alert scraped_ts data_source").split()


def _unified_merge():
    picked = [
        f"CASE WHEN s.silver_record_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}"
        if c not in ("city", "event_ts") else f"coalesce(t.{c}, s.{c}) AS {c}"
        for c in _UNIFIED_COLUMNS
    ]
    early = "scraped_ts < '2024-01-20'"
    return f"""WITH {FA}, {FF}, {_unified('t0', early)}, {_unified('s0')},
 t AS (SELECT * FROM t0), s AS (SELECT * FROM s0 WHERE silver_record_id IS NOT NULL)
 SELECT coalesce(t.silver_record_id, s.silver_record_id) AS silver_record_id, {', '.join(picked)}
 FROM t FULL OUTER JOIN s ON t.silver_record_id = s.silver_record_id"""


def _compass(angle):
    # The points of the compass, clockwise.
    turned = f"(({angle} + 180) % 360)"
    names = ["North East", "East", "South East", "South", "South West", "West", "North West"]
    cases = " ".join(
        f"WHEN {turned} >= {22.5 + 45 * i} AND {turned} < {67.5 + 45 * i} THEN '{n}'" for i, n in enumerate(names)
    )
    return f"CASE WHEN {turned} >= 337.5 OR {turned} < 22.5 THEN 'North' {cases} END"


# Labels of the weather codes.
_WEATHER = """MAP {'01': 'Clear Sky', '02': 'Few Clouds', '03': 'Scattered Clouds', '04': 'Broken Clouds',
 '09': 'Shower Rain', '10': 'Rain', '11': 'Thunderstorm', '13': 'Snow', '50': 'Mist/Fog'}"""


def _label(code, fallback):
    return f"coalesce({_WEATHER}[{code}], {fallback})"


def _band(x):
    # Upper limits of the bands and their names.
    return f"""CASE WHEN {x} <= 50 THEN 'Good' WHEN {x} <= 100 THEN 'Moderate'
 WHEN {x} <= 150 THEN 'Unhealthy for Sensitive Groups' WHEN {x} <= 200 THEN 'Unhealthy' ELSE 'Very Unhealthy' END"""


def _title(x):
    """Sign by sign: a letter is upper case if the sign before it is no letter."""
    s = f"lower(replace({x}, '-', ' '))"
    sign = (f"CASE WHEN i = 1 OR NOT regexp_matches(substr({s}, i - 1, 1), '\\p{{L}}') "
            f"THEN upper(substr({s}, i, 1)) ELSE substr({s}, i, 1) END")
    return f"array_to_string(list_transform(range(1, length({s}) + 1), lambda i: {sign}), '')"


_MEASURES = """[CAST(value AS VARCHAR) || '°', CASE WHEN event_id % 3 = 0 THEN CAST(value AS VARCHAR) || ' km/h' ELSE 'calm' END,
 CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) || '%', CASE WHEN event_id % 4 = 0 THEN '7° at 3 km/h' ELSE 'none' END]"""
_IS_T = "contains(x, '°')"
_IS_W = "NOT contains(x, '°') AND contains(x, 'km/h')"
_IS_H = "NOT contains(x, '°') AND NOT contains(x, 'km/h') AND contains(x, '%')"

_PAGE = """pg AS (SELECT *, 'Region ' || (nation % 5) AS province_t, 'New City ' || nation AS city_t,
 strftime(date_trunc('hour', ts), '%H:%M, %b %d') AS hour_text, strftime(ts, '%Y-%m-%d %H:%M:%S') AS scraped
 FROM (SELECT c_custkey AS number, c_nationkey AS nation, lower(c_mktsegment) AS status, abs(c_acctbal) AS value,
 TIMESTAMP '2024-01-01' + to_minutes(c_custkey * 37) AS ts FROM customer))"""

_CELLS = f"""{_PAGE}, cells AS (SELECT pg.*, i, number % 7 = 0 AND i = 3 AS bad_hour, number % 9 = 0 AND i = 2 AS bad_metric,
 CASE WHEN i = 0 THEN hour(ts) ELSE (hour(ts) + i * 5) % 24 END AS h FROM pg, range(6) r(i) WHERE number % 13 <> 5),
 dated AS (SELECT *, sum(CASE WHEN h < prev THEN 1 ELSE 0 END) OVER (PARTITION BY number ORDER BY i) AS day_offset FROM
 (SELECT *, lag(h) OVER (PARTITION BY number ORDER BY i) AS prev FROM cells WHERE NOT bad_hour))"""

_SILVER_A = "SELECT id, province, city, event_ts, aqi_val, aqi_status, main_pollutant, pollutant_val, weather_condition, temp_val, humidity_val, wind_val, wind_dir, alert, scraped_ts FROM sa"
def _plain(x):
    """Text with its character references resolved."""
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&middot;", "·"), ("&amp;", "&")):
        x = f"replace({x}, '{name}', '{sign}')"
    return x


_HEADING = """CASE event_id % 7 WHEN 0 THEN 'Air quality near the city centre ' WHEN 1 THEN NULL
 WHEN 2 THEN 'Updated ' || clock ELSE 'Air quality • index • ' || clock || ' Local time ' END"""
_CLOCK = "hour(ts) || CASE WHEN event_id % 2 = 0 THEN ':' ELSE '.' END || lpad(CAST(minute(ts) AS VARCHAR), 2, '0') || ', ' || strftime(ts, '%b %-d')"
_DIM_CITY = "SELECT DISTINCT upper(md5(city)) AS id, city, province, 'Indonesia' AS country FROM"
_DIM_CAT = "SELECT upper(md5(aqi_status)) AS id, aqi_status AS category, min(aqi_val) AS min_val, max(aqi_val) AS max_val FROM"
_LOOKED_UP = f"""{BOTH}, {_folded('merged', 'sa', 'sf', 'a')},
 one AS (SELECT *, ts AS event_ts, aqi_val AS aqi, upper(md5(city || strftime(ts, '%Y-%m-%d %H:%M:%S.%f'))) AS fact_id FROM merged)"""


def _merge_dim(old, new):
    """A state merged with its rebuilt rows, which keep the creation stamp."""
    return f"""SELECT n.* EXCLUDE (created_at, updated_at), coalesce(o.created_at, n.created_at) AS created_at, n.updated_at
 FROM ({new}) n LEFT JOIN ({old}) o ON n.id = o.id
 UNION ALL SELECT o.* FROM ({old}) o WHERE o.id NOT IN (SELECT id FROM ({new}))"""


def _lookup_run(name, a, f, since):
    """A run of the older fact, with categories by bands of the index."""
    return f"""{name}_bands AS (SELECT {_band('aqi_val')} AS category, min(aqi_val) AS low, max(aqi_val) AS high FROM {a}
 WHERE aqi_val IS NOT NULL GROUP BY 1), {_folded(name + '_rows', a, f, 'a')},
 {name} AS (SELECT upper(md5(r.city || strftime(ts, '%Y-%m-%d %H:%M:%S.%f'))) AS fact_id, ts AS event_ts,
 (SELECT any_value(upper(md5(c.city))) FROM {a} c WHERE c.city = r.city) AS city_id, aqi_val AS aqi, upper(md5(b.category)) AS aqi_id,
 weather_condition, temp_val, humidity_val, wind_val, pollutant_val, main_pollutant, wind_dir, alert, scraped_ts AS load_ts, observation_ts
 FROM {name}_rows r LEFT JOIN {name}_bands b ON r.aqi_val BETWEEN b.low AND b.high WHERE ts >= {since})"""


def _lookup_merge():
    kept = ("event_ts", "observation_ts")
    columns = ("event_ts city_id aqi aqi_id weather_condition temp_val humidity_val wind_val pollutant_val main_pollutant "
               "wind_dir alert load_ts observation_ts").split()
    picked = [f"CASE WHEN {'o.fact_id IS NULL' if c in kept else 'n.fact_id IS NOT NULL'} THEN n.{c} ELSE o.{c} END AS {c}" for c in columns]
    return f"""WITH {BOTH}, {_PRIOR_SIDES}, {_lookup_run('o', 'pa', 'pf', "TIMESTAMP '0001-01-01'")},
 {_lookup_run('n', 'sa', 'sf', "TIMESTAMP '2024-01-17'")}
 SELECT coalesce(o.fact_id, n.fact_id) AS fact_id, {', '.join(picked)} FROM o FULL OUTER JOIN n ON o.fact_id = n.fact_id"""


_LOOK_BACK = f"""{FA}, drops AS (SELECT *, CASE WHEN substr(scraped_ts, 15, 2) = '07' OR substr(scraped_ts, 1, 10) > '2024-01-21' THEN 3
 WHEN substr(scraped_ts, 1, 10) < '2024-01-12' THEN 1 ELSE 2 END AS number FROM fa),
 timed AS (SELECT number, lower({_trim('city')}) AS city, {_clean_a()} AS event_ts, {_AT} AS scraped_ts, {_USABLE} AS usable FROM drops),
 first_two AS (SELECT t.*, CASE number WHEN 1 THEN TIMESTAMP '2020-01-01' ELSE
 (SELECT max(scraped_ts) - INTERVAL 2 DAY FROM timed WHERE number = 1 AND usable) END AS bound FROM timed t WHERE number < 3),
 judged AS (SELECT * FROM first_two UNION ALL SELECT t.*,
 (SELECT max(scraped_ts) - INTERVAL 2 DAY FROM first_two WHERE usable AND scraped_ts >= bound) FROM timed t WHERE number = 3)"""

SQL = {
    "stream_lookback": f"""WITH {_LOOK_BACK} SELECT 'merged' AS outcome, city, event_ts, max(scraped_ts) AS scraped_ts,
 NULL::TIMESTAMP AS bound FROM judged WHERE usable AND scraped_ts >= bound GROUP BY city, event_ts
 UNION ALL SELECT 'late', city, NULL, scraped_ts, bound FROM judged WHERE scraped_ts < bound""",
    "silver_actual": f"WITH {SA} {_SILVER_A}",
    "full_refresh": f"WITH {SA} {_SILVER_A}",
    "stream_upsert": f"WITH {SA} {_SILVER_A}",
    "silver_incremental": f"WITH {SA} {_SILVER_A} WHERE id IS NOT NULL",
    "silver_incremental_forecast": f"""WITH {SF} SELECT id, province, city, forecast_ts, observation_ts, aqi_val, weather_condition,
 temp_val, wind_val, humidity_val, scraped_ts FROM sf WHERE id IS NOT NULL""",
    "partitioned_write": f"WITH {SA} SELECT *, city AS p_city, strftime(event_ts, '%Y-%m') AS p_month FROM ({_SILVER_A})",
    "silver_forecast": f"""WITH {SF} SELECT id, province, city, forecast_ts, observation_ts, aqi_val, weather_condition,
 temp_val, wind_val, humidity_val, scraped_ts FROM sf""",
    "silver_rejects": f"""WITH {SA} SELECT count(*) AS total_rows,
 count(*) FILTER (event_ts IS NULL) AS event_ts, count(*) FILTER (aqi_val IS NULL) AS aqi_val,
 count(*) FILTER (pollutant_val IS NULL) AS pollutant_val, count(*) FILTER (temp_val IS NULL) AS temp_val,
 count(*) FILTER (humidity_val IS NULL) AS humidity_val, count(*) FILTER (wind_val IS NULL) AS wind_val FROM sa0""",
    "surrogate_keys": """WITH e AS (SELECT *, 'city ' || (user_id % 20) AS city FROM events)
 SELECT event_id, upper(md5(city)) AS one_part,
 upper(md5(city || strftime(ts, '%Y-%m-%d %H:%M:%S.%g'))) AS two_parts_3,
 upper(md5(city || strftime(ts, '%Y-%m-%d %H:%M:%S.%f'))) AS two_parts_6,
 upper(md5(city || event_type || strftime(ts, '%Y-%m-%d %H:%M:%S.%g'))) AS three_parts,
 upper(md5(city || CASE WHEN event_id % 2 = 0 THEN event_type END)) AS null_part FROM e""",
    "fact_reconciled": f"WITH {BOTH}, {_fact('fact')} SELECT * FROM fact",
    "fact_incremental": f"WITH {_INCREMENT} SELECT * FROM delta",
    "fact_merged": f"WITH {_INCREMENT} SELECT * FROM delta UNION ALL SELECT * FROM prior WHERE id NOT IN (SELECT id FROM delta)",
    "stream_gold": f"WITH {_INCREMENT} SELECT * FROM delta UNION ALL SELECT * FROM prior WHERE id NOT IN (SELECT id FROM delta)",
    "rolling_day": f"""WITH {_LOOKED_UP} SELECT fact_id, province, city, event_ts, aqi, weather_condition, temp_val, humidity_val,
 wind_val, aqi_status, main_pollutant, pollutant_val, wind_dir, alert, observation_ts, scraped_ts
 FROM one WHERE event_ts >= DATE '2024-01-30' - INTERVAL 1 DAY""",
    "dim_city": f"WITH {SA} SELECT *, {_stamps(_T1)} FROM ({_DIM_CITY} sa)",
    "dim_city_incremental": f"WITH {SA} " + _merge_dim(
        f"SELECT *, {_stamps(_T1)} FROM ({_DIM_CITY} sa WHERE scraped_ts < TIMESTAMP '2024-01-01 01:00:00')",
        f"SELECT *, {_stamps(_T2)} FROM ({_DIM_CITY} sa)"),
    "dim_category": f"WITH {SA} SELECT *, {_stamps(_T1)} FROM ({_DIM_CAT} sa GROUP BY aqi_status)",
    "dim_category_incremental": f"WITH {SA} " + _merge_dim(
        f"SELECT *, {_stamps(_T1)} FROM ({_DIM_CAT} sa WHERE {PRIOR} AND aqi_status <> 'view' GROUP BY aqi_status)",
        f"SELECT *, {_stamps(_T2)} FROM ({_DIM_CAT} sa GROUP BY aqi_status)"),
    "dim_city_partials": f"WITH {SA} SELECT *, {_stamps(_T1)} FROM ({_DIM_CITY} sa)",
    "dim_category_partials": f"""WITH {SA}, x AS (SELECT city, event_ts, any_value(aqi_status) AS first_status,
 arg_max(aqi_status, scraped_ts) AS aqi_status, arg_max(aqi_val, scraped_ts) AS aqi_val FROM (
 SELECT city, strftime(event_ts, '%m-%d %H') AS event_ts, aqi_status, scraped_ts, aqi_val FROM sa0
 UNION ALL SELECT city, strftime(event_ts, '%m-%d %H'), aqi_status,
 TRY_CAST('2024-12' || strftime(scraped_ts, '-%d %H:%M:%S.%f') AS TIMESTAMP), 41 FROM sa0 WHERE aqi_val >= 60)
 GROUP BY city, event_ts) SELECT *, {_stamps(_T1)} FROM ({_DIM_CAT} x GROUP BY aqi_status)""",
    "dim_date": f"WITH {BOTH} SELECT {_DATE_PARTS}, {_stamps(_T1)} FROM ({_times()})",
    "dim_date_incremental": f"WITH {BOTH}, {_PRIOR_SIDES} " + _merge_dim(
        f"SELECT {_DATE_PARTS}, {_stamps(_T1)} FROM ({_times('pa', 'pf')})",
        f"SELECT {_DATE_PARTS}, {_stamps(_T2)} FROM ({_times(since='(SELECT max(scraped_ts) - INTERVAL 2 DAY FROM sa)')})"),
    "dim_date_flags": f"""WITH {BOTH} SELECT CAST(strftime(ts, '%Y%m%d%H') AS BIGINT) AS id, ts AS full_date_time,
 CAST(ts AS DATE) = DATE '2024-01-15' AS is_current_day, date_trunc('month', ts) = DATE '2024-01-01' AS is_current_month,
 year(ts) = 2024 AS is_current_year FROM ({_times()})""",
    "upsert_all": _upsert("o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority updated_ts".split()),
    "upsert_partial": _upsert(["o_totalprice", "updated_ts"]),
    "upsert_touch": _upsert(["updated_ts"]),
    "unified_priority": f"WITH {FA}, {FF}, {_unified('u')} SELECT * FROM u",
    "unified_merged": _unified_merge(),
    "insert_values": f"""WITH {FA}, {FF}, {_unified('u')} SELECT silver_record_id, {', '.join(_UNIFIED_COLUMNS)} FROM u UNION ALL SELECT 'test-id-123', 'tangerang',
 TIMESTAMP '2024-02-06 12:00:00', 75, 'Moderate', NULL, NULL, 'Cloudy', 30.5, 80, 15.0, NULL, NULL,
 TIMESTAMP '2024-02-06 12:00:00', 'manual_test'""",
    "union_count": f"""WITH {FA}, {FF} SELECT count(1) AS row_count FROM
 (SELECT city, 'a' AS s FROM fa UNION ALL SELECT city, 'f' FROM ff) WHERE city = '  City 7 '""",
    "range_lookup": """SELECT o_orderkey, o_totalprice, n_name AS band FROM orders LEFT JOIN nation
 ON o_totalprice BETWEEN n_nationkey * 20000 AND n_nationkey * 20000 + 18000""",
    "range_lookup_many": """SELECT o_orderkey, o_totalprice, p_partkey AS band FROM orders LEFT JOIN part
 ON o_totalprice >= CASE p_partkey WHEN 2 THEN 1000 ELSE p_partkey * 40 END
 AND (p_partkey = 1 OR o_totalprice <= CASE p_partkey WHEN 2 THEN 1e9 ELSE p_partkey * 40 + p_size END)""",
    "fact_with_lookups": f"""WITH {_LOOKED_UP}, c AS ({_DIM_CITY} sa), k AS ({_DIM_CAT} sa GROUP BY aqi_status)
 SELECT fact_id, event_ts, c.id AS city_id, aqi, k.id AS aqi_id, weather_condition, temp_val, humidity_val, wind_val,
 pollutant_val, main_pollutant, wind_dir, alert, scraped_ts AS load_ts, observation_ts
 FROM one LEFT JOIN c ON one.city = c.city LEFT JOIN k ON one.aqi BETWEEN k.min_val AND k.max_val""",
    "dim_lookup": f"""WITH {BOTH}, c AS ({_DIM_CITY} sa) SELECT sf.id, sf.city, forecast_ts, c.id AS city_id, c.country
 FROM sf LEFT JOIN c ON sf.city = c.city""",
    "star_integrity": f"""WITH {BOTH}, {_PRIOR_SIDES}, {_fact('fact')},
 d AS (SELECT 'city_id' AS fk, upper(md5(city)) AS key FROM sa UNION SELECT 'aqi_id', upper(md5(aqi_status)) FROM sa
 UNION SELECT 'date_id', strftime(ts, '%Y%m%d%H') FROM ({_times('pa', 'pf')})),
 u AS (SELECT 'city_id' AS fk, city_id AS key FROM fact UNION ALL SELECT 'aqi_id', aqi_id FROM fact
 UNION ALL SELECT 'date_id', CAST(date_id AS VARCHAR) FROM fact)
 SELECT u.fk, count(*) AS total_rows, count(*) FILTER (u.key IS NULL) AS null_rows,
 count(*) FILTER (u.key IS NOT NULL AND d.key IS NULL) AS orphan_rows
 FROM u LEFT JOIN d ON u.fk = d.fk AND u.key = d.key GROUP BY u.fk""",
    "category_band": f"WITH {SA} SELECT id, aqi_val, {_band('(aqi_val * 2)')} AS aqi_category FROM sa",
    # The colours of the categories.
    "category_palette": f"""WITH l AS (SELECT CAST(floor(l_extendedprice / 400) AS INTEGER) AS v FROM lineitem),
 r AS (SELECT {_band('v')} AS category, min(v) AS min_val, max(v) AS max_val FROM l GROUP BY 1)
 SELECT CAST(row_number() OVER (ORDER BY min_val, category) AS INTEGER) AS aqi_range_id, *, CASE category WHEN 'Good' THEN '#00E400' WHEN 'Moderate' THEN '#FFFF00'
 WHEN 'Unhealthy' THEN '#FF0000' WHEN 'Very Unhealthy' THEN '#8F3F97' ELSE '#CCCCCC' END AS color_code FROM r""",
    "point_lookup": f"""WITH {SF} SELECT id, province, city, forecast_ts, observation_ts, aqi_val, weather_condition,
 temp_val, wind_val, humidity_val, scraped_ts FROM sf WHERE city = 'city 3' AND forecast_ts >= TIMESTAMP '2024-01-10'""",
    "hour_rollover": """WITH e AS (SELECT user_id, event_id, ts, CASE WHEN event_id % 50 = 0 THEN hour(ts)
 WHEN event_id % 83 = 0 THEN NULL ELSE (hour(ts) * 7 + event_id) % 24 END AS hour FROM events),
 p AS (SELECT *, lag(hour) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM e WHERE hour IS NOT NULL),
 o AS (SELECT *, CAST(sum(CASE WHEN hour < prev THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id
 ROWS UNBOUNDED PRECEDING) AS INTEGER) AS day_offset FROM p)
 SELECT user_id, event_id, CAST(hour AS INTEGER) AS hour, day_offset,
 strftime(DATE '2024-01-01' + day_offset, '%Y-%m-%d') || ' ' || lpad(CAST(hour AS VARCHAR), 2, '0') || ':00:00' AS forecast_ts FROM o""",
    "first_row_detail": f"""WITH {SF}, n AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY forecast_ts) AS rn FROM sf)
 SELECT city, forecast_ts, CASE WHEN rn = 1 THEN province ELSE '' END AS province,
 CASE WHEN rn = 1 THEN weather_condition ELSE '' END AS weather_condition, aqi_val FROM n""",
    "wind_cardinal": f"""SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'N/A'
 ELSE {_compass('CAST(floor(value * 37) AS INTEGER)')} END AS wind_direction FROM events""",
    "code_lookup": f"""WITH c AS (SELECT event_id, lpad(CAST(event_id % 60 AS VARCHAR), 2, '0') AS code FROM events),
 p AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '/icons/weather-' || code || 'd.svg'
 WHEN 1 THEN '/img/ic-w-' || code || 'n.svg' WHEN 2 THEN '/img/plain' || code || '.svg' WHEN 3 THEN ''
 ELSE '/a/weather-x-weather-' || code || '.svg' END AS path FROM c),
 n AS (SELECT *, split_part(path, '/', -1) AS name FROM p),
 k AS (SELECT *, substr(split_part(name, 'weather-', -1), 1, 2) AS a, string_split(name, '-')[3] AS part FROM n)
 SELECT event_id, CASE WHEN contains(name, 'weather-') THEN {_label('a', "'Unknown (' || a || ')'")} ELSE 'N/A' END AS current_label,
 CASE WHEN path = '' THEN 'Unknown' WHEN part IS NULL THEN 'Error Parsing Code'
 ELSE {_label('substr(part, 1, 2)', "'Code ' || substr(part, 1, 2)")} END AS forecast_label FROM k""",
    "unit_routing": f"""WITH m AS (SELECT event_id, {_MEASURES} AS texts FROM events) SELECT event_id,
 coalesce(list_filter(texts, lambda x: {_IS_T})[-1], 'N/A') AS temperature,
 coalesce(list_filter(texts, lambda x: {_IS_W})[-1], 'N/A') AS wind_speed,
 coalesce(list_filter(texts, lambda x: {_IS_H})[-1], 'N/A') AS humidity FROM m""",
    "unit_routing_rows": f"""WITH m AS (SELECT user_id, event_id, {_MEASURES} AS texts FROM events),
 r AS (SELECT user_id, event_id * 10 + i AS pos, texts[i + 1] AS x FROM m, range(4) t(i)) SELECT user_id,
 coalesce(max_by(x, pos) FILTER ({_IS_T}), 'N/A') AS temperature,
 coalesce(max_by(x, pos) FILTER ({_IS_W}), 'N/A') AS wind_speed,
 coalesce(max_by(x, pos) FILTER ({_IS_H}), 'N/A') AS humidity FROM r GROUP BY user_id""",
    "observation_text": f"""WITH c AS (SELECT event_id, {_CLOCK} AS clock FROM events), h AS (SELECT event_id, {_HEADING} AS heading FROM c)
 SELECT event_id, CASE WHEN heading IS NULL THEN 'N/A'
 WHEN regexp_matches(heading, '\\d{{1,2}}[:.]\\d{{2}},\\s\\w{{3}}\\s\\d{{1,2}}')
 THEN regexp_extract(heading, '(\\d{{1,2}}[:.]\\d{{2}},\\s\\w{{3}}\\s\\d{{1,2}})', 1)
 ELSE trim(right(heading, 15)) END AS observation_ts,
 CASE WHEN contains(coalesce(heading, ''), '•') THEN trim(replace(split_part(heading, '•', -1), 'Local time', '')) ELSE 'N/A' END AS observation_time FROM h""",
    "default_fill": """SELECT event_id, CASE WHEN event_id % 6 = 0 THEN 'N/A' ELSE CAST(value AS VARCHAR) || ' µg/m³' END AS concentration,
 CASE WHEN event_id % 4 = 1 THEN event_type ELSE 'No Alert' END AS alert,
 CASE WHEN event_id % 6 = 0 THEN 'Unknown' ELSE event_type END AS weather,
 CASE WHEN event_id % 6 = 0 THEN '-' ELSE CAST(value AS VARCHAR) END AS wind_speed FROM events""",
    "year_rollover": """WITH o AS (SELECT o_orderkey, o_orderdate, strftime(o_orderdate - INTERVAL 10 DAY, '07:00, %b %d') AS obs FROM orders)
 SELECT o_orderkey, try_strptime(obs || ', ' || year(o_orderdate), '%H:%M, %b %d, %Y') AS event_ts,
 try_strptime(obs || ', ' || (year(o_orderdate) - CASE WHEN month(o_orderdate) = 1 AND contains(obs, 'Dec') THEN 1 ELSE 0 END),
 '%H:%M, %b %d, %Y') AS event_ts_fixed FROM o""",
    "target_list": f"""WITH l AS (SELECT 'west-' || lower(c_mktsegment) AS p, lower(replace(c_name, '#', '_d''arc-3rd')) || '-' || i AS c
 FROM customer, range(1, 4) r(i)) SELECT p AS province_slug, c AS city_slug, {_title('p')} AS province, {_title('c')} AS city,
 'https://example.org/' || p || '/' || c AS url FROM l""",
    "topn_recent": f"WITH {SA} {_SILVER_A} WHERE event_ts IS NOT NULL ORDER BY event_ts DESC, city LIMIT 10",
    "pages_extract": f"""SELECT page_id, url, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
 trim({_plain("regexp_extract(html, '<title>([^<]*)</title>', 1)")}) AS title,
 CASE WHEN page_id % 3 = 0 THEN 'Indonesia' ELSE 'Land ' || (page_id % 3) END AS country,
 trim(replace({_plain("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")}, 'Air quality in ', '')) AS city_named FROM pages""",
    "pages_extract_items": """SELECT page_id, CAST(i AS INTEGER) AS pos,
 regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1)[i + 1] AS href,
 trim(regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2)[i + 1]) AS label
 FROM pages, LATERAL (SELECT unnest(range(len(regexp_extract_all(html, '<li>')))) AS i)""",
    "current_extract": f"""WITH {_PAGE} SELECT province_t AS province, city_t AS city,
 CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) || '*' AS aqi, status AS aqi_status, 'PM2.5' AS main_pollutant,
 CAST(value AS VARCHAR) || ' µg/m³' AS concentration,
 CASE WHEN number % 5 = 0 THEN 'N/A' ELSE {_label("lpad(CAST(number % 14 AS VARCHAR), 2, '0')", "'Unknown (' || lpad(CAST(number % 14 AS VARCHAR), 2, '0') || ')'")} END AS weather,
 CASE WHEN number % 5 = 0 THEN 'N/A' ELSE CAST(value AS VARCHAR) || '°' END AS temperature,
 CASE WHEN number % 5 = 0 THEN 'N/A' ELSE CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) || '%' END AS humidity,
 CASE WHEN number % 5 = 0 THEN 'N/A' ELSE CAST(value AS VARCHAR) || ' km/h' END AS wind_speed,
 CASE WHEN number % 5 = 0 THEN 'N/A' ELSE {_compass('CAST(floor(value * 7) AS INTEGER) % 360')} END AS wind_direction,
 CASE WHEN number % 3 = 0 THEN 'No Alert' ELSE 'Alert & ' || status END AS alert,
 hour_text AS observation_ts, scraped AS scraped_ts FROM pg WHERE number % 11 <> 5""",
    "forecast_extract": f"""WITH {_CELLS} SELECT province_t AS province, city_t AS city,
 strftime(CAST(ts AS DATE) + CAST(day_offset AS INTEGER), '%Y-%m-%d') || ' ' || lpad(CAST(h AS VARCHAR), 2, '0') || ':00:00' AS forecast_ts,
 CAST(CAST(floor(value) AS INTEGER) + i AS VARCHAR) AS aqi,
 {_label("lpad(CAST((number + i) % 14 AS VARCHAR), 2, '0')", "'Code ' || lpad(CAST((number + i) % 14 AS VARCHAR), 2, '0')")} AS weather,
 CAST(value AS VARCHAR) || '°' AS temperature, CAST(value AS VARCHAR) || ' km/h' AS wind_speed, (i * 10) || '%' AS humidity,
 hour_text AS observation_ts, scraped AS scraped_ts FROM dated WHERE NOT bad_metric""",
    "forecast_quarantine": f"""WITH {_CELLS} SELECT 'new-city-' || nation AS city, ts AS fetched_ts, CAST(i AS INTEGER) AS pos,
 CASE WHEN bad_hour THEN '--' ELSE lpad(CAST(h AS VARCHAR), 2, '0') || ':00' END AS clock,
 CASE WHEN bad_hour THEN 'unreadable hour' ELSE 'metric without a value' END AS error FROM cells WHERE bad_hour OR bad_metric""",
    "load_counts": f"""WITH {_PAGE}, b AS (SELECT number % 11 = 5 AS bad_c, number % 13 = 5 AS bad_f, number FROM pg),
 c AS (SELECT count(*) AS cells, count(*) FILTER (number % 7 = 0 AND i = 3) AS hours,
 count(*) FILTER (number % 9 = 0 AND i = 2) AS metrics FROM b, range(6) r(i) WHERE NOT bad_f),
 p AS (SELECT count(*) AS n, count(*) FILTER (bad_c) + count(*) FILTER (bad_f) AS bad FROM b)
 SELECT unnest(['pages', 'current_read', 'current_rejected', 'forecast_rejected', 'cells_read', 'cells_unreadable_hour',
 'cells_metric_without_value', 'cells_other', 'raw_aqi_index', 'raw_weather_forecast', 'page_quarantine']) AS outcome,
 unnest([2 * n, 2 * n - bad, bad, bad, cells - hours - metrics, hours, metrics, 0, 2 * n - bad, cells - hours - metrics, 2 * bad]) AS n
 FROM p, c""",
    "bronze_append_evolve": f"""WITH {FA} SELECT *, count(*) OVER () AS rows_added FROM fa
 UNION ALL SELECT NULL AS province, * EXCLUDE (province), count(*) OVER () FROM fa""",
    "layout_by_day": f"WITH {SA} SELECT *, CAST(event_ts AS DATE) AS p_day FROM ({_SILVER_A})",
    "layout_by_year": f"""WITH {BOTH} SELECT id, full_date_time, year_val, CAST(year_val AS INTEGER) AS p_year
 FROM (SELECT {_DATE_PARTS} FROM ({_times()}))""",
    "stored_lookup": f"""WITH {SF} SELECT id, province, city, forecast_ts, observation_ts, aqi_val, weather_condition,
 temp_val, wind_val, humidity_val, scraped_ts FROM sf WHERE city = 'city 3' AND forecast_ts >= TIMESTAMP '2024-01-10'""",
    "stored_lookup_by_id": f"""WITH {SF} SELECT id, province, city, forecast_ts, observation_ts, aqi_val, weather_condition,
 temp_val, wind_val, humidity_val, scraped_ts FROM sf
 WHERE city = 'city 3' AND forecast_ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12'""",
    "insert_stored": "SELECT r_regionkey, r_name FROM region UNION ALL SELECT 99, 'ADDED'",
    "silver_partial_merge": f"""WITH {SA} SELECT * REPLACE (CASE WHEN {PRIOR} THEN 'old' ELSE province END AS province)
 FROM ({_SILVER_A}) WHERE id IS NOT NULL""",
    "csv_roundtrip": r"""SELECT * REPLACE (CASE c_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN NULL
 WHEN 2 THEN ' two' || chr(10) || 'lines' || chr(13) || chr(10) || c_name WHEN 3 THEN 'say "x", \n\b' ELSE c_mktsegment END AS c_mktsegment)
 FROM customer""",
    "evolve_types": """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_size::DOUBLE WHEN 1 THEN (p_size + 3000000000)::DOUBLE
 ELSE p_retailprice END AS value, CASE WHEN p_partkey % 3 = 1 THEN 'second' END AS note FROM part""",
    "fact_bucketed": f"WITH {BOTH}, {_fact('fact')} SELECT * FROM fact",
    "upsert_bucketed": _upsert("o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority updated_ts".split()),
    "fact_lookup_merge": _lookup_merge(),
    "silver_forecast_merge": f"""WITH {SF} SELECT id, CASE WHEN {PRIOR} THEN 'old' ELSE province END AS province, city, forecast_ts,
 observation_ts, aqi_val, weather_condition, temp_val, wind_val, humidity_val, scraped_ts FROM sf WHERE id IS NOT NULL""",
    "ensure_table": "SELECT * FROM customer",
    "page_quarantine": f"""WITH {_PAGE} SELECT 'current' AS feed, * FROM (SELECT 'region-' || (nation % 5) AS province,
 'new-city-' || nation AS city, ts AS fetched_ts, 'AssertionError' AS error FROM pg WHERE number % 11 = 5)
 UNION ALL SELECT 'forecast', 'region-' || (nation % 5), 'new-city-' || nation, ts, 'AssertionError' FROM pg WHERE number % 13 = 5""",
    "catalog_scan": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, min({k})::BIGINT AS min_key, max({k})::BIGINT AS max_key, count({c}) AS filled FROM {t}"
        for t, k, c in (
            ("region", "r_regionkey", "r_name"), ("nation", "n_nationkey", "n_name"), ("customer", "c_custkey", "c_acctbal"),
            ("supplier", "s_suppkey", "s_acctbal"), ("part", "p_partkey", "p_retailprice"), ("orders", "o_orderkey", "o_orderdate"),
            ("lineitem", "l_orderkey", "l_shipdate"), ("events", "event_id", "ts"), ("documents", "doc_id", "source"),
            ("embeddings", "vec_id", "label"), ("pages", "page_id", "url"), ("benchmark", "item_id", "text"),
            ("labels", "doc_id", "quality"), ("conversations", "conv_id", "turn"))
    ),
    "build_dimension": """SELECT upper(md5(p_brand || p_type)) AS id, p_brand, p_type, min(p_size) AS min_size,
 max(p_size) AS max_size, max(p_retailprice) AS top_price FROM part GROUP BY p_brand, p_type""",
}
SQL["pages_loaded"] = SQL["forecast_extract"]
