"""SQL counterparts of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

from suite.derive import AS_OF, EVENT_FEED, FLAG_FEED, SPLIT, WEATHER_RANGE
from wattspan.functions.comfort import WIND_TO_MPH
from wattspan.schema import METERS, SCALED_FEATURES, WEATHER_VARS

KW = "DECIMAL(18,2)"
SQL: dict[str, str] = {}


def case(column: str, mapping: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {column} {arms} END"


def band_of(ts: str) -> str:
    return (
        f"CAST(CASE WHEN hour({ts}) < 9 THEN 1 WHEN hour({ts}) < 19 THEN 2 "
        f"WHEN hour({ts}) >= 19 THEN 3 END AS INTEGER)"
    )


def sun0(ts: str) -> str:
    return f"CAST(dayofweek({ts}) AS INTEGER)"


# Common table expressions ---------------------------------------------------------

RAW = f"""raw AS (
  SELECT {case('event_type', EVENT_FEED)} AS feed, event_id AS seq,
         time_bucket(INTERVAL 15 MINUTE, ts) AS ts, CAST(value AS {KW}) AS kilowatt
  FROM events)"""


def feeds_cte(site: bool = False) -> str:
    k = "site, " if site else ""
    own = "user_id AS site, " if site else ""
    slots = (
        """SELECT DISTINCT user_id AS site,
         unnest([date_trunc('hour', ts), time_bucket(INTERVAL 15 MINUTE, ts)]) AS ts FROM events"""
        if site
        else """SELECT unnest(generate_series(date_trunc('hour', min(ts)), max(ts),
         INTERVAL 15 MINUTE)) AS ts FROM events"""
    )
    return f"""slots AS ({slots}),
steps AS (
  SELECT {own}{case('event_type', EVENT_FEED)} AS feed,
         time_bucket(INTERVAL 15 MINUTE, ts) AS ts, CAST(value AS {KW}) AS amount FROM events
  UNION ALL SELECT {k}'building', ts, 0 FROM slots
  UNION ALL SELECT {k}'data_center', ts, 0 FROM slots),
amounts AS (SELECT {k}feed, ts, sum(amount) AS amount FROM steps GROUP BY ALL),
feeds AS (
  SELECT {k}feed, ts, CAST(sum(amount) OVER (PARTITION BY {k}feed ORDER BY ts) AS {KW}) AS kilowatt
  FROM amounts)"""


LONG = f"""amounts AS (
  SELECT {case('l_returnflag', FLAG_FEED)} AS feed, l_shipdate AS ts,
         sum(CAST(l_quantity AS {KW})) AS amount FROM lineitem GROUP BY ALL),
feeds AS (
  SELECT feed, ts, CAST(sum(amount) OVER (PARTITION BY feed ORDER BY ts) AS {KW}) AS kilowatt
  FROM amounts)"""


def value_of(feed: str) -> str:
    return f"coalesce(max(kilowatt) FILTER (feed = '{feed}'), 0)"


def readings_cte(site: bool = False, feeds: str = "feeds", name: str = "readings") -> str:
    """Times that both needed feeds report, by one pass over all feeds."""
    k = "site, " if site else ""
    columns = ", ".join(f"CAST({value_of(f)} AS {KW}) AS {f}" for f in METERS[:3])
    return f"""{name}_wide AS (
  SELECT {k}ts, {columns}, list(feed) AS reported FROM {feeds} GROUP BY ALL),
{name} AS (
  SELECT {k}ts, building, data_center, solar,
         CAST(building + solar - data_center AS {KW}) AS office,
         {band_of('ts')} AS band, {sun0('ts')} AS dow
  FROM {name}_wide WHERE list_has_all(reported, ['building', 'data_center']))"""


FEEDS = feeds_cte()
READINGS = f"{FEEDS}, {readings_cte()}"
SITE_READINGS = f"{feeds_cte(True)}, {readings_cte(True)}"
LONG_READINGS = f"{LONG}, {readings_cte()}"

DELTAS = ", ".join(f"CAST(arg_max({m}, ts) - arg_min({m}, ts) AS {KW}) AS {m}" for m in METERS)


def delta_sql(grain: str, site: bool = False, source: str = "readings") -> str:
    k = "site, " if site else ""
    if grain == "band":
        return (
            f"SELECT {k}CAST(ts AS DATE) AS day, band, {DELTAS}, dow FROM {source} "
            f"GROUP BY {k}CAST(ts AS DATE), band, dow"
        )
    bucket = f"date_trunc('{grain}', ts)"
    dow = f", {sun0(f'min({source}.ts)')} AS dow" if grain in ("hour", "day") else ""
    return (
        f"SELECT {k}CAST({bucket} AS TIMESTAMP) AS ts, {DELTAS}{dow} "
        f"FROM {source} GROUP BY {k}{bucket}"
    )


KEPT = (
    "WHERE NOT (building IS NULL OR data_center IS NULL OR office IS NULL) "
    "AND NOT (building = 0 AND data_center = 0 AND office = 0)"
)


def table_cte(grain: str, name: str | None = None, site: bool = False) -> str:
    name = name or grain
    return f"{name}_all AS ({delta_sql(grain, site)}), {name} AS (SELECT * FROM {name}_all {KEPT})"


WEATHER = """per_hour AS (
  SELECT date_trunc('hour', ts) AS ts, count(*) AS n,
         CAST(sum(CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT)) AS BIGINT) AS k
  FROM events GROUP BY 1),
weather AS (SELECT CAST(ts AS TIMESTAMP) AS ts, """ + ", ".join(
    f"CAST((k * {i + 1} + n * 7) % {m} + ({o}) AS DOUBLE) AS {v}"
    for i, (v, (m, o)) in enumerate(zip(WEATHER_VARS, WEATHER_RANGE))
) + " FROM per_hour)"

MEANS = ", ".join(f"avg({v}) AS {v}" for v in WEATHER_VARS)


def stored(v: str) -> str:
    """Mean of whole numbers, rounded half away from zero to hundredths in whole-number steps."""
    s = f"CAST(sum({v}) AS BIGINT)"
    return (
        f"CAST(CAST(sign({s}) * ((200 * abs({s}) + count(*)) // (2 * count(*))) AS DECIMAL(15,0)) "
        f"* CAST(0.01 AS DECIMAL(3,2)) AS {KW}) AS {v}"
    )


STORED = ", ".join(stored(v) for v in WEATHER_VARS)
ROUNDED = ", ".join(f"CAST({v} AS {KW}) AS {v}" for v in WEATHER_VARS)
VARS = ", ".join(WEATHER_VARS)


def resample_sql(grain: str) -> str:
    band = f"max({band_of('ts')}) AS band, " if grain == "hour" else ""
    return f"""WITH {WEATHER}, means AS (
  SELECT date_trunc('{grain}', weather.ts) AS bin, {band}{MEANS} FROM weather GROUP BY 1),
spine AS (SELECT unnest(generate_series(CAST(date_trunc('{grain}', min(ts)) AS TIMESTAMP),
  CAST(date_trunc('{grain}', max(ts)) AS TIMESTAMP), INTERVAL 1 {grain.upper()})) AS ts FROM weather)
SELECT spine.ts, means.* EXCLUDE (bin) FROM spine LEFT JOIN means ON spine.ts = means.bin"""


# Sources and sinks ----------------------------------------------------------------

SQL["scan_feed"] = f"WITH {RAW} SELECT feed, ts, kilowatt FROM raw"
SQL["sink_roundtrip"] = f"""WITH {RAW}
SELECT feed, CAST(ts AS DATE) AS day, count(*) AS n, CAST(sum(kilowatt) AS DECIMAL(18,2)) AS total
FROM raw GROUP BY 1, 2"""
SQL["select_year"] = f"""WITH {LONG_READINGS}
SELECT * FROM readings WHERE extract(year FROM ts) = 1998"""
SQL["load_window"] = f"""WITH {RAW}
SELECT feed, min(ts) AS start, max(ts) AS "end", (SELECT min(ts) FROM raw) AS log_start,
       (SELECT max(ts) FROM raw) AS log_end FROM raw GROUP BY feed"""
SQL["weather_explode"] = f"""WITH {WEATHER}, days AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM weather),
axis AS (SELECT unnest(generate_series(CAST(day AS TIMESTAMP), day + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS ts FROM days)
SELECT axis.ts, {VARS} FROM axis LEFT JOIN weather ON axis.ts = weather.ts"""
SQL["forecast_window"] = f"""WITH {WEATHER} SELECT * FROM weather
WHERE ts >= TIMESTAMP '{AS_OF} 00:00:00' AND ts < TIMESTAMP '{AS_OF} 00:00:00' + INTERVAL 15 DAY"""
SQL["archive_window"] = f"""WITH {WEATHER} SELECT * FROM weather
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'"""
SQL["ramp_feed"] = f"""WITH {RAW}, spans AS (SELECT feed, min(ts) AS lo, max(ts) AS hi FROM raw GROUP BY 1),
steps AS (SELECT feed, lo, unnest(generate_series(lo, hi, INTERVAL 5 MINUTE)) AS ts FROM spans)
SELECT feed, ts, CAST(100000 + date_diff('minute', lo, ts) // 5 * CAST(0.41 AS DECIMAL(4,2)) AS {KW}) AS kilowatt
FROM steps"""

# Cleaning -------------------------------------------------------------------------

SQL["align_feeds"] = f"""WITH {RAW}, ends AS (SELECT max(ts) AS last FROM raw GROUP BY feed)
SELECT feed, seq, ts, kilowatt FROM raw WHERE ts <= (SELECT min(last) FROM ends)"""
FIRSTS = """SELECT feed, seq, ts, kilowatt FROM raw
QUALIFY row_number() OVER (PARTITION BY feed, ts ORDER BY seq) = 1"""
SQL["dedup_feed"] = f"WITH {RAW} {FIRSTS}"
SQL["incremental_feed"] = f"""WITH {FEEDS} SELECT feed, ts, kilowatt FROM feeds
WHERE ts > (SELECT max(ts) FROM feeds WHERE ts < TIMESTAMP '{SPLIT}')"""
SQL["insert_ignore"] = f"""WITH {FEEDS},
target AS (SELECT * FROM feeds WHERE ts < TIMESTAMP '{SPLIT}'),
batch AS (SELECT feed, ts, CAST(kilowatt + 1 AS {KW}) AS kilowatt FROM feeds
          WHERE ts >= TIMESTAMP '2024-01-19 00:00:00')
SELECT feed, ts, kilowatt FROM target UNION ALL
SELECT feed, ts, kilowatt FROM batch b WHERE NOT EXISTS (
  SELECT 1 FROM target t WHERE t.feed = b.feed AND t.ts = b.ts)"""

# Readings -------------------------------------------------------------------------

SQL["office_load"] = f"""WITH {FEEDS}, signed AS (
  SELECT ts, kilowatt FROM feeds WHERE feed <> 'data_center'
  UNION ALL SELECT ts, -kilowatt FROM feeds WHERE feed = 'data_center')
SELECT ts, CAST(sum(kilowatt) AS {KW}) AS kilowatt FROM signed GROUP BY ts"""
SQL["join_readings"] = f"WITH {READINGS} SELECT * FROM readings"
DEDUPED = f"""{RAW}, feeds AS (SELECT feed, ts, kilowatt FROM raw
  QUALIFY row_number() OVER (PARTITION BY feed, ts ORDER BY seq) = 1)"""
SQL["raw_readings"] = f"WITH {DEDUPED}, {readings_cte()} SELECT * FROM readings"
SQL["feed_roundtrip"] = f"WITH {DEDUPED} SELECT * FROM feeds"
SQL["time_band"] = f"""SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, {band_of('ts')} AS band FROM events"""
SQL["calendar_parts"] = f"""SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
  CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour, {sun0('ts')} AS dow_sun0,
  CAST(isodow(ts) - 1 AS INTEGER) AS dow_mon0,
  concat(year(ts), '-', month(ts), '-', day(ts)) AS date_text, strftime(ts, '%Y-%m') AS month_text
FROM events"""

# Buckets --------------------------------------------------------------------------

SQL["delta_hour"] = f"WITH {READINGS} {delta_sql('hour')}"
SQL["delta_day"] = f"WITH {READINGS} {delta_sql('day')}"
SQL["delta_band"] = f"WITH {READINGS} {delta_sql('band')}"
SQL["delta_rollup"] = SQL["delta_day"]


SQL["delta_month"] = f"WITH {LONG_READINGS} {delta_sql('month')}"
SQL["delta_year"] = f"WITH {LONG_READINGS} {delta_sql('year')}"
ENDS = ", ".join(
    f"CAST(sum(CASE WHEN left_over = 1 THEN {m} ELSE 0 END) - "
    f"sum(CASE WHEN nth = 1 THEN {m} ELSE 0 END) AS {KW}) AS {m}"
    for m in METERS
)
SQL["delta_hour_window"] = f"""WITH {READINGS}, numbered AS (
  SELECT *, time_bucket(INTERVAL 1 HOUR, ts) AS slot,
         row_number() OVER (PARTITION BY time_bucket(INTERVAL 1 HOUR, ts) ORDER BY ts) AS nth,
         row_number() OVER (PARTITION BY time_bucket(INTERVAL 1 HOUR, ts) ORDER BY ts DESC) AS left_over
  FROM readings)
SELECT slot AS ts, {ENDS}, any_value(dow) AS dow FROM numbered GROUP BY slot"""
SQL["drop_empty"] = f"WITH {READINGS}, {table_cte('hour')} SELECT * FROM hour"


def edges_sql(*period: str) -> str:
    """First and last reading of every period, taken whole."""
    whole = "{'ts': ts, 'building': building, 'data_center': data_center, 'solar': solar, "
    whole += "'office': office, 'band': band, 'dow': dow}"
    columns = ", ".join(f"reading.{c} AS {c}" for c in ("ts", *METERS, "band", "dow"))
    return f""", ends AS (
  SELECT arg_min({whole}, ts) AS opening, arg_max({whole}, ts) AS closing
  FROM readings GROUP BY {', '.join(period)}),
sides AS (
  SELECT 'first' AS edge, opening AS reading FROM ends
  UNION ALL SELECT 'last', closing FROM ends)
SELECT {columns}, edge FROM sides"""


SQL["semi_first_last"] = f"WITH {LONG_READINGS}{edges_sql('year(ts)', 'month(ts)')}"
SQL["semi_first_last_band"] = f"WITH {READINGS}{edges_sql('CAST(ts AS DATE)', 'band')}"
SQL["band_sorted"] = f"WITH {READINGS}, {table_cte('band')} SELECT * FROM band ORDER BY day, band"
SQL["head_rows"] = f"WITH {READINGS}, {table_cte('band')} SELECT * FROM band ORDER BY day, band LIMIT 5"
SQL["site_readings_joined"] = f"WITH {SITE_READINGS} SELECT * FROM readings"
SQL["site_delta_hour"] = f"WITH {SITE_READINGS}, {table_cte('hour', site=True)} SELECT * FROM hour"
SQL["site_delta_band"] = f"WITH {SITE_READINGS}, {table_cte('band', site=True)} SELECT * FROM band"

# Weather --------------------------------------------------------------------------

for grain in ("hour", "day", "month", "year"):
    SQL[f"weather_{grain}"] = resample_sql(grain)

LAST_OF_BAND = f"""SELECT CAST(ts AS DATE) AS day, {band_of('ts')} AS band, {{columns}} FROM weather
QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE), {band_of('ts')} ORDER BY ts DESC) = 1"""
SQL["weather_band_last"] = f"WITH {WEATHER} {LAST_OF_BAND.format(columns=VARS)}"
SQL["weather_band_mean"] = f"""WITH {WEATHER}
SELECT CAST(ts AS DATE) AS day, {band_of('ts')} AS band, {MEANS} FROM weather GROUP BY 1, 2"""

# Hours without weather between the first and the last are bins of their own.
HOUR_WITH_WEATHER = f"""spine AS (
  SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM {{weather}}),
bins AS (SELECT spine.ts, {band_of('x.ts')} AS band, {VARS}
         FROM spine LEFT JOIN {{weather}} x ON spine.ts = x.ts),
agg_hour AS (
  SELECT coalesce(h.ts, w.ts) AS ts, building, data_center, solar, office, dow,
         band, {ROUNDED}
  FROM {{table}} h FULL OUTER JOIN bins w ON h.ts = w.ts)"""
FULL_HOUR = f"{READINGS}, {table_cte('hour')}, {WEATHER}, " + HOUR_WITH_WEATHER.format(
    table="hour", weather="weather"
)
SQL["merge_weather"] = f"""WITH {READINGS}, {table_cte('hour')}, {WEATHER},
later AS (SELECT * REPLACE (ts + INTERVAL 2 DAY AS ts) FROM weather),
{HOUR_WITH_WEATHER.format(table='hour', weather='later')} SELECT * FROM agg_hour"""
BAND_WITH_WEATHER = f"""{READINGS}, {table_cte('band')}, {WEATHER},
band_weather AS ({LAST_OF_BAND.format(columns=ROUNDED)}),
agg_band AS (SELECT coalesce(b.day, w.day) AS day, coalesce(b.band, w.band) AS band,
  building, data_center, solar, office, dow, {VARS}
  FROM band b FULL OUTER JOIN band_weather w ON b.day = w.day AND b.band = w.band)"""
SQL["merge_weather_band"] = f"WITH {BAND_WITH_WEATHER} SELECT * FROM agg_band"
SQL["merge_weather_day"] = f"""WITH {READINGS}, {table_cte('day')}, {WEATHER},
day_weather AS (SELECT CAST(date_trunc('day', weather.ts) AS TIMESTAMP) AS at, {STORED} FROM weather GROUP BY 1)
SELECT coalesce(day.ts, w.at) AS ts, building, data_center, solar, office, dow, {VARS}
FROM day FULL OUTER JOIN day_weather w ON day.ts = w.at"""

T, RH, MPH = "t", "rh", "mph"
COMFORT = f"""units AS (
  SELECT *, CAST(temperature_2m AS DOUBLE) * 9 / 5 + 32 AS t, CAST(relative_humidity_2m AS DOUBLE) AS rh,
         CAST(wind_speed_10m AS DOUBLE) * CAST({WIND_TO_MPH} AS DOUBLE) AS mph FROM {{source}}),
terms AS (
  SELECT *, 0.5 * (t + 61 + (t - 68) * 1.2 + rh * 0.094) AS simple,
    CAST(-42.379 AS DOUBLE) + 2.04901523 * t + 10.14333127 * rh - 0.22475541 * t * rh
      - 0.00683783 * t * t - 0.05481717 * rh * rh + 0.00122874 * t * t * rh
      + 0.00085282 * t * rh * rh - 0.00000199 * t * t * rh * rh AS regression FROM units),
indices AS (
  SELECT * EXCLUDE (t, rh, mph, simple, regression),
    CASE WHEN NOT (t >= 80 AND rh >= 40) THEN t
         WHEN (simple + t) / 2 < 80 THEN simple
         WHEN rh < 13 AND t BETWEEN 80 AND 112
           THEN regression - (13 - rh) / 4 * sqrt((17 - abs(t - 95)) / 17)
         WHEN rh > 85 AND t BETWEEN 80 AND 87 THEN regression + (rh - 85) / 10 * (87 - t) / 5
         ELSE regression END AS heat_index,
    CASE WHEN t <= 50 AND mph >= 3
         THEN 35.74 + 0.6215 * t - 35.75 * pow(mph, 0.16) + 0.4275 * t * pow(mph, 0.16)
         ELSE t END AS wind_chill FROM terms)"""
SQL["weather_indices"] = f"""WITH {WEATHER}, {COMFORT.format(source='weather')}
SELECT ts, round(heat_index, 6) AS heat_index, round(wind_chill, 6) AS wind_chill FROM indices"""
SQL["cyclical"] = f"""WITH {WEATHER}
SELECT ts, round(sin(2 * pi() * hour(ts) / 24), 6) + 0.0 AS hour_sin,
       round(cos(2 * pi() * hour(ts) / 24), 6) + 0.0 AS hour_cos FROM weather"""

# Remote work ----------------------------------------------------------------------


def threshold_cte(site: bool = False) -> str:
    k = "site, " if site else ""
    group = "GROUP BY site" if site else ""
    return f"""means AS (
  SELECT {k}avg(abs(office)) FILTER (WHERE dow IN (0, 6)) AS weekend_mean,
         avg(abs(office)) FILTER (WHERE dow NOT IN (0, 6)) AS workday_mean
  FROM band WHERE band = 2 AND office IS NOT NULL AND office <> 0 {group}),
limits AS (SELECT *, weekend_mean + (workday_mean - weekend_mean) / 57 * 10 AS threshold FROM means)"""


def flags_cte(site: bool = False) -> str:
    k = "b.site, " if site else ""
    link = "LEFT JOIN limits l ON b.site = l.site" if site else "CROSS JOIN limits l"
    workday = "b.band = 2 AND b.dow NOT IN (0, 6)"
    return f"""flags AS (
  SELECT {k}b.day, b.band, CASE WHEN {workday} AND b.office > l.threshold THEN 'KO'
         WHEN {workday} AND b.office < l.threshold THEN 'OK' ELSE 'NA' END AS remote_flag
  FROM band b {link} WHERE b.office IS NOT NULL AND b.office <> 0)"""


BANDS = f"{READINGS}, {table_cte('band')}, {threshold_cte()}, {flags_cte()}"
DAYS = f"""{BANDS}, {table_cte('day')}, flagged AS (
  SELECT day.*, f.remote_flag FROM day LEFT JOIN flags f ON f.band = 2 AND CAST(f.day AS TIMESTAMP) = day.ts)"""
SQL["remote_threshold"] = f"""WITH {READINGS}, {table_cte('band')}, {threshold_cte()}
SELECT round(weekend_mean, 6) AS weekend_mean, round(workday_mean, 6) AS workday_mean,
       round(threshold, 6) AS threshold FROM limits"""
SQL["remote_days"] = f"WITH {DAYS} SELECT * FROM flagged"
SQL["remote_bands"] = f"""WITH {BANDS} SELECT band.*, f.remote_flag FROM band
LEFT JOIN flags f ON f.day = band.day AND f.band = band.band"""
SQL["remote_counts"] = f"WITH {DAYS} SELECT remote_flag, count(*) AS days FROM flagged GROUP BY 1"


def share_sql(grain: str, period: str) -> str:
    return f"""WITH {DAYS}, {table_cte(grain)}, share AS (
  SELECT {period.format('ts')} AS period, CAST(CAST(round(100.0 * count(*) FILTER (WHERE remote_flag = 'OK')
    / count(*), 2) AS DECIMAL(10,2)) AS VARCHAR) || '%' AS remote_pct
  FROM flagged WHERE remote_flag IN ('OK', 'KO') GROUP BY 1)
SELECT t.*, s.remote_pct FROM {grain} t LEFT JOIN share s ON s.period = {period.format('t.ts')}"""


SQL["remote_pct_month"] = share_sql("month", "strftime({}, '%Y-%m')")
SQL["remote_pct_year"] = share_sql("year", "year({})")
SQL["site_remote_days"] = f"""WITH {SITE_READINGS}, {table_cte('band', site=True)}, {threshold_cte(True)},
{flags_cte(True)} SELECT * FROM flags"""

# Features and statistics ----------------------------------------------------------

ALL_HOUR = ["ts", "building", "data_center", "solar", "office", "dow", "band", *WEATHER_VARS]
COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in ALL_HOUR)
FEATURE_CTE = f"""{FULL_HOUR}, usable AS (SELECT * FROM agg_hour WHERE {COMPLETE} AND solar <> 0),
{COMFORT.format(source='usable')}"""
CALENDAR = """CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
  CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS dow"""
FEATURE_COLUMNS = ", ".join(
    f"round({c}, 6) AS {c}" if c in ("heat_index", "wind_chill") else f"CAST({c} AS DOUBLE) AS {c}"
    for c in SCALED_FEATURES
)
SQL["feature_rows"] = f"""WITH {FEATURE_CTE}
SELECT ts, {FEATURE_COLUMNS}, band, {CALENDAR}, building FROM indices"""
SCALED = ", ".join(
    f"round((CAST({c} AS DOUBLE) - (SELECT avg(CAST({c} AS DOUBLE)) FROM indices)) / "
    f"(SELECT CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) = 0 THEN 1 ELSE stddev_pop(CAST({c} AS DOUBLE)) END "
    f"FROM indices), 6) AS {c}"
    for c in SCALED_FEATURES
)
SQL["scaled_features"] = f"WITH {FEATURE_CTE} SELECT ts, {SCALED} FROM indices"
ZEROED = ", ".join(
    f"CAST(coalesce({c}, 0) AS {'INTEGER' if c in ('dow', 'band') else KW}) AS {c}"
    for c in ALL_HOUR if c != "ts"
)
SQL["fill_zero"] = f"WITH {FULL_HOUR} SELECT ts, {ZEROED} FROM agg_hour"
SQL["filter_outliers"] = f"""WITH {READINGS}, {table_cte('hour')}
SELECT * FROM hour WHERE CAST(building AS DOUBLE) BETWEEN
  (SELECT quantile_cont(CAST(building AS DOUBLE), 1 - CAST(0.95 AS DOUBLE)) FROM hour) AND
  (SELECT quantile_cont(CAST(building AS DOUBLE), 0.95) FROM hour)"""


def describe_sql(c: str, table: str = "band") -> str:
    d = f"CAST({c} AS DOUBLE)"
    return f"""SELECT '{c}' AS name, count({c}) AS "count", round(avg({d}), 6) AS mean,
  round(stddev_samp({d}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,
  round(quantile_cont({d}, 0.25), 6) AS q25, round(quantile_cont({d}, 0.5), 6) AS q50,
  round(quantile_cont({d}, 0.75), 6) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM {table}"""


SQL["describe"] = f"WITH {READINGS}, {table_cte('band')} " + " UNION ALL ".join(
    describe_sql(m) for m in METERS
)
FEATURE_MEANS = ", ".join(f"round(avg({c}), 6) AS {c}" for c in SCALED_FEATURES)
SQL["weather_features_band"] = f"""WITH {WEATHER},
future AS (SELECT * FROM weather WHERE ts >= TIMESTAMP '{AS_OF} 00:00:00'
           AND ts < TIMESTAMP '{AS_OF} 00:00:00' + INTERVAL 15 DAY),
{COMFORT.format(source='future')}
SELECT CAST(ts AS DATE) AS day, CAST(isodow(ts) - 1 AS INTEGER) AS dow, {band_of('ts')} AS band, {FEATURE_MEANS}
FROM indices GROUP BY 1, 2, 3"""
SQL["error_metrics"] = f"""WITH {READINGS}, {table_cte('hour')}, m AS (
  SELECT count(*) AS n, CAST(sum(abs(building - office)) AS DOUBLE) / count(*) AS mae,
         CAST(sum((building - office) * (building - office)) AS DOUBLE) / count(*) AS mse, var_pop(CAST(building AS DOUBLE)) AS spread FROM hour)
SELECT n, round(mae, 6) AS mae, round(mse, 6) AS mse, round(sqrt(mse), 6) AS rmse,
       round(1 - mse / spread, 6) AS r2 FROM m"""


def dealt(seed: int, *keys: str) -> str:
    """The number under 100 that deals a row to a side, from its keys as text."""
    text = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"(CAST('0x' || substr(md5('{seed}|' || {text}), 1, 8) AS BIGINT) % 100)"


SQL["train_test"] = f"""WITH {FEATURE_CTE}
SELECT CASE WHEN {dealt(70, 'ts')} < 70 THEN 'train' ELSE 'test' END AS side, count(*) AS n,
       round(CAST(sum(building) AS DOUBLE), 4) AS label_sum FROM indices GROUP BY 1"""
SQL["linreg_one"] = f"""WITH {READINGS}, {table_cte('band')},
sides AS (SELECT CAST(building AS DOUBLE) AS y, CAST(office AS DOUBLE) AS x,
                 {dealt(0, 'day', 'band')} < 80 AS training FROM band),
line AS (SELECT CAST(regr_count(y, x) AS BIGINT) AS n, regr_slope(y, x) AS slope,
                regr_intercept(y, x) AS intercept FROM sides WHERE training),
errors AS (SELECT y, y - (intercept + slope * x) AS e FROM sides, line WHERE NOT training),
measured AS (SELECT count(*) AS test_n, avg(abs(e)) AS mae, avg(e * e) AS mse, var_pop(y) AS spread FROM errors)
SELECT n, round(slope, 6) AS slope, round(intercept, 3) AS intercept, test_n, round(mae, 3) AS mae,
       round(mse, 2) AS mse, round(sqrt(mse), 3) AS rmse, round(1 - mse / spread, 6) AS r2
FROM line, measured"""



def solved(source: str, inputs, y: str, name: str) -> str:
    """Least squares of ``y`` on some inputs: sums over ``source``, then elimination.

    ``name`` gets one row with w, the weights with the intercept last.
    """
    z = [f"CAST({c} AS DOUBLE)" for c in inputs] + ["CAST(1 AS DOUBLE)"]
    lines = ", ".join(
        "[" + ", ".join(f"sum({a} * {b})" for b in (*z, f"CAST({y} AS DOUBLE)")) + "]" for a in z
    )
    p = len(z)
    return f"""{name}_steps AS (
  SELECT 1 AS k, m FROM (SELECT [{lines}] AS m FROM {source})
  UNION ALL
  SELECT k + 1, list_transform(m, lambda r, i: CASE WHEN i = k
      THEN list_transform(r, lambda x: x / r[k])
      ELSE list_transform(r, lambda x, j: x - r[k] / m[k][k] * m[k][j]) END)
  FROM {name}_steps WHERE k <= {p}),
{name} AS (SELECT list_transform(m, lambda r: r[{p + 1}]) AS w FROM {name}_steps WHERE k = {p + 1})"""


def linear_value(inputs, fit: str) -> str:
    terms = [f"{fit}.w[{i + 1}] * CAST({c} AS DOUBLE)" for i, c in enumerate(inputs)]
    return " + ".join([*terms, f"{fit}.w[{len(inputs) + 1}]"])


SEVEN = ("office", "data_center", "band", "dow", "temperature_2m", "rain", "cloud_cover")
ZEROED_BANDS = f"""zeroed AS (
  SELECT day, band, coalesce(building, 0) AS building, {', '.join(f'coalesce({c}, 0) AS {c}' for c in SEVEN if c != 'band')}
  FROM agg_band),
dealt AS (SELECT *, {dealt(0, 'day', 'band')} < 80 AS training,
                 CAST('0x' || substr(md5('72|' || CAST(day AS VARCHAR) || '|' || CAST(band AS VARCHAR)), 1, 8) AS BIGINT) % 5 AS fold
          FROM zeroed),
training AS (SELECT * FROM dealt WHERE training)"""
ERRORS = """round(avg(abs(y - v)), 3) AS mae, round(avg((y - v) * (y - v)), 2) AS mse,
       round(sqrt(avg((y - v) * (y - v))), 3) AS rmse, round(1 - avg((y - v) * (y - v)) / var_pop(y), 6) AS r2"""
SQL["linreg_multi"] = f"""WITH RECURSIVE {BAND_WITH_WEATHER}, {ZEROED_BANDS}, {solved('training', SEVEN, 'building', 'line')}
SELECT 'linear' AS model, count(*) AS n, {ERRORS}
FROM (SELECT CAST(building AS DOUBLE) AS y, {linear_value(SEVEN, 'line')} AS v FROM dealt, line WHERE NOT training)"""
SQL["linreg_coefficients"] = f"""WITH RECURSIVE {BAND_WITH_WEATHER}, {ZEROED_BANDS}, {solved('zeroed', SEVEN, 'building', 'line')}
SELECT (SELECT count(*) FROM zeroed) AS n, round(w[8], 3) AS intercept,
       {', '.join(f'round(w[{i + 1}], 6) AS w_{c}' for i, c in enumerate(SEVEN))} FROM line"""

# Out-of-fold lines, then coordinate descent on the means and covariances of their values.
BASES = {"by_office": "office", "by_center": "data_center"}
OUT_OF_FOLD = ", ".join(
    f"regr_intercept(y, {x}) AS i_{n}, regr_slope(y, {x}) AS s_{n}" for n, x in BASES.items()
)
VALUES = ", ".join(f"i_{n} + s_{n} * {x} AS {n}" for n, x in BASES.items())
SQL["lasso_meta"] = f"""WITH RECURSIVE {BAND_WITH_WEATHER}, {ZEROED_BANDS},
known AS (SELECT day, band, fold, training, CAST(building AS DOUBLE) AS y, CAST(office AS DOUBLE) AS office,
                 CAST(data_center AS DOUBLE) AS data_center FROM dealt),
seen AS (SELECT k, {OUT_OF_FOLD} FROM known, range(5) AS r(k) WHERE training AND fold <> k GROUP BY k),
held AS (SELECT y, {VALUES} FROM known JOIN seen ON fold = k WHERE training),
moments AS (
  SELECT avg(y) AS my, avg(by_office) AS m1, avg(by_center) AS m2, var_pop(by_office) AS a11, var_pop(by_center) AS a22,
         covar_pop(by_office, by_center) AS a12, covar_pop(by_office, y) AS b1, covar_pop(by_center, y) AS b2 FROM held),
descent AS (
  SELECT 0 AS k, CAST(0 AS DOUBLE) AS w1, CAST(0 AS DOUBLE) AS w2
  UNION ALL
  SELECT k + 1, n1, sign(b2 - a12 * n1) * greatest(abs(b2 - a12 * n1) - 1, 0) / a22 FROM (
    SELECT k, a12, a22, b2, sign(b1 - a12 * w2) * greatest(abs(b1 - a12 * w2) - 1, 0) / a11 AS n1
    FROM descent, moments WHERE k < 3000)),
meta AS (SELECT w1, w2, my - m1 * w1 - m2 * w2 AS b FROM descent, moments WHERE k = 3000),
lines AS (SELECT {OUT_OF_FOLD} FROM known WHERE training),
tested AS (SELECT y, {VALUES} FROM known, lines WHERE NOT training),
long AS (
  SELECT 'by_office' AS model, y, by_office AS v FROM tested UNION ALL SELECT 'by_center', y, by_center FROM tested
  UNION ALL SELECT 'stack', y, b + w1 * by_office + w2 * by_center FROM tested, meta)
SELECT model, count(*) AS n, {ERRORS}, round(any_value(b), 3) AS intercept, round(any_value(w1), 6) AS w_by_office,
       round(any_value(w2), 6) AS w_by_center
FROM long, meta GROUP BY model"""

WEATHER_INPUTS = ("temperature_2m", "relative_humidity_2m", "cloud_cover", "wind_speed_10m", "hour", "dow", "band")
SQL["forecast_linear"] = f"""WITH RECURSIVE {FEATURE_CTE}, past AS (
  SELECT building, temperature_2m, relative_humidity_2m, cloud_cover, wind_speed_10m, band, {CALENDAR}
  FROM indices WHERE ts < TIMESTAMP '{AS_OF} 00:00:00'),
{solved('past', WEATHER_INPUTS, 'building', 'line')},
later AS (SELECT * FROM weather WHERE ts >= TIMESTAMP '{AS_OF} 00:00:00'
          AND ts < TIMESTAMP '{AS_OF} 00:00:00' + INTERVAL 15 DAY),
rated AS (WITH {COMFORT.format(source='later')} SELECT * FROM indices),
parts AS (SELECT *, {band_of('ts')} AS band, CAST(isodow(ts) - 1 AS INTEGER) AS dow, hour(ts) AS hour FROM rated)
SELECT CAST(ts AS DATE) AS day, dow, band, {FEATURE_MEANS},
       round(sum({linear_value(WEATHER_INPUTS, 'line')}), 3) AS building_forecast,
       TIMESTAMP '{AS_OF} 00:00:00' AS updated_at
FROM parts, line GROUP BY 1, 2, 3"""

# Loads ----------------------------------------------------------------------------

GRAINS = {"hour": "ts", "day": "ts", "band": "day, band", "month": "ts", "year": "ts"}


def aligned_cte(name: str, condition: str) -> str:
    """Feed rows under a condition, up to the last time all feeds have reached."""
    return f"""{name}_some AS (SELECT * FROM all_feeds WHERE {condition}),
{name} AS (SELECT * FROM {name}_some WHERE ts <= (
  SELECT min(last) FROM (SELECT max(ts) AS last FROM {name}_some GROUP BY feed)))"""


def load_sql(first_until: str | None = None) -> str:
    """All stored tables; with a time, buckets that a load of the rows before it holds stay."""
    parts = [
        feeds_cte().replace("feeds AS (", "all_feeds AS ("),
        aligned_cte("feeds", "true"),
        readings_cte(),
    ]
    if first_until:
        parts += [
            aligned_cte("early", f"ts < TIMESTAMP '{first_until}'"),
            readings_cte(feeds="early", name="early_readings"),
        ]
    for grain, keys in GRAINS.items():
        later = ""
        if first_until:
            first = delta_sql(grain, source="early_readings")
            parts.append(f"{grain}_first AS (SELECT * FROM ({first}) {KEPT})")
            later = f" WHERE ({keys}) NOT IN (SELECT ({keys}) FROM {grain}_first)"
        parts.append(f"{grain}_last AS (SELECT * FROM ({delta_sql(grain)}){later})")
        union = f"SELECT * FROM {grain}_first UNION ALL BY NAME " if first_until else ""
        parts.append(
            f"{grain} AS (SELECT * FROM ({union}SELECT * FROM {grain}_last) {KEPT})"
        )
    parts += [
        WEATHER,
        HOUR_WITH_WEATHER.format(table="hour", weather="weather"),
        f"band_weather AS ({LAST_OF_BAND.format(columns=ROUNDED)})",
        threshold_cte(),
        flags_cte(),
        f"day_flags AS (SELECT CAST(day AS TIMESTAMP) AS at, remote_flag FROM flags WHERE band = 2)",
    ]
    meters = ", ".join(METERS)
    shown = [
        f"SELECT 'hour' AS grain, ts, CAST(NULL AS INTEGER) AS band, {meters}, rain, CAST(NULL AS VARCHAR) AS remote FROM agg_hour",
        f"""SELECT 'band', CAST(coalesce(b.day, w.day) AS TIMESTAMP), coalesce(b.band, w.band), {meters}, w.rain,
  f.remote_flag FROM band b FULL OUTER JOIN band_weather w ON b.day = w.day AND b.band = w.band
  LEFT JOIN flags f ON f.day = b.day AND f.band = b.band""",
    ]
    for grain in ("day", "month", "year"):
        parts.append(
            f"{grain}_rain AS (SELECT CAST(date_trunc('{grain}', weather.ts) AS TIMESTAMP) AS at, "
            f"{stored('rain')} FROM weather GROUP BY 1)"
        )
        remote = "f.remote_flag"
        link = f"LEFT JOIN day_flags f ON f.at = t.ts"
        if grain != "day":
            parts.append(f"""{grain}_share AS (
  SELECT CAST(date_trunc('{grain}', d.ts) AS TIMESTAMP) AS at,
         CAST(CAST(round(100.0 * count(*) FILTER (f.remote_flag = 'OK') / count(*), 2) AS DECIMAL(10,2)) AS VARCHAR) || '%' AS share
  FROM day d JOIN day_flags f ON f.at = d.ts WHERE f.remote_flag IN ('OK', 'KO') GROUP BY 1)""")
            remote, link = "f.share", f"LEFT JOIN {grain}_share f ON f.at = t.ts"
        shown.append(f"""SELECT '{grain}', coalesce(t.ts, w.at), NULL, {meters}, w.rain, {remote}
FROM {grain} t FULL OUTER JOIN {grain}_rain w ON t.ts = w.at {link}""")
    return f"WITH {', '.join(parts)}\n" + "\nUNION ALL ".join(shown)


SQL["load_once"] = load_sql()
SQL["load_twice"] = load_sql(SPLIT)
SQL["load_twice_recomputed"] = SQL["load_once"]
SQL["load_by_site"] = f"""WITH {feeds_cte(True).replace('feeds AS (', 'all_feeds AS (')},
lasts AS (SELECT site, feed, max(ts) AS last FROM all_feeds GROUP BY ALL),
horizons AS (SELECT site, min(last) AS horizon FROM lasts GROUP BY site),
feeds AS (SELECT a.* FROM all_feeds a JOIN horizons h ON a.site = h.site AND a.ts <= h.horizon),
{readings_cte(True)}, {table_cte('band', site=True)}, {threshold_cte(True)}, {flags_cte(True)}
SELECT band.*, f.remote_flag FROM band
LEFT JOIN flags f ON f.site = band.site AND f.day = band.day AND f.band = band.band"""
STORED_HOURS = f"""WITH {feeds_cte().replace('feeds AS (', 'all_feeds AS (')},
{aligned_cte('feeds', 'true')}, {readings_cte()}, {table_cte('hour')}"""
SQL["usual_hours"] = f"""{STORED_HOURS}
SELECT ts, {', '.join(METERS)}, dow FROM hour WHERE CAST(building AS DOUBLE) BETWEEN
  (SELECT quantile_cont(CAST(building AS DOUBLE), 1 - CAST(0.95 AS DOUBLE)) FROM hour) AND
  (SELECT quantile_cont(CAST(building AS DOUBLE), 0.95) FROM hour)"""
SQL["stored_summary"] = f"{STORED_HOURS} " + " UNION ALL ".join(
    describe_sql(m, "hour") for m in METERS
)

# Streaming ------------------------------------------------------------------------

SQL["stream_incremental"] = SQL["dedup_feed"]
# Rows that arrive after the watermark has passed them are not counted.
LATE = f"ts < TIMESTAMP '{SPLIT}' AND minute(ts) = 45 AND hour(ts) % 6 = 0"
SQL["stream_delta_hour"] = f"""WITH {READINGS},
timely AS (SELECT * FROM readings WHERE NOT ({LATE})) {delta_sql('hour', source='timely')}"""
SQL["stream_dedup"] = f"WITH {RAW} SELECT feed, seq, ts, kilowatt FROM raw"
SQL["stream_late_rows"] = f"WITH {READINGS} SELECT * FROM readings WHERE {LATE}"
# A window closes once the last time but an hour has passed its end.
CLOSED = "(SELECT max(ts) - INTERVAL 1 HOUR FROM timely)"
for _grain, _day in (("day", "ts"), ("band", "CAST(day AS TIMESTAMP)")):
    SQL[f"stream_delta_{_grain}"] = f"""WITH {READINGS},
timely AS (SELECT * FROM readings WHERE NOT ({LATE})),
closed AS ({delta_sql(_grain, source='timely')})
SELECT * FROM closed WHERE {_day} + INTERVAL 1 DAY <= {CLOSED}"""

