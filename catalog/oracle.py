"""The same queries as plain SQL over the raw tables, written for DuckDB."""

from __future__ import annotations

EVENTS = """
ev AS (
  SELECT event_id, ts, user_id, event_type, CAST(floor(value * 100 + 0.5) AS BIGINT) AS cents,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, n_nationkey AS nk, n_name, r_name, r_regionkey
  FROM events JOIN nation ON n_nationkey = user_id % 25 JOIN region ON r_regionkey = n_regionkey
)"""

OBS = EVENTS + """,
obs AS (
  SELECT event_id AS seq, ts, CAST(ts AS DATE) AS event_date, 'C' || user_id AS city, n_name AS state,
         r_name AS region, CAST(user_id % 181 - 90 AS DOUBLE) AS latitude,
         CAST(user_id % 361 - 180 AS DOUBLE) AS longitude, CASE WHEN user_id % 2 = 0 THEN 'sensor' ELSE 'station' END AS source,
         CASE WHEN k <> 7 THEN (cents % 5120) / 128.0::DOUBLE END AS temperature_2m,
         CASE WHEN k <> 13 THEN (CASE WHEN event_type = 'error' THEN cents ELSE 0 END) / 1024.0::DOUBLE END
           AS precipitation_mm,
         CAST(k AS DOUBLE) AS relative_humidity_2m, CAST(cents % 97 AS DOUBLE) AS wind_speed_kmh,
         CAST(cents % 900 AS DOUBLE) AS shortwave_radiation, k / 64.0::DOUBLE AS evapotranspiration
  FROM ev
)"""

DAILY = OBS + """,
daily AS (
  SELECT event_date, city, state, region, latitude, longitude, source,
         AVG(temperature_2m) AS avg_temperature, MAX(temperature_2m) AS max_temperature,
         MIN(temperature_2m) AS min_temperature, SUM(precipitation_mm) AS total_precipitation,
         AVG(relative_humidity_2m) AS avg_humidity, AVG(wind_speed_kmh) AS avg_wind_speed,
         MAX(wind_speed_kmh) AS max_wind_speed, SUM(shortwave_radiation) AS solar_radiation,
         SUM(evapotranspiration) AS evapotranspiration
  FROM obs GROUP BY ALL
)"""

GOLD = DAILY + """,
flagged AS (
  SELECT *, CASE WHEN COALESCE(total_precipitation, 0) < 1 THEN 1 ELSE 0 END AS is_dry_day FROM daily
),
rolled AS (
  SELECT *,
         CAST(SUM(is_dry_day) OVER w7 AS BIGINT) AS days_without_rain,
         SUM(total_precipitation) OVER w7 AS precipitation_accumulated_7d,
         SUM(total_precipitation) OVER w30 AS precipitation_accumulated_30d,
         AVG(avg_temperature) OVER w7 AS avg_temperature_7d,
         AVG(avg_temperature) OVER w30 AS avg_temperature_30d
  FROM flagged
  WINDOW w7 AS (PARTITION BY city, state ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
         w30 AS (PARTITION BY city, state ORDER BY event_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
),
gold AS (
  SELECT *, max_temperature - min_temperature AS thermal_amplitude,
         CASE WHEN precipitation_accumulated_7d <= 5 AND days_without_rain >= 7 AND avg_temperature_7d >= 20
              THEN 'high' ELSE 'normal' END AS drought_risk,
         CASE WHEN max_temperature >= 35 THEN 'high' ELSE 'normal' END AS heat_risk,
         CASE WHEN total_precipitation >= 5 THEN 'high' ELSE 'normal' END AS heavy_rain_risk
  FROM rolled
)"""

READINGS = GOLD + """,
counted AS (
  SELECT event_date AS full_date, * EXCLUDE (event_date),
         CAST((drought_risk = 'high')::INT + (heat_risk = 'high')::INT + (heavy_rain_risk = 'high')::INT AS BIGINT)
           AS risk_events
  FROM gold
),
readings AS (
  SELECT *, CASE risk_events WHEN 0 THEN 'Normal' WHEN 1 THEN 'Atencao' ELSE 'Critico' END AS risk_level FROM counted
),
latest AS (SELECT * FROM readings WHERE full_date = (SELECT MAX(full_date) FROM readings))"""

RAW = EVENTS + """,
raw AS (
  SELECT event_id AS seq,
         CASE k WHEN 3 THEN NULL WHEN 4 THEN 'not a time'
                ELSE strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M') END AS "timestamp",
         CASE WHEN k = 5 THEN '' ELSE 'C' || nk END AS city, n_name AS state, r_name AS region,
         CAST(CASE WHEN k = 6 THEN 95.5 ELSE nk * 4 - 50 END AS DOUBLE) AS latitude,
         CAST(nk * 7 - 90 AS DOUBLE) AS longitude,
         CASE WHEN k = 9 THEN NULL ELSE (cents % 5120) / 128.0::DOUBLE END AS temperature_2m,
         CAST(k + 5 AS DOUBLE) AS relative_humidity_2m,
         CASE WHEN k <> 13 THEN CAST(cents % 64 AS DOUBLE) END AS precipitation_mm,
         CASE WHEN k <> 14 THEN CAST(cents % 97 - 2 AS DOUBLE) END AS wind_speed_kmh,
         strftime(ts, '%Y-%m-%d') AS ingestion_timestamp,
         'run-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS pipeline_execution_id
  FROM ev
),
typed AS (
  SELECT *, TRY_CAST("timestamp" AS TIMESTAMP) AS event_timestamp,
         sha256(concat_ws('|', city, "timestamp", CAST(latitude AS VARCHAR), CAST(longitude AS VARCHAR)))
           AS weather_record_id
  FROM raw
),
valid AS (
  SELECT * FROM typed
  WHERE event_timestamp IS NOT NULL AND trim(city) <> '' AND latitude BETWEEN -90 AND 90
    AND longitude BETWEEN -180 AND 180
    AND (relative_humidity_2m IS NULL OR relative_humidity_2m BETWEEN 0 AND 100)
    AND (precipitation_mm IS NULL OR precipitation_mm >= 0) AND (wind_speed_kmh IS NULL OR wind_speed_kmh >= 0)
    AND (temperature_2m IS NULL OR temperature_2m BETWEEN -20 AND 60)
),
ruled AS (
  SELECT *, concat_ws(',',
      CASE WHEN "timestamp" IS NULL OR "timestamp" = '' THEN 'timestamp_is_required' END,
      CASE WHEN city IS NULL OR city = '' THEN 'city_is_required' END,
      CASE WHEN latitude IS NULL OR latitude NOT BETWEEN -90 AND 90 THEN 'latitude_out_of_range' END,
      CASE WHEN longitude IS NULL OR longitude NOT BETWEEN -180 AND 180 THEN 'longitude_out_of_range' END,
      CASE WHEN relative_humidity_2m NOT BETWEEN 0 AND 100 THEN 'relative_humidity_2m_out_of_range' END,
      CASE WHEN precipitation_mm < 0 THEN 'precipitation_mm_below_minimum' END,
      CASE WHEN wind_speed_kmh < 0 THEN 'wind_speed_kmh_below_minimum' END,
      CASE WHEN temperature_2m NOT BETWEEN -20 AND 60 THEN 'temperature_2m_out_of_range' END) AS own_reason
  FROM raw
),
judged AS (
  SELECT seq, CASE WHEN seq > MIN(CASE WHEN own_reason = '' THEN seq END)
                           OVER (PARTITION BY city, "timestamp", latitude, longitude)
                   THEN 'duplicate_record' ELSE own_reason END AS reason
  FROM ruled
)"""

STATISTICS = """
shipments AS (
  SELECT lineitem.*, p_brand, p_size, n_nationkey, n_name, ROUND(l_quantity) AS m214,
         ROUND(l_extendedprice * 100) AS m215, CASE WHEN l_returnflag <> 'R' THEN ROUND(l_discount * 100) END AS m216
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
)"""

CROPS = STATISTICS + """,
crops AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(n_nationkey AS VARCHAR) AS territory_code,
         n_name AS territory_name, p_brand AS product_code, p_brand AS product_name,
         SUM(m214) AS produced_quantity, SUM(m215) AS production_value, SUM(m216) AS harvested_area,
         CAST(NULL AS DOUBLE) AS reported_yield_kg_ha,
         CASE WHEN SUM(m216) <> 0 THEN SUM(m214) / SUM(m216) END AS calculated_yield_t_ha,
         CAST(NULL AS DOUBLE) AS reported_yield_t_ha, 'ibge_pam' AS source
  FROM shipments GROUP BY 1, 2, 3, 4, 5
)"""

EXPOSED = READINGS + "," + CROPS + """,
climate AS (
  SELECT state, CAST(SUM(risk_events) AS BIGINT) AS ev, AVG(avg_temperature) AS temp, SUM(total_precipitation) AS rain
  FROM latest GROUP BY state
),
joined AS (
  SELECT c.*, CASE WHEN territory_code <> '24' THEN territory_name END AS state
  FROM crops c WHERE year = (SELECT MAX(year) FROM crops)
),
matched AS (SELECT j.*, ev, temp, rain FROM joined j LEFT JOIN climate USING (state)),
exposed AS (
  SELECT *, COALESCE(ev, 0) AS eventos_de_risco,
         COALESCE(temp, (SELECT AVG(temp) FROM matched)) AS temperatura_media, COALESCE(rain, 0) AS chuva_total,
         GREATEST(COALESCE(ev, 0), 1) AS bubble_size
  FROM matched
)"""


def _bucketed(table: str, key: list[str], id_column: str, first: str = "1") -> str:
    """Dense ids in the order of the key's md5 prefix, then the key."""
    text = ", ".join(f"CAST({k} AS VARCHAR)" for k in key)
    order = f"substr(md5(concat_ws('|', {text})), 1, 3), {', '.join(key)}"
    return f"SELECT *, CAST({first} - 1 + ROW_NUMBER() OVER (ORDER BY {order}) AS BIGINT) AS {id_column} FROM {table}"


LOCATIONS = (
    ",\nplace AS (SELECT DISTINCT city, state, region, latitude, longitude FROM obs),\nlocations AS ("
    + _bucketed("place", ["city", "state"], "location_id")
    + "),\nkinds AS (SELECT DISTINCT source AS source_name FROM obs),\nsources AS ("
    + _bucketed("kinds", ["source_name"], "source_id", "2")
    + ")"
)


def _numeric(name: str, precision: int) -> str:
    settled = f"ROUND({name} + 1e-7, 4)" if name.startswith("avg_temperature_") else name
    return f"CAST(ROUND(CAST({settled} AS DECIMAL(28, 9)), 2) AS DOUBLE) AS {name}"


_NUMERIC = {
    "avg_temperature": 6,
    "max_temperature": 6,
    "min_temperature": 6,
    "total_precipitation": 10,
    "avg_humidity": 6,
    "avg_wind_speed": 6,
    "max_wind_speed": 6,
    "solar_radiation": 12,
    "evapotranspiration": 10,
    "days_without_rain": 0,
    "precipitation_accumulated_7d": 10,
    "precipitation_accumulated_30d": 10,
    "avg_temperature_7d": 6,
    "avg_temperature_30d": 6,
    "thermal_amplitude": 6,
}
_MEASURES = ", ".join(
    _numeric(n, p) if p else f"CAST({n} AS INTEGER) AS {n}" for n, p in _NUMERIC.items()
) + ", drought_risk, heat_risk, heavy_rain_risk"

FACT = (
    GOLD
    + LOCATIONS
    + f""",
keyed AS (
  SELECT CAST(strftime(event_date, '%Y%m%d') AS INTEGER) AS date_id, location_id, source_id,
         gold.event_date, gold.city, gold.state, gold.region, gold.latitude, gold.longitude, {_MEASURES}
  FROM gold JOIN locations USING (city, state) JOIN sources ON source_name = gold.source
)"""
)

_LOC_BATCHES = (
    OBS
    + """,
early AS (SELECT DISTINCT city, state, region, latitude, longitude FROM obs WHERE event_date <= DATE '2024-01-02'),
late AS (SELECT DISTINCT city, state, region || ' II' AS region, latitude, longitude FROM obs
         WHERE event_date >= DATE '2024-01-02'),
first_ids AS ("""
    + _bucketed("early", ["city", "state"], "location_id")
    + """),
late_ids AS ("""
    + _bucketed("late", ["city", "state"], "location_id", "(SELECT MAX(location_id) + 1 FROM first_ids)")
    + "), fresh_ids AS (SELECT * FROM late_ids ANTI JOIN early USING (city, state))"
)


def _fmt(value: str, suffix: str) -> str:
    return f"printf('%+.1f', round_even({value}, 1)) || '{suffix}'"


def _mean(value: str) -> str:
    return f"ROUND({value} + 1e-7, 4)"


_OFFICE = "CASE WHEN product_code < 'Brand#2' THEN 'ibge_pam' ELSE 'survey' END"
_DAY = "CAST(event_date AS VARCHAR) AS event_date"
_FULL_DAY = "CAST(full_date AS VARCHAR) AS full_date"

ORACLE: dict[str, str] = {}


def _add(name: str, ctes: str, select: str) -> None:
    ORACLE[name] = f"WITH {ctes.strip()}\n{select.strip()}"


# --- weather core -----------------------------------------------------------------------------------------
_add("gold_daily", DAILY, f"SELECT * REPLACE (CAST(event_date AS VARCHAR) AS event_date) FROM daily")
_add(
    "rolling_metrics",
    GOLD,
    f"""SELECT {_DAY}, city, state, days_without_rain, precipitation_accumulated_7d, precipitation_accumulated_30d,
       {_mean('avg_temperature_7d')} AS avg_temperature_7d, {_mean('avg_temperature_30d')} AS avg_temperature_30d
FROM gold""",
)
_add(
    "rolling_calendar",
    GOLD
    + """,
calendar AS (
  SELECT event_date, city, state, precipitation_accumulated_30d,
         CAST(SUM(is_dry_day) OVER d7 AS BIGINT) AS dry_days_in_7_days,
         SUM(total_precipitation) OVER d7 AS precipitation_in_7_days,
         SUM(total_precipitation) OVER d30 AS precipitation_in_30_days,
         AVG(avg_temperature) OVER d7 AS avg_temperature_in_7_days,
         AVG(avg_temperature) OVER d30 AS avg_temperature_in_30_days
  FROM gold
  WINDOW d7 AS (PARTITION BY city, state ORDER BY event_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW),
         d30 AS (PARTITION BY city, state ORDER BY event_date RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW)
)""",
    f"""SELECT {_DAY}, city, state, dry_days_in_7_days, precipitation_in_7_days, precipitation_in_30_days,
       {_mean('avg_temperature_in_7_days')} AS avg_temperature_in_7_days,
       {_mean('avg_temperature_in_30_days')} AS avg_temperature_in_30_days,
       precipitation_accumulated_30d <> precipitation_in_30_days AS differs_from_rows
FROM calendar""",
)
_add(
    "risk_flags",
    GOLD,
    f"""SELECT {_DAY}, city, state, thermal_amplitude, drought_risk, heat_risk, heavy_rain_risk,
       CAST(year(gold.event_date) AS INTEGER) AS year, CAST(month(gold.event_date) AS INTEGER) AS month FROM gold""",
)
_add("risk_level", READINGS, f"SELECT {_FULL_DAY}, city, state, risk_events, risk_level FROM readings")
_add(
    "typed_cast",
    RAW,
    """SELECT seq, strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS event_timestamp,
       CAST(CAST(typed.event_timestamp AS DATE) AS VARCHAR) AS event_date,
       CAST(year(typed.event_timestamp) AS INTEGER) AS year, CAST(month(typed.event_timestamp) AS INTEGER) AS month,
       latitude, temperature_2m, wind_speed_kmh
FROM typed""",
)
_add("record_id", RAW, "SELECT seq, weather_record_id FROM typed")
_add("silver_filter", RAW, "SELECT seq, city, relative_humidity_2m, precipitation_mm, wind_speed_kmh FROM valid")
_add(
    "silver_dedup",
    RAW,
    """SELECT weather_record_id, seq, pipeline_execution_id,
       strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS event_timestamp, temperature_2m
FROM valid QUALIFY ROW_NUMBER() OVER (
  PARTITION BY weather_record_id ORDER BY ingestion_timestamp DESC, pipeline_execution_id DESC) = 1""",
)
_add("obs_enrich", OBS, f"SELECT seq, {_DAY}, city, state, region, temperature_2m FROM obs")
_add(
    "obs_filter",
    READINGS,
    f"""SELECT {_FULL_DAY}, city, state, risk_level, max_temperature FROM readings
WHERE readings.full_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'
  AND state IN ('NATION_3', 'NATION_8', 'NATION_17') AND risk_level IN ('Atencao', 'Critico')""",
)
_add(
    "filter_options",
    READINGS,
    """SELECT DISTINCT 'state' AS kind, state AS option FROM readings
UNION ALL SELECT DISTINCT 'city', city FROM readings WHERE state IN ('NATION_3', 'NATION_8')
UNION ALL SELECT 'first_day', CAST(MIN(full_date) AS VARCHAR) FROM readings
UNION ALL SELECT 'last_day', CAST(MAX(full_date) AS VARCHAR) FROM readings""",
)
_add(
    "incremental_slice",
    OBS,
    f"SELECT seq, {_DAY}, city FROM obs WHERE obs.event_date BETWEEN DATE '2024-01-21' AND DATE '2024-01-25'",
)
_add(
    "latest_points",
    READINGS,
    f"SELECT {_FULL_DAY}, city, state, latitude, longitude, total_precipitation, risk_level FROM latest",
)
_add(
    "array_normalize",
    EVENTS,
    """SELECT lpad(CAST(event_id AS VARCHAR), 12, '0') || '#' || lpad(CAST(h AS VARCHAR), 9, '0') AS record_order,
       strftime(ts + h * INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M') AS "timestamp", 'C' || nk AS city, 'R' || r_regionkey AS region,
       CASE WHEN event_type <> 'view' THEN 1.5 ELSE CAST(nk * 4 - 50 AS DOUBLE) END AS latitude,
       CAST(2.5 AS DOUBLE) AS longitude,
       CASE WHEN k % 4 = 0 OR (k % 4 = 1 AND h = 2) THEN NULL ELSE (cents % 5120) / 128.0::DOUBLE + h END
         AS temperature_2m,
       CASE WHEN h = 0 THEN CAST(cents % 64 AS DOUBLE) END AS precipitation_mm
FROM ev, range(3) AS r(h)""",
)
_add(
    "payload_quarantine",
    EVENTS,
    """SELECT lpad(CAST(event_id AS VARCHAR), 12, '0') AS payload_file, 'C' || nk AS city,
       CASE WHEN k NOT IN (3, 4, 5) AND event_type <> 'view' THEN CAST(1.5 AS DOUBLE) END AS latitude,
       CASE WHEN k NOT IN (3, 4, 5) THEN CAST(2.5 AS DOUBLE) END AS longitude,
       CASE WHEN k IN (3, 4, 5) THEN 'unreadable_payload' END AS reason,
       CASE WHEN k NOT IN (3, 4, 5) THEN 3 END AS hours,
       CASE WHEN k NOT IN (3, 4, 5) AND k % 4 <> 0 THEN (cents % 5120) / 128.0::DOUBLE END AS first_temperature
FROM ev""",
)
_add(
    "union_all",
    OBS,
    """SELECT seq, city, CASE WHEN precipitation_mm > 0 THEN precipitation_mm END AS precipitation_mm,
       CASE WHEN COALESCE(precipitation_mm, 0) <= 0 THEN temperature_2m END AS temperature_2m FROM obs""",
)

# --- quality ----------------------------------------------------------------------------------------------
_add("rule_reasons", RAW, "SELECT seq, own_reason AS reason FROM ruled")
_add("quality_split", RAW, "SELECT seq, reason, reason = '' AS accepted FROM judged")
_add(
    "quarantine_counts",
    RAW,
    "SELECT reason, COUNT(*) AS rows FROM judged WHERE reason <> '' GROUP BY reason ORDER BY reason",
)


def _report(ctes: str, source: str, nulls: list[str], ranges: dict[str, str]) -> tuple[str, str]:
    parts = [
        f"SELECT 'null:{c}' AS check_name, COUNT(*) FILTER ({c} IS NULL) AS failed_rows FROM {source}" for c in nulls
    ]
    parts += [
        f"SELECT 'range:{c}' AS check_name, COUNT(*) FILTER ({bad}) AS failed_rows FROM {source}"
        for c, bad in ranges.items()
    ]
    return ctes, "\nUNION ALL ".join(parts)


_COORDINATES = {
    "latitude": "latitude IS NULL OR latitude NOT BETWEEN -90 AND 90",
    "longitude": "longitude IS NULL OR longitude NOT BETWEEN -180 AND 180",
}
_add(
    "dq_report",
    *_report(
        RAW + ", dated AS (SELECT *, CAST(event_timestamp AS DATE) AS event_date FROM typed)",
        "dated",
        ["weather_record_id", "event_timestamp", "event_date", "city", "state", "latitude", "longitude"],
        {
            **_COORDINATES,
            "relative_humidity_2m": "relative_humidity_2m NOT BETWEEN 0 AND 100",
            "precipitation_mm": "precipitation_mm < 0",
            "wind_speed_kmh": "wind_speed_kmh < 0",
            "temperature_2m": "temperature_2m NOT BETWEEN -20 AND 60",
        },
    ),
)
_add(
    "dq_report_gold",
    *_report(
        GOLD,
        "gold",
        ["event_date", "city", "state", "latitude", "longitude"],
        {
            **_COORDINATES,
            "avg_humidity": "avg_humidity NOT BETWEEN 0 AND 100",
            "total_precipitation": "total_precipitation < 0",
            "days_without_rain": "days_without_rain < 0",
            "avg_temperature": "avg_temperature NOT BETWEEN -20 AND 60",
            "max_temperature": "max_temperature NOT BETWEEN -20 AND 60",
            "min_temperature": "min_temperature NOT BETWEEN -20 AND 60",
        },
    ),
)
_add(
    "dq_report_agri",
    *_report(
        CROPS,
        "crops",
        ["year", "territory_code", "territory_name", "product_code", "product_name"],
        {
            name: f"{name} < 0"
            for name in ("produced_quantity", "production_value", "harvested_area", "reported_yield_kg_ha")
        },
    ),
)
_add("dq_unique", RAW, "SELECT weather_record_id, COUNT(*) AS rows FROM typed GROUP BY 1 HAVING COUNT(*) > 1")

# --- crop statistics --------------------------------------------------------------------------------------
ORACLE["number_parse"] = """
SELECT p_partkey, CASE WHEN p_size % 5 = 3 THEN p_size + CAST(0.5 AS DOUBLE) END AS value FROM part"""
_add(
    "agri_silver",
    STATISTICS
    + """,
long AS (
  SELECT s.*, code AS metric_code, CASE code WHEN '214' THEN m214 WHEN '215' THEN m215 ELSE m216 END AS value,
         CASE WHEN p_size = 1 THEN '' WHEN p_size <> 2 THEN p_brand END AS product_name,
         CASE WHEN l_linenumber <> 7 THEN CAST(year(l_shipdate) AS INTEGER) END AS year,
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS pipeline_execution_id
  FROM shipments s, (VALUES ('214'), ('215'), ('216')) AS m(code)
)""",
    """SELECT year, CAST(n_nationkey AS VARCHAR) AS territory_code, metric_code, p_brand AS product_code, product_name,
       value, 't' AS unit, 'ibge_pam' AS data_source, pipeline_execution_id
FROM long WHERE year BETWEEN 1974 AND 2100 AND product_name <> ''
QUALIFY ROW_NUMBER() OVER (PARTITION BY year, n_nationkey, metric_code, p_brand
  ORDER BY strftime(l_shipdate, '%Y-%m-%d') DESC, pipeline_execution_id DESC, value DESC NULLS LAST) = 1""",
)
_add(
    "agri_gold",
    CROPS,
    f"SELECT * REPLACE ({_mean('calculated_yield_t_ha')} AS calculated_yield_t_ha) FROM crops",
)
for _name, _by in (("prod_by_crop", "product_name"), ("prod_by_state", "territory_name")):
    for _suffix, _years in (("", ""), ("_latest", "WHERE year = (SELECT MAX(year) FROM crops)")):
        _add(
            _name + _suffix,
            CROPS,
            f"""SELECT {_by}, SUM(produced_quantity) AS produced_quantity,
       printf('%.1f', round_even(SUM(produced_quantity) / 1e6, 1)) || 'M t' AS display
FROM crops {_years} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12""",
        )
_add(
    "agri_kpi",
    CROPS,
    """SELECT MAX(year) AS year, COUNT(DISTINCT product_name) AS crops, COUNT(DISTINCT territory_name) AS territories,
       SUM(produced_quantity) AS produced_quantity,
       printf('%.1f', round_even(SUM(produced_quantity) / 1e6, 1)) || ' mi t' AS display
FROM crops WHERE year = (SELECT MAX(year) FROM crops)""",
)
_add(
    "crop_table",
    CROPS,
    """SELECT year, territory_name, product_name, produced_quantity, harvested_area FROM crops
WHERE year = (SELECT MAX(year) FROM crops) ORDER BY produced_quantity DESC, territory_name, product_name""",
)

# --- star schema ------------------------------------------------------------------------------------------
ORACLE["dim_date"] = """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, CAST(d AS VARCHAR) AS full_date,
       CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week,
       CAST(weekofyear(d) AS INTEGER) AS week, CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year, isodow(d) >= 6 AS is_weekend
FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)"""
_add(
    "dim_location",
    _LOC_BATCHES,
    """SELECT f.location_id, f.city, f.state, COALESCE(l.region, f.region) AS region,
       COALESCE(l.latitude, f.latitude) AS latitude, COALESCE(l.longitude, f.longitude) AS longitude
FROM first_ids f LEFT JOIN late l USING (city, state)
UNION ALL SELECT location_id, city, state, region, latitude, longitude FROM fresh_ids""",
)
_add(
    "dim_source",
    OBS
    + LOCATIONS
    + ","
    + CROPS
    + f", offices AS (SELECT DISTINCT {_OFFICE} AS source_name FROM crops), office_ids AS ("
    + _bucketed("offices", ["source_name"], "source_id", "(SELECT MAX(source_id) + 1 FROM sources)")
    + ")",
    """SELECT CAST(1 AS BIGINT) AS source_id, 'open_meteo' AS source_name, 'weather_api' AS source_type
UNION ALL SELECT source_id, source_name, 'weather_api' FROM sources
UNION ALL SELECT source_id, source_name, 'agriculture_statistics' FROM office_ids""",
)
_add(
    "dim_crop",
    CROPS
    + """,
early AS (SELECT product_code AS crop_code, MAX(product_name) AS crop_name FROM crops
          WHERE year <= 1995 AND product_code < 'Brand#4' GROUP BY 1),
late AS (SELECT product_code AS crop_code, MAX(product_name) || ' II' AS crop_name FROM crops
         WHERE year >= 1995 GROUP BY 1),
first_ids AS ("""
    + _bucketed("early", ["crop_code"], "crop_id")
    + "), late_ids AS ("
    + _bucketed("late", ["crop_code"], "crop_id", "(SELECT MAX(crop_id) + 1 FROM first_ids)")
    + ")",
    """SELECT f.crop_id, crop_code, COALESCE(l.crop_name, f.crop_name) AS crop_name
FROM first_ids f LEFT JOIN late l USING (crop_code)
UNION ALL SELECT crop_id, crop_code, crop_name FROM late_ids ANTI JOIN early USING (crop_code)""",
)
_WEATHER_FACT_ID = "CAST(date_id AS BIGINT) * 68719476736 + location_id * 256 + source_id AS weather_fact_id"
_NO_FACT_COLUMNS = "event_date, city, state, region, latitude, longitude"
_add(
    "fact_weather",
    FACT,
    f"""SELECT {_WEATHER_FACT_ID}, * EXCLUDE ({_NO_FACT_COLUMNS}), '2024-02-01 00:00:00' AS loaded_at FROM keyed""",
)
_add(
    "fact_agri",
    CROPS
    + ", named AS (SELECT DISTINCT product_code AS crop_code FROM crops), crop AS ("
    + _bucketed("named", ["crop_code"], "crop_id")
    + f"), offices AS (SELECT DISTINCT {_OFFICE} AS source_name FROM crops), office AS ("
    + _bucketed("offices", ["source_name"], "source_id")
    + f"""),
keyed AS (
  SELECT year, territory_code AS state_code, crop_id, source_id, territory_name AS state_name,
         produced_quantity + CASE WHEN year >= 1995 THEN 1 ELSE 0 END AS produced_quantity,
         CASE WHEN year < 1995 THEN production_value END AS production_value,
         harvested_area, reported_yield_kg_ha, reported_yield_t_ha,
         CAST(ROUND(CAST(calculated_yield_t_ha AS DECIMAL(28, 9)), 4) AS DOUBLE) AS calculated_yield_t_ha
  FROM crops JOIN crop ON crop_code = product_code JOIN office ON source_name = {_OFFICE}
)""",
    """SELECT CAST(year AS BIGINT) * 281474976710656
         + CAST('0x' || substr(md5(concat_ws('|', state_code, crop_id, source_id)), 1, 12) AS BIGINT) AS agriculture_fact_id,
       *, CASE WHEN year <= 1995 THEN '2024-02-01 00:00:00' ELSE '2024-02-02 00:00:00' END AS loaded_at FROM keyed""",
)
_add(
    "fact_upsert",
    FACT,
    f"""SELECT {_WEATHER_FACT_ID}, * EXCLUDE ({_NO_FACT_COLUMNS}) REPLACE (
  CASE WHEN event_date >= DATE '2024-01-15' THEN CAST(CAST(avg_temperature AS DECIMAL(6, 2)) + 1 AS DOUBLE)
       ELSE avg_temperature END AS avg_temperature,
  CASE WHEN event_date < DATE '2024-01-15' THEN avg_humidity END AS avg_humidity),
  CASE WHEN event_date <= DATE '2024-01-20' THEN '2024-02-01 00:00:00' ELSE '2024-02-02 00:00:00' END AS loaded_at
FROM keyed""",
)
_add(
    "fk_check",
    DAILY,
    """SELECT 'date_id' AS foreign_key, COUNT(*) FILTER (day(event_date) > 25) AS orphan_rows FROM daily
UNION ALL SELECT 'location_id', COUNT(*) FILTER (region = 'ASIA') FROM daily
UNION ALL SELECT 'source_id', COUNT(*) FILTER (source IS NULL) FROM daily""",
)
_add(
    "star_read",
    FACT,
    f"""SELECT CAST(event_date AS VARCHAR) AS full_date, city, state, region, latitude, longitude,
       {', '.join(_NUMERIC)}, drought_risk, heat_risk, heavy_rain_risk FROM keyed ORDER BY 1, 2""",
)

# --- reports ----------------------------------------------------------------------------------------------
_add(
    "rain_by_state",
    READINGS,
    """SELECT state, SUM(total_precipitation) AS accumulated_precipitation_mm FROM readings GROUP BY state
ORDER BY 2 DESC NULLS LAST, 1""",
)
_add(
    "monthly_temp",
    READINGS,
    """SELECT CAST(year(full_date) AS INTEGER) AS year, CAST(month(full_date) AS INTEGER) AS month,
       CAST(ROUND(CAST(AVG(avg_temperature) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS monthly_avg_temperature
FROM readings GROUP BY 1, 2 ORDER BY 1, 2""",
)
_add(
    "hottest_cities",
    READINGS,
    """SELECT city, state, CAST(ROUND(CAST(AVG(max_temperature) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS avg_max_temperature
FROM readings GROUP BY 1, 2 ORDER BY 3 DESC NULLS LAST, 1, 2 LIMIT 10""",
)
_add(
    "wettest_cities",
    READINGS,
    """SELECT city, state, SUM(total_precipitation) AS total_precipitation FROM readings GROUP BY 1, 2
ORDER BY 3 DESC NULLS LAST, 1, 2 LIMIT 10""",
)
_add(
    "dry_days",
    READINGS,
    """SELECT city, state, COUNT(*) FILTER (total_precipitation < 1) AS dry_days FROM readings GROUP BY 1, 2
ORDER BY 3 DESC, 1, 2""",
)
_SNAP = ("avg_temperature", "total_precipitation", "avg_humidity", "risk_events")
_SUFFIX = {"avg_temperature": " C", "total_precipitation": " mm", "avg_humidity": "%", "risk_events": ""}


def _snap(column: str, alias: str) -> str:
    value = _mean(column) if "avg" in alias else column
    return f"{value} AS {alias}"


_add(
    "snapshot_kpi",
    READINGS
    + """,
per_day AS (
  SELECT full_date, AVG(avg_temperature) AS avg_temperature, SUM(total_precipitation) AS total_precipitation,
         AVG(avg_humidity) AS avg_humidity, CAST(SUM(risk_events) AS BIGINT) AS risk_events
  FROM readings GROUP BY full_date
),
cur AS (SELECT * FROM per_day ORDER BY full_date DESC LIMIT 1),
prev AS (SELECT * FROM per_day ORDER BY full_date DESC LIMIT 1 OFFSET 1)""",
    "SELECT CAST(cur.full_date AS VARCHAR) AS latest_date, CAST(prev.full_date AS VARCHAR) AS previous_date, "
    + ", ".join(_snap(f"cur.{c}", c) for c in _SNAP)
    + ", "
    + ", ".join(_snap(f"prev.{c}", f"previous_{c}") for c in _SNAP)
    + ", "
    + ", ".join(f"{_fmt(f'CAST(cur.{c} - prev.{c} AS DOUBLE)', _SUFFIX[c])} AS delta_{c}" for c in _SNAP)
    + " FROM cur LEFT JOIN prev ON true",
)
_SUMMARY = READINGS + """,
summary AS (
  SELECT city, state, COUNT(DISTINCT full_date) AS dias_monitorados, CAST(SUM(risk_events) AS BIGINT) AS eventos_de_risco,
         MAX(days_without_rain) AS maior_sequencia_seca, MAX(precipitation_accumulated_7d) AS chuva_7d_max,
         MAX(max_temperature) AS temperatura_maxima, arg_min(latitude, full_date) AS latitude,
         arg_min(longitude, full_date) AS longitude
  FROM readings GROUP BY city, state
)"""
_WORST = "eventos_de_risco DESC, maior_sequencia_seca DESC, temperatura_maxima DESC NULLS LAST, city, state"
_add("risk_summary", _SUMMARY, f"SELECT * FROM summary ORDER BY {_WORST}")
_add(
    "risk_top10",
    _SUMMARY,
    f"SELECT *, city || '/' || state AS city_label FROM summary WHERE eventos_de_risco > 0 ORDER BY {_WORST} LIMIT 10",
)
_add(
    "insights",
    _SUMMARY,
    f"""SELECT * FROM (SELECT 'riskiest_city' AS insight, city, state, CAST(eventos_de_risco AS DOUBLE) AS value
  FROM summary ORDER BY {_WORST} LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'hottest_reading', city, state, max_temperature FROM readings
  ORDER BY max_temperature DESC NULLS LAST, full_date, city, state LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'rainiest_city', city, state, SUM(total_precipitation) FROM readings
  GROUP BY city, state ORDER BY 4 DESC NULLS LAST, city, state LIMIT 1)""",
)
_add(
    "daily_state",
    READINGS,
    f"""SELECT {_FULL_DAY}, state, {_mean('AVG(avg_temperature)')} AS avg_temperature,
       SUM(total_precipitation) AS total_precipitation FROM readings GROUP BY readings.full_date, state ORDER BY 1, 2""",
)
_add(
    "risk_share",
    READINGS
    + """,
counts AS (
  SELECT 'Seca' AS risk_type, COUNT(*) FILTER (drought_risk = 'high') AS events FROM readings
  UNION ALL SELECT 'Calor', COUNT(*) FILTER (heat_risk = 'high') FROM readings
  UNION ALL SELECT 'Chuva forte', COUNT(*) FILTER (heavy_rain_risk = 'high') FROM readings
),
shares AS (
  SELECT risk_type, events, round_even(events / (SELECT SUM(events) FROM counts) * 100, 1) AS percentage
  FROM counts WHERE events > 0
)""",
    """SELECT risk_type, events, CAST(percentage AS DOUBLE) AS percentage,
       events || ' eventos (' || CAST(CAST(percentage AS DOUBLE) AS VARCHAR) || '%)' AS label FROM shares""",
)
_add(
    "water_balance",
    READINGS,
    f"""SELECT {_FULL_DAY}, state, SUM(total_precipitation) AS total_precipitation,
       SUM(evapotranspiration) AS evapotranspiration FROM readings GROUP BY readings.full_date, state ORDER BY 1, 2""",
)
_add(
    "city_rain",
    READINGS,
    """SELECT city, state, SUM(total_precipitation) AS chuva_total, MAX(precipitation_accumulated_30d) AS chuva_30d_max,
       MAX(days_without_rain) AS dias_sem_chuva FROM readings GROUP BY 1, 2 ORDER BY 3 DESC NULLS LAST, 1, 2 LIMIT 15""",
)
_ROLLING_3D = """AVG(avg_temperature) OVER (PARTITION BY city ORDER BY full_date, state
         ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""
_add(
    "rolling_3d",
    READINGS + f", smooth AS (SELECT *, {_ROLLING_3D} AS r3 FROM readings)",
    f"SELECT {_FULL_DAY}, city, state, {_mean('r3')} AS temperature_rolling_3d FROM smooth",
)
_RANKED = READINGS + """,
ranked AS (
  SELECT city, state, AVG(avg_temperature) AS t, MAX(max_temperature) AS max_temperature FROM latest GROUP BY 1, 2
)"""
_add(
    "latest_temp_rank",
    _RANKED,
    f"""SELECT city, state, {_mean('t')} AS avg_temperature, max_temperature, city || '/' || state AS city_label,
       printf('%.1f', round_even(t, 1)) || ' C' AS display FROM ranked ORDER BY t DESC NULLS LAST, city, state""",
)
_add(
    "temp_band",
    READINGS,
    """SELECT CASE WHEN avg_temperature >= 28 THEN 'hot' WHEN avg_temperature >= 24 THEN 'warm' ELSE 'mild' END AS band,
       COUNT(*) AS rows FROM readings GROUP BY 1 ORDER BY 1""",
)
_add(
    "trend_top_cities",
    _RANKED
    + f""",
top_cities AS (SELECT city FROM ranked ORDER BY t DESC NULLS LAST, city, state LIMIT 6),
smooth AS (SELECT *, {_ROLLING_3D} AS r3 FROM readings)""",
    f"""SELECT {_FULL_DAY}, city, state, avg_temperature, {_mean('r3')} AS temperature_rolling_3d
FROM smooth WHERE city IN (SELECT city FROM top_cities)""",
)
_add(
    "export_table",
    READINGS,
    f"""SELECT {_FULL_DAY}, city, state, region, avg_temperature, max_temperature, total_precipitation, avg_humidity,
       days_without_rain, drought_risk, heat_risk, heavy_rain_risk
FROM readings ORDER BY readings.full_date DESC, state, city""",
)
_add(
    "risk_by_state",
    READINGS,
    "SELECT state, CAST(SUM(risk_events) AS BIGINT) AS risk_events FROM latest GROUP BY state ORDER BY state",
)
_add(
    "dataset_summary",
    READINGS + "," + CROPS,
    """SELECT CAST(MAX(full_date) AS VARCHAR) AS latest_date, COUNT(DISTINCT city) AS cities,
       COUNT(DISTINCT state) AS states, COUNT(*) AS weather_rows, (SELECT COUNT(*) FROM crops) AS agriculture_rows,
       (SELECT COUNT(DISTINCT product_name) FROM crops) AS crops FROM readings""",
)
_add(
    "agri_climate",
    EXPOSED,
    f"""SELECT territory_code, product_code, state, produced_quantity, bubble_size, eventos_de_risco,
       {_mean('temperatura_media')} AS temperatura_media, chuva_total FROM exposed""",
)
_add(
    "exposure_top",
    EXPOSED,
    """SELECT territory_name, product_name, produced_quantity, eventos_de_risco, bubble_size FROM exposed
ORDER BY eventos_de_risco DESC, produced_quantity DESC NULLS LAST, territory_name, product_name LIMIT 15""",
)
_add(
    "agro_score",
    EXPOSED
    + """,
states AS (
  SELECT state, territory_name, SUM(produced_quantity) AS produced_quantity, MAX(eventos_de_risco) AS eventos_de_risco,
         AVG(temperatura_media) AS temperatura_media, AVG(chuva_total) AS chuva_total
  FROM exposed WHERE state IS NOT NULL GROUP BY 1, 2
),
scale AS (
  SELECT MAX(produced_quantity) AS p, GREATEST(MAX(eventos_de_risco), 1) AS e, MIN(temperatura_media) AS low,
         MAX(temperatura_media) - MIN(temperatura_media) AS span FROM states
),
weighted AS (
  SELECT states.*, produced_quantity / p AS production_weight, eventos_de_risco / e AS risk_weight,
         CASE WHEN span = 0 THEN 0 ELSE (temperatura_media - low) / span END AS temperature_weight
  FROM states CROSS JOIN scale
),
scored AS (
  SELECT *, round_even(100 * (CAST(0.5 AS DOUBLE) * production_weight + CAST(0.3 AS DOUBLE) * risk_weight
           + CAST(0.2 AS DOUBLE) * temperature_weight), 1) AS score
  FROM weighted ORDER BY score DESC NULLS LAST, state, territory_name LIMIT 12
)""",
    f"""SELECT state, territory_name, produced_quantity, eventos_de_risco, chuva_total, score,
       {_mean('production_weight')} AS production_weight, {_mean('temperature_weight')} AS temperature_weight,
       {_mean('risk_weight')} AS risk_weight, {_mean('temperatura_media')} AS temperatura_media FROM scored""",
)
