"""Independent SQL for the registered queries, for DuckDB over the same tables.

The SQL is written the direct way, with brute-force joins and global windows,
so it shares no shortcut with the Spark jobs.
"""

from __future__ import annotations

EV = """ev AS (
  SELECT event_id, user_id, CAST(ts AS TIMESTAMP) AS time_utc,
         CAST(-11 + (user_id * 37 % 170) / 10.0 AS DOUBLE) AS latitude,
         CAST(95 + (user_id * 53 % 460) / 10.0 AS DOUBLE) AS longitude,
         CAST(2.5 + least(value, 480) / 100.0 AS DOUBLE) AS magnitude,
         CAST(event_id % 701 AS DOUBLE) AS depth_km,
         CASE WHEN event_id % 3 = 0 THEN 'USGS' WHEN event_id % 2 = 0 THEN 'BMKG-terkini'
              ELSE 'BMKG-dirasakan' END AS source
  FROM events)"""

RAW = """first_rows AS (
  SELECT CASE WHEN event_id % 97 = 0 THEN '  ' ELSE 'ev' || event_id END AS event_id, source,
         CASE WHEN event_id % 19 = 0 THEN 'bad' ELSE strftime(time_utc, '%Y-%m-%dT%H:%M:%S.%f') END AS time_utc,
         CAST(CASE WHEN event_id % 23 = 0 THEN latitude + 40 ELSE latitude END AS VARCHAR) AS latitude,
         CAST(longitude AS VARCHAR) AS longitude,
         CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 29 = 0 THEN '701'
              ELSE CAST(depth_km AS VARCHAR) END AS depth_km,
         CASE WHEN event_id % 17 = 0 THEN '' ELSE CAST(magnitude AS VARCHAR) END AS magnitude,
         CASE WHEN event_id % 7 = 0 THEN 'nan' ELSE ' mb ' END AS magnitude_type,
         CASE WHEN event_id % 31 = 0 THEN NULL ELSE '  Site ' || (event_id % 100) || ' ' END AS place,
         CASE WHEN event_id % 11 = 0 THEN 'III Palu' WHEN event_id % 5 = 0 THEN '3.5' END AS felt_intensity,
         CASE WHEN event_id % 37 = 0 THEN NULL ELSE 'reviewed' END AS status,
         '2024-02-01T00:00:00' AS ingested_at, event_id AS feed_position
  FROM ev),
raw AS (
  SELECT * FROM first_rows
  UNION ALL
  SELECT * REPLACE (CASE WHEN source = 'USGS' THEN 'BMKG-terkini' ELSE 'USGS' END AS source,
                    '2024-02-01T01:00:00' AS ingested_at)
  FROM first_rows WHERE feed_position % 5 = 0)"""

# The three overlapping snapshots as they look after a round trip through CSV.
SNAPS = """runs_of_days AS (SELECT unnest([0, 1, 2]) AS k),
cells AS (
  SELECT * REPLACE ('2024-02-0' || (k + 1) || 'T00:00:00' AS ingested_at)
  FROM raw, runs_of_days WHERE feed_position % 3 = k OR feed_position % 10 = 0),
snaps AS (
  SELECT * REPLACE (CASE WHEN magnitude_type = 'nan' THEN NULL ELSE magnitude_type END AS magnitude_type,
                    nullif(magnitude, '') AS magnitude),
         'gempa_2024020' || (k + 1) || '_000000.csv' AS snapshot
  FROM cells)"""


def typed(source: str, name: str = "typed", extra: str = "") -> str:
    return f"""{name} AS (
  SELECT nullif(trim(event_id), 'nan') AS event_id, nullif(trim(source), 'nan') AS source,
         TRY_CAST(time_utc AS TIMESTAMP) AS time_utc,
         TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude,
         TRY_CAST(depth_km AS DOUBLE) AS depth_km, TRY_CAST(magnitude AS DOUBLE) AS magnitude,
         nullif(trim(magnitude_type), 'nan') AS magnitude_type, nullif(trim(place), 'nan') AS place,
         TRY_CAST(felt_intensity AS DOUBLE) AS felt_intensity, nullif(trim(status), 'nan') AS status,
         TRY_CAST(ingested_at AS TIMESTAMP) AS ingested_at{extra}
  FROM {source})"""


def complete(source: str = "typed", name: str = "complete") -> str:
    return f"""{name} AS (
  SELECT * FROM {source}
  WHERE event_id IS NOT NULL AND trim(event_id) <> '' AND time_utc IS NOT NULL
    AND latitude IS NOT NULL AND longitude IS NOT NULL AND magnitude IS NOT NULL)"""


def imputed(source: str = "complete", name: str = "imputed") -> str:
    return f"""{name} AS (
  SELECT * REPLACE (coalesce(depth_km, 10.0) AS depth_km, coalesce(magnitude_type, 'M') AS magnitude_type,
                    coalesce(place, 'Unknown') AS place, coalesce(felt_intensity, 0.0) AS felt_intensity)
  FROM {source})"""


IN_BOX = "latitude BETWEEN -11 AND 6 AND longitude BETWEEN 95 AND 141"
IN_RANGE = "magnitude BETWEEN 0 AND 10 AND depth_km BETWEEN 0 AND 700"
SCREENED = f"screened AS (SELECT * FROM imputed WHERE {IN_BOX} AND {IN_RANGE})"


def ranked(source: str, keys: str, name: str) -> str:
    return f"""{name} AS (
  SELECT * FROM {source}
  QUALIFY row_number() OVER (PARTITION BY {keys}
    ORDER BY CASE WHEN source LIKE 'USGS%' THEN 0 ELSE 1 END, time_utc, source, ingested_at) = 1)"""


ZONE_NAME = """CASE WHEN latitude > -6 AND latitude < 6 AND longitude > 95 AND longitude < 103 THEN 'Sesar_Sumatra'
       WHEN latitude > -11 AND latitude < -6 AND longitude > 95 AND longitude < 120 THEN 'Subduksi_Jawa'
       WHEN latitude > -4 AND latitude < 2 AND longitude > 119 AND longitude < 124 THEN 'Sesar_Palu_Koro'
       WHEN latitude > -8 AND latitude < 2 AND longitude > 124 AND longitude < 135 THEN 'Subduksi_Maluku'
       ELSE 'Lainnya_Papua' END"""
ZONE_CODE = f"""CASE {ZONE_NAME} WHEN 'Subduksi_Jawa' THEN 0 WHEN 'Subduksi_Maluku' THEN 1
       WHEN 'Sesar_Sumatra' THEN 2 WHEN 'Sesar_Palu_Koro' THEN 3 ELSE 4 END"""


def depth_class(d: str) -> str:
    return f"""CASE WHEN {d} > 0 AND {d} <= 70 THEN 'shallow' WHEN {d} > 70 AND {d} <= 300 THEN 'intermediate'
       WHEN {d} > 300 AND {d} <= 700 THEN 'deep' ELSE 'nan' END"""


def size_class(m: str) -> str:
    return f"""CASE WHEN {m} > 0 AND {m} <= 2 THEN 'micro' WHEN {m} > 2 AND {m} <= 3 THEN 'minor'
       WHEN {m} > 3 AND {m} <= 4 THEN 'light' WHEN {m} > 4 AND {m} <= 5 THEN 'moderate'
       WHEN {m} > 5 AND {m} <= 6 THEN 'strong' WHEN {m} > 6 AND {m} <= 10 THEN 'major' ELSE 'nan' END"""


DERIVED = f"""year(time_utc) AS year, month(time_utc) AS month, hour(time_utc) AS hour_utc,
  {depth_class('depth_km')} AS depth_category, {size_class('magnitude')} AS magnitude_category,
  {ZONE_NAME} AS zona_sesar, coalesce(felt_intensity, 0) > 0 AS is_felt"""

VIEW = """event_id, source, time_utc, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, depth_km,
  round(magnitude, 6) AS magnitude, magnitude_type, place, felt_intensity, status, ingested_at"""
CLEAN_VIEW = f"{VIEW}, {DERIVED}"
RAW_VIEW = """event_id, source, time_utc, magnitude_type, place, felt_intensity, status, ingested_at,
  round(TRY_CAST(latitude AS DOUBLE), 6) AS latitude, round(TRY_CAST(longitude AS DOUBLE), 6) AS longitude,
  TRY_CAST(depth_km AS DOUBLE) AS depth_km, round(TRY_CAST(magnitude AS DOUBLE), 6) AS magnitude"""


def distance(a: str, b: str) -> str:
    return f"""2 * 6371.0 * asin(sqrt(least(1.0,
      pow(sin(radians({b}.latitude - {a}.latitude) / 2), 2)
      + cos(radians({a}.latitude)) * cos(radians({b}.latitude))
        * pow(sin(radians({b}.longitude - {a}.longitude) / 2), 2))))"""


MAIN = f"""main AS (
  SELECT c.* FROM ev c
  WHERE c.magnitude >= 5 AND NOT EXISTS (
    SELECT 1 FROM ev p
    WHERE p.magnitude >= 5 AND p.time_utc >= c.time_utc - INTERVAL 7 DAY AND p.time_utc < c.time_utc
      AND {distance('c', 'p')} < 100))"""

PAIRS = f"""pairs AS (
  SELECT m.event_id AS mainshock_id, m.time_utc AS t0, e.event_id AS aftershock_id, e.time_utc AS t,
         e.magnitude AS mag, {distance('m', 'e')} AS km
  FROM main m JOIN ev e
    ON e.time_utc > m.time_utc AND e.time_utc <= m.time_utc + INTERVAL 96 HOUR AND e.event_id <> m.event_id
   AND {distance('m', 'e')} < 100)"""

FEAT = f"""snap AS (SELECT unnest([1, 3, 6, 12, 24, 48, 72]) AS h),
grid AS (SELECT m.*, h, time_utc + h * INTERVAL 1 HOUR AS snap_at FROM main m, snap),
feat AS (
  SELECT CAST(g.event_id AS VARCHAR) AS mainshock_id, g.time_utc AS mainshock_time, g.h AS snapshot_hours,
         g.magnitude AS mainshock_magnitude, coalesce(g.depth_km, 10.0) AS mainshock_depth,
         {ZONE_CODE} AS zona_sesar, CAST(g.h AS DOUBLE) AS jam_sejak_mainshock,
         count(*) FILTER (t <= snap_at AND t >= snap_at - INTERVAL 1 HOUR) AS count_susulan_1jam,
         count(*) FILTER (t <= snap_at AND t >= snap_at - INTERVAL 6 HOUR) AS count_susulan_6jam,
         count(*) FILTER (t <= snap_at AND t >= snap_at - INTERVAL 24 HOUR) AS count_susulan_24jam,
         coalesce(max(mag) FILTER (t <= snap_at AND t >= snap_at - INTERVAL 6 HOUR), 0.0) AS max_mag_susulan_6jam,
         coalesce(max(mag) FILTER (t <= snap_at AND t >= snap_at - INTERVAL 24 HOUR), 0.0) AS max_mag_susulan_24jam,
         10.0 / (greatest(g.h / 24.0, 0.001) + 0.1) AS omori_rate_est,
         coalesce(max(CASE WHEN t > snap_at AND t <= snap_at + INTERVAL 24 HOUR AND mag >= 4 THEN 1 ELSE 0 END), 0)
           AS label_susulan_besar_24jam
  FROM grid g LEFT JOIN pairs p ON p.mainshock_id = g.event_id
  GROUP BY g.event_id, g.time_utc, g.h, g.snap_at, g.magnitude, g.depth_km, g.latitude, g.longitude)"""
FEATURE_CTES = ", ".join([EV, MAIN, PAIRS, FEAT])

SCORED = """scored AS (
  SELECT event_id AS id, CAST(magnitude >= 4 AS INT) AS y, (event_id * 7919 % 1000) / 1000.0 AS proba, source
  FROM ev)"""

RUNS = """runs AS (
  SELECT 'run' || user_id AS run_id, 'name-' || (user_id % 7) AS run_name,
         CASE WHEN user_id % 4 = 3 THEN 'FAILED' ELSE 'FINISHED' END AS status,
         CASE WHEN user_id % 13 <> 12 THEN
           count(*) FILTER (event_id * 7919 % 100 < 45) / count(*) END AS pr_auc,
         count(*) FILTER (event_id * 31 % 100 < 33) / count(*) AS f1_score,
         count(*) FILTER (event_id * 17 % 100 < 42) / count(*) AS recall
  FROM events GROUP BY user_id)"""
GATED = """gated AS (
  SELECT run_id, coalesce(pr_auc, 0) AS pr_auc, coalesce(f1_score, 0) AS f1_score, coalesce(recall, 0) AS recall
  FROM runs)"""
VERSIONS = """versions AS (
  SELECT DISTINCT 'model' || (user_id % 5) AS model_name, user_id // 5 + 1 AS version, 'run' || user_id AS run_id
  FROM events)"""
PROMOTED = """placed AS (
  SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY version) AS place,
         count(*) OVER (PARTITION BY model_name) AS n FROM versions),
promoted AS (
  SELECT model_name, version, run_id, CASE WHEN place = 1 THEN 'Production' ELSE 'Staging' END AS stage,
         CASE WHEN place = 1 THEN 'champion' ELSE 'challenger' END AS alias
  FROM placed WHERE place <= 2 AND n >= 2)"""

TEXTS = """texts AS (
  SELECT event_id, ts,
         CASE WHEN event_id % 31 = 0 THEN '  ' WHEN event_id % 37 = 0 THEN 'x LS'
              ELSE CAST(CAST(user_id * 37 % 18000 / 100 AS DECIMAL(6, 2)) AS VARCHAR)
                   || ([' LS', ' LU', ' BT', ' bb', ' S', ' w', '', ' N'])[event_id % 8 + 1] END AS coord,
         CASE WHEN event_id % 29 = 0 THEN '? km' ELSE (event_id % 701) || ' km' END AS depth,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS date_time,
         CAST(CAST(user_id % 60 / 10 AS DECIMAL(3, 1)) AS VARCHAR) AS size,
         CASE WHEN event_id % 3 <> 0 THEN 'Site ' || (event_id % 100) END AS region,
         CASE WHEN event_id % 2 <> 0 THEN event_type END AS remark
  FROM events)"""

BULLETIN = """bulletin AS (
  SELECT *,
         CASE WHEN event_id % 41 <> 0 THEN strftime(time_utc, '%Y-%m-%d %H:%M:%S+00:00') END AS dt,
         CASE WHEN event_id % 43 = 0 THEN 'x' ELSE CAST(CAST(magnitude AS DECIMAL(6, 4)) AS VARCHAR) END AS mag,
         CASE WHEN event_id % 47 = 0 THEN NULL WHEN event_id % 61 = 0 THEN 0.0
              WHEN latitude < 0 THEN -CAST(CAST(abs(latitude) AS DECIMAL(8, 2)) AS DOUBLE)
              ELSE CAST(CAST(abs(latitude) AS DECIMAL(8, 2)) AS DOUBLE) END AS lat,
         CAST(CAST(longitude AS DECIMAL(8, 2)) AS DOUBLE) AS lon,
         CASE WHEN event_id % 53 = 0 THEN 0.0 ELSE depth_km END AS depth
  FROM ev),
read_items AS (
  SELECT replace('BMKG-' || dt || '-' || mag, ' ', '_') AS event_id, 'BMKG-terkini' AS source,
         date_trunc('second', CASE WHEN dt IS NOT NULL THEN time_utc END) AS time_utc,
         lat AS latitude, lon AS longitude, depth AS depth_km, TRY_CAST(mag AS DOUBLE) AS magnitude,
         'M' AS magnitude_type, CASE WHEN event_id % 5 <> 0 THEN 'Site ' || (event_id % 100) ELSE 'Laut' END AS place,
         CASE WHEN event_id % 11 = 0 THEN 'III Palu' END AS felt_intensity, 'reviewed' AS status,
         TIMESTAMP '2024-02-01 00:00:00' AS ingested_at
  FROM bulletin)"""

COUNTS = """SELECT count(*) FILTER (y = 0 AND proba < {t}) AS tn, count(*) FILTER (y = 0 AND proba >= {t}) AS fp,
  count(*) FILTER (y = 1 AND proba < {t}) AS fn, count(*) FILTER (y = 1 AND proba >= {t}) AS tp FROM scored"""

TOP_DIGEST = "md5(concat_ws('|', '{salt}', mainshock_id, snapshot_hours))"


def _cm(threshold: float) -> str:
    return COUNTS.format(t=threshold)


def _ap(groups: str = "") -> str:
    part = f"PARTITION BY {groups}" if groups else ""
    lead = f"{groups}, " if groups else ""
    by = f"GROUP BY {groups}" if groups else ""
    return f"""by_score AS (
  SELECT {lead}proba, count(*) FILTER (y = 1) AS pos, count(*) AS n FROM scored GROUP BY {lead}proba),
curve AS (
  SELECT {lead}pos, sum(pos) OVER ({part} ORDER BY proba DESC) AS hits,
         sum(n) OVER ({part} ORDER BY proba DESC) AS claimed FROM by_score)
SELECT {lead}round(coalesce(sum(pos * (hits / claimed)) / nullif(sum(pos), 0), 0), 6) AS average_precision
FROM curve {by}"""


def _psi(columns: list[str]) -> str:
    """CTEs from ``pool(feature, x, is_ref)`` to ``psi_scores(feature, psi)``."""
    tenths = ", ".join(str(i / 10) for i in range(1, 10))
    place = " + ".join(f"CAST(edges[{i}] <= x AS INT)" for i in range(1, 10))
    return f"""edges AS (
  SELECT feature, quantile_cont(x, [{tenths}]) AS edges FROM pool WHERE is_ref GROUP BY feature),
binned AS (
  SELECT feature, {place} AS bin, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c
  FROM pool JOIN edges USING (feature) GROUP BY feature, bin),
shares AS (
  SELECT feature,
         CASE WHEN r = 0 THEN 1e-6 ELSE r / sum(r) OVER (PARTITION BY feature) END AS r,
         CASE WHEN c = 0 THEN 1e-6 ELSE c / sum(c) OVER (PARTITION BY feature) END AS c
  FROM binned),
psi_scores AS (SELECT feature, sum((c - r) * ln(c / r)) AS psi FROM shares GROUP BY feature)"""


WATCHED = ("magnitude", "depth_km", "latitude", "longitude")
POOL = """newest AS (SELECT max(time_utc) AS newest FROM ev),
pool AS (
""" + "\n  UNION ALL\n".join(
    f"  SELECT '{c}' AS feature, {c} AS x, time_utc < newest - INTERVAL 7 DAY AS is_ref FROM ev, newest"
    for c in WATCHED
) + ")"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_RAW = (EV, RAW)
_TYPED = (*_RAW, typed("raw"))
_SCREENED = (*_TYPED, complete(), imputed(), SCREENED)
_CLEAN = (*_SCREENED, ranked("screened", "event_id", "clean"))
_SNAP_CLEAN = (
    *_RAW, SNAPS, typed("snaps", extra=", snapshot"), complete(), imputed(), SCREENED,
)
_FEAT = f"WITH {FEATURE_CTES}\n"
_FEATURE_ROUNDED = """SELECT mainshock_id, mainshock_time, snapshot_hours,
  round(mainshock_magnitude, 6) AS mainshock_magnitude, mainshock_depth, zona_sesar, jam_sejak_mainshock,
  count_susulan_1jam, count_susulan_6jam, count_susulan_24jam,
  round(max_mag_susulan_6jam, 6) AS max_mag_susulan_6jam,
  round(max_mag_susulan_24jam, 6) AS max_mag_susulan_24jam,
  round(omori_rate_est, 6) AS omori_rate_est, label_susulan_besar_24jam FROM feat"""

_QUALITY = """, counted AS (
  SELECT count(*) AS rows_read,
         count(*) FILTER (NOT ok) AS rows_without_critical_fields,
         count(*) FILTER (ok AND depth_km IS NULL) AS depth_imputed,
         count(*) FILTER (ok AND NOT fine) AS rows_out_of_range,
         count(*) FILTER (ok AND fine) AS rows_before_dedup
  FROM (SELECT *, event_id <> '' AND time_utc IS NOT NULL AND magnitude IS NOT NULL AS ok,
               latitude BETWEEN -11 AND 6 AND longitude BETWEEN 95 AND 141 AND magnitude BETWEEN 0 AND 10
               AND coalesce(depth_km, 10) BETWEEN 0 AND 700 AS fine FROM typed)),
overall AS (
  SELECT count(*) AS rows_clean, min(magnitude) AS magnitude_min, max(magnitude) AS magnitude_max,
         min(depth_km) AS depth_min, max(depth_km) AS depth_max, count(DISTINCT source) AS sources FROM clean)
""" + "\nUNION ALL ".join(
    f"SELECT '{m}' AS metric, 'all' AS key, round(CAST({m} AS DOUBLE), 6) AS value FROM {t}"
    for t, names in (
        ("counted", ("rows_read", "rows_without_critical_fields", "depth_imputed", "rows_out_of_range",
                     "rows_before_dedup")),
        ("overall", ("rows_clean", "magnitude_min", "magnitude_max", "depth_min", "depth_max", "sources")),
    )
    for m in names
) + f"""
UNION ALL SELECT 'zone_rows', {ZONE_NAME}, CAST(count(*) AS DOUBLE) FROM clean GROUP BY 2"""

ORACLES: dict[str, str] = {
    "scan_geojson_feed": _with(EV) + """SELECT 'us' || event_id AS event_id, 'USGS' AS source,
  date_trunc('second', time_utc) AS time_utc, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude,
  CASE WHEN event_id % 9 <> 0 THEN depth_km END AS depth_km,
  CASE WHEN event_id % 43 <> 0 THEN round(magnitude, 6) END AS magnitude, 'mb' AS magnitude_type,
  'Site ' || (event_id % 100) AS place, CASE WHEN event_id % 5 = 0 THEN '3.5' END AS felt_intensity,
  'reviewed' AS status, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at, event_id % 100 AS feed_position FROM ev""",
    "feed_pushdown_filter": _with(EV) + f"""SELECT event_id, time_utc, round(latitude, 6) AS latitude,
  round(longitude, 6) AS longitude, round(magnitude, 6) AS magnitude FROM ev
WHERE time_utc BETWEEN TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-22 12:00:00'
  AND {IN_BOX} AND magnitude >= 2.5 ORDER BY time_utc, event_id""",
    "scan_bulletin_feed": _with(EV, BULLETIN) + """SELECT * FROM read_items
WHERE event_id IS NOT NULL AND latitude IS NOT NULL AND magnitude IS NOT NULL""",
    "scan_bulletin_rejects": _with(EV, BULLETIN) + """SELECT reason, count(*) AS n FROM (
  SELECT concat_ws(',', CASE WHEN event_id IS NULL THEN 'event_id' END,
    CASE WHEN latitude IS NULL THEN 'latitude' END, CASE WHEN magnitude IS NULL THEN 'magnitude' END) AS reason
  FROM read_items) WHERE reason <> '' GROUP BY reason""",
    "scan_raw_csv": _with(*_RAW) + f"""SELECT {RAW_VIEW} FROM (
  SELECT * REPLACE (CASE WHEN magnitude_type = 'nan' THEN NULL ELSE magnitude_type END AS magnitude_type) FROM raw)""",
    "scan_latest_snapshot": _with(*_RAW, SNAPS) + f"SELECT {RAW_VIEW} FROM snaps WHERE k = 2",
    "scan_all_snapshots": _with(*_RAW, SNAPS) + f"SELECT {RAW_VIEW}, snapshot FROM snaps",
    "scan_processed_union": _with(
        *_SNAP_CLEAN, ranked("screened", "snapshot, event_id", "per_snapshot")
    ) + f"""SELECT {CLEAN_VIEW} FROM per_snapshot
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY snapshot) = 1""",
    "scan_events_db": _with(*_CLEAN) + "SELECT round(magnitude, 6) AS magnitude, time_utc FROM clean",
    "sink_manifest": _with(*_RAW, SNAPS) + """SELECT TIMESTAMP '2024-02-01 00:00:00' AS run_timestamp,
  snapshot AS output_file, count(*) AS row_count, 'success' AS status FROM snaps GROUP BY snapshot""",
    "sink_processed": _with(*_CLEAN) + f"SELECT {CLEAN_VIEW} FROM clean",
    "conform_schema": _with(*_RAW) + """SELECT event_id, source, time_utc, CAST(NULL AS VARCHAR) AS depth_km,
  CAST(NULL AS VARCHAR) AS magnitude_type, CAST(NULL AS VARCHAR) AS place, status FROM raw""",
    "normalize_types": _with(*_TYPED) + f"SELECT {VIEW} FROM typed",
    "drop_critical_nulls": _with(*_TYPED, complete()) + f"SELECT {VIEW} FROM complete",
    "impute_defaults": _with(*_TYPED, imputed("typed")) + f"SELECT {VIEW} FROM imputed",
    "filter_bbox": _with(*_TYPED) + f"SELECT {VIEW} FROM typed WHERE {IN_BOX}",
    "filter_valid_ranges": _with(*_TYPED, imputed("typed")) + f"SELECT {VIEW} FROM imputed WHERE {IN_RANGE}",
    "clean_events": _with(*_CLEAN) + f"SELECT {CLEAN_VIEW} FROM clean",
    "quality_report": "WITH " + ",\n".join(_CLEAN) + _QUALITY,
    "parse_hemisphere_coord": _with(TEXTS) + """SELECT event_id, coord, CASE WHEN trim(coord) = '' THEN 0.0
  WHEN upper(split_part(trim(coord), ' ', 2)) IN ('LS', 'S', 'W', 'BB')
    THEN -TRY_CAST(split_part(trim(coord), ' ', 1) AS DOUBLE)
  ELSE TRY_CAST(split_part(trim(coord), ' ', 1) AS DOUBLE) END AS degrees FROM texts""",
    "parse_depth_km": _with(TEXTS) + """SELECT event_id, TRY_CAST(trim(replace(depth, ' km', '')) AS DOUBLE) AS depth_km
FROM texts""",
    "compose_event_id": _with(TEXTS) + """SELECT event_id,
  replace('BMKG-' || date_time || '-' || size, ' ', '_') AS bulletin_id FROM texts""",
    "coalesce_place": _with(TEXTS) + "SELECT event_id, coalesce(region, remark, '') AS place FROM texts",
    "epoch_ms_to_utc": "SELECT event_id, date_trunc('second', CAST(ts AS TIMESTAMP)) AS time_utc FROM events",
    "date_parts": _with(EV) + """SELECT event_id, year(time_utc) AS year, month(time_utc) AS month,
  hour(time_utc) AS hour_utc FROM ev""",
    "depth_category": _with(EV) + f"SELECT event_id, {depth_class('depth_km')} AS depth_category FROM ev",
    "magnitude_category": _with(EV) + f"""SELECT event_id, {size_class('magnitude')} AS magnitude_category,
  {size_class('round(magnitude - 2.5, 1)')} AS shifted_category FROM ev""",
    "fault_zone_name": _with(EV) + f"SELECT event_id, {ZONE_NAME} AS zona_sesar FROM ev",
    "fault_zone_code": _with(EV) + f"SELECT event_id, {ZONE_CODE} AS zona_sesar FROM ev",
    "is_felt": """SELECT event_id,
  coalesce(CASE WHEN event_id % 3 <> 0 THEN event_id % 5 - 1 END, 0) > 0 AS is_felt FROM events""",
    "haversine_km": _with(EV, "j AS (SELECT -6.2088 AS latitude, 106.8456 AS longitude)") + f"""SELECT event_id,
  round({distance('j', 'ev')}, 6) AS distance_km FROM ev, j""",
    "omori_rate": """SELECT event_id,
  round(10.0 / pow(greatest((event_id % 200) / 24.0, 0.001) + 0.1, 1.0), 6) AS rate FROM events""",
    "threshold_predict": _with(EV, SCORED) + """SELECT id, proba, CAST(proba >= 0.45 AS INT) AS prediction FROM scored""",
    "risk_label": _with(EV, SCORED) + """SELECT id,
  CASE y WHEN 1 THEN 'Ada Susulan' ELSE 'Tidak Ada Susulan' END AS actual_label,
  CASE WHEN proba >= 0.45 THEN 'Ada Susulan' ELSE 'Tidak Ada Susulan' END AS predicted_label,
  CASE WHEN proba >= 0.45 THEN 'TINGGI' ELSE 'RENDAH' END AS risk,
  y = CAST(proba >= 0.45 AS INT) AS matches FROM scored""",
    "mainshock_isolation": _with(EV, MAIN) + """SELECT event_id, time_utc, round(latitude, 6) AS latitude,
  round(longitude, 6) AS longitude, round(magnitude, 6) AS magnitude FROM main""",
    "aftershock_pairs": _with(EV, MAIN, PAIRS) + """SELECT mainshock_id, t0 AS mainshock_time, aftershock_id,
  t AS aftershock_time, round(mag, 6) AS aftershock_magnitude, round(km, 6) AS distance_km FROM pairs""",
    "snapshot_expand": _with(EV, MAIN) + """SELECT event_id, time_utc, unnest([1, 3, 6, 12, 24, 48, 72])
  AS snapshot_hours FROM main""",
    "build_feature_table": _FEAT + _FEATURE_ROUNDED,
    "refresh_features": _FEAT + _FEATURE_ROUNDED,
    "aftershock_features": _FEAT + """SELECT mainshock_id, snapshot_hours, count_susulan_1jam, count_susulan_6jam,
  count_susulan_24jam, round(max_mag_susulan_6jam, 6) AS max_mag_susulan_6jam,
  round(max_mag_susulan_24jam, 6) AS max_mag_susulan_24jam FROM feat""",
    "aftershock_label": _FEAT + "SELECT mainshock_id, snapshot_hours, label_susulan_besar_24jam FROM feat",
    "select_features": f"SELECT * EXCLUDE (mainshock_id, mainshock_time, snapshot_hours) FROM ({_FEAT}{_FEATURE_ROUNDED})",
    "scan_features": _FEAT + _FEATURE_ROUNDED,
    "sink_features": _FEAT + _FEATURE_ROUNDED,
    "label_distribution": _FEAT + """SELECT label_susulan_besar_24jam AS label, count(*) AS n,
  round(count(*) / sum(count(*)) OVER (), 6) AS share FROM feat GROUP BY 1""",
    "magnitude_describe": _with(EV) + """SELECT count(magnitude) AS n, round(avg(magnitude), 6) AS mean,
  round(stddev_samp(magnitude), 6) AS std, round(min(magnitude), 6) AS min,
  round(quantile_cont(magnitude, 0.25), 6) AS q25, round(quantile_cont(magnitude, 0.5), 6) AS q50,
  round(quantile_cont(magnitude, 0.75), 6) AS q75, round(max(magnitude), 6) AS max,
  min(time_utc) AS first_time, max(time_utc) AS last_time FROM ev""",
    "group_counts": _with(EV) + f"SELECT {ZONE_NAME} AS zona_sesar, source, count(*) AS n FROM ev GROUP BY 1, 2",
    "confusion_matrix": _with(EV, SCORED) + _cm(0.45),
    "classification_metrics": _with(EV, SCORED, f"cm AS ({_cm(0.45)})") + """SELECT
  round(2 * tp / (2 * tp + fp + fn), 6) AS f1_score, round(tp / (tp + fn), 6) AS recall FROM cm""",
    "average_precision": _with(EV, SCORED, _ap()),
    "average_precision_by_source": _with(EV, SCORED, _ap("source")),
    "classification_report": _with(EV, SCORED, f"cm AS ({_cm(0.45)})", """per AS (
  SELECT 'Tidak Ada Susulan (0)' AS row, tn / (tn + fn) AS p, tn / (tn + fp) AS r, tn + fp AS s FROM cm
  UNION ALL SELECT 'Ada Susulan (1)', tp / (tp + fp), tp / (tp + fn), tp + fn FROM cm),
scores AS (SELECT row, p, r, 2 * p * r / (p + r) AS f, s FROM per)""") + """SELECT row, round(p, 6) AS precision,
  round(r, 6) AS recall, round(f, 6) AS f1_score, s AS support FROM scores
UNION ALL SELECT 'accuracy', round((tn + tp) / (tn + fp + fn + tp), 6), round((tn + tp) / (tn + fp + fn + tp), 6),
  round((tn + tp) / (tn + fp + fn + tp), 6), tn + fp + fn + tp FROM cm
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(s) AS BIGINT) FROM scores
UNION ALL SELECT 'weighted avg', round(sum(p * s) / sum(s), 6), round(sum(r * s) / sum(s), 6),
  round(sum(f * s) / sum(s), 6), CAST(sum(s) AS BIGINT) FROM scores""",
    "roc_auc": _with(EV, SCORED, """by_score AS (
  SELECT proba, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM scored GROUP BY proba)""")
    + """SELECT round(sum(a.pos * b.neg * CASE WHEN a.proba > b.proba THEN 1.0 WHEN a.proba = b.proba THEN 0.5 ELSE 0.0 END)
  / (max(t.p) * max(t.n)), 6) AS roc_auc
FROM by_score a, by_score b, (SELECT CAST(sum(pos) AS DOUBLE) AS p, CAST(sum(neg) AS DOUBLE) AS n FROM by_score) t""",
    "three_metrics": "SELECT round(average_precision, 6) AS pr_auc, f1_score, recall FROM ("
    + _with(EV, SCORED, _ap()) + "), (" + _with(EV, SCORED, f"cm AS ({_cm(0.45)})") + """SELECT
  round(2 * tp / (2 * tp + fp + fn), 6) AS f1_score, round(tp / (tp + fn), 6) AS recall FROM cm)""",
    "class_weight": _with(EV, SCORED) + """SELECT count(*) FILTER (y = 1) AS positives,
  count(*) FILTER (y = 0) AS negatives,
  round(count(*) FILTER (y = 0) / count(*) FILTER (y = 1), 6) AS scale_pos_weight FROM scored""",
    "threshold_tradeoff": _with(EV, SCORED, f"cm AS (SELECT 0.45 AS threshold, * FROM ({_cm(0.45)}) "
                                f"UNION ALL SELECT 0.40, * FROM ({_cm(0.40)}))")
    + """SELECT CAST(threshold AS DOUBLE) AS threshold, tn, fp, fn, tp,
  round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(tp / (tp + fp), 6) AS precision,
  round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1_score FROM cm""",
    "psi": _with(EV, """pool AS (
  SELECT 'magnitude' AS feature, magnitude AS x, time_utc < TIMESTAMP '2024-01-16 00:00:00' AS is_ref FROM ev)""",
                 _psi(["magnitude"])) + """SELECT feature, round(psi, 6) AS psi,
  CASE WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'moderate' ELSE 'critical' END AS band FROM psi_scores""",
    "drift_quick_check": _with(EV, """newest AS (SELECT max(time_utc) AS newest FROM ev),
pool AS (
  SELECT 'magnitude' AS feature, magnitude AS x, time_utc < newest - INTERVAL 7 DAY AS is_ref
  FROM ev, newest WHERE time_utc >= newest - INTERVAL 37 DAY)""", _psi(["magnitude"]),
        "sizes AS (SELECT count(*) FILTER (is_ref) AS n_reference, count(*) FILTER (NOT is_ref) AS n_recent FROM pool)",
    ) + """SELECT CASE WHEN enough THEN 'ok' ELSE 'insufficient_data' END AS status, n_reference, n_recent,
  CASE WHEN enough THEN round(psi, 6) END AS psi_magnitude,
  coalesce(CASE WHEN enough THEN psi >= 0.1 END, false) AS should_retrain
FROM (SELECT *, n_reference >= 50 AND n_recent >= 10 AS enough FROM sizes, psi_scores)""",
    "drift_report": _with(EV, POOL, _psi(list(WATCHED)), """per_value AS (
  SELECT feature, x, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c FROM pool GROUP BY feature, x),
totals AS (
  SELECT feature, count(*) FILTER (is_ref) AS nr, count(*) FILTER (NOT is_ref) AS nc,
         stddev_pop(x) FILTER (is_ref) AS sd FROM pool GROUP BY feature),
steps AS (
  SELECT v.feature, nr, nc, sd,
         abs(sum(r) OVER w / nr - sum(c) OVER w / nc) AS gap, lead(x) OVER w - x AS width
  FROM per_value v JOIN totals USING (feature) WINDOW w AS (PARTITION BY v.feature ORDER BY x)),
dist AS (
  SELECT feature, max(nr) AS n_reference, max(nc) AS n_current, max(gap) AS ks,
         sum(gap * coalesce(width, 0)) / greatest(max(sd), 0.001) AS wn FROM steps GROUP BY feature),
judged AS (
  SELECT *, wn >= 0.1 AS drifted,
     ks > 1.3581 * sqrt((n_reference + n_current) / (CAST(n_reference AS DOUBLE) * n_current)) AS ks_drifted
  FROM dist JOIN psi_scores USING (feature))""") + """SELECT feature, n_reference, n_current, round(ks, 6) AS ks,
  round(wn, 6) AS wasserstein_normed, round(psi, 6) AS psi, drifted, ks_drifted, drifted AS distance_drifted,
  round(avg(CAST(drifted AS INT)) OVER (), 6) AS drift_share,
  avg(CAST(drifted AS INT)) OVER () >= 0.5 AS dataset_drift FROM judged""",
    "dedup_source_priority": _with(*_CLEAN) + f"SELECT {VIEW} FROM clean",
    "dedup_feed_order": _with(*_RAW) + """SELECT event_id, source, time_utc, feed_position FROM raw
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY
  CASE source WHEN 'USGS' THEN 0 WHEN 'BMKG-terkini' THEN 1 ELSE 2 END, feed_position) = 1""",
    "union_feeds": _with(EV) + """SELECT event_id, source, round(magnitude, 6) AS magnitude,
  CASE WHEN source = 'USGS' THEN depth_km END AS depth_km FROM ev""",
    "time_split": _FEAT + f"""SELECT mainshock_id, mainshock_time, snapshot_hours,
  CASE WHEN row_number() OVER (ORDER BY mainshock_time, {TOP_DIGEST.format(salt='')})
    <= floor((SELECT count(*) FROM feat) * 0.75) THEN 'train' ELSE 'test' END AS part FROM feat""",
    "stratified_split": _FEAT + f"""SELECT mainshock_id, snapshot_hours, label_susulan_besar_24jam,
  CASE WHEN row_number() OVER (PARTITION BY label_susulan_besar_24jam ORDER BY {TOP_DIGEST.format(salt='42')})
    <= round(count(*) OVER (PARTITION BY label_susulan_besar_24jam) * 0.25) THEN 'test' ELSE 'train' END AS part
FROM feat""",
    "history_keep_last": """SELECT 'model' || (user_id % 5) AS model_name, event_id AS version,
  CASE WHEN event_id % 2 = 0 THEN 'Staging' ELSE 'Production' END AS stage, CAST(ts AS TIMESTAMP) AS promoted_at,
  'run' || user_id AS mlflow_run_id, (event_id * 7919 % 1000) / 1000.0 AS pr_auc
FROM events ORDER BY ts DESC, event_id DESC LIMIT 20""",
    "current_stage": """WITH moves AS (
  SELECT 'model' || (user_id % 5) AS model_name, user_id // 5 + 1 AS version,
         CASE event_id % 3 WHEN 0 THEN 'Staging' WHEN 1 THEN 'Production' ELSE 'None' END AS stage,
         CAST(ts AS TIMESTAMP) AS moved_at, event_id % 2 = 0 AS archive_existing FROM events),
last AS (
  SELECT * FROM moves
  QUALIFY row_number() OVER (PARTITION BY model_name, version ORDER BY moved_at DESC, stage DESC) = 1)
SELECT model_name, version, moved_at AS since,
  CASE WHEN EXISTS (SELECT 1 FROM moves m WHERE m.model_name = last.model_name AND m.stage = last.stage
                    AND m.archive_existing AND m.moved_at > last.moved_at) THEN 'Archived' ELSE stage END AS stage FROM last""",
    "sort_by_time": "SELECT event_id, CAST(ts AS TIMESTAMP) AS time_utc FROM events ORDER BY ts, event_id",
    "top_runs": _with(RUNS) + """SELECT run_id, run_name, round(pr_auc, 6) AS pr_auc, round(f1_score, 6) AS f1_score,
  round(recall, 6) AS recall FROM runs WHERE status = 'FINISHED' ORDER BY runs.pr_auc DESC NULLS LAST, run_id LIMIT 10""",
    "best_run": _with(RUNS) + """SELECT run_id, round(pr_auc, 6) AS pr_auc, round(f1_score, 6) AS f1_score,
  round(recall, 6) AS recall FROM runs ORDER BY runs.pr_auc DESC NULLS LAST, run_id LIMIT 1""",
    "preview": _with(EV) + """SELECT event_id, time_utc, round(magnitude, 6) AS magnitude FROM ev
ORDER BY time_utc, event_id LIMIT 5""",
    "gate_all": _with(RUNS, GATED) + """SELECT run_id, pr_auc >= 0.35 AS pass_pr_auc, f1_score >= 0.30 AS pass_f1_score,
  recall >= 0.40 AS pass_recall, pr_auc >= 0.35 AND f1_score >= 0.30 AND recall >= 0.40 AS passed FROM gated""",
    "gate_details": _with(RUNS, GATED) + """SELECT run_id, 'pr_auc' AS metric, round(pr_auc, 6) AS actual,
  CAST(0.35 AS DOUBLE) AS threshold, pr_auc >= 0.35 AS passed FROM gated
UNION ALL SELECT run_id, 'f1_score', round(f1_score, 6), 0.30, f1_score >= 0.30 FROM gated
UNION ALL SELECT run_id, 'recall', round(recall, 6), 0.40, recall >= 0.40 FROM gated""",
    "gate_two_of_three": _with(RUNS, GATED) + """SELECT run_id,
  CAST(pr_auc >= 0.45 AS INT) + CAST(f1_score >= 0.35 AS INT) + CAST(recall >= 0.40 AS INT) AS n_passed,
  pr_auc >= 0.45 AND (f1_score >= 0.35 OR recall >= 0.40) AS passed FROM gated""",
    "promote_champion": _with(RUNS, VERSIONS, PROMOTED) + """SELECT model_name, version, run_id, stage,
  round(pr_auc, 4) AS pr_auc, round(f1_score, 4) AS f1_score, round(recall, 4) AS recall, alias
FROM promoted LEFT JOIN (SELECT run_id, pr_auc, f1_score, recall FROM runs) USING (run_id) WHERE alias = 'champion'""",
    "alias_lookup": _with(RUNS, VERSIONS, PROMOTED) + """SELECT v.model_name, v.version,
  coalesce(p.stage, 'None') AS stage, p.alias, v.run_id, round(coalesce(r.pr_auc, 0), 6) AS pr_auc,
  round(r.f1_score, 6) AS f1_score, round(r.recall, 6) AS recall
FROM versions v LEFT JOIN promoted p USING (model_name, version) LEFT JOIN runs r ON r.run_id = v.run_id""",
    "stream_ingest_dedup": _with(*_SNAP_CLEAN, ranked("screened", "event_id", "clean"))
    + f"SELECT {CLEAN_VIEW} FROM clean",
}
ORACLES["drift_quick_check_kept"] = ORACLES["drift_quick_check"]
ORACLES["drift_report_kept"] = ORACLES["drift_report"]
ORACLES["stream_merge_by_day"] = ORACLES["stream_ingest_dedup"]
ORACLES["sink_raw_snapshot"] = ORACLES["scan_raw_csv"]

_INPUTS = (
    "mainshock_magnitude", "mainshock_depth", "jam_sejak_mainshock", "count_susulan_1jam", "count_susulan_6jam",
    "count_susulan_24jam", "max_mag_susulan_6jam", "max_mag_susulan_24jam", "omori_rate_est", "zona_sesar",
)
_SQUARED = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in _INPUTS)
ORACLES["tomek_links"] = _FEAT + f""", rows AS (
  SELECT mainshock_id || '|' || snapshot_hours AS id, * FROM feat),
nearest AS (
  SELECT a.id, arg_min(b.id, (d, b.id)) AS neighbor, any_value(a.label_susulan_besar_24jam) AS y
  FROM rows a JOIN rows b ON a.id <> b.id, LATERAL (SELECT {_SQUARED} AS d)
  GROUP BY a.id)
SELECT n.id FROM nearest n JOIN nearest m ON m.id = n.neighbor AND m.neighbor = n.id WHERE n.y <> m.y"""

_DRAW = "CAST('0x' || substr(md5(concat_ws('|', '42:{n}', id, copy)), 1, 12) AS BIGINT)"
_BETWEEN = ", ".join(
    f"round(v[{i}] + share * (w[{i}] - v[{i}]), 6) AS {c}" for i, c in enumerate(_INPUTS, start=1)
)
ORACLES["smote_oversample"] = _FEAT + f""", rows AS (
  SELECT mainshock_id || '|' || snapshot_hours AS id, label_susulan_besar_24jam AS y, *,
         [{", ".join(f"CAST({c} AS DOUBLE)" for c in _INPUTS)}] AS v FROM feat),
sizes AS (
  SELECT least(count(*) FILTER (y = 1), count(*) FILTER (y = 0)) AS few,
         greatest(count(*) FILTER (y = 1), count(*) FILTER (y = 0)) AS many,
         CASE WHEN count(*) FILTER (y = 1) < count(*) FILTER (y = 0) THEN 1 ELSE 0 END AS minority FROM rows),
small AS (
  SELECT rows.*, few, many, min(id) OVER (PARTITION BY v) AS same,
         row_number() OVER (ORDER BY md5('42|' || id)) AS place
  FROM rows, sizes WHERE y = minority),
near AS (
  SELECT a.id, b.v AS w, row_number() OVER (PARTITION BY a.id ORDER BY d, b.same) - 1 AS pick
  FROM small a JOIN small b ON a.id <> b.id, LATERAL (SELECT {_SQUARED} AS d)),
copies AS (
  SELECT *, unnest(range((many - few) // few + CASE WHEN place <= (many - few) % few THEN 1 ELSE 0 END)) AS copy
  FROM small),
drawn AS (
  SELECT id, y, v, copy, {_DRAW.format(n=1)} % least(5, few - 1) AS pick, {_DRAW.format(n=2)} / 281474976710656.0 AS share
  FROM copies)
SELECT id, y, false AS synthetic, {", ".join(f"round(v[{i}], 6) AS {c}" for i, c in enumerate(_INPUTS, start=1))} FROM rows
UNION ALL
SELECT id || '#' || copy, y, true, {_BETWEEN} FROM drawn JOIN near USING (id, pick)"""
