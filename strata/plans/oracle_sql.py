"""Shared SQL fragments for the DuckDB oracles (independent of the Spark code paths)."""

from __future__ import annotations

from ..functions.schemas import MOBILITY_COLUMNS
from ..sources.adapters import MOBILITY_SQL, WEATHER_SQL, render

MOBILITY = render(MOBILITY_SQL, "duckdb")
WEATHER = render(WEATHER_SQL, "duckdb")


def dec6(expr: str) -> str:
    return f"CAST({expr} + CAST(0.000000013 AS DOUBLE) AS DECIMAL(18,6))"


TYPED_COLS = ", ".join(f"CAST({n} AS {'VARCHAR' if t == 'string' else t.upper()}) AS {n}"
                       for n, t in MOBILITY_COLUMNS)

MOBILITY_COND = """
vehicle_id IS NOT NULL AND route_id IS NOT NULL AND lat IS NOT NULL AND lng IS NOT NULL
AND speed IS NOT NULL AND dt_sec IS NOT NULL AND dist_km IS NOT NULL AND ingest_date IS NOT NULL
AND hour IS NOT NULL AND period IS NOT NULL AND lat_grid IS NOT NULL AND lng_grid IS NOT NULL
AND is_congested IS NOT NULL AND is_alert IS NOT NULL AND is_post_alert IS NOT NULL AND temp_c IS NOT NULL
AND precip_mm IS NOT NULL AND rain_mm IS NOT NULL AND snow_cm IS NOT NULL AND snow_depth_m IS NOT NULL
AND wind_kmh IS NOT NULL AND visibility_m IS NOT NULL AND cloud_pct IS NOT NULL AND is_freezing IS NOT NULL
AND is_snowing IS NOT NULL AND is_raining IS NOT NULL AND bad_visibility IS NOT NULL
AND speed >= 0 AND speed <= 150 AND dt_sec > 0 AND dist_km >= 0 AND lat BETWEEN -90 AND 90
AND lng BETWEEN -180 AND 180 AND temp_c BETWEEN -60 AND 100 AND precip_mm >= 0 AND rain_mm >= 0
AND snow_cm >= 0 AND snow_depth_m >= 0 AND wind_kmh >= 0 AND visibility_m >= 0
AND cloud_pct BETWEEN 0 AND 100 AND hour BETWEEN 0 AND 23
"""

MODELING_COND = """
vehicle_id IS NOT NULL AND route_id IS NOT NULL AND lat IS NOT NULL AND lng IS NOT NULL
AND speed IS NOT NULL AND dir IS NOT NULL AND dt_sec IS NOT NULL AND dist_km IS NOT NULL
AND ingest_date IS NOT NULL AND hour IS NOT NULL AND day_of_week IS NOT NULL AND period IS NOT NULL
AND lat_grid IS NOT NULL AND lng_grid IS NOT NULL AND is_congested IS NOT NULL AND temp_c IS NOT NULL
AND precip_mm IS NOT NULL AND rain_mm IS NOT NULL AND snow_cm IS NOT NULL AND snow_depth_m IS NOT NULL
AND wind_kmh IS NOT NULL AND visibility_m IS NOT NULL AND cloud_pct IS NOT NULL AND is_freezing IS NOT NULL
AND is_snowing IS NOT NULL AND is_raining IS NOT NULL AND bad_visibility IS NOT NULL AND event_ts IS NOT NULL
AND NOT isnan(lat) AND NOT isnan(lng) AND NOT isnan(speed) AND NOT isnan(dir) AND NOT isnan(dt_sec)
AND NOT isnan(dist_km) AND NOT isnan(lat_grid) AND NOT isnan(lng_grid) AND NOT isnan(temp_c)
AND NOT isnan(precip_mm) AND NOT isnan(rain_mm) AND NOT isnan(snow_cm) AND NOT isnan(snow_depth_m)
AND NOT isnan(wind_kmh) AND NOT isnan(visibility_m) AND NOT isnan(cloud_pct)
AND speed >= 0 AND speed <= 150 AND dt_sec > 0 AND dist_km >= 0 AND lat BETWEEN -90 AND 90
AND lng BETWEEN -180 AND 180 AND temp_c BETWEEN -60 AND 100 AND precip_mm >= 0 AND rain_mm >= 0
AND snow_cm >= 0 AND snow_depth_m >= 0 AND wind_kmh >= 0 AND visibility_m >= 0
AND cloud_pct BETWEEN 0 AND 100 AND hour BETWEEN 0 AND 23
"""

# CTE chain: mp (adapter) -> typed -> clean (gold rules).
GOLD_CTES = f"""
mp AS ({MOBILITY}),
typed AS (SELECT event_id, {TYPED_COLS}, 'owner' AS gold_author_surname, 1 AS schema_v FROM mp),
clean AS (SELECT * FROM typed WHERE {MOBILITY_COND})
"""

# Modeling set: typed + event_ts + owner, cleaned with the ML rules.
_MOBILITY_NAMES = ", ".join(n for n, _ in MOBILITY_COLUMNS)
MODEL_CTES = f"""
mp AS ({MOBILITY}),
typed AS (SELECT event_id, {TYPED_COLS} FROM mp),
timed AS (SELECT event_id, {_MOBILITY_NAMES}, CASE WHEN time_unix BETWEEN -9223372036 AND 9223372036
                         THEN timezone('UTC', to_timestamp(time_unix)) END AS event_ts,
                         'owner' AS model_author_surname FROM typed),
model AS (SELECT * FROM timed WHERE {MODELING_COND})
"""
