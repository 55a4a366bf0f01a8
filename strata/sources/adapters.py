"""Adapters: the driver's tables -> domain-shaped frames (see FIXTURES.md).

Each adapter is one SQL text with a handful of engine tokens, rendered for
Spark (tables passed as DataFrame arguments to ``spark.sql``) or for DuckDB
(the oracle's pre-registered views), so both engines derive the same rows.
These are test shapes with invented formulas, not the real snapshot's
derivation.  Every adapter is row-local or groups by a key whose group size is
bounded by construction (``event_id`` is unique), so they scale with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.schemas import CITIES

TOKENS = {
    "spark": {
        "S": "STRING",
        # json_tuple is a generator: props is parsed once per row (a projected
        # get_json_object would be inlined into every pushed-down predicate).
        "K": "TRY_CAST(k_raw AS INT)",
        "KFROM": "{events} LATERAL VIEW json_tuple(props, 'k') jt AS k_raw",
        "EPOCH": "unix_seconds(CAST(ts AS TIMESTAMP))",
        "DOW": "dayofweek(ts) - 1",
        "FMTI": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
        "FMTE": "date_format(ts, \"yyyy-MM-dd'T'HH:mm\")",
        "FMTD": "date_format(ts, 'yyyy-MM-dd')",
        "FMTH": "date_format(ts, 'HH')",
        "DIV": "div",
        "MD5KEY": "md5(CAST(event_id AS STRING))",
    },
    "duckdb": {
        "S": "VARCHAR",
        "K": "TRY_CAST(json_extract_string(props, '$.k') AS INT)",
        "KFROM": "{events}",
        "EPOCH": "CAST(floor(epoch(ts)) AS BIGINT)",
        "DOW": "dayofweek(ts)",
        "FMTI": "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')",
        "FMTE": "strftime(ts, '%Y-%m-%dT%H:%M')",
        "FMTD": "strftime(ts, '%Y-%m-%d')",
        "FMTH": "strftime(ts, '%H')",
        "DIV": "//",
        "MD5KEY": "md5(CAST(event_id AS VARCHAR))",
    },
}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def render(sql: str, engine: str) -> str:
    """Replace ``@TOKEN@`` markers; ``{table}`` stays for Spark, is unbraced for DuckDB."""
    for k, v in TOKENS[engine].items():
        sql = sql.replace(f"@{k}@", v)
    if engine == "duckdb":
        for t in TABLES:
            sql = sql.replace("{" + t + "}", t)
    return sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_sql(spark: SparkSession, sf_dir: str, sql: str, **frames) -> DataFrame:
    """Render for Spark and bind the referenced base tables as DataFrame args."""
    text = render(sql, "spark")
    args = dict(frames)
    for t in TABLES:
        if "{" + t + "}" in text and t not in args:
            args[t] = table(spark, sf_dir, t)
    return spark.sql(text, **args)


MOBILITY_SQL = """
SELECT event_id,
  user_id AS vehicle_id, user_id % 12 AS route_id,
  CAST(5020 + event_id % 40 AS DOUBLE) / CAST(100 AS DOUBLE) AS lat,
  CAST(3020 + event_id % 30 AS DOUBLE) / CAST(100 AS DOUBLE) AS lng,
  value AS speed, CAST((event_id * 7) % 360 AS DOUBLE) AS dir,
  @EPOCH@ AS time_unix, CAST(CAST(ts AS DATE) AS @S@) AS ingest_date, CAST(hour(ts) AS INT) AS hour,
  CASE WHEN event_id % 9 <> 0 THEN value END AS speed_gps,
  CAST(event_id % 61 AS DOUBLE) AS dt_sec,
  value * CAST(event_id % 61 AS DOUBLE) / CAST(3600 AS DOUBLE) AS dist_km,
  CAST(@DOW@ AS INT) AS day_of_week,
  CASE WHEN hour(ts) < 6 THEN 'night' WHEN hour(ts) < 10 THEN 'morning' WHEN hour(ts) < 16 THEN 'day'
       WHEN hour(ts) < 20 THEN 'evening' ELSE 'late' END AS period,
  CAST(5020 + event_id % 40 AS DOUBLE) / CAST(100 AS DOUBLE) AS lat_grid,
  CAST(3020 + event_id % 30 AS DOUBLE) / CAST(100 AS DOUBLE) AS lng_grid,
  CASE WHEN value < 20 THEN 1 ELSE 0 END AS is_congested,
  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_alert,
  CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS is_post_alert,
  CASE WHEN event_type <> 'error' THEN CAST(k AS DOUBLE) END AS min_since_alert,
  CASE WHEN k < 97 THEN CAST(k - 30 AS DOUBLE) END AS temp_c,
  CAST(k % 7 AS DOUBLE) AS precip_mm, CAST(k % 5 AS DOUBLE) AS rain_mm, CAST(k % 3 AS DOUBLE) AS snow_cm,
  CAST(k % 2 AS DOUBLE) AS snow_depth_m, CAST(k % 40 AS DOUBLE) AS wind_kmh,
  CAST((k + 3) * 100 AS DOUBLE) AS visibility_m, CAST(k AS DOUBLE) AS cloud_pct,
  CASE WHEN k < 30 THEN 1 ELSE 0 END AS is_freezing, CASE WHEN k % 3 > 0 THEN 1 ELSE 0 END AS is_snowing,
  CASE WHEN k % 5 > 0 THEN 1 ELSE 0 END AS is_raining, CASE WHEN k < 5 THEN 1 ELSE 0 END AS bad_visibility
FROM (SELECT *, @K@ AS k FROM @KFROM@) t
"""

# Flat weather observations, one per event (the silver input before enveloping).
WEATHER_SQL = """
SELECT event_id, ts, CASE WHEN event_id % 17 <> 0 THEN 'owner' END AS author_surname, 'weather' AS domain,
  CASE WHEN event_id % 2 = 0 THEN 'current_api' ELSE 'archive_api' END AS source,
  @FMTI@ AS ingest_ts, CASE WHEN event_id % 23 = 0 THEN 'bad' ELSE @FMTE@ END AS event_time,
  concat('city_', CAST(user_id % 10 AS @S@)) AS city,
  CAST(4500 + event_id % 700 AS DOUBLE) / CAST(100 AS DOUBLE) AS latitude,
  CAST(2200 + event_id % 1700 AS DOUBLE) / CAST(100 AS DOUBLE) AS longitude,
  CAST(k * 10 AS DOUBLE) AS elevation, 'Europe/Kyiv' AS timezone, 'EET' AS timezone_abbreviation,
  CAST(k - 30 AS DOUBLE) AS temperature_2m, CAST(k + 3 AS DOUBLE) AS relative_humidity_2m,
  CAST(k % 7 AS DOUBLE) AS precipitation, value AS wind_speed_10m,
  @FMTD@ AS ingest_date, @FMTH@ AS hour
FROM (SELECT *, @K@ AS k FROM @KFROM@) t
"""

OWNER = "owner"
SOURCES = ("current_api", "archive_api")
FETCHED_AT = "2024-01-31T00:00:00Z"
AS_OF = "2024-01-25 00:00:00"
BATCH_ID = "batch-0001"


def mobility_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, MOBILITY_SQL)


def weather_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, WEATHER_SQL)


def cities_values_sql() -> str:
    """The city dimension as an inline VALUES list (pos, city, lat, lon) for SQL oracles."""
    rows = ", ".join(f"({i}, '{c}', CAST({la} AS DOUBLE), CAST({lo} AS DOUBLE))"
                     for i, (c, la, lo) in enumerate(CITIES))
    return f"(VALUES {rows}) AS cities(pos, city, city_lat, city_lon)"


# --- raw API-shaped payloads built from the weather observations -----------
# "current" responses: 10 consecutive events form one response, so every event is
# an item of one (short arrays and single objects are cases of the unit tests).
# Group size <= 10 by construction.
CURRENT_RESPONSE_DIV = 10
# "archive" responses: 100 consecutive events; item c = event_id % 12 (so items
# 10 and 11 are extra and must be dropped); per item, hourly arrays ordered by
# event_id; temperature shortened to greatest(n-2, 1), wind one element longer.
ARCHIVE_RESPONSE_DIV = 100
ARCHIVE_ITEMS = 12


def current_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(response_id, fetched_at, raw) with raw = JSON text of the API response."""
    w = weather_records(spark, sf_dir)
    item = F.struct(
        F.col("latitude"), F.col("longitude"), F.col("elevation"), F.col("timezone"),
        F.col("timezone_abbreviation"),
        F.struct(F.col("event_time").alias("time"), "temperature_2m", "relative_humidity_2m",
                 "precipitation", "wind_speed_10m").alias("current"),
        F.struct(F.lit("iso8601").alias("time"), F.lit("°C").alias("temperature_2m"),
                 F.lit("%").alias("relative_humidity_2m"), F.lit("mm").alias("precipitation"),
                 F.lit("km/h").alias("wind_speed_10m")).alias("current_units"))
    keyed = w.select(F.expr(f"event_id div {CURRENT_RESPONSE_DIV}").alias("response_id"), "event_id",
                     "ingest_ts", F.struct("event_id", item.alias("item")).alias("entry"))
    resp = keyed.groupBy("response_id").agg(
        F.max("ingest_ts").alias("fetched_at"),
        F.sort_array(F.collect_list("entry")).alias("entries"))
    items = F.transform("entries", lambda e: e["item"])
    return resp.select("response_id", "fetched_at", F.to_json(items).alias("raw"))


def archive_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = weather_records(spark, sf_dir)
    keyed = w.select(F.expr(f"event_id div {ARCHIVE_RESPONSE_DIV}").alias("response_id"),
                     (F.col("event_id") % ARCHIVE_ITEMS).alias("c"), "ingest_ts",
                     F.struct("event_id", "event_time", "temperature_2m", "relative_humidity_2m",
                              "precipitation", "wind_speed_10m", "latitude", "longitude").alias("obs"))
    per_item = keyed.groupBy("response_id", "c").agg(
        F.max("ingest_ts").alias("fetched_at"), F.sort_array(F.collect_list("obs")).alias("obs"))
    n = F.size("obs")
    first = F.get("obs", 0)
    hourly = F.struct(
        F.transform("obs", lambda o: o["event_time"]).alias("time"),
        F.slice(F.transform("obs", lambda o: o["temperature_2m"]), 1, F.greatest(n - 2, F.lit(1)))
        .alias("temperature_2m"),
        F.transform("obs", lambda o: o["relative_humidity_2m"]).alias("relative_humidity_2m"),
        F.transform("obs", lambda o: o["precipitation"]).alias("precipitation"),
        F.concat(F.transform("obs", lambda o: o["wind_speed_10m"]),
                 F.array(F.lit(-1.0))).alias("wind_speed_10m"))
    item = F.struct(first["latitude"].alias("latitude"), first["longitude"].alias("longitude"),
                    F.lit("Europe/Kyiv").alias("timezone"), hourly.alias("hourly"))
    resp = per_item.groupBy("response_id").agg(
        F.max("fetched_at").alias("fetched_at"),
        F.sort_array(F.collect_list(F.struct("c", item.alias("item")))).alias("items"))
    return resp.select("response_id", "fetched_at",
                       F.to_json(F.transform("items", lambda e: e["item"])).alias("raw"))
