"""Bronze shaping queries over payloads derived from the driver's tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..functions.schemas import ALERTS_ENVELOPE, MEASURES, envelope
from ..session import input_key, scratch_path
from ..sinks.files import land_files, write_sidecar_files
from ..sinks.writers import land_text, write_csv
from ..sources import adapters as A
from ..sources.bronze import (csv_rows_to_envelopes, document_envelope, document_field, envelope_json, history_window,
                              manifest, partition_columns, preferred_file, shape_weather_archive, shape_weather_current)
from ..sources.readers import (BRONZE_GLOB, landed_files, path_value, read_bronze, read_csv_dialect,
                               read_manifests)
from .oracle_sql import WEATHER
from .registry import register
from .silver_queries import land_weather_bronze

CITIES_SQL = A.cities_values_sql()


def flat_envelope(df: DataFrame, keys, units: bool = False) -> DataFrame:
    cols = [*keys, "ingest_ts", "source", "domain", F.col("metadata.author_surname").alias("author_surname"),
            "payload.city", "payload.latitude", "payload.longitude", "payload.elevation", "payload.timezone",
            "payload.timezone_abbreviation", *[f"payload.{m}" for m in MEASURES], "payload.event_time"]
    if units:
        cols.append(F.col("payload.units.temperature_2m").alias("unit_temperature"))
    return df.select(*cols)


def current_rows(spark, sf_dir):
    return shape_weather_current(A.current_payloads(spark, sf_dir), keep=("response_id",))


def archive_rows(spark, sf_dir):
    return shape_weather_archive(A.archive_payloads(spark, sf_dir), keep=("response_id",))


_CURRENT_CTES = f"""w AS ({WEATHER}),
r AS (SELECT event_id // 10 AS response_id, max(ingest_ts) AS fetched_at FROM w GROUP BY 1),
it AS (SELECT *, event_id // 10 AS response_id,
       row_number() OVER (PARTITION BY event_id // 10 ORDER BY event_id) - 1 AS pos FROM w),
joined AS (SELECT r.response_id, cities.pos AS city_pos, r.fetched_at, cities.city, cities.city_lat,
       cities.city_lon, it.* EXCLUDE (response_id, city, pos) FROM r CROSS JOIN {CITIES_SQL}
       LEFT JOIN it ON it.response_id = r.response_id AND it.pos = cities.pos)"""

_CURRENT_SELECT = """response_id, city_pos, fetched_at AS ingest_ts, 'current_api' AS source, 'weather' AS domain,
  'owner' AS author_surname, city, coalesce(latitude, city_lat) AS latitude, coalesce(longitude, city_lon) AS longitude,
  elevation, timezone, timezone_abbreviation, temperature_2m, relative_humidity_2m, precipitation, wind_speed_10m,
  event_time"""


@register("bronze_weather_current", f"""WITH {_CURRENT_CTES} SELECT {_CURRENT_SELECT},
    CASE WHEN event_id IS NOT NULL THEN '°C' END AS unit_temperature FROM joined""")
def q_bronze_weather_current(spark, sf_dir):
    return flat_envelope(current_rows(spark, sf_dir), ["response_id", "city_pos"], units=True)


@register("positional_city_join", f"""WITH {_CURRENT_CTES} SELECT response_id, city_pos, city,
    event_id IS NOT NULL AS has_item, coalesce(latitude, city_lat) AS latitude FROM joined""")
def q_positional_city_join(spark, sf_dir):
    df = current_rows(spark, sf_dir)
    return df.select("response_id", "city_pos", "payload.city",
                     F.col("payload.event_time").isNotNull().alias("has_item"), "payload.latitude")


_ARCHIVE_CTES = f"""w AS ({WEATHER}),
a AS (SELECT *, event_id // 100 AS response_id, event_id % 12 AS c,
      row_number() OVER (PARTITION BY event_id // 100, event_id % 12 ORDER BY event_id) - 1 AS h,
      count(*) OVER (PARTITION BY event_id // 100, event_id % 12) AS n,
      first_value(latitude) OVER (PARTITION BY event_id // 100, event_id % 12 ORDER BY event_id) AS item_lat,
      first_value(longitude) OVER (PARTITION BY event_id // 100, event_id % 12 ORDER BY event_id) AS item_lon,
      max(ingest_ts) OVER (PARTITION BY event_id // 100) AS fetched_at FROM w),
z AS (SELECT a.* EXCLUDE (city), cities.city FROM a JOIN {CITIES_SQL} ON cities.pos = a.c)"""


@register("bronze_weather_archive", f"""WITH {_ARCHIVE_CTES} SELECT response_id, CAST(c AS INTEGER) AS city_pos,
    CAST(h AS INTEGER) AS hour_pos,
    fetched_at AS ingest_ts, 'archive_api' AS source, 'weather' AS domain, 'owner' AS author_surname, city,
    item_lat AS latitude, item_lon AS longitude, CAST(NULL AS DOUBLE) AS elevation, 'Europe/Kyiv' AS timezone,
    CAST(NULL AS VARCHAR) AS timezone_abbreviation,
    CASE WHEN h < greatest(n - 2, 1) THEN temperature_2m END AS temperature_2m, relative_humidity_2m,
    precipitation, wind_speed_10m, event_time FROM z""")
def q_bronze_weather_archive(spark, sf_dir):
    return flat_envelope(archive_rows(spark, sf_dir), ["response_id", "city_pos", "hour_pos"])


@register("parallel_array_zip", f"""WITH {_ARCHIVE_CTES} SELECT response_id, city_pos, hour_pos, event_time,
    temperature_2m, relative_humidity_2m, precipitation, wind_speed_10m FROM (SELECT response_id,
    CAST(c AS INTEGER) AS city_pos, CAST(h AS INTEGER) AS hour_pos, event_time, CASE WHEN h < greatest(n - 2, 1) THEN temperature_2m END AS temperature_2m,
    relative_humidity_2m, precipitation, wind_speed_10m FROM z) t""")
def q_parallel_array_zip(spark, sf_dir):
    df = archive_rows(spark, sf_dir)
    return df.select("response_id", "city_pos", "hour_pos", "payload.event_time",
                     *[f"payload.{m}" for m in MEASURES])


# --- alerts: header CSV -> envelope JSON lines (#3) ----------------------------
ALERTS_SQL = """SELECT CAST(event_id AS @S@) AS alert_id, concat('region_', CAST(user_id % 25 AS @S@)) AS region,
  strftime_placeholder AS started_at, CAST(event_id % 120 AS @S@) AS duration_min,
  CASE event_id % 4 WHEN 0 THEN concat('line one', chr(10), 'line "two"') WHEN 1 THEN 'say "hi", ok' WHEN 2 THEN ''
       ELSE event_type END AS note
  FROM {events}"""


def _alerts_sql(engine: str) -> str:
    fmt = ("date_format(ts, 'yyyy-MM-dd HH:mm:ss')" if engine == "spark"
           else "strftime(ts, '%Y-%m-%d %H:%M:%S')")
    return A.render(ALERTS_SQL.replace("strftime_placeholder", fmt), engine)


ALERT_COLUMNS = ("alert_id", "region", "started_at", "duration_min", "note")
_ALERTS_CSV: dict = {}


def land_alerts_csv(spark: SparkSession, sf_dir: str) -> str:
    key = input_key(spark, sf_dir)
    if key not in _ALERTS_CSV:
        rows = spark.sql(_alerts_sql("spark"), events=A.table(spark, sf_dir, "events"))
        _ALERTS_CSV[key] = write_csv(rows, scratch_path(spark, "alerts_csv"))
    return _ALERTS_CSV[key]


def alerts_envelopes(spark: SparkSession, csv_path: str, fetched_at: str = A.FETCHED_AT,
                     source: str = "alerts_csv", owner: str = A.OWNER) -> DataFrame:
    return csv_rows_to_envelopes(read_csv_dialect(spark, csv_path), fetched_at, source, owner)


def land_alerts(spark: SparkSession, csv_path: str) -> str:
    """Alert envelopes as JSON lines under ``domain=/source=/ingest_date=/hour=``."""
    env = alerts_envelopes(spark, csv_path)
    lines = env.select(envelope_json().alias("value"), "domain", "source", *partition_columns(F.col("ingest_ts")))
    return land_text(lines, "value", scratch_path(spark, "alerts"), ["domain", "source", "ingest_date", "hour"])


@register("bronze_alerts_csv", f"""SELECT '{A.FETCHED_AT}' AS ingest_ts, 'alerts_csv' AS source, 'alerts' AS domain,
    'owner' AS author_surname, alert_id, region, started_at, duration_min, note FROM ({_alerts_sql('duckdb')}) t""")
def q_bronze_alerts_csv(spark, sf_dir):
    """CSV rows with quoted line ends, doubled quotes and empty fields, landed as envelopes and read back."""
    env = read_bronze(spark, land_alerts(spark, land_alerts_csv(spark, sf_dir)), ALERTS_ENVELOPE)
    return env.select("ingest_ts", "source", "domain", F.col("metadata.author_surname").alias("author_surname"),
                      *[F.col("payload")[c].alias(c) for c in ALERT_COLUMNS])


# --- whole JSON documents, pretty-printed, one per file (#4) -------------------
ROADS_DOC_DIV = 1000
_DOCS: dict = {}


def land_documents(spark: SparkSession, sf_dir: str) -> str:
    """Raw documents (JSON text) -> one-line envelopes, many to a file.

    A document groups 1000 consecutive events, so its size is bounded."""
    key = input_key(spark, sf_dir)
    if key not in _DOCS:
        w = A.weather_records(spark, sf_dir)
        el = F.struct(F.lit("node").alias("type"), F.col("event_id").alias("id"),
                      F.col("latitude").alias("lat"), F.col("longitude").alias("lon"),
                      F.struct("source").alias("tags"))
        docs = (w.groupBy(F.expr(f"event_id div {ROADS_DOC_DIV}").alias("doc_id"))
                .agg(F.sort_array(F.collect_list(el)).alias("elements"))
                .select("doc_id", F.to_json(F.struct(
                    F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("generator"),
                    F.struct(F.col("doc_id").alias("revision"), F.array("doc_id", F.lit(0)).alias("history")).alias("meta"),
                    "elements")).alias("raw")))
        env = document_envelope(docs, "raw", A.FETCHED_AT, "roads_osm", A.OWNER)
        lines = env.select(envelope_json().alias("value"), "domain", "source", *partition_columns(F.col("ingest_ts")))
        _DOCS[key] = land_text(lines, "value", scratch_path(spark, "roads"), ["domain", "source", "ingest_date", "hour"])
    return _DOCS[key]


def read_documents(spark: SparkSession, root: str, payload: T.DataType = T.VariantType(), glob: str = "*{Z.json,.txt}") -> DataFrame:
    """Each file is one (multi-line) JSON value.  The default glob takes landed
    ``part-<stamp>Z.json`` documents and our text-sink files, never ``*.meta.json`` sidecars."""
    return (spark.read.schema(envelope(payload)).option("multiLine", True)
            .option("recursiveFileLookup", True).option("pathGlobFilter", glob).json(root))


@register("bronze_json_document", f"""WITH w AS ({WEATHER}) SELECT concat('doc-', CAST(event_id // {ROADS_DOC_DIV}
    AS VARCHAR)) AS generator, event_id // {ROADS_DOC_DIV} AS revision, concat('[', CAST(event_id // {ROADS_DOC_DIV} AS VARCHAR),
    ',0]') AS history, count(*) AS n_elements, count(*) FILTER (source = 'current_api') AS n_current, min(event_id) AS min_id, max(event_id) AS max_id,
    'roads' AS domain, 'roads_osm' AS source, 'owner' AS author_surname, '{A.FETCHED_AT}' AS ingest_ts
    FROM w GROUP BY event_id // {ROADS_DOC_DIV}""")
def q_bronze_json_document(spark, sf_dir):
    """Documents landed whole and read back as VARIANT; fields are looked up by path, nested ones among them."""
    d = read_bronze(spark, land_documents(spark, sf_dir), envelope(T.VariantType()))
    p = F.col("payload")
    elements = document_field(p, "$.elements", "array<struct<id: bigint, tags: map<string, string>>>")
    ids = F.transform(elements, lambda e: e["id"])
    current = F.filter(elements, lambda e: e["tags"]["source"] == "current_api")
    return d.select(document_field(p, "$.generator", "string").alias("generator"),
                    document_field(p, "$.meta.revision", "bigint").alias("revision"),
                    F.to_json(document_field(p, "$.meta.history", "variant")).alias("history"),
                    F.size(elements).cast("bigint").alias("n_elements"), F.size(current).cast("bigint").alias("n_current"),
                    F.array_min(ids).alias("min_id"), F.array_max(ids).alias("max_id"), "domain", "source",
                    F.col("metadata.author_surname").alias("author_surname"), "ingest_ts")


@register("bronze_binary_landing")
def q_bronze_binary_landing(spark, sf_dir):
    """The files of the tables as opaque blobs: landed by name, read again and compared by digest.

    A table may be a folder of files, whose names those of other tables share, so a
    file keeps its path below the folder of the tables."""
    root, tables = scratch_path(spark, "blobs"), f"{sf_dir}/*.parquet"
    top = sf_dir.rstrip("/").rpartition("/")[2]
    files = landed_files(spark, tables)
    below = F.regexp_replace("file_path", f"^.*/{re.escape(top)}/", "")
    listing = files.select("file_path", F.concat(F.lit(f"{root}/files/"), below).alias("target"))
    return land_files(listing, f"{root}/log", tables).select(
        F.replace("target", F.lit(f"{root}/files/"), F.lit("")).alias("file_name"), "length", "content_md5", "unchanged")


@register("bronze_manifest", f"""WITH w AS ({WEATHER}) SELECT 'owner' AS author_surname, domain, source,
    CASE source WHEN 'current_api' THEN 'https://example.invalid/current'
                ELSE 'https://example.invalid/archive' END AS source_url,
    concat(ingest_date, 'T', hour, ':00:00Z') AS fetched_at, 'application/json' AS content_type, ingest_date, hour,
    'txt' AS stored_ext, false AS orphan FROM w GROUP BY domain, source, ingest_date, hour""")
def q_bronze_manifest(spark, sf_dir):
    """A sidecar file beside each landed file, read back and matched with the files."""
    root = land_weather_bronze(spark, sf_dir)
    files = landed_files(spark, root, BRONZE_GLOB)
    date, hour = (path_value(F.col("file_path"), k) for k in ("ingest_date", "hour"))
    listing = files.select("file_path", F.concat(date, F.lit("T"), hour, F.lit(":00:00Z")).alias("fetched_at"))
    records = manifest(listing, A.OWNER, {"current_api": "https://example.invalid/current",
                                          "archive_api": "https://example.invalid/archive"}, "application/json")
    write_sidecar_files(records)
    sidecars = read_manifests(spark, root)
    m = (files.select("file_path", date.alias("ingest_date"), hour.alias("hour")).join(sidecars, "file_path", "left")
         .withColumn("orphan", F.col("stored_file").isNull()))
    return m.select(
        "orphan",
        "author_surname", "domain", "source", "source_url", "fetched_at", "content_type", "ingest_date", "hour",
        F.regexp_extract("stored_file", r"\.([a-z]+)$", 1).alias("stored_ext"))


LISTING_SQL = """SELECT concat(CASE p_partkey % 4 WHEN 0 THEN 'datasets/' WHEN 1 THEN 'archive/' ELSE 'data/' END,
  'p', CAST(p_partkey AS @S@),
  CASE WHEN p_partkey % 4999 = 0 THEN '_official_data_en.csv' WHEN p_partkey % 997 = 0 THEN '_official_en.csv'
       WHEN p_partkey % 3 = 0 THEN '_official.csv' WHEN p_partkey % 2 = 0 THEN '.json' ELSE '.csv' END) AS path,
  p_partkey AS pos FROM {part}"""


@register("preferred_file", f"""SELECT path, pos, priority FROM (SELECT path, pos,
    CASE WHEN ends_with(path, 'official_data_en.csv') THEN 0 WHEN ends_with(path, 'official_en.csv') THEN 1
         WHEN starts_with(path, 'datasets/') AND contains(path, 'official') AND ends_with(path, '.csv') THEN 2
    END AS priority FROM ({A.render(LISTING_SQL, 'duckdb')}) l) t WHERE priority IS NOT NULL
    ORDER BY priority, pos LIMIT 1""")
def q_preferred_file(spark, sf_dir):
    return preferred_file(A.run_sql(spark, sf_dir, LISTING_SQL))


@register("history_window", """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-30' - 6 AND DATE '2024-01-30'""")
def q_history_window(spark, sf_dir):
    e = A.table(spark, sf_dir, "events").select("event_id", "ts")
    return history_window(e, "ts", "2024-01-30", 7).select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))
