"""Explicit schemas: no inference pass, and a column always exists even when
every value in a batch is null."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values ----------------------------------------------------------
# The city dimension the weather payloads are paired with *by position*
# (item i of an API response belongs to city i).  Order matters.
CITIES = (
    ("Kyiv", 50.4501, 30.5234),
    ("Kharkiv", 49.9935, 36.2304),
    ("Odesa", 46.4825, 30.7233),
    ("Dnipro", 48.4647, 35.0462),
    ("Donetsk", 48.0159, 37.8029),
    ("Zaporizhzhia", 47.8388, 35.1396),
    ("Lviv", 49.8397, 24.0297),
    ("Kryvyi Rih", 47.9105, 33.3918),
    ("Mykolaiv", 46.9750, 31.9946),
    ("Mariupol", 47.0971, 37.5434),
)
# Local wall-clock zone of the weather API responses.
WEATHER_TZ = "Europe/Kyiv"
# Local event time format of the weather payloads.
LOCAL_MINUTE_FORMAT = "yyyy-MM-dd'T'HH:mm"
# ISO instant with a literal Z, as written in the envelope's ingest_ts.
ISO_Z_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# Preferred suffixes when choosing the alerts CSV from a repository listing,
# in priority order, then the fallback rule (prefix, infix, suffix).
PREFERRED_SUFFIXES = ("official_data_en.csv", "official_en.csv")
FALLBACK_RULE = ("datasets/", "official", ".csv")
SCHEMA_VERSION = 1
# (column, Spark SQL type) of the 32-column mobility snapshot, in file order.
MOBILITY_COLUMNS = (
    ("vehicle_id", "bigint"), ("route_id", "bigint"), ("lat", "double"), ("lng", "double"),
    ("speed", "double"), ("dir", "double"), ("time_unix", "bigint"), ("ingest_date", "string"),
    ("hour", "int"), ("speed_gps", "double"), ("dt_sec", "double"), ("dist_km", "double"),
    ("day_of_week", "int"), ("period", "string"), ("lat_grid", "double"), ("lng_grid", "double"),
    ("is_congested", "int"), ("is_alert", "int"), ("is_post_alert", "int"),
    ("min_since_alert", "double"), ("temp_c", "double"), ("precip_mm", "double"),
    ("rain_mm", "double"), ("snow_cm", "double"), ("snow_depth_m", "double"),
    ("wind_kmh", "double"), ("visibility_m", "double"), ("cloud_pct", "double"),
    ("is_freezing", "int"), ("is_snowing", "int"), ("is_raining", "int"), ("bad_visibility", "int"),
)
# Columns that a silver run adds to a row.
LINEAGE = ("schema_v", "batch_id", "processed_author_surname", "processed_source")
# Domains whose payloads do not change from pass to pass.
STATIC_DOMAINS = ("alerts", "roads")
# Measured values of a weather payload.
MEASURES = ("temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m")
# Fields of a sidecar record.
MANIFEST_FIELDS = ("author_surname", "domain", "source", "source_url", "fetched_at", "content_type", "stored_file")
# Validity of weather rows: (column, least, most, rule sets that require the column).
WEATHER_VALIDITY = (
    ("author_surname", None, None, "silver audit"),
    ("domain", None, None, "silver audit"),
    ("source", None, None, "silver audit"),
    ("ingest_ts", None, None, "silver audit"),
    ("event_ts", None, None, "silver audit"),
    ("city", None, None, "silver audit"),
    ("latitude", -90, 90, "silver audit"),
    ("longitude", -180, 180, "silver audit"),
    ("temperature_2m", -100, 100, "silver audit"),
    ("relative_humidity_2m", 0, 100, "silver audit"),
    ("precipitation", 0, None, "silver audit"),
    ("wind_speed_10m", 0, None, "silver audit"),
    ("ingest_date", None, None, "silver"),
    ("hour", None, None, "silver"),
    ("schema_v", None, None, "audit"),
    ("batch_id", None, None, "audit"),
)
# Validity of mobility rows: (column, least, most, rule sets that require the column);
# a limit in ABOVE must be exceeded, not only reached.
MOBILITY_VALIDITY = (
    ("vehicle_id", None, None, "gold modeling"),
    ("route_id", None, None, "gold modeling"),
    ("lat", -90, 90, "gold modeling"),
    ("lng", -180, 180, "gold modeling"),
    ("speed", 0, 150, "gold modeling"),
    ("dir", None, None, "modeling"),
    ("ingest_date", None, None, "gold modeling"),
    ("hour", 0, 23, "gold modeling"),
    ("dt_sec", 0, None, "gold modeling"),
    ("dist_km", 0, None, "gold modeling"),
    ("day_of_week", None, None, "modeling"),
    ("period", None, None, "gold modeling"),
    ("lat_grid", None, None, "gold modeling"),
    ("lng_grid", None, None, "gold modeling"),
    ("is_congested", None, None, "gold modeling"),
    ("is_alert", None, None, "gold"),
    ("is_post_alert", None, None, "gold"),
    ("temp_c", -60, 100, "gold modeling"),
    ("precip_mm", 0, None, "gold modeling"),
    ("rain_mm", 0, None, "gold modeling"),
    ("snow_cm", 0, None, "gold modeling"),
    ("snow_depth_m", 0, None, "gold modeling"),
    ("wind_kmh", 0, None, "gold modeling"),
    ("visibility_m", 0, None, "gold modeling"),
    ("cloud_pct", 0, 100, "gold modeling"),
    ("is_freezing", None, None, "gold modeling"),
    ("is_snowing", None, None, "gold modeling"),
    ("is_raining", None, None, "gold modeling"),
    ("bad_visibility", None, None, "gold modeling"),
    ("event_ts", None, None, "modeling"),
)
ABOVE = ("dt_sec",)
# --- end of fixed values ---------------------------------------------------

LOCATION_FIELDS = [
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("elevation", T.DoubleType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("timezone_abbreviation", T.StringType()),
]

CURRENT_BLOCK = T.StructType([T.StructField("time", T.StringType())]
                             + [T.StructField(m, T.DoubleType()) for m in MEASURES])
CURRENT_UNITS = T.StructType([T.StructField("time", T.StringType())]
                             + [T.StructField(m, T.StringType()) for m in MEASURES])

# One location item of a "current weather" response.
CURRENT_ITEM = T.StructType(LOCATION_FIELDS + [
    T.StructField("current", CURRENT_BLOCK),
    T.StructField("current_units", CURRENT_UNITS),
])

HOURLY_BLOCK = T.StructType([T.StructField("time", T.ArrayType(T.StringType()))]
                            + [T.StructField(m, T.ArrayType(T.DoubleType())) for m in MEASURES])
# One location item of an "archive" response: parallel hourly arrays.
ARCHIVE_ITEM = T.StructType(LOCATION_FIELDS + [T.StructField("hourly", HOURLY_BLOCK)])

WEATHER_PAYLOAD = T.StructType(
    [T.StructField("city", T.StringType())]
    + LOCATION_FIELDS
    + [T.StructField(m, T.DoubleType()) for m in MEASURES]
    + [T.StructField("event_time", T.StringType()), T.StructField("units", CURRENT_UNITS)]
)

METADATA = T.StructType([T.StructField("author_surname", T.StringType())])


def envelope(payload: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("ingest_ts", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("domain", T.StringType()),
        T.StructField("metadata", METADATA),
        T.StructField("payload", payload),
    ])


WEATHER_ENVELOPE = envelope(WEATHER_PAYLOAD)
# Alerts rows are header-driven CSV rows: any header -> string value.
ALERTS_ENVELOPE = envelope(T.MapType(T.StringType(), T.StringType()))

MANIFEST = T.StructType([T.StructField(n, T.StringType()) for n in MANIFEST_FIELDS])

SILVER_WEATHER = T.StructType([
    T.StructField("author_surname", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("ingest_ts", T.TimestampType()),
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("city", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("elevation", T.DoubleType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("timezone_abbreviation", T.StringType()),
    T.StructField("temperature_2m", T.DoubleType()),
    T.StructField("relative_humidity_2m", T.DoubleType()),
    T.StructField("precipitation", T.DoubleType()),
    T.StructField("wind_speed_10m", T.DoubleType()),
    T.StructField("ingest_date", T.StringType()),
    T.StructField("hour", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("schema_v", T.IntegerType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("processed_author_surname", T.StringType()),
    T.StructField("processed_source", T.StringType()),
])

_SQL_TO_TYPE = {"bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
                "string": T.StringType()}

MOBILITY = T.StructType([T.StructField(n, _SQL_TO_TYPE[t]) for n, t in MOBILITY_COLUMNS])

