"""Bronze shaping: raw payloads -> enveloped rows, partition paths, manifests.

Downloads are out of scope; these jobs start from landed payload text.  All
shaping is narrow (per payload row): positions pair a response item with the
fixed city dimension through ``posexplode``/``get`` on a literal array, so no
join and no shuffle is needed, and a payload's arrays never leave its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..functions.schemas import ARCHIVE_ITEM, CITIES, CURRENT_ITEM, FALLBACK_RULE, PREFERRED_SUFFIXES
from ..functions.timefmt import partition_date, partition_hour, parse_iso_ts
from .readers import path_value


def city_array() -> Column:
    """The city dimension as a literal array<struct<city, latitude, longitude>>."""
    return F.array(*[F.struct(F.lit(c).alias("city"), F.lit(la).alias("latitude"), F.lit(lo).alias("longitude"))
                     for c, la, lo in CITIES])


def parse_items(raw: Column, item_schema: T.StructType) -> Column:
    """JSON text that is either an array of items or one object -> array of items."""
    text = F.ltrim(raw)
    return (F.when(text.startswith("["), F.from_json(raw, T.ArrayType(item_schema)))
            .otherwise(F.array(F.from_json(raw, item_schema))))


def envelope_cols(ingest_ts: Column, source: str, domain: str, owner: str) -> list[Column]:
    return [ingest_ts.alias("ingest_ts"), F.lit(source).alias("source"), F.lit(domain).alias("domain"),
            F.struct(F.lit(owner).alias("author_surname")).alias("metadata")]


def shape_weather_current(payloads: DataFrame, raw: str = "raw", fetched_at: str = "fetched_at",
                          source: str = "current_api", owner: str = "owner",
                          keep: tuple[str, ...] = ()) -> DataFrame:
    """One envelope row per city of the dimension; city i takes item i of the
    response (array or single object).  A missing item keeps the city's own
    coordinates and nulls elsewhere; items beyond the dimension are dropped."""
    items = F.coalesce(parse_items(F.col(raw), CURRENT_ITEM), F.array().cast(T.ArrayType(CURRENT_ITEM)))
    paired = payloads.select(
        *keep, F.col(fetched_at).alias("_fetched"),
        F.posexplode(F.zip_with(city_array(), F.slice(items, 1, len(CITIES)),
                                lambda c, it: F.struct(c.alias("c"), it.alias("it")))).alias("city_pos", "p"))
    c, it = F.col("p.c"), F.col("p.it")
    payload = F.struct(
        c["city"].alias("city"),
        F.coalesce(it["latitude"], c["latitude"]).alias("latitude"),
        F.coalesce(it["longitude"], c["longitude"]).alias("longitude"),
        it["elevation"].alias("elevation"), it["timezone"].alias("timezone"),
        it["timezone_abbreviation"].alias("timezone_abbreviation"),
        it["current"]["temperature_2m"].alias("temperature_2m"),
        it["current"]["relative_humidity_2m"].alias("relative_humidity_2m"),
        it["current"]["precipitation"].alias("precipitation"),
        it["current"]["wind_speed_10m"].alias("wind_speed_10m"),
        it["current"]["time"].alias("event_time"),
        it["current_units"].alias("units"))
    return paired.select(*keep, "city_pos", *envelope_cols(F.col("_fetched"), source, "weather", owner),
                         payload.alias("payload"))


def shape_weather_archive(payloads: DataFrame, raw: str = "raw", fetched_at: str = "fetched_at",
                          source: str = "archive_api", owner: str = "owner",
                          keep: tuple[str, ...] = ()) -> DataFrame:
    """Per city, one row per element of ``hourly.time``; the value arrays are
    read at the same index (``get`` -> null past the end, so shorter arrays give
    nulls and longer ones are cut).  No ``units``.  Bare ``arrays_zip`` would be
    wrong: it pads to the longest array."""
    items = parse_items(F.col(raw), ARCHIVE_ITEM)
    per_city = (payloads.select(*keep, F.col(fetched_at).alias("_fetched"), F.posexplode(items).alias("city_pos", "it"))
                .where(F.col("city_pos") < len(CITIES))
                .withColumn("c", F.get(city_array(), F.col("city_pos"))))
    hours = per_city.select(*keep, "city_pos", "_fetched", "c", "it",
                            F.posexplode(F.col("it.hourly.time")).alias("h", "event_time"))
    it, c, h = F.col("it"), F.col("c"), F.col("h")
    payload = F.struct(
        c["city"].alias("city"),
        F.coalesce(it["latitude"], c["latitude"]).alias("latitude"),
        F.coalesce(it["longitude"], c["longitude"]).alias("longitude"),
        it["elevation"].alias("elevation"), it["timezone"].alias("timezone"),
        it["timezone_abbreviation"].alias("timezone_abbreviation"),
        *[F.get(it["hourly"][m], h).alias(m) for m in ("temperature_2m", "relative_humidity_2m",
                                                        "precipitation", "wind_speed_10m")],
        F.col("event_time"))
    return hours.select(*keep, "city_pos", F.col("h").alias("hour_pos"),
                        *envelope_cols(F.col("_fetched"), source, "weather", owner), payload.alias("payload"))


def envelope_json() -> Column:
    """An envelope row as one JSON line."""
    return F.to_json(F.struct("ingest_ts", "source", "domain", "metadata", "payload"))


def partition_columns(ingest_ts_text: Column) -> list[Column]:
    """``ingest_date`` (yyyy-MM-dd) and zero-padded ``hour`` of the fetch time, in UTC."""
    ts = parse_iso_ts(ingest_ts_text)
    return [partition_date(ts).alias("ingest_date"), partition_hour(ts).alias("hour")]


def partition_dir(domain: Column, source: Column, ingest_date: Column, hour: Column) -> Column:
    return F.concat(F.lit("domain="), domain, F.lit("/source="), source, F.lit("/ingest_date="), ingest_date,
                    F.lit("/hour="), hour)


def csv_rows_to_envelopes(rows: DataFrame, fetched_at: str, source: str, owner: str,
                          domain: str = "alerts") -> DataFrame:
    """Header-CSV rows (all strings) -> envelope rows whose payload maps header to value."""
    payload = F.create_map(*[x for c in rows.columns for x in (F.lit(c), F.col(f"`{c}`"))])
    return rows.select(*envelope_cols(F.lit(fetched_at), source, domain, owner), payload.alias("payload"))


def document_envelope(docs: DataFrame, raw: str, fetched_at: str, source: str, owner: str, domain: str = "roads") -> DataFrame:
    """A whole JSON document as the VARIANT payload of one envelope record.

    No schema is named, so every field of the document is kept, known or not;
    text that does not begin with a JSON value gives a null payload (Spark's parser
    ignores what follows the value)."""
    return docs.select(*envelope_cols(F.lit(fetched_at), source, domain, owner),
                       F.try_parse_json(F.col(raw)).alias("payload"))


def document_field(payload: Column, path: str, kind: str) -> Column:
    """A field of a VARIANT payload, null where it is missing or of another kind."""
    return F.try_variant_get(payload, path, kind)


def manifest(landed: DataFrame, owner: str, source_urls: dict[str, str], content_type: str,
             keep: tuple[str, ...] = ()) -> DataFrame:
    """Sidecar records, one per landed file, from a listing with ``file_path`` and
    ``fetched_at`` (which the folder names tell, so no file is opened)."""
    fp = F.col("file_path")
    url = F.lit(None).cast("string")
    for s, u in source_urls.items():
        url = F.when(path_value(fp, "source") == s, F.lit(u)).otherwise(url)
    return landed.select(
        F.lit(owner).alias("author_surname"), path_value(fp, "domain").alias("domain"),
        path_value(fp, "source").alias("source"), url.alias("source_url"),
        F.col("fetched_at"), F.lit(content_type).alias("content_type"),
        F.regexp_extract(fp, r"([^/]+)$", 1).alias("stored_file"), fp.alias("file_path"), *keep)


def orphan_files(files: DataFrame, manifests: DataFrame) -> DataFrame:
    """Landed files without a sidecar record, matched on the full path (file
    names repeat across domain/source folders)."""
    return files.join(manifests.select("file_path"), "file_path", "left_anti")


def preferred_file(listing: DataFrame, path: str = "path", pos: str = "pos") -> DataFrame:
    """Pick one path: the first preferred suffix in priority order, then the
    fallback rule, ties by listing position.  ``orderBy().limit(1)`` plans as a
    TakeOrdered (top-1 per task, then one merge).  Empty result = none found."""
    p = F.col(path)
    prio = F.lit(None).cast("int")
    prefix, infix, suffix = FALLBACK_RULE
    fallback = p.startswith(prefix) & p.contains(infix) & p.endswith(suffix)
    prio = F.when(fallback, F.lit(len(PREFERRED_SUFFIXES))).otherwise(prio)
    for i, s in reversed(list(enumerate(PREFERRED_SUFFIXES))):
        prio = F.when(p.endswith(s), F.lit(i)).otherwise(prio)
    return (listing.select(p.alias("path"), F.col(pos).alias("pos"), prio.alias("priority"))
            .where(F.col("priority").isNotNull()).orderBy("priority", "pos").limit(1))


def history_window(df: DataFrame, ts_col: str, end_date: str, days: int) -> DataFrame:
    """Inclusive last-``days`` window ending at ``end_date``: start = end - max(days-1, 0).

    Expressed as a half-open range on the raw timestamp so the bounds are pushed
    to the Parquet scan as row-group filters."""
    start = F.date_sub(F.lit(end_date).cast("date"), max(days - 1, 0))
    stop = F.date_add(F.lit(end_date).cast("date"), 1)
    ts = F.col(ts_col)
    return df.where((ts >= start.cast("timestamp_ntz")) & (ts < stop.cast("timestamp_ntz")))
