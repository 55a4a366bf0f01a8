"""Projections: flattening, casting, lineage columns, feature selection."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.schemas import LINEAGE, MOBILITY_COLUMNS, SCHEMA_VERSION, SILVER_WEATHER, WEATHER_PAYLOAD
from ..functions.timefmt import epoch_to_ts, local_to_utc, parse_iso_ts


# Names that readers give to columns without a header: none, ``_c<n>``, ``Unnamed: <n>``.
_HEADERLESS = re.compile(r"_c\d+|Unnamed: \d+|")


def synthetic_columns(columns: list[str]) -> list[str]:
    """Index columns left by CSV round trips; real names such as ``_city`` stay."""
    return list(filter(_HEADERLESS.fullmatch, columns))


def drop_synthetic_columns(df: DataFrame) -> DataFrame:
    names = synthetic_columns(df.columns)
    return df.drop(*names) if names else df


def typed_mobility(df: DataFrame, owner: str, schema_v: int = SCHEMA_VERSION,
                   keep: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """The 32 snapshot columns with explicit, non-throwing casts + lineage literals.

    ``try_cast`` keeps the reference's "bad value -> null" behaviour under ANSI mode.
    """
    casts = [F.col(f"`{n}`").try_cast(t).alias(n) for n, t in MOBILITY_COLUMNS]
    kept = [F.col(k) for k in keep if k in df.columns]
    return df.select(*kept, *casts, F.lit(owner).alias("gold_author_surname"),
                     F.lit(schema_v).alias("schema_v"))


def lineage_columns(df: DataFrame, batch_id: Column | str, owner: str, processed_source: Column | str | None = None,
                    schema_v: int = SCHEMA_VERSION) -> DataFrame:
    cols = {"schema_v": F.lit(schema_v), "batch_id": batch_id if isinstance(batch_id, Column) else F.lit(batch_id),
            "processed_author_surname": F.lit(owner)}
    if processed_source is not None:
        cols["processed_source"] = (processed_source if isinstance(processed_source, Column)
                                    else F.lit(processed_source))
    return df.withColumns(cols)


def normalize_weather(bronze: DataFrame, batch_id: str, owner: str,
                      processed_source: Column | str | None = None) -> DataFrame:
    """Flatten the envelope, cast, convert local event time to UTC, add lineage.

    ``processed_source`` defaults to the ``source=`` path partition so that one
    plan can run over every source at once (each row is judged against the
    source folder it was landed in).
    """
    if processed_source is None:
        processed_source = F.nullif(F.regexp_extract("file_path", r"source=([^/]+)", 1), F.lit(""))
    # a batch id of its own for every source
    label = processed_source if isinstance(processed_source, Column) else F.lit(processed_source)
    batch = F.concat_ws("-", F.lit(batch_id), label)
    in_payload = set(WEATHER_PAYLOAD.fieldNames())
    derived = {"author_surname": F.col("metadata.author_surname"), "ingest_ts": parse_iso_ts(F.col("ingest_ts")),
               "event_ts": local_to_utc(F.col("payload.event_time"))}

    def value(f):
        """A silver column: derived, or cast from the payload, or as the reader gave it."""
        if f.name in derived:
            return derived[f.name]
        return F.col(f"payload.{f.name}").try_cast(f.dataType) if f.name in in_payload else F.col(f.name)

    stored = [f for f in SILVER_WEATHER.fields if f.name not in LINEAGE]
    return lineage_columns(bronze.select(*[value(f).alias(f.name) for f in stored]), batch, owner, processed_source)


# --- fixed values: feature lists of the models ---
FEATURES = ("hour", "day_of_week", "period", "dir", "dt_sec", "dist_km", "speed_gps", "temp_c",
            "precip_mm", "wind_kmh", "visibility_m", "cloud_pct", "is_freezing", "is_raining",
            "is_snowing", "bad_visibility", "lat_grid", "lng_grid")
NUMERIC_FEATURES = tuple(f for f in FEATURES if f != "period")
CATEGORICAL_FEATURES = ("period",)
CLUSTER_FEATURES = ("lat_grid", "lng_grid", "speed", "temp_c", "precip_mm", "wind_kmh", "visibility_m")
# --- end of fixed values ---


def with_event_ts(df: DataFrame) -> DataFrame:
    return df.withColumn("event_ts", epoch_to_ts(F.col("time_unix")))


def feature_projection(df: DataFrame, key: str = "event_id") -> DataFrame:
    """18 features + the two labels (speed, is_congested as int)."""
    keys = [key] if key in df.columns else []
    return df.select(*keys, *FEATURES, F.col("speed").alias("label_speed"),
                     F.col("is_congested").cast("int").alias("label_congested"))
