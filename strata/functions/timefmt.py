"""Time parsing/formatting helpers (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .schemas import ISO_Z_FORMAT, LOCAL_MINUTE_FORMAT, WEATHER_TZ

# pandas' datetime64[ns] range, in epoch seconds: outside it an epoch is "unparseable".
EPOCH_MIN_S = -9_223_372_036
EPOCH_MAX_S = 9_223_372_036


def iso_z(ts: Column) -> Column:
    """UTC instant rendered like ``2024-01-01T00:00:07Z`` (seconds, literal Z)."""
    return F.date_format(ts, ISO_Z_FORMAT)


def parse_iso_ts(text: Column) -> Column:
    """ISO-8601 text (``...Z`` or offset) -> timestamp; bad text -> null."""
    return F.try_to_timestamp(text)


def local_to_utc(text: Column, tz: str = WEATHER_TZ, fmt: str = LOCAL_MINUTE_FORMAT) -> Column:
    """Local wall-clock minute text in ``tz`` -> UTC timestamp; bad text -> null."""
    return F.to_utc_timestamp(F.try_to_timestamp(text, F.lit(fmt)), tz)


def epoch_to_ts(seconds: Column) -> Column:
    """Epoch seconds -> UTC timestamp, null when outside the representable range."""
    s = seconds.cast("bigint")
    return F.when(s.between(EPOCH_MIN_S, EPOCH_MAX_S), F.timestamp_seconds(s))


def partition_date(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def partition_hour(ts: Column) -> Column:
    """Zero-padded UTC hour (``"09"``), a string like the path value."""
    return F.date_format(ts, "HH")
