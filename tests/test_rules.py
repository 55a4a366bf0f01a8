"""Rule sets on hand-made edge rows: nulls, NaN, boundaries, accounting."""

import math

from pyspark.sql import functions as F

from strata.functions.schemas import MOBILITY_COLUMNS
from strata.operators.quality import (mobility_condition, quality_counts, rejected_mobility, valid_modeling,
                                      valid_mobility, having_min_points)


def base_row():
    vals = {n: (1 if t in ("bigint", "int") else (1.0 if t == "double" else "x")) for n, t in MOBILITY_COLUMNS}
    vals.update(ingest_date="2024-01-01", period="day", hour=5, speed=10.0, lat=50.0, lng=30.0, temp_c=0.0,
                cloud_pct=50.0, dt_sec=1.0)
    return vals


def frame(spark, rows):
    schema = ", ".join(f"{n} {t}" for n, t in MOBILITY_COLUMNS)
    return spark.createDataFrame([tuple(r[n] for n, _ in MOBILITY_COLUMNS) for r in rows], schema)


def test_boundaries_and_nulls(spark):
    cases = {
        "ok": {}, "speed0": {"speed": 0.0}, "speed150": {"speed": 150.0}, "speed151": {"speed": 150.01},
        "lat90": {"lat": 90.0}, "lat-90.1": {"lat": -90.1}, "lng-180": {"lng": -180.0}, "lng180.5": {"lng": 180.5},
        "temp-60": {"temp_c": -60.0}, "temp100": {"temp_c": 100.0}, "temp-61": {"temp_c": -61.0},
        "hour23": {"hour": 23}, "hour24": {"hour": 24}, "dt0": {"dt_sec": 0.0}, "null_speed": {"speed": None},
        "null_alert": {"is_alert": None}, "nan_speed": {"speed": math.nan}, "nan_dist": {"dist_km": math.nan},
        "cloud100": {"cloud_pct": 100.0}, "cloud_nan": {"cloud_pct": math.nan},
    }
    rows = []
    for name, upd in cases.items():
        r = base_row()
        r.update(upd)
        r["period"] = name
        rows.append(r)
    df = frame(spark, rows)
    ok = {r["period"] for r in valid_mobility(df).select("period").collect()}
    # Spark semantics: NaN >= 0 is true (NaN is the largest double) but NaN between a and b is false.
    assert ok == {"ok", "speed0", "speed150", "lat90", "lng-180", "temp-60", "temp100", "hour23", "cloud100",
                  "nan_dist"}
    counts = quality_counts(df, mobility_condition()).first()
    assert counts["rows_before"] == len(cases)
    assert counts["rows_after"] + counts["rows_rejected"] == counts["rows_before"]
    assert rejected_mobility(df).count() == counts["rows_rejected"]


def test_modeling_rules_drop_nan(spark):
    r1, r2 = base_row(), base_row()
    r2["dist_km"] = math.nan
    df = frame(spark, [r1, r2]).withColumn("event_ts", F.current_timestamp())
    assert valid_modeling(df).count() == 1


def test_having_min_points_is_strict(spark):
    df = spark.createDataFrame([("a", 20), ("b", 21)], "k string, points_cnt long")
    assert [r.k for r in having_min_points(df, 20).collect()] == ["b"]
