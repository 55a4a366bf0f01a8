"""The adapters reproduce the expected counts published in FIXTURES.md (sf0.01)."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"


def test_gold_counts_match_fixtures(spark):
    q = E.queries()
    c = q["quality_counts"](spark, SF).first()
    assert (c.rows_before, c.rows_after, c.rows_rejected) == (10_000, 9_070, 930)
    expected = {"traffic_activity_daily": 30, "avg_speed_by_period": 150, "congestion_weather_daily": 30,
                "route_performance_daily": 297, "geo_hotspots_daily": 3_589}
    assert {k: q[k](spark, SF).count() for k in expected} == expected


def test_archive_arrays_shape(spark):
    # every event lands in exactly one archive item; items 10 and 11 of each response are dropped
    df = E.queries()["parallel_array_zip"](spark, SF)
    assert df.count() == 10_000 - sum(1 for e in range(10_000) if e % 12 >= 10)
