"""The three end-to-end runs on data derived from the smallest tables."""

import os

from strata.plans.gold_queries import land_snapshot_csv
from strata.plans.jobs import gold_job, ml_job, silver_job
from strata.plans.silver_queries import land_weather_bronze
from strata.session import local_path, scratch_path

from .conftest import SF_SMALL


def test_gold_job(spark):
    res = gold_job(spark, land_snapshot_csv(spark, SF_SMALL), scratch_path(spark, "gold_job"), "owner", "b1")
    assert (res["rows_before"], res["rows_after"], res["rows_rejected"]) == (1000, 925, 75)
    assert res["metrics"]["traffic_activity_daily"]["total_rows"] == 30
    assert res["metrics"]["route_performance_daily"]["total_rows"] == 0  # no group exceeds 20 points


def test_silver_job(spark):
    res = silver_job(spark, land_weather_bronze(spark, SF_SMALL), scratch_path(spark, "silver_job"), "owner",
                     as_of="2024-01-25 00:00:00", batch_id="b1")
    assert res["written"] and os.path.isdir(local_path(res["path"]))
    assert sum(t for t, _ in res["counts"].values()) == 1000


def test_ml_job(spark):
    out = scratch_path(spark, "ml_job")
    res = ml_job(spark, land_snapshot_csv(spark, SF_SMALL), out, "owner", "r1", n_init=2)
    m = res["metrics"]
    assert 0.0 <= m["logistic_regression"]["roc_auc"] <= 1.0 and m["kmeans"]["inertia"] > 0
    assert os.path.isdir(local_path(f"{out}/models/r1/linear_regression"))
