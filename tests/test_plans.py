"""Plan guards: what every registered query must (not) contain."""

import pytest

from strata.plans.registry import load_all

from .conftest import SF_SMALL

QUERIES, _ = load_all()
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "CartesianProduct",
             "BroadcastNestedLoopJoin")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_udf_or_cross_join(spark, key):
    plan = plan_of(QUERIES[key](spark, SF_SMALL))
    assert not [f for f in FORBIDDEN if f in plan], plan


def test_silver_distincts_is_one_scan(spark):
    from strata.operators.profile import silver_distincts

    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet").selectExpr(
        "o_orderstatus AS author_surname", "1 AS schema_v", "o_orderpriority AS batch_id")
    assert plan_of(silver_distincts(df)).count("FileScan") == 1


def test_current_payload_is_parsed_once(spark):
    from strata.sources.bronze import shape_weather_current

    df = spark.range(3).selectExpr("id AS response_id", "'F' AS fetched_at", "string(id) AS raw")
    plan = spark._jvm.PythonSQLUtils.explainString(shape_weather_current(df)._jdf.queryExecution(), "extended")
    optimized = plan[plan.index("Optimized Logical Plan"):plan.index("Physical Plan")]
    # the parsed items are an argument of zip_with; its function only pairs
    pairing = optimized[optimized.index("lambdafunction("):]
    assert "from_json" not in pairing


def test_gold_tables_share_two_aggregates(spark):
    from strata.operators import metrics as M
    from strata.plans.gold_queries import clean_points

    clean = clean_points(spark, SF_SMALL)
    shared = M.gold_tables(M.cells(clean, M.CELL, M.ALL_MEASURES), M.visits(clean))
    for name, fn in M.GOLD_METRICS.items():
        a, b = (sorted(map(str, df.selectExpr(*[f"round({c}, 9) AS {c}" if t == "double" else c for c, t in df.dtypes])
                           .collect())) for df in (shared[name], fn(clean)))
        assert a == b


def formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_gold_scan_prunes_and_pushes(spark):
    plan = formatted(QUERIES["route_performance_daily"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(event_id), IsNotNull(ts), IsNotNull(user_id), IsNotNull(value), " \
           "GreaterThanOrEqual(value,0.0), LessThanOrEqual(value,150.0)]" in plan
    # only the columns the rules and metrics need are read (no event_type: its flags are never null)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double,props:string>" in plan


def test_bronze_shaping_is_narrow(spark):
    from strata.sources.bronze import shape_weather_archive, shape_weather_current

    df = spark.createDataFrame([(1, "F", "[]")], "response_id long, fetched_at string, raw string")
    for op in (shape_weather_current, shape_weather_archive):
        assert "Exchange" not in plan_of(op(df)) and "Join" not in plan_of(op(df))


def test_sampling_is_narrow(spark):
    from strata.operators.sampling import hash_sample, split_by_hash

    df = spark.range(100).withColumnRenamed("id", "k")
    assert "Exchange" not in plan_of(hash_sample(df, "k", 0.1))
    assert "Exchange" not in plan_of(split_by_hash(df, "k", 0.2))
