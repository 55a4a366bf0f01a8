"""Gold layer: typed mobility points -> rules -> five metric tables (+ sinks)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.schemas import MOBILITY_COLUMNS
from ..functions.stats import stable_dec6
from ..operators import metrics as M
from ..operators.projections import drop_synthetic_columns, typed_mobility
from ..operators.quality import (having_min_points, mobility_condition, quality_counts, rejected_mobility,
                                 valid_mobility)
from ..session import input_key, scratch_path
from ..sinks.writers import versioned_path, write_csv, write_gold_csv
from ..sources.adapters import BATCH_ID, OWNER, mobility_points
from ..sources.readers import read_csv_strings, read_csv_typed, read_gold_metric
from .oracle_sql import GOLD_CTES, dec6
from .registry import register


def typed_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_mobility(mobility_points(spark, sf_dir), OWNER)


def clean_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_mobility(typed_points(spark, sf_dir))


def stable(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: stable_dec6(F.col(c)) for c in cols})


def _metric_query(name):
    def q(spark, sf_dir):
        return stable(M.GOLD_METRICS[name](clean_points(spark, sf_dir)), M.AVERAGE_COLUMNS[name])
    q.__name__ = name
    return q


_METRIC_SQL = {
    "traffic_activity_daily": f"""SELECT ingest_date, count(DISTINCT vehicle_id) AS active_vehicles,
        count(DISTINCT route_id) AS active_routes, count(*) AS movement_points,
        {dec6('avg(speed)')} AS avg_speed_kmh FROM clean GROUP BY ingest_date""",
    "avg_speed_by_period": f"""SELECT ingest_date, period, {dec6('avg(speed)')} AS avg_speed_kmh,
        CAST(sum(is_congested) AS BIGINT) AS congested_points, count(*) AS points_cnt FROM clean GROUP BY ingest_date, period""",
    "congestion_weather_daily": f"""SELECT ingest_date, {dec6('avg(is_congested)')} AS congested_share,
        {dec6('avg(is_alert)')} AS alert_share, {dec6('avg(is_post_alert)')} AS post_alert_share,
        {dec6('avg(temp_c)')} AS avg_temp_c, {dec6('avg(precip_mm)')} AS avg_precip_mm,
        {dec6('avg(bad_visibility)')} AS bad_visibility_share, {dec6('avg(is_freezing)')} AS freezing_share
        FROM clean GROUP BY ingest_date""",
    "route_performance_daily": f"""SELECT * FROM (SELECT ingest_date, route_id,
        count(DISTINCT vehicle_id) AS vehicles_cnt, count(*) AS points_cnt,
        {dec6('avg(speed)')} AS avg_speed_kmh, {dec6('avg(dist_km)')} AS avg_dist_km,
        {dec6('avg(is_congested)')} AS congestion_rate FROM clean GROUP BY ingest_date, route_id) r
        WHERE points_cnt > 20""",
    "geo_hotspots_daily": f"""SELECT ingest_date, lat_grid, lng_grid, count(*) AS points_cnt,
        {dec6('avg(speed)')} AS avg_speed_kmh, {dec6('avg(is_congested)')} AS congestion_rate,
        {dec6('avg(is_alert)')} AS alerts_rate, {dec6('avg(bad_visibility)')} AS bad_visibility_rate
        FROM clean GROUP BY ingest_date, lat_grid, lng_grid""",
}

for _name in M.GOLD_METRICS:
    register(_name, f"WITH {GOLD_CTES} {_METRIC_SQL[_name]}")(_metric_query(_name))


@register("typed_mobility", f"WITH {GOLD_CTES} SELECT * FROM typed")
def q_typed_mobility(spark, sf_dir):
    return typed_points(spark, sf_dir)


@register("valid_mobility", f"WITH {GOLD_CTES} SELECT * FROM clean")
def q_valid_mobility(spark, sf_dir):
    return clean_points(spark, sf_dir)


@register("rejected_mobility", f"WITH {GOLD_CTES} SELECT * FROM typed WHERE NOT ("
          "event_id IN (SELECT event_id FROM clean))")
def q_rejected_mobility(spark, sf_dir):
    return rejected_mobility(typed_points(spark, sf_dir))


@register("quality_counts", f"""WITH {GOLD_CTES} SELECT (SELECT count(*) FROM typed) AS rows_before,
    (SELECT count(*) FROM clean) AS rows_after,
    (SELECT count(*) FROM typed) - (SELECT count(*) FROM clean) AS rows_rejected""")
def q_quality_counts(spark, sf_dir):
    return quality_counts(typed_points(spark, sf_dir), mobility_condition())


@register("having_min_points", f"""WITH {GOLD_CTES} SELECT ingest_date, route_id, count(*) AS points_cnt
    FROM clean GROUP BY ingest_date, route_id HAVING count(*) > 20""")
def q_having_min_points(spark, sf_dir):
    agg = clean_points(spark, sf_dir).groupBy("ingest_date", "route_id").agg(F.count(F.lit(1)).alias("points_cnt"))
    return having_min_points(agg, 20)


# --- CSV snapshot round trips (#12, #13, #23) -------------------------------
_SNAPSHOT_CACHE: dict = {}


def land_snapshot_csv(spark: SparkSession, sf_dir: str) -> str:
    """Land the mobility snapshot as a header CSV with a leading pandas-style
    index column, like the notebooks' input.  Landed once per session+input."""
    key = input_key(spark, sf_dir)
    if key not in _SNAPSHOT_CACHE:
        mp = mobility_points(spark, sf_dir)
        snap = mp.select(F.col("event_id").alias("Unnamed: 0"), "event_id", *[n for n, _ in MOBILITY_COLUMNS])
        _SNAPSHOT_CACHE[key] = write_csv(snap, scratch_path(spark, "snapshot_csv"))
    return _SNAPSHOT_CACHE[key]


@register("read_mobility_csv", f"WITH {GOLD_CTES} SELECT * FROM typed")
def q_read_mobility_csv(spark, sf_dir):
    raw = read_csv_strings(spark, land_snapshot_csv(spark, sf_dir))
    return typed_mobility(drop_synthetic_columns(raw).withColumn("event_id", F.col("event_id").try_cast("bigint")), OWNER)


@register("drop_synthetic_columns", f"WITH {GOLD_CTES} SELECT * FROM typed")
def q_drop_synthetic_columns(spark, sf_dir):
    """The explicit schema, read by header name: no inference pass."""
    raw = read_csv_typed(spark, land_snapshot_csv(spark, sf_dir), index_cols=("Unnamed: 0",),
                         extra=(("event_id", "bigint"),))
    return typed_mobility(drop_synthetic_columns(raw), OWNER)


@register("read_mobility_typed", f"WITH {GOLD_CTES} SELECT * FROM typed")
def q_read_mobility_typed(spark, sf_dir):
    raw = read_csv_typed(spark, land_snapshot_csv(spark, sf_dir), index_cols=("Unnamed: 0",),
                         extra=(("event_id", "bigint"),))
    return typed_mobility(drop_synthetic_columns(raw), OWNER)


# --- gold sinks (#18, #15) ----------------------------------------------------
def run_gold(spark: SparkSession, sf_dir: str, root: str | None = None, batch_id: str = BATCH_ID,
             owner: str = OWNER) -> dict[str, str]:
    """Build the five metric tables from the two shared pre-aggregates and write them.

    Points are read twice, once for each pre-aggregate; the tables are made from
    the aggregates, which are landed in the shared folder."""
    root = root or scratch_path(spark, "gold")
    paths = {}
    for name, table in M.gold_tables(*landed_aggregates(clean_points(spark, sf_dir))).items():
        # a batch id of its own for every metric
        out = table.withColumns({"gold_author_surname": F.lit(owner), "schema_v": F.lit(1),
                                 "batch_id": F.lit(f"{batch_id}-{name}")})
        paths[name] = write_gold_csv(out, versioned_path(root, name, f"{batch_id}-{name}"))
        paths[name + ":columns"] = out.columns
    return paths


def landed_aggregates(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    spark, out = points.sparkSession, []
    for name, df in (("gold-cells", M.cells(points, M.CELL, M.ALL_MEASURES)), ("gold-visits", M.visits(points))):
        path = scratch_path(spark, name)
        df.write.parquet(path)
        out.append(spark.read.schema(df.schema).parquet(path))
    return out[0], out[1]


_GOLD_RUNS: dict = {}


def gold_paths(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    key = input_key(spark, sf_dir)
    if key not in _GOLD_RUNS:
        _GOLD_RUNS[key] = run_gold(spark, sf_dir)
    return _GOLD_RUNS[key]


@register("write_gold_csv", f"WITH {GOLD_CTES} {_METRIC_SQL['route_performance_daily']}")
def q_write_gold_csv(spark, sf_dir):
    runs = gold_paths(spark, sf_dir)
    back = read_gold_metric(spark, runs["route_performance_daily"], runs["route_performance_daily:columns"])
    typed = back.select(
        "ingest_date", F.col("route_id").try_cast("bigint").alias("route_id"),
        F.col("vehicles_cnt").try_cast("bigint").alias("vehicles_cnt"),
        F.col("points_cnt").try_cast("bigint").alias("points_cnt"),
        *[F.col(c).try_cast("double").alias(c) for c in ("avg_speed_kmh", "avg_dist_km", "congestion_rate")])
    return stable(typed, M.AVERAGE_COLUMNS["route_performance_daily"])


@register("read_gold_metric", f"""WITH {GOLD_CTES}, r AS ({_METRIC_SQL['traffic_activity_daily']})
    SELECT 'traffic_activity_daily' AS metric, count(*) AS total_rows,
           count(DISTINCT ingest_date) AS n_partitions, min(ingest_date) AS first_date, max(ingest_date) AS last_date,
           true AS files_of_each_date FROM r""")
def q_read_gold_metric(spark, sf_dir):
    runs = gold_paths(spark, sf_dir)
    back = read_gold_metric(spark, runs["traffic_activity_daily"], runs["traffic_activity_daily:columns"])
    return back.agg(F.lit("traffic_activity_daily").alias("metric"), F.count(F.lit(1)).alias("total_rows"),
                    F.countDistinct("p_ingest_date").alias("n_partitions"), F.min("ingest_date").alias("first_date"),
                    F.max("ingest_date").alias("last_date"),
                    # every date has files of its own
                    (F.countDistinct("file_path") >= F.countDistinct("p_ingest_date")).alias("files_of_each_date"))

