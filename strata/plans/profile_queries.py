"""Modeling-set preparation, profiles, samples and splits (ML layer inputs)."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.schemas import MOBILITY_COLUMNS
from ..functions.stats import stable_dec6
from ..functions.timefmt import epoch_to_ts
from ..operators import sampling as S
from ..operators.profile import describe_numeric, null_profile, schema_profile
from ..operators.projections import CLUSTER_FEATURES, FEATURES, feature_projection, typed_mobility
from ..operators.quality import cluster_input, valid_modeling
from ..session import input_key, scratch_path
from ..sinks.writers import write_csv
from ..sources.adapters import OWNER, mobility_points
from ..sources.readers import read_csv_typed
from .oracle_sql import MODEL_CTES
from .registry import register

NAMES = [n for n, _ in MOBILITY_COLUMNS]
DESCRIBE_COLS = ["speed", "temp_c", "precip_mm", "wind_kmh", "visibility_m", "cloud_pct", "is_congested"]
MODEL_COLS = ["event_id", *NAMES, "event_ts", "model_author_surname"]


def modeling_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = typed_mobility(mobility_points(spark, sf_dir), OWNER)
    return typed.select("event_id", *NAMES, epoch_to_ts(F.col("time_unix")).alias("event_ts"),
                        F.lit(OWNER).alias("model_author_surname"))


def modeling_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_modeling(modeling_frame(spark, sf_dir))


_MODEL_CACHE: dict = {}


def modeling_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The modeling set, persisted once per session (memory, spilling to disk;
    recomputable from lineage if an executor is lost): profiles, samples,
    splits and every model fit read it several times."""
    key = input_key(spark, sf_dir)
    if key not in _MODEL_CACHE:
        m = modeling_set(spark, sf_dir)
        # Iterative fits run one task per partition: a small input (one file) is
        # spread over the cores first.  Large inputs already have more partitions.
        par = spark.sparkContext.defaultParallelism
        if m.rdd.getNumPartitions() < par:
            m = m.repartition(par)
        _MODEL_CACHE[key] = m.persist(StorageLevel.MEMORY_AND_DISK)
    return _MODEL_CACHE[key]


def ts_text(df: DataFrame, *cols) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in cols})


_MODEL_SELECT = ", ".join(["event_id", *NAMES, "strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_ts",
                           "model_author_surname"])


@register("epoch_to_ts", f"""WITH {MODEL_CTES} SELECT event_id, time_unix,
    strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_ts FROM timed""")
def q_epoch_to_ts(spark, sf_dir):
    return ts_text(modeling_frame(spark, sf_dir).select("event_id", "time_unix", "event_ts"), "event_ts")


@register("valid_modeling", f"WITH {MODEL_CTES} SELECT {_MODEL_SELECT} FROM model")
def q_valid_modeling(spark, sf_dir):
    return ts_text(modeling_set(spark, sf_dir).select(*MODEL_COLS), "event_ts")


@register("feature_projection", f"""WITH {MODEL_CTES} SELECT event_id, {', '.join(FEATURES)},
    speed AS label_speed, CAST(is_congested AS INTEGER) AS label_congested FROM model""")
def q_feature_projection(spark, sf_dir):
    return feature_projection(modeling_set(spark, sf_dir))


@register("cluster_input", f"""WITH {MODEL_CTES} SELECT event_id, {', '.join(CLUSTER_FEATURES)}, is_congested
    FROM model WHERE {' AND '.join(f'{c} IS NOT NULL AND NOT isnan({c})' for c in CLUSTER_FEATURES)}
    AND is_congested IS NOT NULL""")
def q_cluster_input(spark, sf_dir):
    return cluster_input(modeling_set(spark, sf_dir), CLUSTER_FEATURES).select(
        "event_id", *CLUSTER_FEATURES, "is_congested")


def _describe_sql():
    parts = []
    for c in DESCRIBE_COLS:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS "column", count({c}) AS count,
            {_d(f'avg({x})')} AS mean, {_d(f'stddev_samp({x})')} AS std, {_d(f'min({x})')} AS min,
            {_d(f'quantile_cont({x}, 0.25)')} AS p25, {_d(f'quantile_cont({x}, 0.5)')} AS p50,
            {_d(f'quantile_cont({x}, 0.75)')} AS p75, {_d(f'max({x})')} AS max FROM model""")
    return f"WITH {MODEL_CTES} " + " UNION ALL ".join(parts)


def _d(e):
    return f"CAST({e} + CAST(0.000000013 AS DOUBLE) AS DECIMAL(18,6))"


@register("describe_numeric", _describe_sql())
def q_describe_numeric(spark, sf_dir):
    d = describe_numeric(modeling_cached(spark, sf_dir), DESCRIBE_COLS)
    return d.withColumns({c: stable_dec6(F.col(c)) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")})


def _null_sql():
    float_cols = {n for n, t in MOBILITY_COLUMNS if t == "double"}
    parts = []
    for c in MODEL_COLS:
        cond = f"{c} IS NULL" + (f" OR isnan({c})" if c in float_cols else "")
        parts.append(f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {cond}) AS null_count FROM model""")
    return (f"WITH {MODEL_CTES} SELECT * FROM (" + " UNION ALL ".join(parts)
            + ') t ORDER BY null_count DESC, "column" LIMIT 15')


@register("null_profile_top15", _null_sql())
def q_null_profile_top15(spark, sf_dir):
    return null_profile(modeling_cached(spark, sf_dir).select(*MODEL_COLS), 15)


@register("schema_profile")
def q_schema_profile(spark, sf_dir):
    return schema_profile(modeling_set(spark, sf_dir).select(*MODEL_COLS))


_MODEL_CSV: dict = {}


def modeling_csv(spark: SparkSession, sf_dir: str) -> str:
    key = input_key(spark, sf_dir)
    if key not in _MODEL_CSV:
        _MODEL_CSV[key] = write_csv(modeling_set(spark, sf_dir).select("event_id", *NAMES),
                                    scratch_path(spark, "modeling_csv"))
    return _MODEL_CSV[key]


@register("write_modeling_csv", f"WITH {MODEL_CTES} SELECT event_id, {', '.join(NAMES)} FROM model")
def q_write_modeling_csv(spark, sf_dir):
    return read_csv_typed(spark, modeling_csv(spark, sf_dir), extra=(("event_id", "bigint"),))


PREVIEW_COLS = ["lat_grid", "lng_grid", "speed", "is_congested", "temp_c", "precip_mm", "visibility_m"]


@register("prediction_sample", f"""WITH {MODEL_CTES} SELECT event_id, {', '.join(PREVIEW_COLS)} FROM model
    ORDER BY event_id LIMIT 5000""")
def q_prediction_sample(spark, sf_dir):
    """First 5000 clean rows (key order), 7 columns, landed as CSV and read back."""
    head = S.head_preview(modeling_set(spark, sf_dir).select("event_id", *PREVIEW_COLS), 5000, "event_id")
    path = write_csv(head, scratch_path(spark, "prediction_sample"))
    types = dict(MOBILITY_COLUMNS)
    schema = "event_id bigint, " + ", ".join(f"{c} {types[c]}" for c in PREVIEW_COLS)
    return spark.read.schema(schema).option("header", True).csv(path)


@register("head_preview", f"""WITH {MODEL_CTES} SELECT event_id, vehicle_id, route_id, speed, period FROM model
    ORDER BY event_id LIMIT 10""")
def q_head_preview(spark, sf_dir):
    return S.head_preview(modeling_set(spark, sf_dir).select("event_id", "vehicle_id", "route_id", "speed", "period"),
                          10, "event_id")


_MD5 = "md5(CAST(event_id AS VARCHAR))"


@register("sample_fraction_capped", f"""WITH {MODEL_CTES} SELECT event_id, speed FROM model
    WHERE substr({_MD5}, 1, 8) < '{S.hex_threshold(0.05)}' ORDER BY {_MD5}, event_id LIMIT 300000""")
def q_sample_fraction_capped(spark, sf_dir):
    return S.sample_fraction_capped(modeling_cached(spark, sf_dir).select("event_id", "speed"), "event_id", 0.05, 300_000)


@register("sample_n", f"""WITH {MODEL_CTES} SELECT event_id, lat_grid, lng_grid FROM model
    ORDER BY {_MD5}, event_id LIMIT 1000""")
def q_sample_n(spark, sf_dir):
    return S.sample_n(modeling_cached(spark, sf_dir).select("event_id", "lat_grid", "lng_grid"), "event_id", 1000)


@register("split_80_20", f"""WITH {MODEL_CTES} SELECT event_id, substr({_MD5}, 1, 8) < '{S.hex_threshold(0.2)}'
    AS is_test FROM model""")
def q_split_80_20(spark, sf_dir):
    return S.split_by_hash(modeling_cached(spark, sf_dir).select("event_id"), "event_id", 0.2)


@register("split_stratified", f"""WITH {MODEL_CTES} SELECT event_id, is_congested,
    row_number() OVER (PARTITION BY is_congested ORDER BY {_MD5}, event_id)
      <= ceil(0.2 * count(*) OVER (PARTITION BY is_congested)) AS is_test FROM model""")
def q_split_stratified(spark, sf_dir):
    return S.split_stratified(modeling_cached(spark, sf_dir).select("event_id", "is_congested"), "event_id",
                              "is_congested", 0.2)


@register("concat_samples", f"""WITH {MODEL_CTES} SELECT event_id, ingest_date FROM model
    WHERE substr({_MD5}, 1, 8) < '{S.hex_threshold(0.05)}' ORDER BY {_MD5}, event_id LIMIT 300000""")
def q_concat_samples(spark, sf_dir):
    m = modeling_cached(spark, sf_dir).select("event_id", "ingest_date")
    chunks = [m.where(F.col("ingest_date") < "2024-01-16"), m.where(F.col("ingest_date") >= "2024-01-16")]
    return S.concat_samples(chunks, "event_id", 0.05, 300_000)
