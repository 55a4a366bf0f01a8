"""End-to-end runs, the counterparts of the reference's three programs.

* ``silver_job``  landed weather bronze -> silver (per-source counts, gate, write)
* ``gold_job``    mobility snapshot CSV -> 42 rules -> five metric tables (+ read-back summary)
* ``ml_job``      mobility snapshot CSV -> modeling set -> three models, metrics JSON,
                  prediction sample, grid map, saved PipelineModels

Each is a composition of the operators; all writes are distributed and go
under caller-given roots (use the shared checkpoint folder on a cluster).
"""

from __future__ import annotations

import json
import uuid

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.schemas import MOBILITY_COLUMNS
from ..functions.timefmt import epoch_to_ts
from ..operators import metrics as M
from ..operators import ml as ML
from ..operators.projections import CLUSTER_FEATURES, NUMERIC_FEATURES, drop_synthetic_columns, typed_mobility
from ..operators.quality import cluster_input, mobility_condition, quality_counts, valid_modeling
from ..operators.sampling import head_preview, split_by_hash, split_stratified
from ..sinks.writers import versioned_path, write_csv, write_gold_csv, write_json_rows, write_layout
from ..sources.readers import metric_file_summary, read_csv_strings
from .gold_queries import landed_aggregates
from .silver_queries import run_silver


def silver_job(spark: SparkSession, bronze_root: str, out_root: str, owner: str, fmt: str = "json",
               as_of=None, batch_id: str | None = None) -> dict:
    """All weather sources in one plan; ``as_of=None`` keeps the wall clock for the future check."""
    return run_silver(spark, bronze_root, out_root, batch_id or str(uuid.uuid4()), owner, as_of,
                      "parquet" if fmt == "parquet" else "json")


def read_snapshot(spark: SparkSession, csv_path: str, owner: str) -> DataFrame:
    """Header CSV (no inference) -> drop index columns -> 32 typed columns + lineage."""
    raw = drop_synthetic_columns(read_csv_strings(spark, csv_path))
    keep = tuple(c for c in raw.columns if c not in dict(MOBILITY_COLUMNS))
    return typed_mobility(raw, owner, keep=keep)


def gold_job(spark: SparkSession, csv_path: str, out_root: str, owner: str, batch_id: str | None = None) -> dict:
    batch_id = batch_id or str(uuid.uuid4())
    typed = read_snapshot(spark, csv_path, owner)
    counts = quality_counts(typed, mobility_condition()).first().asDict()
    written = {}
    for name, table in M.gold_tables(*landed_aggregates(typed.filter(mobility_condition()))).items():
        out = table.withColumns({"gold_author_surname": F.lit(owner), "schema_v": F.lit(1),
                                 "batch_id": F.lit(f"{batch_id}-{name}")})
        path = write_gold_csv(out, versioned_path(out_root, name, f"{batch_id}-{name}"))
        written[name] = {"path": path, **metric_file_summary(spark, path, out.columns).first().asDict()}
    return {"batch_id": batch_id, **counts, "metrics": written}


def ml_job(spark: SparkSession, csv_path: str, out_root: str, owner: str, run_id: str | None = None,
           n_init: int = 20) -> dict:
    """Models are fitted and scored on all rows; ``n_init`` K-means restarts each read them all."""
    run_id = run_id or str(uuid.uuid4())
    typed = read_snapshot(spark, csv_path, owner)
    model = (valid_modeling(typed.withColumn("event_ts", epoch_to_ts(F.col("time_unix"))))
             .withColumn("model_author_surname", F.lit(owner)))
    key = "event_id" if "event_id" in model.columns else "time_unix"
    model = model.persist(StorageLevel.MEMORY_AND_DISK)
    cls = split_stratified(model, key, "is_congested", 0.2).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_csv(model.drop("event_ts"), f"{out_root}/processed/traffic_modeling_dataset")
        reg = split_by_hash(model, key, 0.2)
        reg_train, reg_test = reg.where(~F.col("is_test")), reg.where(F.col("is_test"))
        linear = ML.fit_linear_regression(reg_train, ML.fit_preprocessing(reg_train, NUMERIC_FEATURES, ("period",)),
                                          "speed")
        cls_train, cls_test = cls.where(~F.col("is_test")), cls.where(F.col("is_test"))
        logistic = ML.fit_logistic_regression(
            cls_train, ML.fit_preprocessing(cls_train, NUMERIC_FEATURES, ("period",)), "is_congested")
        crow = cluster_input(model, CLUSTER_FEATURES)
        cprep = Pipeline(stages=ML.fit_preprocessing(crow, CLUSTER_FEATURES).stages).fit(crow)
        km = ML.fit_kmeans_best(cprep.transform(crow), k=4, n_init=n_init)
        scored_clusters = km.transform(cprep.transform(crow))
        lin_m = ML.regression_metrics(linear.transform(reg_test), "speed", "prediction").first().asDict()
        t = logistic.transform(cls_test).withColumn("p1", ML.positive_probability()).withColumn(
            "yhat", F.col("prediction").cast("int"))
        log_m = {**ML.classification_metrics(t, "is_congested", "yhat").first().asDict(),
                 **ML.roc_auc(t, "is_congested", "p1").first().asDict()}
        km_m = ML.kmeans_metrics(km, scored_clusters, key)
        metrics = {"author_surname": owner, "run_id": run_id, "linear_regression": lin_m,
                   "logistic_regression": log_m, "kmeans": km_m}
        write_json_rows(spark.createDataFrame([(run_id, json.dumps(metrics))], "run_id string, metrics string"),
                        f"{out_root}/models/model_metrics/run_id={run_id}")
        for name, m in (("linear_regression", linear), ("logistic_regression", logistic), ("kmeans_prep", cprep)):
            m.write().overwrite().save(f"{out_root}/models/{run_id}/{name}")
        km.write().overwrite().save(f"{out_root}/models/{run_id}/kmeans")
        preview = head_preview(model.select(key, "lat_grid", "lng_grid", "speed", "is_congested", "temp_c",
                                            "precip_mm", "visibility_m"), 5000, key)
        write_csv(preview, f"{out_root}/processed/prediction_sample_{run_id}")
        s = model
        base = s.columns
        s = linear.transform(s).select(*base, F.col("prediction").alias("predicted_speed"))
        base = s.columns
        s = logistic.transform(s).select(*base, ML.positive_probability().alias("predicted_congestion_probability"))
        base = s.columns
        s = km.transform(cprep.transform(s)).select(*base, F.col("cluster_id").alias("predicted_cluster_id"))
        grid = ML.grid_map(s)
        write_layout(grid).write.mode("overwrite").parquet(f"{out_root}/maps/grid_map_{run_id}")
        center = ML.grid_center(grid).first().asDict()
        return {"run_id": run_id, "metrics": metrics, "center": center}
    finally:
        model.unpersist()
        cls.unpersist()
