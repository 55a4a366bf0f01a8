"""ML layer queries: preprocessing fits, models, evaluation, scoring, grid map."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.stats import stable_dec6
from ..operators import ml as ML
from ..operators.projections import CLUSTER_FEATURES, NUMERIC_FEATURES
from ..operators.quality import cluster_input
from ..operators.sampling import hex_threshold, split_by_hash, split_stratified
from ..session import input_key, scratch_path
from ..sinks.writers import write_json_rows
from ..sources.adapters import OWNER
from .oracle_sql import MODEL_CTES
from .profile_queries import modeling_cached
from .registry import register

_STATE: dict = {}
RUN_ID = "run-0001"
_MD5 = "md5(CAST(event_id AS VARCHAR))"
_TRAIN = f"train AS (SELECT * FROM model WHERE NOT (substr({_MD5}, 1, 8) < '{hex_threshold(0.2)}'))"


def _d(e):
    return f"CAST({e} + CAST(0.000000013 AS DOUBLE) AS DECIMAL(18,6))"


class MLState:
    """Fitted artefacts of one run, built lazily and kept for the session."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.model = modeling_cached(spark, sf_dir)
        self._cache = {}

    def _get(self, name, fn):
        if name not in self._cache:
            self._cache[name] = fn()
        return self._cache[name]

    @property
    def reg_split(self) -> DataFrame:
        return split_by_hash(self.model, "event_id", 0.2)

    @property
    def reg_train(self):
        return self.reg_split.where(~F.col("is_test"))

    @property
    def reg_test(self):
        return self.reg_split.where(F.col("is_test"))

    @property
    def prep_reg(self):
        return self._get("prep_reg", lambda: ML.fit_preprocessing(self.reg_train, NUMERIC_FEATURES, ("period",)))

    @property
    def linear(self):
        return self._get("linear", lambda: ML.fit_linear_regression(self.reg_train, self.prep_reg, "speed"))

    @property
    def cls_split(self):
        return self._get("cls_split", lambda: split_stratified(self.model, "event_id", "is_congested", 0.2)
                         .persist(StorageLevel.MEMORY_AND_DISK))

    @property
    def prep_cls(self):
        return self._get("prep_cls", lambda: ML.fit_preprocessing(
            self.cls_split.where(~F.col("is_test")), NUMERIC_FEATURES, ("period",)))

    @property
    def logistic(self):
        return self._get("logistic", lambda: ML.fit_logistic_regression(
            self.cls_split.where(~F.col("is_test")), self.prep_cls, "is_congested"))

    @property
    def cluster_rows(self):
        return cluster_input(self.model, CLUSTER_FEATURES)

    @property
    def cluster_prep(self):
        def fit():
            rows = self.cluster_rows
            prep = ML.fit_preprocessing(rows, CLUSTER_FEATURES)
            return Pipeline(stages=prep.stages).fit(rows)
        return self._get("cluster_prep", fit)

    @property
    def kmeans(self):
        """Scaler, medians and every restart are fitted on all rows."""
        return self._get("kmeans", lambda: ML.fit_kmeans_best(
            self.cluster_prep.transform(self.cluster_rows), k=4, n_init=20, seed=42))

    def cluster_scored(self) -> DataFrame:
        return self.kmeans.transform(self.cluster_prep.transform(self.cluster_rows))

    def scored_map(self) -> DataFrame:
        """All rows scored by all three models in one narrow chain: each
        PipelineModel adds its columns, and only the prediction is kept before the next."""
        s = self.model
        base = s.columns
        s = self.linear.transform(s).select(*base, F.col("prediction").alias("predicted_speed"))
        base = s.columns
        s = self.logistic.transform(s).select(*base, ML.positive_probability().alias("predicted_congestion_probability"))
        base = s.columns
        s = self.kmeans.transform(self.cluster_prep.transform(s)).select(
            *base, F.col("cluster_id").alias("predicted_cluster_id"))
        return s


def state(spark: SparkSession, sf_dir: str) -> MLState:
    key = input_key(spark, sf_dir)
    if key not in _STATE:
        _STATE[key] = MLState(spark, sf_dir)
    return _STATE[key]


# --- preprocessing fits (SQL-checked) ---------------------------------------------
@register("impute_median", f"WITH {MODEL_CTES}, {_TRAIN} " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {_d(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)')} AS median FROM train"
    for c in NUMERIC_FEATURES))
def q_impute_median(spark, sf_dir):
    med = ML.fit_medians(state(spark, sf_dir).reg_train, NUMERIC_FEATURES)
    rows = [(c, float(med[c])) for c in NUMERIC_FEATURES]
    return spark.createDataFrame(rows, "feature string, median double").withColumn("median", stable_dec6(F.col("median")))


@register("impute_mode", f"""WITH {MODEL_CTES}, {_TRAIN} SELECT period AS mode_period FROM train
    GROUP BY period ORDER BY count(*) DESC, period LIMIT 1""")
def q_impute_mode(spark, sf_dir):
    t = state(spark, sf_dir).reg_train.where(F.col("period").isNotNull())
    return (t.groupBy("period").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), "period").limit(1)
            .select(F.col("period").alias("mode_period")))


def _scale_sql():
    parts = []
    for c in NUMERIC_FEATURES:
        x = f"coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM train))"
        parts.append(f"SELECT '{c}' AS feature, {_d(f'avg({x})')} AS mean, {_d(f'stddev_pop({x})')} AS std FROM train")
    return f"WITH {MODEL_CTES}, {_TRAIN} " + " UNION ALL ".join(parts)


@register("standard_scale", _scale_sql())
def q_standard_scale(spark, sf_dir):
    p = state(spark, sf_dir).prep_reg
    rows = [(c, float(p.moments[c][0]), float(p.moments[c][1])) for c in NUMERIC_FEATURES]
    df = spark.createDataFrame(rows, "feature string, mean double, std double")
    return df.withColumns({"mean": stable_dec6(F.col("mean")), "std": stable_dec6(F.col("std"))})


@register("one_hot", f"""WITH {MODEL_CTES}, {_TRAIN}, cats AS (SELECT DISTINCT period AS p FROM train)
    SELECT event_id, period, CAST(CASE WHEN period IN (SELECT p FROM cats)
      THEN (SELECT count(*) FROM cats WHERE p < model.period) ELSE -1 END AS INTEGER) AS hot_index FROM model""")
def q_one_hot(spark, sf_dir):
    st = state(spark, sf_dir)
    # mode, indexer and encoder of the category alone: no numeric fit, no model
    enc = Pipeline(stages=ML.fit_preprocessing(st.reg_train, (), ("period",)).stages[:-1]).fit(st.reg_train).transform(st.model)
    arr = vector_to_array(F.col("period_ohe"))
    return enc.select("event_id", "period", (F.array_position(arr, 1.0) - 1).cast("int").alias("hot_index"))


# --- metric operators on deterministic predictors (SQL-checked) ----------------
_REG_PRED = "coalesce(speed_gps, 0.0) * 0.8 + dt_sec * 0.1"
_CLS_PRED = "CASE WHEN dt_sec < 20 THEN 1 ELSE 0 END"


@register("regression_metrics", f"""WITH {MODEL_CTES}, p AS (SELECT speed AS y, {_REG_PRED} AS yhat FROM model)
    SELECT {_d('avg(abs(y - yhat))')} AS mae, {_d('sqrt(avg((y - yhat) * (y - yhat)))')} AS rmse,
    {_d('1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*))')} AS r2 FROM p""")
def q_regression_metrics(spark, sf_dir):
    p = state(spark, sf_dir).model.select(F.col("speed").alias("y"), F.expr(_REG_PRED).alias("yhat"))
    m = ML.regression_metrics(p, "y", "yhat")
    return m.select(*[stable_dec6(F.col(c)).alias(c) for c in ("mae", "rmse", "r2")])


@register("classification_metrics", f"""WITH {MODEL_CTES}, p AS (SELECT is_congested AS y, {_CLS_PRED} AS yhat
    FROM model), c AS (SELECT avg(CASE WHEN y = yhat THEN 1.0 ELSE 0.0 END) AS accuracy,
    count(*) FILTER (WHERE y = 1 AND yhat = 1) AS tp, count(*) FILTER (WHERE y <> 1 AND yhat = 1) AS fp,
    count(*) FILTER (WHERE y = 1 AND yhat <> 1) AS fn FROM p)
    SELECT {_d('accuracy')} AS accuracy, {_d('coalesce(tp / nullif(tp + fp, 0), 0)')} AS precision,
    {_d('coalesce(tp / nullif(tp + fn, 0), 0)')} AS recall,
    {_d('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)')} AS f1 FROM c""")
def q_classification_metrics(spark, sf_dir):
    p = state(spark, sf_dir).model.select(F.col("is_congested").alias("y"), F.expr(_CLS_PRED).alias("yhat"))
    m = ML.classification_metrics(p, "y", "yhat")
    return m.select(*[stable_dec6(F.col(c)).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@register("roc_auc", f"""WITH {MODEL_CTES}, g AS (SELECT cloud_pct AS score,
    count(*) FILTER (WHERE is_congested = 1) AS pos, count(*) FILTER (WHERE is_congested <> 1) AS neg
    FROM model GROUP BY cloud_pct), c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before FROM g)
    SELECT {_d('sum(pos * (neg_before + 0.5 * neg)) / (sum(pos) * sum(neg))')} AS roc_auc FROM c""")
def q_roc_auc(spark, sf_dir):
    m = ML.roc_auc(state(spark, sf_dir).model, "is_congested", "cloud_pct")
    return m.select(stable_dec6(F.col("roc_auc")).alias("roc_auc"))


@register("confusion_matrix", f"""WITH {MODEL_CTES}, p AS (SELECT is_congested AS y, {_CLS_PRED} AS yhat
    FROM model) SELECT y AS actual, count(*) FILTER (WHERE yhat = 0) AS pred_0,
    count(*) FILTER (WHERE yhat = 1) AS pred_1 FROM p GROUP BY y""")
def q_confusion_matrix(spark, sf_dir):
    p = state(spark, sf_dir).model.select("is_congested", F.expr(_CLS_PRED).alias("yhat"))
    return ML.confusion_matrix(p, "is_congested", "yhat")


# --- models (rows-only: fitted solvers) ----------------------------------------------
@register("linear_regression")
def q_linear_regression(spark, sf_dir):
    st = state(spark, sf_dir)
    return st.linear.transform(st.reg_test).select("event_id", "speed", "prediction")


@register("speed_predictions")
def q_speed_predictions(spark, sf_dir):
    st = state(spark, sf_dir)
    s = st.linear.transform(st.reg_test).select("event_id", F.col("speed").alias("actual_speed"),
                                               F.col("prediction").alias("predicted_speed"))
    return s.orderBy("event_id").limit(10)


@register("coefficients")
def q_coefficients(spark, sf_dir):
    st = state(spark, sf_dir)
    return ML.coefficients(st.linear, st.prep_reg, spark)


@register("top_coefficients")
def q_top_coefficients(spark, sf_dir):
    return ML.top_coefficients(q_coefficients(spark, sf_dir), 20)


@register("logistic_regression")
def q_logistic_regression(spark, sf_dir):
    st = state(spark, sf_dir)
    test = st.cls_split.where(F.col("is_test"))
    return st.logistic.transform(test).select("event_id", "is_congested", ML.positive_probability().alias("probability"),
                                              F.col("prediction").cast("int").alias("prediction"))


@register("congestion_preview")
def q_congestion_preview(spark, sf_dir):
    st = state(spark, sf_dir)
    test = st.cls_split.where(F.col("is_test"))
    s = st.logistic.transform(test)
    return s.orderBy("event_id").limit(10).select(
        "hour", "period", "temp_c", "precip_mm", "visibility_m", F.col("is_congested").alias("actual_is_congested"),
        F.col("prediction").cast("int").alias("predicted_is_congested"),
        ML.positive_probability().alias("predicted_congestion_probability"))


@register("kmeans_sectors")
def q_kmeans_sectors(spark, sf_dir):
    return state(spark, sf_dir).cluster_scored().select("event_id", "cluster_id")


KMEANS_METRICS = ("inertia", "silhouette", "silhouette_bound", "silhouette_sq_euclidean")


@register("kmeans_metrics")
def q_kmeans_metrics(spark, sf_dir):
    st = state(spark, sf_dir)
    m = ML.kmeans_metrics(st.kmeans, st.cluster_scored(), "event_id")
    return spark.createDataFrame([tuple(m[c] for c in KMEANS_METRICS)], ", ".join(f"{c} double" for c in KMEANS_METRICS))


@register("cluster_summary")
def q_cluster_summary(spark, sf_dir):
    return ML.cluster_summary(state(spark, sf_dir).cluster_scored())


@register("assign_clusters_back")
def q_assign_clusters_back(spark, sf_dir):
    """Cluster id on every clean row, scored in place (no join); rows that
    the clustering input excluded keep a null id."""
    st = state(spark, sf_dir)
    ok = F.lit(True)
    for c in (*CLUSTER_FEATURES, "is_congested"):
        ok = ok & F.col(c).isNotNull()
    scored = st.kmeans.transform(st.cluster_prep.transform(st.model))
    return scored.select("event_id", F.when(ok, F.col("cluster_id")).alias("cluster_id"))


@register("batch_scoring")
def q_batch_scoring(spark, sf_dir):
    return state(spark, sf_dir).scored_map().select(
        "event_id", "lat_grid", "lng_grid", "predicted_speed", "predicted_congestion_probability",
        "predicted_cluster_id")


@register("grid_map")
def q_grid_map(spark, sf_dir):
    return ML.grid_map(state(spark, sf_dir).scored_map())


_GRID_ACTUAL = f"""grid AS (SELECT lat_grid, lng_grid, {_d('avg(speed)')} AS actual_avg_speed,
    {_d('avg(is_congested)')} AS actual_congestion_rate FROM model GROUP BY ALL),
    cc AS (SELECT lat_grid, lng_grid, route_id % 4 AS k, count(*) AS n FROM model GROUP BY ALL),
    md AS (SELECT lat_grid, lng_grid, arg_max(k, n * 1000 - k) AS dominant_cluster FROM cc GROUP BY ALL)"""


@register("grid_map_actual", f"""WITH {MODEL_CTES}, {_GRID_ACTUAL}
    SELECT grid.*, coalesce(CAST(md.dominant_cluster AS INTEGER), -1) AS dominant_cluster
    FROM grid LEFT JOIN md USING (lat_grid, lng_grid)""")
def q_grid_map_actual(spark, sf_dir):
    """Grid map without models: the dominant-cluster logic runs on ``route_id % 4``
    as a stand-in cluster label so the mode rule is SQL-checked."""
    s = state(spark, sf_dir).model.withColumn("stand_in", (F.col("route_id") % 4).cast("int"))
    g = ML.grid_map(s, "stand_in", None, None)
    return g.withColumns({c: stable_dec6(F.col(c)) for c in ("actual_avg_speed", "actual_congestion_rate")})


@register("grid_center", f"""WITH {MODEL_CTES}, {_GRID_ACTUAL}
    SELECT {_d('avg(lat_grid)')} AS center_lat, {_d('avg(lng_grid)')} AS center_lng FROM grid""")
def q_grid_center(spark, sf_dir):
    s = state(spark, sf_dir).model
    c = ML.grid_center(ML.grid_map(s, "route_id", None, None))
    return c.select(stable_dec6(F.col("center_lat")).alias("center_lat"),
                    stable_dec6(F.col("center_lng")).alias("center_lng"))


@register("write_metrics_json")
def q_write_metrics_json(spark, sf_dir):
    """run id + the three models' metrics as one JSON record, written and read back."""
    st = state(spark, sf_dir)
    lin = ML.regression_metrics(st.linear.transform(st.reg_test), "speed", "prediction").first().asDict()
    test = st.logistic.transform(st.cls_split.where(F.col("is_test"))).withColumn(
        "p1", ML.positive_probability()).withColumn("yhat", F.col("prediction").cast("int"))
    cls = (ML.classification_metrics(test, "is_congested", "yhat").first().asDict()
           | ML.roc_auc(test, "is_congested", "p1").first().asDict())
    km = ML.kmeans_metrics(st.kmeans, st.cluster_scored(), "event_id")
    rec = spark.createDataFrame(
        [(OWNER, RUN_ID, tuple(lin[c] for c in ("mae", "rmse", "r2")),
          tuple(cls[c] for c in ("accuracy", "precision", "recall", "f1", "roc_auc")),
          tuple(km[c] for c in KMEANS_METRICS))],
        "author_surname string, run_id string, linear_regression struct<mae: double, rmse: double, r2: double>, "
        "logistic_regression struct<accuracy: double, precision: double, recall: double, f1: double, roc_auc: double>, "
        f"kmeans struct<{', '.join(f'{c}: double' for c in KMEANS_METRICS)}>")
    path = write_json_rows(rec, scratch_path(spark, "model_metrics"))
    return spark.read.schema(rec.schema).json(path)
