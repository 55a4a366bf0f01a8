"""ML operators on synthetic data with known answers."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from strata.operators import ml as ML


@pytest.fixture(scope="module")
def synth(spark):
    rng = np.random.default_rng(3)
    n = 2000
    x1, x2 = rng.normal(0, 1, n), rng.normal(5, 2, n)
    cat = rng.choice(["b", "a", "c"], n)
    y = 3.0 + 2.0 * x1 - 1.0 * x2 + np.where(cat == "c", 4.0, 0.0) + rng.normal(0, 0.01, n)
    cls = (x1 + rng.normal(0, 0.3, n) > 0).astype(int)
    rows = [(int(i), float(a), float(b) if i % 17 else None, str(c), float(t), int(k))
            for i, (a, b, c, t, k) in enumerate(zip(x1, x2, cat, y, cls))]
    return spark.createDataFrame(rows, "id long, x1 double, x2 double, cat string, y double, k int")


def test_preprocessing_constants(spark, synth):
    prep = ML.fit_preprocessing(synth, ["x1", "x2"], ["cat"])
    x2 = [r.x2 for r in synth.select("x2").collect() if r.x2 is not None]
    assert prep.medians["x2"] == pytest.approx(float(np.median(x2)))
    imputed = np.array([v if v is not None else prep.medians["x2"] for v in [r.x2 for r in synth.collect()]])
    assert prep.moments["x2"][1] == pytest.approx(float(imputed.std()))  # population std


def test_one_hot_unseen_is_all_zero(spark, synth):
    prep = ML.fit_preprocessing(synth, ["x1"], ["cat"])
    from pyspark.ml import Pipeline
    model = Pipeline(stages=prep.stages).fit(synth)
    test = spark.createDataFrame([(0.0, "a"), (0.0, "z"), (0.0, None)], "x1 double, cat string")
    vecs = [r.cat_ohe.toArray().tolist() for r in model.transform(test).collect()]
    mode = ML.fit_mode(synth, "cat")
    assert vecs[0] == [1.0, 0.0, 0.0] and vecs[1] == [0.0, 0.0, 0.0]
    assert vecs[2] == [1.0 if c == mode else 0.0 for c in ["a", "b", "c"]]  # null -> mode


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, c double")
    prep = ML.fit_preprocessing(df, ["a", "c"])
    from pyspark.ml import Pipeline
    out = Pipeline(stages=prep.stages).fit(df).transform(df)
    assert [r.c_s for r in out.collect()] == [0.0, 0.0, 0.0]


def test_linear_regression_recovers_predictions(spark, synth):
    clean = synth.where("x2 IS NOT NULL")
    prep = ML.fit_preprocessing(clean, ["x1", "x2"], ["cat"])
    model = ML.fit_linear_regression(clean, prep, "y")
    m = ML.regression_metrics(model.transform(clean), "y", "prediction").first()
    assert m.r2 > 0.9999 and m.mae < 0.05


def test_logistic_regression_and_metrics(spark, synth):
    prep = ML.fit_preprocessing(synth, ["x1", "x2"], ["cat"])
    model = ML.fit_logistic_regression(synth, prep, "k")
    s = model.transform(synth).withColumn("p1", ML.positive_probability()).withColumn("yhat", F.col("prediction").cast("int"))
    c = ML.classification_metrics(s, "k", "yhat").first()
    assert c.accuracy > 0.85
    auc = ML.roc_auc(s, "k", "p1").first().roc_auc
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    ref = BinaryClassificationEvaluator(rawPredictionCol="p1", labelCol="k", numBins=0).evaluate(
        s.withColumn("k", F.col("k").cast("double")))
    assert auc == pytest.approx(ref, abs=1e-9)


def test_roc_auc_ties_brute_force(spark):
    rows = [(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1), (0, 0.5), (1, 0.1)]
    df = spark.createDataFrame(rows, "y int, s double")
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert ML.roc_auc(df, "y", "s").first().roc_auc == pytest.approx(brute)


def test_precision_zero_when_no_positive_predictions(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    r = ML.classification_metrics(df, "y", "p").first()
    assert (r.precision, r.recall, r.f1, r.accuracy) == (0.0, 0.0, 0.0, 0.5)


def test_confusion_matrix(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 1)], "y int, p int")
    got = {r.actual: (r.pred_0, r.pred_1) for r in ML.confusion_matrix(df, "y", "p").collect()}
    assert got == {0: (1, 0), 1: (1, 1)}


def test_kmeans_best_of_n_and_grid_mode(spark):
    pts = [(float(x), float(y)) for x, y in [(0, 0), (0, 1), (10, 10), (10, 11), (20, 0), (21, 0), (0, 20), (1, 20)]]
    df = spark.createDataFrame(pts * 5, "a double, b double")
    prep = ML.fit_preprocessing(df, ["a", "b"])
    from pyspark.ml import Pipeline
    feats = Pipeline(stages=prep.stages).fit(df).transform(df)
    km = ML.fit_kmeans_best(feats, k=4, n_init=3, seed=1)
    scored = km.transform(feats)
    assert scored.select("cluster_id").distinct().count() == 4
    g = spark.createDataFrame([(1.0, 1.0, 2, 1.0, 0), (1.0, 1.0, 1, 1.0, 0), (1.0, 1.0, 2, 1.0, 0),
                               (1.0, 1.0, 1, 1.0, 0), (2.0, 2.0, None, 1.0, 1)],
                              "lat_grid double, lng_grid double, predicted_cluster_id int, speed double, is_congested int")
    m = {(r.lat_grid): r.dominant_cluster for r in ML.grid_map(g, pred_speed=None, pred_prob=None).collect()}
    assert m == {1.0: 1, 2.0: -1}  # tie -> smallest; no cluster -> -1


def plain_lloyd(x, centers, limit):
    while True:
        near = ((x[:, None] - centers[None]) ** 2).sum(2).argmin(1)
        moved = np.array([x[near == j].mean(0) if (near == j).any() else c for j, c in enumerate(centers)])
        done = ((moved - centers) ** 2).sum() <= limit
        centers = moved
        if done:
            return centers, ((x[:, None] - centers[None]) ** 2).sum(2).min(1).sum()


def test_restarts_that_share_passes_are_single_runs(spark):
    """Same centers and inertia as the best of single runs from the same seeds; passes are those of the longest."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 3)) * [1, 5, 0.2] + rng.integers(0, 3, (3000, 1)) * [4, 0, 1]
    df = spark.createDataFrame([(Vectors.dense(r),) for r in x], ["features"])
    points = df.select(*(F.get(vector_to_array("features"), F.lit(i)).alias(f"x{i}") for i in range(3)))
    seeds = ML.seed_centers(points, 5, 6, 11)
    assert list(seeds) == list(range(6)) and all(len({tuple(c) for c in m}) == 5 for m in seeds.values())
    rows = {tuple(r) for r in x}
    assert all(tuple(c) in rows for m in seeds.values() for c in m)
    limit = 1e-4 * x.var(0).mean()
    runs = [plain_lloyd(x, m, limit) for m in seeds.values()]
    best = min(runs, key=lambda r: r[1])
    model = ML.fit_kmeans_best(df, k=5, n_init=6, seed=11)
    assert np.allclose(np.array(model.clusterCenters()), best[0])
    assert ML.inertia(model, model.transform(df)) == pytest.approx(best[1])


def test_seeds_are_drawn_by_squared_distance(spark):
    """Two far groups: the second seed lies in the other group nearly always; repeated rows weigh as often as they occur."""
    df = spark.createDataFrame([(0.0, 0.0)] * 60 + [(0.1, 0.0)] * 60 + [(50.0, 0.0)] * 120, "x0 double, x1 double")
    seeds = ML.seed_centers(df, 2, 60, 3)
    assert all((m[0, 0] > 25) != (m[1, 0] > 25) for m in seeds.values())
    assert 15 <= sum(m[0, 0] > 25 for m in seeds.values()) <= 45


def test_seeds_are_drawn_without_sorting_rows(spark, monkeypatch):
    """A pass for seeds has a row for each point and restart: it is aggregated in a hash table."""
    df = spark.range(400).selectExpr("id % 17 + 0.5D AS x0", "id % 5 * 1.0D AS x1")
    plans, collect = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda d: plans.append(d._jdf.queryExecution().executedPlan().toString()) or collect(d))
    seeds = ML.seed_centers(df, 3, 4, 7)
    assert len(plans) == 3 and not any("SortAggregate" in p for p in plans)
    rows = {(i % 17 + 0.5, i % 5 * 1.0) for i in range(400)}
    assert all(tuple(c) in rows for m in seeds.values() for c in m) and all(len({tuple(c) for c in m}) == 3 for m in seeds.values())


def test_kmeans_on_few_distinct_rows_and_none(spark):
    df = spark.createDataFrame([(Vectors.dense([1.0, 2.0]),)] * 7 + [(Vectors.dense([3.0, 2.0]),)] * 2, ["features"])
    model = ML.fit_kmeans_best(df, k=4, n_init=3)
    assert sorted(c.tolist() for c in model.clusterCenters()) == [[1.0, 2.0], [3.0, 2.0]]
    assert {r.cluster_id for r in model.transform(df).collect()} == {0, 1}
    with pytest.raises(ValueError):
        ML.fit_kmeans_best(df.limit(0), k=2, n_init=2)


def test_centers_are_saved_and_loaded(spark, tmp_path):
    model = ML.Centers([[1.0, 2.0], [3.0, 2.0], [3.0, 2.0]])
    model.write().overwrite().save(f"file://{tmp_path}/km")
    back = ML.Centers.load(f"file://{tmp_path}/km")
    df = spark.createDataFrame([(Vectors.dense([2.9, 2.0]),), (Vectors.dense([2.0, 0.0]),)], ["features"])
    assert [r.cluster_id for r in back.transform(df).collect()] == [1, 0]  # ties: the first center


def test_undefined_metrics_are_null_not_errors(spark):
    df = spark.createDataFrame([(1, 0.2, 3.0, 3.5), (1, 0.7, 3.0, 2.5)], "y int, s double, t double, p double")
    assert ML.roc_auc(df, "y", "s").first().roc_auc is None          # one class only
    m = ML.regression_metrics(df, "t", "p").first()
    assert m.r2 is None and m.mae == 0.5                               # constant label
