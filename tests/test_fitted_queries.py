"""The fitted-model queries: optimality and agreement, on the driver's smallest tables."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from strata.operators import ml as ML
from strata.plans import ml_queries as Q
from strata.plans.registry import load_all

from .conftest import SF_SMALL

QUERIES, _ = load_all()


@pytest.fixture(scope="module")
def st(spark):
    return Q.state(spark, SF_SMALL)


def direct_silhouette(x, labels):
    """All pairs."""
    out, ids = [], np.unique(labels)
    for lo in range(0, len(x), 500):
        far = np.sqrt(((x[lo:lo + 500, None, :] - x[None]) ** 2).sum(2))
        sums = np.stack([far[:, labels == c].sum(1) for c in ids], axis=1)
        counts = np.array([(labels == c).sum() for c in ids])
        own = np.searchsorted(ids, labels[lo:lo + 500])
        r = np.arange(len(far))
        a = sums[r, own] / np.maximum(counts[own] - 1, 1)
        rest = sums / counts
        rest[r, own] = np.inf
        b = rest.min(1)
        out.append(np.where((counts[own] == 1) | (np.maximum(a, b) == 0), 0, (b - a) / np.maximum(np.maximum(a, b), 1e-300)))
    return float(np.concatenate(out).mean())


def points(spark, x, labels):
    from pyspark.ml.linalg import Vectors
    return spark.createDataFrame([(i, int(c), Vectors.dense(v)) for i, (v, c) in enumerate(zip(x.tolist(), labels))],
                                 ["id", "cluster_id", "features"])


def test_silhouette_is_exact_on_small_tables(spark):
    rng = np.random.default_rng(2)
    labels = np.array([0] * 150 + [1] * 120 + [2] * 40 + [3])  # one point alone
    x = rng.normal(size=(len(labels), 3)) + labels[:, None] * 1.5
    x[:30] = x[0]  # copies
    mean, bound = ML.silhouette(points(spark, x, labels), 3, "id")
    assert bound == 0 and mean == pytest.approx(direct_silhouette(x, labels), abs=1e-12)
    assert ML.silhouette(points(spark, x, np.zeros(len(x), int)), 3, "id") == (None, None)


def test_silhouette_of_a_sample_keeps_its_bound(spark):
    rng = np.random.default_rng(3)
    labels = rng.choice(3, 4000, p=[0.6, 0.35, 0.05])
    x = rng.normal(size=(len(labels), 2)) + labels[:, None]
    mean, bound = ML.silhouette(points(spark, x, labels), 2, "id", points=250)
    assert 0 < bound < 0.5 and abs(mean - direct_silhouette(x, labels)) <= bound


def test_silhouette_of_large_clusters_is_over_all_rows(spark, monkeypatch):
    """More than 1 000 rows of a cluster, in one pair of blocks and in many."""
    rng = np.random.default_rng(3)
    labels = rng.choice([2, 5, 9], 4000, p=[0.6, 0.35, 0.05])
    x = rng.normal(size=(len(labels), 2)) + labels[:, None] / 3
    x[:200] = x[0]  # copies
    scored, want = points(spark, x + 1e4, labels), direct_silhouette(x, labels)
    for least in (1 << 13, 500):
        monkeypatch.setattr(ML, "SILHOUETTE_LEAST", least)
        mean, bound = ML.silhouette(scored, 2, "id")
        assert bound == 0 and mean == pytest.approx(want, abs=1e-10)
    assert ML.silhouette(points(spark, x[:2], [2, 5]), 2, "id") == (0, 0)  # alone in their clusters


def test_metrics_of_large_clusters_are_over_all_rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 3)) + rng.choice(2, 3000)[:, None] * 2
    model = ML.Centers(np.array([[0.0, 0, 0], [2, 2, 2]]))
    scored = model.transform(points(spark, x, np.zeros(len(x), int)).drop("cluster_id"))
    m = ML.kmeans_metrics(model, scored, "id")
    labels = np.array([r.cluster_id for r in scored.orderBy("id").collect()])
    assert np.bincount(labels).min() > 1000 and m["silhouette_bound"] == 0
    assert m["silhouette"] == pytest.approx(direct_silhouette(x, labels), abs=1e-10)


def test_distances_keep_their_digits():
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(60, 3)), 5, axis=0) * [1, 1, 1e3]
    x += rng.normal(size=x.shape) * 1e-7
    x[7] = x[8]
    cluster = np.sort(rng.choice(3, len(x)))
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) @ np.eye(3)[cluster]
    sums = np.zeros((len(x), 3))
    for rows, side in ((np.arange(300), np.repeat([0, 1], [100, 200])), (np.arange(100), -1), (np.arange(100, 300), -1)):
        pair = {"row": rows, "cluster": cluster[rows].astype(np.int32), "side": np.broadcast_to(side, len(rows)).astype(np.int32)}
        got = ML.block_sums(3, 3)(pa.table(pair | {f"x{i}": np.ascontiguousarray(x[rows, i]) for i in range(3)}))
        sums[got["row"].to_numpy()] += np.column_stack([got[f"s{c}"] for c in range(3)])
    assert np.allclose(sums, far, rtol=1e-11, atol=0)


def test_coefficients_are_those_of_lstsq(spark, st):
    """The one-hot design is rank-deficient: centred lstsq gives the solution of least norm."""
    x, rows = features(st.linear, st.reg_train, "speed")
    y = np.array([r.speed for r in rows])
    assert np.linalg.matrix_rank(x - x.mean(0)) < x.shape[1]
    want = np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=1e-8)[0]
    model = st.linear.stages[-1]
    assert np.allclose(model.coefficients.toArray(), want, atol=1e-7)
    assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ want)


def test_least_squares_keeps_its_digits_and_is_saved(spark, tmp_path):
    from pyspark.ml.feature import VectorAssembler
    rng = np.random.default_rng(4)
    a = rng.normal(size=(500, 3)) * [1, 1e-3, 10] + [1e6, 5, -1e5]
    rows = [(*map(float, r), float(r @ [2, -300, 0.1] + 7 + e)) for r, e in zip(a, rng.normal(size=500) * 0.01)]
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(spark.createDataFrame(rows, "a double, b double, c double, y double"))
    n, mean, second = ML.moments(df, "features", "y", 3)
    w = ML.minimum_norm(second)
    x, y = np.array(rows)[:, :3], np.array(rows)[:, 3]
    want = np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=None)[0]
    assert n == 500 and np.allclose(w, want, rtol=1e-6)
    model = ML.LeastSquares(w, mean[-1] - mean[:-1] @ w)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = ML.LeastSquares.load(str(tmp_path / "m"))
    got = [r.prediction for r in again.transform(df).collect()]
    assert again.coefficients == model.coefficients and np.allclose(got, x @ w + model.intercept)
    with pytest.raises(ValueError):
        ML.moments(df.filter("false"), "features", "y", 3)


def features(model, df, *cols):
    rows = model.transform(df).select(vector_to_array("features").alias("x"), *cols).collect()
    return np.array([r.x for r in rows]), rows


def test_linear_regression_residuals_are_orthogonal(spark, st):
    x, rows = features(st.linear, st.reg_train, "speed", "prediction")
    residual = np.array([r.speed - r.prediction for r in rows])
    scale = np.abs(x).sum(0) + 1
    assert abs(residual.sum()) / len(rows) < 1e-6
    assert (np.abs(x.T @ residual) / scale).max() < 1e-5
    test = {r.event_id: r for r in st.reg_test.select("event_id", "speed").collect()}
    got = QUERIES["linear_regression"](spark, SF_SMALL).collect()
    assert {r.event_id: r.speed for r in got} == {i: r.speed for i, r in test.items()}
    top = QUERIES["speed_predictions"](spark, SF_SMALL).collect()
    assert [r.event_id for r in top] == sorted(test)[:10]
    by_id = {r.event_id: r.prediction for r in got}
    assert all(r.predicted_speed == pytest.approx(by_id[r.event_id]) for r in top)


def test_coefficients_reproduce_the_prediction(spark, st):
    coefs = {r.feature: r.coefficient for r in QUERIES["coefficients"](spark, SF_SMALL).collect()}
    x, rows = features(st.linear, st.reg_test, "prediction")
    lr = st.linear.stages[-1]
    assert len(coefs) == x.shape[1] and list(coefs.values()) == pytest.approx(lr.coefficients.toArray().tolist())
    assert np.allclose(x @ np.array(list(coefs.values())) + lr.intercept, [r.prediction for r in rows])
    top = QUERIES["top_coefficients"](spark, SF_SMALL).collect()
    assert [abs(r.coefficient) for r in top] == sorted((abs(v) for v in coefs.values()), reverse=True)[:20]


def test_logistic_gradient_is_near_zero(spark, st):
    train = st.cls_split.where(~F.col("is_test"))
    x, rows = features(st.logistic, train, "is_congested", ML.positive_probability().alias("p"))
    gap = np.array([r.p - r.is_congested for r in rows])
    w = st.logistic.stages[-1].coefficients.toArray()
    gradient = x.T @ gap / len(rows) + w / len(rows)
    assert np.abs(gradient).max() < 2e-3 and abs(gap.mean()) < 2e-3
    got = QUERIES["logistic_regression"](spark, SF_SMALL).collect()
    ids = {r.event_id for r in st.cls_split.where("is_test").select("event_id").collect()}
    assert {r.event_id for r in got} == ids
    assert all((r.probability > 0.5) == (r.prediction == 1) for r in got)
    preview = QUERIES["congestion_preview"](spark, SF_SMALL).collect()
    by_id = {r.event_id: r.probability for r in got}
    assert [r.predicted_congestion_probability for r in preview] == pytest.approx([by_id[i] for i in sorted(ids)[:10]])


def test_every_row_is_in_the_nearest_cluster(spark, st):
    x, rows = features(st.kmeans, st.cluster_prep.transform(st.cluster_rows), "event_id", "cluster_id")
    centers = np.array(st.kmeans.clusterCenters())
    gaps = ((x[:, None, :] - centers[None]) ** 2).sum(2)
    mine = gaps[np.arange(len(rows)), [r.cluster_id for r in rows]]
    assert np.allclose(mine, gaps.min(1))
    assert {r.event_id: r.cluster_id for r in QUERIES["kmeans_sectors"](spark, SF_SMALL).collect()} == {
        r.event_id: r.cluster_id for r in rows}
    m = QUERIES["kmeans_metrics"](spark, SF_SMALL).first()
    assert m.inertia == pytest.approx(mine.sum()) and -1 <= m.silhouette_sq_euclidean <= 1
    assert abs(m.silhouette - direct_silhouette(x, np.array([r.cluster_id for r in rows]))) <= m.silhouette_bound + 1e-9 < 0.3
    summary = {r.cluster_id: r["rows"] for r in QUERIES["cluster_summary"](spark, SF_SMALL).collect()}
    assert summary == {int(k): int(n) for k, n in zip(*np.unique([r.cluster_id for r in rows], return_counts=True))}
    back = {r.event_id: r.cluster_id for r in QUERIES["assign_clusters_back"](spark, SF_SMALL).collect()}
    assert len(back) == st.model.count() and {i: back[i] for i in (r.event_id for r in rows)} == {
        r.event_id: r.cluster_id for r in rows}


def test_batch_scores_are_those_of_the_single_models(spark, st):
    got = {r.event_id: r for r in QUERIES["batch_scoring"](spark, SF_SMALL).collect()}
    assert len(got) == st.model.count()
    lin = {r.event_id: r.prediction for r in st.linear.transform(st.model).select("event_id", "prediction").collect()}
    log = {r.event_id: r.p for r in st.logistic.transform(st.model).select(
        "event_id", ML.positive_probability().alias("p")).collect()}
    assert all(r.predicted_speed == pytest.approx(lin[i]) and
               r.predicted_congestion_probability == pytest.approx(log[i]) for i, r in got.items())
    cells = {}
    for r in got.values():
        cells.setdefault((r.lat_grid, r.lng_grid), []).append(r)
    grid = QUERIES["grid_map"](spark, SF_SMALL).collect()
    assert {(g.lat_grid, g.lng_grid) for g in grid} == set(cells)
    for g in grid:
        mine = cells[(g.lat_grid, g.lng_grid)]
        assert g.predicted_avg_speed == pytest.approx(np.mean([r.predicted_speed for r in mine]))
        assert g.predicted_congestion_rate == pytest.approx(np.mean([r.predicted_congestion_probability for r in mine]))
        count = {}
        for r in mine:
            count[r.predicted_cluster_id] = count.get(r.predicted_cluster_id, 0) + 1
        assert g.dominant_cluster == min(count, key=lambda k: (-count[k], k))


def test_metrics_file_holds_the_metrics(spark, st):
    rec = QUERIES["write_metrics_json"](spark, SF_SMALL).first()
    m = QUERIES["kmeans_metrics"](spark, SF_SMALL).first()
    assert rec.kmeans.inertia == pytest.approx(m.inertia)
    test = np.array([(r.speed, r.prediction) for r in QUERIES["linear_regression"](spark, SF_SMALL).collect()])
    assert rec.linear_regression.mae == pytest.approx(np.abs(test[:, 0] - test[:, 1]).mean())


def test_inertia_is_over_all_rows(spark):
    """Over 300 000 rows: equal to a direct sum of squared distances."""
    from pyspark.ml.feature import VectorAssembler

    df = spark.range(320_000).selectExpr("pmod(hash(id), 1000) / 100.0D AS a", "pmod(hash(id, 1), 1000) / 200.0D AS b")
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    model = ML.fit_kmeans_best(data, k=3, n_init=2, max_iter=10)
    scored = model.transform(data)
    x = np.array(scored.select("a", "b", "cluster_id").toPandas())
    direct = ((x[:, :2] - np.array(model.clusterCenters())[x[:, 2].astype(int)]) ** 2).sum()
    assert ML.inertia(model, scored) == pytest.approx(direct)


def test_binary_landing_is_unchanged(spark):
    rows = QUERIES["bronze_binary_landing"](spark, SF_SMALL).collect()
    assert rows and all(r.unchanged for r in rows)


def test_local_folder_is_refused_on_a_cluster(monkeypatch):
    from strata import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())
