"""Spark ML: preprocessing fits, models, evaluation.

Preprocessing constants (median, mode, mean, population std) are fitted with
distributed aggregates and frozen into a ``SQLTransformer`` stage, so the
fitted preprocessing + model is one ``PipelineModel`` (persistable, applied
with a single ``transform``).  Metrics are SQL aggregates over
(label, prediction) columns, checkable against any SQL engine.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F
from pyspark import StorageLevel

from ..functions.stats import exact_mode, exact_quantiles, running_sum_before
from ..session import scratch_path


# --- preprocessing fits --------------------------------------------------------
def fit_medians(df: DataFrame, cols) -> dict[str, float]:
    q = exact_quantiles(df, list(cols), [0.5]) if cols else {}
    return {c: q[c][0] for c in cols}


def fit_mode(df: DataFrame, col: str):
    return exact_mode(df, col)


def fit_scaler(df: DataFrame, cols, medians: dict | None = None) -> dict[str, tuple[float, float]]:
    """Mean and population std of the (median-imputed) columns, one aggregate."""
    medians = medians or {}
    def x(c):
        v = F.col(c).cast("double")
        return F.coalesce(v, F.lit(medians[c])) if medians.get(c) is not None else v
    if not cols:
        return {}
    row = df.agg(*[e for c in cols for e in (F.avg(x(c)).alias(f"{c}__m"), F.stddev_pop(x(c)).alias(f"{c}__s"))]).first()
    return {c: (row[f"{c}__m"], row[f"{c}__s"]) for c in cols}


def _num(v) -> str:
    return "CAST(NULL AS DOUBLE)" if v is None else f"CAST({float(v)!r} AS DOUBLE)"


def impute_scale_sql(numeric, medians, moments, categorical=(), modes=None, suffix="_s") -> str:
    """SQL of the frozen impute(median) -> scale((x - mean) / std) step; a
    constant column (std 0) scales to 0, like scikit-learn."""
    parts = ["*"]
    for c in numeric:
        mean, std = moments[c]
        x = f"coalesce(CAST(`{c}` AS DOUBLE), {_num(medians.get(c))})"
        denom = _num(std if std not in (None, 0.0) else 1.0)
        parts.append(f"({x} - {_num(mean if mean is not None else 0.0)}) / {denom} AS `{c}{suffix}`")
    for c in categorical:
        m = (modes or {}).get(c)
        parts.append(f"coalesce(`{c}`, {'NULL' if m is None else repr(str(m))}) AS `{c}_imp`")
    return f"SELECT {', '.join(parts)} FROM __THIS__"


@dataclass
class Prep:
    numeric: tuple
    categorical: tuple
    medians: dict
    modes: dict
    moments: dict
    stages: list = field(default_factory=list)

    @property
    def feature_names(self) -> list[str]:
        return [f"{c}_s" for c in self.numeric] + [f"{c}_ohe" for c in self.categorical]


def fit_preprocessing(train: DataFrame, numeric, categorical=()) -> Prep:
    medians = fit_medians(train, numeric)
    moments = fit_scaler(train, numeric, medians)
    modes = {c: fit_mode(train, c) for c in categorical}
    stages = [SQLTransformer(statement=impute_scale_sql(numeric, medians, moments, categorical, modes))]
    for c in categorical:
        stages += [StringIndexer(inputCol=f"{c}_imp", outputCol=f"{c}_idx", stringOrderType="alphabetAsc",
                                 handleInvalid="keep"),
                   # With the indexer's extra "unknown" label, dropLast removes exactly that slot:
                   # k known categories -> k columns, unseen -> all zeros.
                   OneHotEncoder(inputCols=[f"{c}_idx"], outputCols=[f"{c}_ohe"], dropLast=True)]
    prep = Prep(tuple(numeric), tuple(categorical), medians, modes, moments, stages)
    prep.stages.append(VectorAssembler(inputCols=prep.feature_names, outputCol="features"))
    return prep


class LeastSquares(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Linear model over ``features``: adds ``prediction``."""

    weights = Param(Params._dummy(), "weights", "one weight for each feature", TypeConverters.toListFloat)
    offset = Param(Params._dummy(), "offset", "prediction of a row of zeros", TypeConverters.toFloat)

    def __init__(self, weights=None, offset=None):
        super().__init__()
        if weights is not None:
            self._set(weights=list(map(float, weights)), offset=float(offset))

    @property
    def coefficients(self):
        return Vectors.dense(self.getOrDefault(self.weights))

    @property
    def intercept(self) -> float:
        return self.getOrDefault(self.offset)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights = F.array(*(F.lit(w) for w in self.getOrDefault(self.weights)))
        products = F.zip_with(vector_to_array("features"), weights, lambda x, w: x * w)
        return dataset.withColumn("prediction", F.aggregate(products, F.lit(self.intercept), lambda s, p: s + p))


def moments(df: DataFrame, features: str, label: str, size: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, means and centred second moments of the features and, last, the label: two aggregates whose size is fixed.

    The means come first, so that large offsets cost no digits."""
    x = df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y")).select(
        *(F.get("x", F.lit(i)).alias(f"c{i}") for i in range(size)), F.col("y").alias(f"c{size}"))
    names = x.columns
    first = x.agg(F.count(F.lit(1)).alias("n"), *(F.avg(c).alias(c) for c in names)).first()
    if not first["n"]:
        raise ValueError("no rows to fit")
    mean = np.array([first[c] for c in names], float)
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    gap = [F.col(c) - F.lit(float(m)) for c, m in zip(names, mean)]
    sums = x.agg(*(F.sum(gap[i] * gap[j]).alias(f"s{k}") for k, (i, j) in enumerate(pairs))).first()
    second = np.zeros((len(names), len(names)))
    for k, (i, j) in enumerate(pairs):
        second[i, j] = second[j, i] = sums[k]
    return first["n"], mean, second


def minimum_norm(second: np.ndarray, rank_tol: float = 1e-10) -> np.ndarray:
    """Least-squares weights from centred moments (label last); of all solutions the one of least norm.

    Directions whose share of the largest eigenvalue is below ``rank_tol`` are those in
    which the features do not vary, as among the dummies of one category."""
    values, vectors = np.linalg.eigh(second[:-1, :-1])
    some = values > rank_tol * max(values.max(initial=0.0), 1e-300)
    v = vectors[:, some]
    return v @ ((v.T @ second[:-1, -1]) / values[some])


def fit_linear_regression(train: DataFrame, prep: Prep, label: str) -> PipelineModel:
    """Ordinary least squares (no penalty), intercept fitted, from one distributed moment matrix.

    The design has all dummies of a category besides the intercept, so its rank is
    deficient; the solution of least norm is the one that ``lstsq`` gives."""
    ready = Pipeline(stages=prep.stages).fit(train)
    rows = ready.transform(train)
    size = rows.schema["features"].metadata["ml_attr"]["num_attrs"]
    _, mean, second = moments(rows, "features", label, size)
    weights = minimum_norm(second)
    return PipelineModel(stages=[*ready.stages, LeastSquares(weights, mean[-1] - mean[:-1] @ weights)])


def fit_logistic_regression(train: DataFrame, prep: Prep, label: str, c: float = 1.0, max_iter: int = 1000,
                            n_train: int | None = None, tol: float = 1e-4) -> PipelineModel:
    """L2 logistic regression equal to C * sum(loss) + 0.5 * |w|^2, i.e.
    Spark's mean loss + regParam * 0.5 * |w|^2 with regParam = 1 / (C * n)."""
    n = n_train or train.count()
    lr = LogisticRegression(featuresCol="features", labelCol=label, regParam=1.0 / (c * n), elasticNetParam=0.0,
                            standardization=False, maxIter=max_iter, tol=tol, family="binomial")
    return Pipeline(stages=[*prep.stages, lr]).fit(train)


def positive_probability(col: str = "probability") -> F.Column:
    return vector_to_array(F.col(col))[1]


def coefficients(model: PipelineModel, prep: Prep, spark) -> DataFrame:
    """Feature name <-> coefficient, names expanded from the assembler metadata."""
    scored_meta = model.stages[-1]
    coefs = scored_meta.coefficients.toArray().tolist()
    names = []
    for c in prep.numeric:
        names.append(f"num__{c}")
    idx = {st.getOutputCol(): st for st in model.stages if hasattr(st, "labels") and hasattr(st, "getOutputCol")}
    for c in prep.categorical:
        labels = idx[f"{c}_idx"].labels
        names += [f"cat__{c}_{v}" for v in labels]
    if len(names) != len(coefs):
        raise ValueError(f"{len(coefs)} coefficients for the features {names}")
    return spark.createDataFrame(list(zip(names, [float(v) for v in coefs])), "feature string, coefficient double")


def top_coefficients(coefs: DataFrame, n: int = 20) -> DataFrame:
    return coefs.orderBy(F.desc(F.abs("coefficient")), F.asc("feature")).limit(n)


# --- K-means -----------------------------------------------------------------------
class Centers(Model, DefaultParamsReadable, DefaultParamsWritable):
    """K-means model over ``features``: adds ``cluster_id``, the nearest center (ties: the first)."""

    flat = Param(Params._dummy(), "flat", "coordinates of the centers, one center after another", TypeConverters.toListFloat)
    k = Param(Params._dummy(), "k", "number of centers", TypeConverters.toInt)

    def __init__(self, centers=None):
        super().__init__()
        if centers is not None:
            self._set(flat=[float(v) for c in centers for v in c], k=len(centers))

    def clusterCenters(self) -> list[np.ndarray]:
        return list(np.array(self.getOrDefault(self.flat)).reshape(self.getOrDefault(self.k), -1))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array("features")
        gaps = [F.aggregate(F.zip_with(x, F.lit(c.tolist()), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, g: s + g)
                for c in self.clusterCenters()]
        # array_position gives the first of equal ones
        nearest = F.transform(F.array(F.array(*gaps)), lambda g: F.array_position(g, F.array_min(g)).cast("int") - 1)
        return dataset.withColumn("cluster_id", F.get(nearest, F.lit(0)))


def with_restarts(points: DataFrame, centers: dict[int, np.ndarray]) -> DataFrame:
    """Every point once for each restart: its columns, ``restart``, ``cluster`` (nearest center) and ``cost`` (its squared distance).

    ``centers`` is a literal of the plan, of restarts x centers numbers."""
    cols, k = points.columns, len(next(iter(centers.values())))
    rows = ", ".join(
        f"named_struct('restart', {r}, " + ", ".join(f"'m{j}_{i}', {float(v)!r}D" for j, c in enumerate(m) for i, v in enumerate(c)) + ")"
        for r, m in centers.items())
    gaps = [" + ".join(f"({c} - m{j}_{i}) * ({c} - m{j}_{i})" for i, c in enumerate(cols)) + f" AS d{j}" for j in range(k)]
    far = points.selectExpr(*cols, f"inline(array({rows}))").selectExpr(*cols, "restart", *gaps)
    cost = f"least({', '.join(f'd{j}' for j in range(k))})" if k > 1 else "d0"
    far = far.selectExpr(*cols, "restart", *(f"d{j}" for j in range(k)), f"{cost} AS cost")
    cluster = "CASE " + " ".join(f"WHEN d{j} = cost THEN {j}" for j in range(k)) + " END"
    return far.selectExpr(*cols, "restart", f"{cluster} AS cluster", "cost")


def seed_centers(points: DataFrame, k: int, restarts: int, seed: int) -> dict[int, np.ndarray]:
    """k-means++ seeds of every restart: k passes over all rows, each one aggregate of a row for each restart.

    A row is drawn with a chance proportional to its squared distance to the restart's
    centers so far: of independent exponential times, that of the row with weight w
    having mean 1/w, the row with the first one is taken.  With fewer distinct rows
    than k there are as many centers as distinct rows."""
    cols = points.columns
    # a buffer of numbers, one for each coordinate, is updated in a hash table; one of structs would have the rows sorted
    earliest = [F.min_by(c, "time").alias(c) for c in cols]
    time = -F.log(1.0 - F.rand(seed))
    drawn = points.select(*cols, F.explode(F.sequence(F.lit(0), F.lit(restarts - 1))).alias("restart")).select(
        *cols, "restart", time.alias("time")).groupBy("restart").agg(*earliest).collect()
    if not drawn:
        raise ValueError("no rows to fit")
    centers = {r["restart"]: np.array([[r[c] for c in cols]], float) for r in sorted(drawn, key=lambda r: r["restart"])}
    for step in range(1, k):
        far = with_restarts(points, centers).filter("cost > 0").select(
            "restart", *cols, (-F.log(1.0 - F.rand(seed + step)) / F.col("cost")).alias("time"))
        drawn = {r["restart"]: [r[c] for c in cols] for r in far.groupBy("restart").agg(*earliest).collect()}
        if len(drawn) < len(centers):
            break  # every row lies on a center
        centers = {r: np.vstack([m, drawn[r]]) for r, m in centers.items()}
    return centers


def fit_kmeans_best(data: DataFrame, k: int = 4, n_init: int = 20, seed: int = 42, max_iter: int = 300,
                    tol: float = 1e-4) -> Centers:
    """Best of ``n_init`` K-means fits (lowest sum of squared distances over all rows; ties: the first).

    All restarts share each pass over the data: one aggregate of (restart, cluster)
    sums, so the passes are those of the longest restart.  A restart ends when its
    centers moved, in sum of squares, by at most ``tol`` times the mean variance of the
    features; then it leaves the plan.  A center that no row is nearest to stays.  The
    input is persisted once (memory, spilling to disk) as plain columns."""
    size = data.schema["features"].metadata.get("ml_attr", {}).get("num_attrs")
    x = vector_to_array("features")
    if size is None:
        one = data.select(x.alias("x")).first()
        if one is None:
            raise ValueError("no rows to fit")
        size = len(one["x"])
    points = data.select(x.alias("x")).select(*(F.get("x", F.lit(i)).alias(f"x{i}") for i in range(size))).persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        centers = seed_centers(points, k, n_init, seed)
        spread = points.agg(*(F.var_pop(c).alias(c) for c in points.columns)).first()
        limit = tol * float(np.mean(list(spread)))
        moving = dict(centers)
        for _ in range(max_iter):
            sums = with_restarts(points, moving).groupBy("restart", "cluster").agg(*(F.avg(c).alias(c) for c in points.columns)).collect()
            moved = {r: m.copy() for r, m in moving.items()}
            for row in sums:
                moved[row["restart"]][row["cluster"]] = row[2:]
            centers |= moved
            moving = {r: m for r, m in moved.items() if ((m - moving[r]) ** 2).sum() > limit}
            if not moving:
                break
        costs = dict(with_restarts(points, centers).groupBy("restart").agg(F.sum("cost")).collect())
        return Centers(centers[min(costs, key=lambda r: (costs[r], r))])
    finally:
        points.unpersist()


def inertia(model, scored: DataFrame) -> float:
    """Sum over all rows of the squared distance to the center of their cluster."""
    centers = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in model.clusterCenters()])
    x = vector_to_array(F.col("features"))
    gaps = F.zip_with(x, F.get(centers, F.col("cluster_id")), lambda a, b: (a - b) * (a - b))
    return float(scored.agg(F.sum(F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g))).first()[0] or 0.0)


SILHOUETTE_MOST = 1 << 21  # coordinates and sums of the rows of a block at most: a task holds two blocks
SILHOUETTE_LEAST = 1 << 13  # rows of a block: no smaller ones are cut for the sake of more tasks
SIDE = 256  # rows of either block compared at once: their distances stay in the processor's cache
NEAR = 1e-6  # share of the squared lengths below which a squared distance is taken from the differences


def block_sums(size: int, clusters: int):
    """Arrow function of a pair of blocks (side 0 and 1), or of a block and itself (side -1): every row with its sums of distances to the other block's rows of each cluster.

    The squared distances are one product of matrices, |x|^2 - 2xy + |y|^2; those so
    small that this has cost them digits are summed from the differences."""
    def parts(rows, cluster):
        """Some rows at a time: themselves, where they are, their clusters, who is in which, squared lengths."""
        for lo in range(0, len(rows), SIDE):
            x = rows[lo:lo + SIDE]
            ids, at = np.unique(cluster[lo:lo + SIDE], return_inverse=True)
            yield x, slice(lo, lo + SIDE), ids, np.eye(len(ids))[at], (x * x).sum(1)

    def add(x, x_cluster, to_x, y, y_cluster, to_y=None):
        one = [(*p, np.column_stack([p[0], p[4], np.ones(len(p[0]))])) for p in parts(x, x_cluster)]
        for b, b_at, b_ids, b_in, b_square in parts(y, y_cluster):
            right = np.ascontiguousarray(np.column_stack([-2 * b, np.ones(len(b)), b_square]).T)
            for a, a_at, a_ids, a_in, a_square, left in one:
                far = left @ right
                near = NEAR * (a_square.max() + b_square.max())
                if far.min() <= near:
                    i, j = np.nonzero(far <= near)
                    far[i, j] = ((a[i] - b[j]) ** 2).sum(1)
                np.sqrt(far, out=far)
                to_x[a_at][:, b_ids] += far @ b_in
                if to_y is not None:
                    to_y[b_at][:, a_ids] += far.T @ a_in

    def run(pair: pa.Table) -> pa.Table:
        side, cluster = (pair[c].to_numpy() for c in ("side", "cluster"))
        order = np.lexsort((cluster, side))  # parts of a single cluster are the fastest
        cluster, row, cut = cluster[order], pair["row"].to_numpy()[order], int((side == 0).sum())
        x = np.column_stack([pair[f"x{i}"].to_numpy() for i in range(size)])[order]
        sums = np.zeros((len(x), clusters))
        if side[0] < 0:
            add(x, cluster, sums, x, cluster)
        else:
            add(x[:cut], cluster[:cut], sums[:cut], x[cut:], cluster[cut:], sums[cut:])
        return pa.table({"row": row, "cluster": cluster, **{f"s{c}": np.ascontiguousarray(sums[:, c]) for c in range(clusters)}})

    return run


def whole_silhouette(scored: DataFrame, size: int) -> float | None:
    """Euclidean silhouette from the distances of all pairs of rows; null with fewer than two clusters.

    The rows are dealt out to blocks and every pair of blocks is one task, which gives
    both blocks' rows their sums; so the work is that of half the square of the rows, in
    tasks of bounded memory.  Each row is sent once for each block.  The rows are
    centred first, so that large offsets cost no digits."""
    spark, x = scored.sparkSession, vector_to_array("features")
    path = scratch_path(spark, "silhouette")
    names = [f"x{i}" for i in range(size)]
    scored.select("cluster_id", F.monotonically_increasing_id().alias("row"),
                  *(F.get(x, F.lit(i)).alias(c) for i, c in enumerate(names))).write.parquet(path)
    rows = spark.read.parquet(path)
    found = rows.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"), *(F.avg(c).alias(c) for c in names)).orderBy("cluster_id").collect()
    if len(found) < 2:
        return None
    ids, counts = [r["cluster_id"] for r in found], [r["n"] for r in found]
    total = sum(counts)
    middle = [sum(r[c] * r["n"] for r in found) / total for c in names]
    # eight pairs of blocks for each partition of the session, if that leaves blocks of some size
    wanted = math.isqrt(16 * int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    blocks = max(-(-total * (size + len(ids)) // SILHOUETTE_MOST), min(-(-total // SILHOUETTE_LEAST), wanted))
    block, other = F.pmod(F.xxhash64("row"), F.lit(blocks)), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    pairs = rows.select(
        "row", (F.array_position(F.array(*map(F.lit, ids)), F.col("cluster_id")) - 1).cast("int").alias("cluster"),
        *((F.col(c) - F.lit(float(m))).alias(c) for c, m in zip(names, middle)), block.cast("int").alias("block"), other.alias("other"))
    pairs = pairs.select(
        (high * (high + 1) / 2 + low).cast("int").alias("pair"),
        F.when(F.col("block") == F.col("other"), -1).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side"),
        "row", "cluster", *names)
    sums = [f"s{c}" for c in range(len(ids))]
    far = pairs.repartitionById(blocks * (blocks + 1) // 2, F.col("pair")).groupBy("pair").applyInArrow(
        block_sums(size, len(ids)), ", ".join(["row long", "cluster int", *(f"{s} double" for s in sums)]))
    far = far.groupBy("row", "cluster").agg(*(F.sum(s).alias(s) for s in sums))
    mine = [F.col("cluster") == c for c in range(len(ids))]
    # a point alone in its cluster has no distance within, and the value 0; so have points that are all equal
    a = F.coalesce(*(F.when(m, F.col(s) / F.lit(float(n - 1))) for m, s, n in zip(mine, sums, counts) if n > 1), F.lit(None).cast("double"))
    b = F.array_min(F.array(*(F.when(~m, F.col(s) / F.lit(float(n))) for m, s, n in zip(mine, sums, counts))))
    far = far.select(a.alias("a"), b.alias("b"))
    top = F.greatest("a", "b")
    return far.agg(F.avg(F.when(F.col("a").isNull() | (top == 0), 0.0).otherwise((F.col("b") - F.col("a")) / top))).first()[0]


SILHOUETTE_BLOCKS = 16  # of a sample
SILHOUETTE_MISS = 0.01  # chance that the true value lies outside the bound


def silhouette(scored: DataFrame, size: int, key: str, points: int | None = None) -> tuple[float | None, float | None]:
    """Euclidean silhouette over all rows and a bound on its error: all pairs of rows, and 0.

    Only a caller that gives ``points`` gets an estimate: of larger clusters a sample by
    the hash of ``key`` then stands for the rest.  The sampled points meet in pairs of
    blocks: a point is sent to every block, a block holds a share of the sample, so the
    work is bounded whatever the table.  The bound adds Hoeffding's, for the mean over
    sampled points of each cluster, to the normal one for the mean distances that a
    point's value rests on.  Null with fewer than two clusters."""
    if points is None:
        mean = whole_silhouette(scored, size)
        return mean, None if mean is None else 0.0
    counts = {r["cluster_id"]: r["count"] for r in scored.groupBy("cluster_id").count().collect()}
    if len(counts) < 2:
        return None, None
    share = F.lit(1.0)
    for c, n in counts.items():
        share = F.when(F.col("cluster_id") == c, F.lit(points / n)).otherwise(share)
    spread = F.pmod(F.xxhash64(key, F.lit("silhouette")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    x = vector_to_array("features")
    path = scratch_path(scored.sparkSession, "silhouette")
    scored.filter(spread < share).select(
        "cluster_id", F.pmod(F.xxhash64(key), F.lit(SILHOUETTE_BLOCKS)).cast("int").alias("block"),
        F.monotonically_increasing_id().alias("row"), *(F.get(x, F.lit(i)).alias(f"x{i}") for i in range(size))).write.parquet(path)
    sample = scored.sparkSession.read.parquet(path)
    mine = sample.drop("block").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(SILHOUETTE_BLOCKS - 1))))
    other = sample.select("block", F.col("cluster_id").alias("to"), F.col("row").alias("at"), *(F.col(f"x{i}").alias(f"z{i}") for i in range(size)))
    squares = [(F.col(f"x{i}") - F.col(f"z{i}")) * (F.col(f"x{i}") - F.col(f"z{i}")) for i in range(size)]
    far = mine.join(other, "block").filter("row <> at").select("row", "cluster_id", "to", F.sqrt(sum(squares[1:], squares[0])).alias("d"))
    means = far.groupBy("row", "cluster_id", "to").agg(F.avg("d").alias("d"), F.coalesce(F.stddev_samp("d"), F.lit(0.0)).alias("sd"), F.count("*").alias("n"))
    whole = F.lit(False)
    for c, n in counts.items():
        whole = whole | (F.col("to") == c) & F.lit(n <= points)
    miss = F.when(whole, 0.0).otherwise(NormalDist().inv_cdf(1 - SILHOUETTE_MISS / 2) * F.col("sd") / F.sqrt("n"))
    means = means.withColumn("miss", miss)
    a = F.struct("d", "miss")
    per_row = means.groupBy("row", "cluster_id").agg(
        F.max(F.when(F.col("to") == F.col("cluster_id"), a)).alias("a"), F.min(F.when(F.col("to") != F.col("cluster_id"), a)).alias("b"))
    top = F.greatest("a.d", "b.d")
    # a point alone in its cluster has no distance within, and the value 0; so have points that are all equal
    value = F.when(F.col("a").isNull() | (top == 0), 0.0).otherwise((F.col("b.d") - F.col("a.d")) / top)
    unsure = F.when(F.col("a").isNull() | (top == 0), 0.0).otherwise((F.col("a.miss") + F.col("b.miss")) / top)
    got = per_row.groupBy("cluster_id").agg(F.avg(value).alias("s"), F.avg(unsure).alias("u"), F.count("*").alias("m")).collect()
    total = sum(counts.values())
    weight = {r["cluster_id"]: counts[r["cluster_id"]] / total for r in got}
    mean = sum(weight[r["cluster_id"]] * r["s"] for r in got)
    outer = sum(weight[r["cluster_id"]] ** 2 / r["m"] for r in got if counts[r["cluster_id"]] > points)
    return mean, (2 * math.log(2 / SILHOUETTE_MISS) * outer) ** 0.5 + sum(weight[r["cluster_id"]] * r["u"] for r in got)


def kmeans_metrics(model, scored: DataFrame, key: str) -> dict:
    """Inertia, the Euclidean silhouette with the bound on its error (0) and the squared Euclidean one, all over all rows."""
    sil = ClusteringEvaluator(featuresCol="features", predictionCol="cluster_id",
                              distanceMeasure="squaredEuclidean").evaluate(scored)
    mean, bound = silhouette(scored, len(model.clusterCenters()[0]), key)
    return {"inertia": inertia(model, scored), "silhouette": mean, "silhouette_bound": bound, "silhouette_sq_euclidean": float(sil)}


def cluster_summary(scored: DataFrame) -> DataFrame:
    return scored.groupBy("cluster_id").agg(
        F.avg("speed").alias("avg_speed"), F.avg("precip_mm").alias("avg_precipitation"),
        F.avg("visibility_m").alias("avg_visibility"), F.avg("is_congested").alias("congestion_share"),
        F.count(F.lit(1)).alias("rows"))


# --- metrics (SQL aggregates) ----------------------------------------------------
def regression_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    e = F.col(label) - F.col(pred)
    # r2 is undefined (null) for a constant label; ANSI mode would raise on x / 0.
    return df.agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
                  (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(label) * F.count(F.lit(1)))).alias("r2"))


def classification_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    y, p = F.col(label) == 1, F.col(pred) == 1
    tp, fp, fn = F.count_if(y & p), F.count_if(~y & p), F.count_if(y & ~p)
    base = df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"),
                  tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0))
    return base.select("accuracy", prec.cast("double").alias("precision"), rec.cast("double").alias("recall"),
                       f1.cast("double").alias("f1"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Tie-aware ROC AUC = sum over scores of pos(s) * (neg below s + neg(s) / 2) / (P * N).

    Scores are first reduced to (score, pos, neg) with a partial aggregate;
    the "negatives below" is a distributed prefix sum over those rows."""
    g = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    c = running_sum_before(g, "score", "neg")
    # undefined (null) when one class is absent
    return c.agg(F.try_divide(F.sum(F.col("pos") * (F.col("neg_before") + 0.5 * F.col("neg"))),
                              F.sum("pos") * F.sum("neg")).cast("double").alias("roc_auc"))


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Rows = actual class, columns = predicted 0 / 1 (explicit pivot values: one aggregate)."""
    return (df.groupBy(F.col(label).alias("actual")).pivot(pred, [0, 1]).agg(F.count(F.lit(1)))
            .fillna(0).withColumnRenamed("0", "pred_0").withColumnRenamed("1", "pred_1"))


def grid_map(scored: DataFrame, cluster_col: str = "predicted_cluster_id",
             pred_speed: str | None = "predicted_speed",
             pred_prob: str | None = "predicted_congestion_probability") -> DataFrame:
    """Per grid cell: actual/predicted averages and the dominant cluster
    (most frequent, ties -> smallest; -1 if none).

    The rows are aggregated once, by (cell, cluster), to sums and counts; averages and
    the mode of a cell are both finished from these few rows."""
    keys = ["lat_grid", "lng_grid"]
    means = {"actual_avg_speed": "speed", "actual_congestion_rate": "is_congested"}
    if pred_speed:
        means["predicted_avg_speed"] = pred_speed
    if pred_prob:
        means["predicted_congestion_rate"] = pred_prob
    parts = [e for out, c in means.items() for e in (F.sum(F.col(c).cast("double")).alias(f"_s_{out}"), F.count(c).alias(f"_n_{out}"))]
    cells = scored.groupBy(*keys, F.col(cluster_col).alias("_cluster")).agg(*parts, F.count(F.lit(1)).alias("_n"))
    best = F.max(F.when(F.col("_cluster").isNotNull(), F.struct(F.col("_n"), (-F.col("_cluster")).alias("_neg"))))
    return cells.groupBy(*keys).agg(
        *(F.try_divide(F.sum(f"_s_{out}"), F.sum(f"_n_{out}")).alias(out) for out in means), best.alias("_best")).select(
        *keys, *means, F.coalesce((-F.col("_best._neg")).cast("int"), F.lit(-1)).alias("dominant_cluster"))


def grid_center(grid: DataFrame) -> DataFrame:
    return grid.agg(F.avg("lat_grid").alias("center_lat"), F.avg("lng_grid").alias("center_lng"))
