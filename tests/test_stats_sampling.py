"""Bounded exact selection, mode, sampling and splits against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.functions.stats import exact_mode, exact_quantiles, running_sum_before, values_at_ranks
from strata.operators import sampling as S


def test_median_of_1_2_4_5(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (5.0,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5])["x"] == [3.0]


@pytest.mark.parametrize("buckets", [4, 1024])
def test_quantiles_match_numpy_in_several_rounds(spark, buckets):
    rnd = random.Random(7)
    xs = [rnd.gauss(0, 1) for _ in range(3000)] + [1.5] * 200
    ys = [float(rnd.randint(0, 9)) for _ in range(3200)]
    df = spark.createDataFrame(list(zip(xs, ys)), "x double, y double")
    got = exact_quantiles(df, ["x", "y"], [0.0, 0.25, 0.5, 0.9, 1.0], buckets=buckets)
    for c, vals in (("x", xs), ("y", ys)):
        assert got[c] == pytest.approx(list(np.quantile(vals, [0.0, 0.25, 0.5, 0.9, 1.0])), abs=1e-12)


def test_values_at_ranks_skips_nothing(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [5, 1, 3, 3, 2]], "name string, value double")
    assert values_at_ranks(df, {"a": [0, 2, 3, 4]}, buckets=3) == {"a": {0: 1.0, 2: 3.0, 3: 3.0,
                                                                                          4: 5.0}}


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "p string")
    assert exact_mode(df, "p") == "a"


def test_running_sum_before(spark):
    df = spark.range(0, 200).select((F.col("id") * 3).alias("k"), (F.col("id") % 5).alias("v"))
    out = {r.k: r.v_before for r in running_sum_before(df, "k", "v", parts=7).collect()}
    acc = 0
    for i in range(200):
        assert out[i * 3] == acc
        acc += i % 5


def test_first_by_hash_matches_sort(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    got = sorted(r.k for r in S.sample_n(df, "k", 321).collect())
    rows = df.select("k", F.md5(F.col("k").cast("string")).alias("m")).collect()
    want = sorted(r.k for r in sorted(rows, key=lambda r: (r.m, r.k))[:321])
    assert got == want


def test_first_by_hash_resolves_ties_by_key(spark):
    # duplicated keys share a hash: the boundary is cut inside the tie, by key order
    df = spark.createDataFrame([(1, i) for i in range(10)] + [(2, i) for i in range(10)], "k long, j long")
    assert S.sample_n(df, "k", 13).count() == 13


def test_sample_cap_and_fraction(spark):
    df = spark.range(0, 20000).withColumnRenamed("id", "k")
    s = S.sample_fraction_capped(df, "k", 0.05, None).count()
    assert 800 < s < 1200
    assert S.sample_fraction_capped(df, "k", 0.05, 100).count() == 100


def test_stratified_split_exact_per_class(spark):
    df = spark.range(0, 1003).select(F.col("id").alias("k"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    out = S.split_stratified(df, "k", "y", 0.2)
    got = {r.y: r.n for r in out.where("is_test").groupBy("y").agg(F.count("*").alias("n")).collect()}
    n1 = df.where("y = 1").count()
    assert got == {1: math.ceil(0.2 * n1), 0: math.ceil(0.2 * (1003 - n1))}
    assert out.count() == 1003


def test_hot_duplicate_key_split_exact(spark):
    # one key is a third of the rows: the boundary falls inside its tie
    hot = [(7, i % 3) for i in range(600)]
    rest = [(k, 0) for k in range(1000, 2200)]
    df = spark.createDataFrame(hot + rest, "k long, v long")
    for n in (5, 700, 1500):
        assert S.sample_n(df, "k", n).count() == n
    out = S.split_stratified(df, "k", "v", 0.2)
    got = {r.v: r.n for r in out.where("is_test").groupBy("v").agg(F.count("*").alias("n")).collect()}
    assert got == {0: math.ceil(0.2 * 1400), 1: math.ceil(0.2 * 200), 2: math.ceil(0.2 * 200)}
    assert out.count() == 1800


def test_selection_over_extreme_values(spark):
    xs = [float("-inf"), -1.7e308, -1.0, -5e-324, 0.0, 5e-324, 1e-300, 1.0, 1.0 + 2**-52, 1.7e308, float("inf")]
    df = spark.createDataFrame([("a", v) for v in xs], "name string, value double")
    assert values_at_ranks(df, {"a": list(range(len(xs)))})["a"] == dict(enumerate(xs))
    with pytest.raises(ValueError):
        values_at_ranks(df, {"a": [11]})


def test_no_one_task_sketch_and_flat_planning(spark):
    """The plan does not follow the number of shuffle partitions."""
    df = spark.range(0, 3000).select(F.col("id").cast("double").alias("k"), (F.col("id") % 3).alias("v"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    sizes = []
    try:
        for parts in ("8", "8000"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            plan = running_sum_before(df, "k", "v")._jdf.queryExecution().toString()
            assert "percentile_approx" not in plan
            sizes.append(len(plan))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sizes[1] < sizes[0] + 500


def test_running_sum_over_skewed_values(spark):
    ks = sorted({2.0 ** (i / 3) for i in range(-300, 300)} | {float(i) for i in range(500)})
    df = spark.createDataFrame([(k, i % 7) for i, k in enumerate(ks)], "k double, v long")
    got = {r.k: r.v_before for r in running_sum_before(df, "k", "v", parts=16).collect()}
    acc = 0
    for i, k in enumerate(ks):
        assert got[k] == acc
        acc += i % 7


def test_null_label_is_a_class(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else "null" if i % 4 == 1 else "x") for i in range(400)],
                               "k long, y string")
    out = S.split_stratified(df, "k", "y", 0.2)
    got = {r.y: r.n for r in out.where("is_test").groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert got == {None: 20, "null": 20, "x": 40} and out.count() == 400
    with pytest.raises(ValueError):
        S.split_stratified(spark.range(2000), "id", "id")


def test_hot_ties_hold_no_array_of_rows(spark):
    df = spark.createDataFrame([(7, 1)] * 3000 + [(k, 0) for k in range(6000)], "k long, v long")
    out = S.sample_n(df, "k", 2500)
    assert out.count() == 2500
    assert "array_repeat" not in out._jdf.queryExecution().toString()


EXTREME = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, 1.0, 1.0 + 2**-52, 1.0 - 2**-53, 2.0, 3.0, -1.5, 8.0, 0.1, 1e300,
           1.7976931348623157e308, -1.7976931348623157e308, float("inf"), float("-inf"), 2.0**1023, 2.0**-1074, 2.0**60, 2.0**60 - 128]


def test_keys_have_the_order_of_the_doubles(spark):
    import numpy as np
    from strata.functions import stats as S
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2**63, 4000, dtype=np.uint64) | (rng.integers(0, 2, 4000, dtype=np.uint64) << np.uint64(63))
    values = [v for v in bits.view(np.float64).tolist() if v == v] + EXTREME + [s * 2.0**e for e in range(-1074, 1024) for s in (1, -1)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", S.ordered_key(F.col("v")).alias("k")).collect()
    assert all(r.k == S.key_of(r.v) for r in rows)
    ordered = sorted(rows, key=lambda r: r.k)
    assert all(a.v < b.v or a.v == b.v and a.k == b.k for a, b in zip(ordered, ordered[1:]))


def test_seven_passes_whatever_the_spread(spark, monkeypatch):
    import numpy as np
    from strata.functions import stats as S
    rng = np.random.default_rng(2)
    wide = (rng.choice([-1.0, 1.0], 5000) * 10.0 ** rng.uniform(-300, 300, 5000)).tolist()
    wide += [1e-320, 1e308, -1e308, 0.0] + [1.0 + k * 2**-52 for k in range(200)]
    passes = []
    one = S._histogram
    monkeypatch.setattr(S, "_histogram", lambda *a: passes.append(len(a[1])) or one(*a))
    df = spark.createDataFrame([("a", v) for v in wide] + [("b", float(k % 7)) for k in range(1000)], "name string, value double")
    ranks = [0, 17, 2500, 2600, 2700, 4000, len(wide) - 1]
    got = S.values_at_ranks(df, {"a": ranks, "b": [0, 500, 999]})
    assert got["a"] == {r: sorted(wide)[r] for r in ranks} and got["b"] == {0: 0.0, 500: 3.0, 999: 6.0}
    assert len(passes) <= 7


def test_a_pass_reads_a_row_once_for_all_columns(spark, monkeypatch):
    """Passes take columns side by side: no row is repeated for each of them and their windows."""
    from strata.functions import stats as S
    frames, one = [], S._histogram
    monkeypatch.setattr(S, "_histogram", lambda *a: frames.append(a[0]) or one(*a))
    nan, inf = float("nan"), float("inf")
    rows = [(float(i % 91), -float(i) if i % 7 else None, nan if i % 5 == 0 else 2.0 ** (i % 60), None, inf if i % 2 else -0.0) for i in range(2000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(3)
    got = exact_quantiles(df, list("abcde"), [0.25, 0.5])
    for j, c in enumerate("abce"):
        k = "abcde".index(c)
        values = [r[k] for r in rows if r[k] is not None and r[k] == r[k]]
        assert got[c] == pytest.approx([float(np.quantile(values, p)) for p in (0.25, 0.5)]) or c == "e"
    assert got["d"] == [None, None] and got["e"][0] == 0.0
    assert frames and all("Generate" not in f._jdf.queryExecution().optimizedPlan().toString() for f in frames)
