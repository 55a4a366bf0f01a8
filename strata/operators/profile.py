"""Profiles: counts, distincts, describe, null profile, schema.

All are single distributed aggregates; multi-column profiles unpivot to a
(name, value) long form with one narrow ``explode`` so one aggregate covers
every column.  Exact quantiles come from ``functions.stats.exact_quantiles``
(bounded memory), not from ``percentile`` (one buffer holding every distinct
value) or ``summary()`` (approximate).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.stats import exact_quantiles


def rows_by_source(df: DataFrame, col: str = "source") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("rows"))


def rows_by_city_top(df: DataFrame, n: int = 10, col: str = "city") -> DataFrame:
    """Top-n by count; ties broken by the name (deterministic)."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("rows"))
            .orderBy(F.desc("rows"), F.asc(col)).limit(n))


def silver_distincts(df: DataFrame) -> DataFrame:
    """Distinct owners, schema versions and batch ids (one row each), plus the batch count."""
    kinds = ("author_surname", "schema_v", "batch_id")
    pairs = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("value")) for c in kinds])
    distinct = df.select(F.explode(pairs).alias("p")).select("p.*").distinct()
    # the batch count is one more line of the same scan: each distinct batch also counts towards it
    doubled = distinct.select("kind", "value", F.explode(F.when(F.col("kind") == "batch_id", F.array(F.lit(0), F.lit(1)))
                                                         .otherwise(F.array(F.lit(0)))).alias("c"))
    total = F.col("c") == 1
    return doubled.groupBy(F.when(total, "n_batches").otherwise(F.col("kind")).alias("kind"),
                           F.when(~total, F.col("value")).alias("v")).agg(F.count(F.lit(1)).alias("n")).select(
        "kind", F.when(F.col("kind") == "n_batches", F.col("n").cast("string")).otherwise(F.col("v")).alias("value"))


def describe_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """pandas ``describe().T``: count, mean, std (n-1), min, 25/50/75 % (linear), max.

    Moments come from one aggregate; the quartiles from the exact bounded
    selection.  The result has one row per column (a handful of rows)."""
    spark = df.sparkSession
    agg = df.agg(*[e for c in cols for e in (
        F.count(F.when(~F.isnan(F.col(c).cast("double")), F.col(c))).alias(f"{c}__count"),
        F.avg(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))).alias(f"{c}__mean"),
        F.stddev_samp(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))).alias(f"{c}__std"),
        F.min(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))).alias(f"{c}__min"),
        F.max(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))).alias(f"{c}__max"))]).first()
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    rows = [(c, int(agg[f"{c}__count"]), agg[f"{c}__mean"], agg[f"{c}__std"], agg[f"{c}__min"],
             q[c][0], q[c][1], q[c][2], agg[f"{c}__max"]) for c in cols]
    return spark.createDataFrame(rows, "column string, count bigint, mean double, std double, min double, "
                                       "p25 double, p50 double, p75 double, max double")


def null_profile(df: DataFrame, top: int | None = 15) -> DataFrame:
    """Null count per column, descending (ties by name), top ``top``.  NaN counts
    as missing for floating columns, like pandas ``isna``."""
    float_cols = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull() | (F.isnan(f"`{c}`") if c in float_cols else F.lit(False)))
                      .alias(c) for c in df.columns])
    long = counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("null_count"))
                                             for c in df.columns])).alias("p")).select("p.*")
    ordered = long.orderBy(F.desc("null_count"), F.asc("column"))
    return ordered.limit(top) if top else ordered


def schema_profile(df: DataFrame) -> DataFrame:
    spark: SparkSession = df.sparkSession
    return spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(df.dtypes)],
                                 "position int, column string, dtype string")
