"""Validity rule sets, valid/rejected splits and row accounting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import rules as R
from ..functions.schemas import ABOVE, MOBILITY_COLUMNS, MOBILITY_VALIDITY, WEATHER_VALIDITY


def weather_rules(owner: str, as_of: Column | str | None = None, domain: str = "weather"):
    """Conditions of a silver weather row.  ``as_of`` replaces ``current_timestamp()``
    so a run is reproducible; ``None`` keeps the wall clock."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return [*audited(owner, domain, "silver"), R.equals("source", F.col("processed_source")),
            ("event_ts_not_future", F.col("event_ts") <= now)]


def audited(owner: str, domain: str, which: str):
    """What a weather row is held to at any time: required fields, ranges, owner and domain."""
    return [*R.from_table(WEATHER_VALIDITY, which), R.equals("author_surname", owner), R.equals("domain", domain)]


def source_gate(df: DataFrame, condition: Column, source: str = "processed_source") -> DataFrame:
    """Rows, valid rows and the write gate of each source: one without a valid row is skipped."""
    return (df.groupBy(F.col(source).alias("source"))
            .agg(F.count(F.lit(1)).alias("rows_total"), F.count_if(condition).alias("rows_valid"))
            .withColumn("skipped", F.col("rows_valid") == 0))


def rejected_domain(domain: str) -> str:
    return f"{domain}_rejected"


def split_by_validity(df: DataFrame, condition: Column, domain: str) -> DataFrame:
    """Every row with the ``domain`` and ``source`` of the folder it is to be written to.

    Rows that fail ``condition`` go to the rejected domain, under the source folder
    they were landed in; what they were found with is kept in ``found_domain`` and
    ``found_source``, which are null in valid rows."""
    valid = F.coalesce(condition, F.lit(False))
    return df.withColumn("__valid", valid).withColumns({
        **{f"found_{c}": F.when(~F.col("__valid"), F.col(c)) for c in ("domain", "source")},
        "domain": F.when(F.col("__valid"), domain).otherwise(rejected_domain(domain)),
        "source": F.col("processed_source")}).drop("__valid")


def valid_weather(df: DataFrame, owner: str, as_of=None) -> DataFrame:
    return df.filter(R.all_of(weather_rules(owner, as_of)))


def audit_rules(owner: str, domain: str = "weather"):
    """Re-validation of stored silver rows (no source equality, no future check)."""
    return audited(owner, domain, "audit")


def audit_silver(df: DataFrame, owner: str) -> DataFrame:
    ok = R.all_of(audit_rules(owner))
    return (df.agg(F.count_if(ok).alias("valid_rows"), F.count_if(~ok).alias("invalid_rows"))
            .withColumn("passed", (F.col("invalid_rows") == 0) & (F.col("valid_rows") > 0)))


def mobility_rules():
    """Conditions of a gold mobility row."""
    return R.from_table(MOBILITY_VALIDITY, "gold", ABOVE)


def mobility_condition() -> Column:
    return R.all_of(mobility_rules())


def valid_mobility(df: DataFrame) -> DataFrame:
    return df.filter(mobility_condition())


def rejected_mobility(df: DataFrame) -> DataFrame:
    """Complement of ``valid_mobility``: the condition is never NULL (every ranged
    column is null-checked), so valid + rejected = total."""
    return df.filter(~mobility_condition())


def modeling_rules():
    """Conditions of a modeling row; NaN counts as missing, like in pandas."""
    floats = [name for name, kind in MOBILITY_COLUMNS if kind == "double"]
    required = [name for name, _, _, sets in MOBILITY_VALIDITY if "modeling" in sets.split()]
    return R.from_table(MOBILITY_VALIDITY, "modeling", ABOVE) + R.not_nan(*(c for c in floats if c in required))


def valid_modeling(df: DataFrame) -> DataFrame:
    return df.filter(R.all_of(modeling_rules()))


def quality_counts(df: DataFrame, condition: Column) -> DataFrame:
    """Rows before / after / rejected in ONE pass (the reference counts twice)."""
    return (df.agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(condition).alias("rows_after"))
            .withColumn("rows_rejected", F.col("rows_before") - F.col("rows_after")))


def having_min_points(df: DataFrame, min_points: int = 20, col: str = "points_cnt") -> DataFrame:
    """Keep groups with strictly more than ``min_points`` points."""
    return df.filter(F.col(col) > min_points)


def cluster_input(df: DataFrame, features, label: str = "is_congested") -> DataFrame:
    cols = list(features) + [label]
    cond = R.all_of(R.not_null(*cols) + R.not_nan(*[c for c in features]))
    return df.filter(cond)
