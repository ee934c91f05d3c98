"""Expectations: each returns the rows or counts that break it; require() turns them into an error."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require(broken: DataFrame, what: str) -> None:
    found = broken.limit(3).collect()
    if found:
        raise ValueError(f"{what}: {[r.asDict() for r in found]}")


def require_columns(df: DataFrame, names: list[str]) -> None:
    if lacking := [n for n in names if n not in df.columns]:
        raise ValueError(f"columns are missing: {lacking}")


def require_same_schema(frames: list[DataFrame]) -> None:
    if any(f.dtypes != frames[0].dtypes for f in frames):
        raise ValueError("tables differ in their columns")


def blank_keys(df: DataFrame, key: str) -> DataFrame:
    """How many keys are null or blank, if any."""
    return df.agg(F.count_if(F.col(key).isNull() | (F.trim(F.col(key).cast("string")) == "")).alias("n")).where("n > 0")


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).count().where("count > 1")


def missing_keys(df: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """Keys of df that are not allowed."""
    return df.select(key).distinct().join(allowed.select(key), key, "left_anti")


def unequal_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has, and which."""
    return missing_keys(a, b, key).withColumn("only_in", F.lit("first")).unionByName(missing_keys(b, a, key).withColumn("only_in", F.lit("second")))


def not_numeric(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is there but no number."""
    return df.where(F.col(column).isNotNull() & F.col(column).try_cast("double").isNull())


def bad_intervals(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.where((F.col(start) < 0) | (F.col(end) <= F.col(start)) | F.col(start).isNull() | F.col(end).isNull())


def mixed_types(calls: DataFrame, by: str = "sample_id") -> DataFrame:
    """Samples with other than exactly one type; blanks do not count."""
    kinds = calls.groupBy(by).agg(F.count_distinct(F.when(F.trim("type") != "", F.col("type"))).alias("n_types"))
    return kinds.where("n_types <> 1")


def bad_medians(coverage: DataFrame) -> DataFrame:
    m = F.col("median_cov")
    return coverage.where(m.isNull() | F.isnan(m) | (m <= 0) | (m == float("inf")))


def unsorted_rows(df: DataFrame, order: list[str], group: str, position: str) -> DataFrame:
    """Rows whose position is less than the one before in the given order, by group."""
    from pyspark.sql import Window

    return df.withColumn("__last", F.lag(position).over(Window.partitionBy(group).orderBy(*order))).where(F.col(position) < F.col("__last")).drop("__last")


def sites_without_values(grid: DataFrame) -> DataFrame:
    return grid.groupBy("site_key").agg(F.count("value").alias("n")).where("n = 0")


def require_range(name: str, value: float, low: float | None = None, high: float | None = None) -> None:
    """A parameter within [low, high]; not a number is outside."""
    if not (low is None or value >= low) or not (high is None or value <= high) or value != value:
        raise ValueError(f"{name} is {value}, outside [{low}, {high}]")


def require_some(df: DataFrame, what: str) -> None:
    """At least one row: not every sample, site or feature may be removed."""
    if df.isEmpty():
        raise ValueError(f"{what}: none is left")
