"""Covariate tables: joins and the covariate-major matrix."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_covariates(covariates: DataFrame, pcs: DataFrame) -> DataFrame:
    """Covariates (sample_id, …) of samples that have PCs (ID, …), with them; without repeated rows."""
    return covariates.join(pcs.withColumnRenamed("ID", "sample_id"), "sample_id").distinct()


def correlation_covariates(pcs: DataFrame, covariates: DataFrame) -> DataFrame:
    """PCs with the covariates of the same samples; every PC sample must have them, and names must not meet."""
    both = (set(pcs.columns) - {"ID"}) & (set(covariates.columns) - {"sample_id"})
    if both:
        raise ValueError(f"covariates come twice: {sorted(both)}")
    lacking = pcs.select(F.col("ID").alias("sample_id")).join(covariates, "sample_id", "left_anti").limit(1).collect()
    if lacking:
        raise ValueError(f"no covariates for sample {lacking[0][0]}")
    return pcs.withColumnRenamed("ID", "sample_id").join(covariates, "sample_id")


def to_long(table: DataFrame, key: str = "sample_id") -> DataFrame:
    """Sample-major to (covariate, sample, value)."""
    values = [c for c in table.columns if c != key]
    wide = table.select(key, *[F.col(c).cast("double").alias(c) for c in values])
    return wide.unpivot([key], values, "ID", "value")


def covariate_matrix(table: DataFrame, samples: list[str], key: str = "sample_id") -> DataFrame:
    """Covariates as rows (ID), samples as columns in the given order."""
    return to_long(table, key).groupBy("ID").pivot(key, samples).agg(F.first("value"))


def unique_names(names: list[str]) -> list[str]:
    """Covariate names as syntactic and unique ones: other characters become dots, a leading digit gets an X, repeats a number."""
    clean = [re.sub(r"[^A-Za-z0-9._]", ".", n) for n in names]
    clean = [n if re.match(r"[A-Za-z]|\.(?![0-9])", n) else f"X{n}" for n in clean]
    taken, out = set(clean), []
    for i, n in enumerate(clean):
        new, k = n, 0
        while n in clean[:i] and (new in taken or new == n):
            k += 1
            new = f"{n}.{k}"
        taken.add(new)
        out.append(new)
    return out
