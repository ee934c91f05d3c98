"""Sample connectivity by biweight midcorrelation. Long rows (feature_id, sample_id, value); complete ones need no sample-by-sample matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import keep
from .ranks import medians

#: Values of two blocks of samples that meet in one task when values are missing, and samples of a block at most.
CELLS, BLOCK = 4_000_000, 32
#: What was done, as the summary says it. Fixed values.
NOT_COMPUTED, ZERO_VARIANCE, COMPUTED = "not_computed", "correlation_pruned_full_wgcna_bicor_zero_variance", "correlation_pruned_full_wgcna_bicor"


def varying_features(long: DataFrame) -> DataFrame:
    """Rows of features that are not constant over samples."""
    kept = long.groupBy("feature_id").agg(F.stddev_samp("value").alias("sd")).where("sd > 0").select("feature_id")
    return long.join(kept, "feature_id", "left_semi")


def bicor_vectors(long: DataFrame) -> DataFrame:
    """long with z, the sample's biweight-normalised vector of unit length; Pearson's where the MAD is zero. Medians are selected by
    rank over all tasks, and what else a sample needs is a sum, so no task holds a sample."""
    middle = keep(medians(long, "sample_id", "value", "med").join(long.groupBy("sample_id").agg(F.avg("value").alias("mean")), "sample_id"), "medians")
    off = long.join(middle, "sample_id").withColumn("d", F.col("value") - F.col("med"))
    spread = keep(medians(off.select("sample_id", F.abs("d").alias("d")), "sample_id", "d", "mad"), "mads")
    u = F.try_divide(F.col("d"), 9 * F.col("mad"))
    weighted = F.when(F.col("mad") == 0, F.col("value") - F.col("mean")).otherwise(F.when(F.abs(u) < 1, F.col("d") * F.pow(1 - u * u, F.lit(2))).otherwise(0.0))
    rows = off.join(spread, "sample_id").select("feature_id", "sample_id", weighted.alias("w"))
    length = keep(rows.groupBy("sample_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length")), "lengths")
    return rows.join(length, "sample_id").select("feature_id", "sample_id", F.try_divide("w", "length").alias("z"))


def complete_connectivity(long: DataFrame) -> DataFrame:
    """sample_id, connectivity: the sum of (1 + bicor) / 2 with every other sample. With unit vectors z this is
    n/2 + z·(sum of all z)/2 - 1, so one aggregate by feature and one by sample do."""
    z = bicor_vectors(long)
    total = z.groupBy("feature_id").agg(F.sum("z").alias("total"))
    n = long.agg(F.count_distinct("sample_id").alias("n"))
    dots = z.join(total, "feature_id").groupBy("sample_id").agg(F.sum(F.col("z") * F.col("total")).alias("dot"))
    return dots.join(F.broadcast(n)).select("sample_id", (F.col("n") / 2 + F.col("dot") / 2 - 1).alias("connectivity"))


def biweight(x: np.ndarray) -> np.ndarray:
    """Columns as biweight-normalised vectors of unit length; Pearson's where the MAD is zero, not a number without variance."""
    d = x - np.median(x, 0)
    mad = np.median(np.abs(d), 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        u = d / (9 * mad)
        w = np.where(mad == 0, x - x.mean(0), d * (1 - u * u) ** 2 * (np.abs(u) < 1))
        return w / np.sqrt((w * w).sum(0))


def adjacency(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(1 + bicor) / 2 of each column of x with each of y, over the rows that both have; 0 where that is undefined."""
    seen_x, seen_y = ~np.isnan(x), ~np.isnan(y)
    out = np.empty((x.shape[1], y.shape[1]))
    whole = seen_x.all() and seen_y.all()
    if whole:
        out = biweight(x).T @ biweight(y) if len(x) else np.full(out.shape, np.nan)
    else:
        for i in range(x.shape[1]):
            for j in range(y.shape[1]):
                both = seen_x[:, i] & seen_y[:, j]
                pair = biweight(np.column_stack([x[both, i], y[both, j]])) if both.any() else np.full((1, 2), np.nan)
                out[i, j] = pair[:, 0] @ pair[:, 1]
    return np.where(np.isnan(out), 0, 0.5 + 0.5 * out)


def pairwise_connectivity(long: DataFrame, n_features: int) -> DataFrame:
    """As complete_connectivity(), where values are missing: each pair of samples is correlated over the features that both have, with
    medians of these, so pairs of blocks of samples meet, each with all features. Blocks are as large as CELLS allows."""
    size = max(1, min(BLOCK, CELLS // max(n_features, 1)))
    order = F.row_number().over(Window.orderBy("sample_id")) - 1  # a row a sample
    numbered = keep(long.select("sample_id").distinct().withColumn("number", order).withColumn("block", F.floor(F.col("number") / size).cast("int")), "samples")
    blocks = (numbered.agg(F.max("block")).first()[0] or 0) + 1
    rows = long.where("value is not null").join(numbered, "sample_id").select("feature_id", "number", "block", "value")
    other = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pairs = other.select(F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "feature_id", "number", "value")

    def correlate(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        a, b = (k.as_py() for k in key)
        feature = table.column("feature_id").combine_chunks().dictionary_encode().indices.to_numpy()
        number = table.column("number").to_numpy()
        columns, place = np.unique(number, return_inverse=True)
        values = np.full((int(feature.max()) + 1, len(columns)), np.nan)
        values[feature, place] = table.column("value").to_numpy()
        left, right = columns // size == a, columns // size == b
        found = adjacency(values[:, left], values[:, right])
        found[columns[left][:, None] == columns[right][None, :]] = 0
        sums = [(columns[left], found.sum(1))] + ([(columns[right], found.sum(0))] if a != b else [])
        return pa.table({"number": np.concatenate([s[0] for s in sums]).astype(np.int32), "part": np.concatenate([s[1] for s in sums])})

    parts = pairs.groupBy("a", "b").applyInArrow(correlate, "number int, part double").groupBy("number").agg(F.sum("part").alias("connectivity"))
    return numbered.join(parts, "number", "left").select("sample_id", F.coalesce("connectivity", F.lit(0.0)).alias("connectivity"))


def connectivity(long: DataFrame) -> DataFrame:
    """sample_id, connectivity: the sum of (1 + bicor) / 2 with every other sample, over the features that both have."""
    told = long.agg(F.count_distinct("feature_id").alias("features"), F.count_distinct("sample_id").alias("samples"), F.count("value").alias("values")).first()
    if told["values"] == told["features"] * told["samples"]:
        return complete_connectivity(long)
    return pairwise_connectivity(long, told["features"])


def outliers(scores: DataFrame, threshold: float = -3.0) -> DataFrame:
    """scores with zscore over samples and pass_connectivity_filter; everyone passes where no deviation is defined."""
    every = Window.partitionBy(F.lit(0))  # a row a sample
    sd = F.stddev_samp("connectivity").over(every)
    z = F.try_divide(F.col("connectivity") - F.avg("connectivity").over(every), F.when(sd > 0, sd))
    return scores.withColumn("zscore", z).withColumn("pass_connectivity_filter", ~F.coalesce(F.col("zscore") < threshold, F.lit(False)))


def score_samples(long: DataFrame, threshold: float = -3.0) -> DataFrame:
    """sample_id, connectivity, zscore, pass_connectivity_filter and method. Below two varying features or three samples nothing is
    computed, and everyone passes. To remove every sample is an error (and can't happen with a negative threshold)."""
    used = keep(varying_features(long), "varying")  # read by each of the steps below
    told = used.agg(F.count_distinct("feature_id").alias("features"), F.count_distinct("sample_id").alias("samples")).first()
    if told["features"] < 2 or told["samples"] < 3:
        none = F.lit(None).cast("double")
        return long.select("sample_id").distinct().select("sample_id", none.alias("connectivity"), none.alias("zscore"), F.lit(True).alias("pass_connectivity_filter"), F.lit(NOT_COMPUTED).alias("method"))
    scored = outliers(connectivity(used), threshold)
    defined = F.max(F.col("zscore").isNotNull()).over(Window.partitionBy(F.lit(0)))  # a row a sample
    return scored.withColumn("method", F.when(defined, COMPUTED).otherwise(ZERO_VARIANCE))


def summary(long: DataFrame, used: DataFrame, scored: DataFrame, threshold: float = -3.0) -> DataFrame:
    """One row: method, features before and after dropping constant ones, samples before, removed, retained and correlated."""
    features = long.agg(F.count_distinct("feature_id").alias("n_representative_cpgs")).join(F.broadcast(used.agg(F.count_distinct("feature_id").alias("n_representative_cpgs_used"))))
    n = F.count(F.lit(1))
    method = F.max("method") if "method" in scored.columns else F.when(F.count("zscore") > 0, COMPUTED).otherwise(ZERO_VARIANCE)
    samples = scored.agg(method.alias("method"), n.alias("n_samples_before"), F.count_if(~F.col("pass_connectivity_filter")).alias("n_samples_removed"), F.count_if("pass_connectivity_filter").alias("n_samples_retained"), n.alias("n_samples_in_full_correlation"))
    return features.join(F.broadcast(samples)).withColumn("z_threshold", F.lit(threshold))
