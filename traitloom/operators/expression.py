"""Gene counts: filters, library sizes, trimmed-mean factors, counts per million, transforms. Long rows (gene_id, sample_id, cnt)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import centred, normal_scores
from ..sources.shared import keep
from .ranks import central


def expressed_genes(counts: DataFrame, above: float = 6, fraction: float = 0.2) -> DataFrame:
    """Rows of genes that more than `above` counts in at least the fraction of samples have."""
    kept = counts.groupBy("gene_id").agg(F.avg((F.col("cnt") > above).cast("double")).alias("share")).where(F.col("share") >= fraction)
    return counts.join(kept.select("gene_id"), "gene_id", "left_semi")


def library_sizes(counts: DataFrame) -> DataFrame:
    return counts.groupBy("sample_id").agg(F.sum("cnt").cast("double").alias("lib_size"))


def tmm_factors(counts: DataFrame, trim_m: float = 0.3, trim_a: float = 0.05) -> DataFrame:
    """(sample_id, factor): trimmed mean of M values against the sample whose upper quartile is nearest the mean upper quartile,
    scaled to geometric mean 1. Samples are few; every step over genes is an aggregate, and ranks are selected over all tasks, so none holds a sample."""
    sizes = library_sizes(counts)
    rows = counts.join(F.broadcast(sizes), "sample_id")
    upper = rows.groupBy("sample_id").agg(F.expr("percentile(cnt / lib_size, 0.75)").alias("uq"))
    every = Window.partitionBy(F.lit(0))
    reference = upper.withColumn("off", F.abs(F.col("uq") - F.avg("uq").over(every))).agg(F.min_by("sample_id", F.struct("off", "sample_id")).alias("ref"))
    ref = rows.join(F.broadcast(reference), F.col("sample_id") == F.col("ref")).select("gene_id", F.col("cnt").alias("r"), F.col("lib_size").alias("nr"))
    pairs = rows.join(ref, "gene_id").where("cnt > 0 and r > 0").select("sample_id", "cnt", "r", "lib_size", "nr")
    share, ref_share = F.col("cnt") / F.col("lib_size"), F.col("r") / F.col("nr")
    pairs = pairs.withColumns(
        {
            "m": F.log2(share / ref_share), "a": F.log2(share * ref_share) / 2,
            "v": (F.col("lib_size") - F.col("cnt")) / F.col("lib_size") / F.col("cnt") + (F.col("nr") - F.col("r")) / F.col("nr") / F.col("r"),
        }
    )
    pairs = keep(pairs.select("sample_id", "m", "a", "v"), "pairs")
    ends = central(pairs, "sample_id", "m", trim_m).toDF("sample_id", "low_m", "high_m").join(central(pairs, "sample_id", "a", trim_a).toDF("sample_id", "low_a", "high_a"), "sample_id")
    ranked = pairs.join(F.broadcast(ends), "sample_id")
    inside = F.col("m").between(F.col("low_m"), F.col("high_m")) & F.col("a").between(F.col("low_a"), F.col("high_a"))
    mean = F.try_divide(F.sum(F.when(inside, F.col("m") / F.col("v"))), F.sum(F.when(inside, 1 / F.col("v"))))
    raw = ranked.groupBy("sample_id").agg(F.when(F.max(F.abs("m")) < 1e-6, 1.0).otherwise(F.coalesce(F.pow(F.lit(2.0), mean), F.lit(1.0))).alias("f"))
    raw = sizes.join(raw, "sample_id", "left").select("sample_id", F.coalesce("f", F.lit(1.0)).alias("f"))
    return raw.select("sample_id", (F.col("f") / F.exp(F.avg(F.ln("f")).over(every))).alias("factor"))


def cpm(counts: DataFrame, factors: DataFrame | None = None) -> DataFrame:
    """counts with cpm, by library size times factor (1 where not given)."""
    sizes = library_sizes(counts)
    sizes = sizes.join(factors, "sample_id") if factors is not None else sizes.withColumn("factor", F.lit(1.0))
    return counts.join(F.broadcast(sizes), "sample_id").withColumn("cpm", F.col("cnt") / (F.col("lib_size") * F.col("factor")) * 1e6).drop("lib_size", "factor")


def rank_normal(long: DataFrame, feature: str, value: str, offset: float = 0.375) -> DataFrame:
    """long with score, the feature's rank-based inverse-normal scores with Blom's offset; a null value is an error."""
    checked = long.withColumn(value, F.when(F.col(value).isNull(), F.raise_error(F.lit("a value is missing")).cast("double")).otherwise(F.col(value)))
    return checked.withColumn("score", normal_scores(value, feature, offset=offset))


def center_scale(long: DataFrame, feature: str, value: str) -> DataFrame:
    return long.withColumn("scaled", centred(F.col(value).cast("double"), Window.partitionBy(feature)))


def log_scale(long: DataFrame, feature: str, value: str) -> DataFrame:
    """log2(value + 1), centred and scaled by feature."""
    return long.withColumn("scaled", centred(F.log2(F.col(value) + 1), Window.partitionBy(feature)))


def locate(long: DataFrame, tss: DataFrame) -> DataFrame:
    """Rows of features that have a start site, with it."""
    return long.join(tss.select("gene_id", "chrom", "tss_start", "tss_end"), "gene_id")


def lost_features(long: DataFrame, located: DataFrame, feature: str = "gene_id") -> DataFrame:
    before = long.agg(F.count_distinct(feature).alias("n_before"))
    return before.join(F.broadcast(located.agg(F.count_distinct(feature).alias("n_after")))).withColumn("n_lost", F.col("n_before") - F.col("n_after"))
