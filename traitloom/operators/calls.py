"""Per-sample work on methylation calls: rows (sample_id, chrom, begin_pos, end_pos, mod_score, type, cov)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import finite
from .expect import require_range

AUTOSOMES = range(1, 23)


def filter_chroms(calls: DataFrame, pattern: str = "X|Y|M|_") -> DataFrame:
    """Without contigs that match; an empty pattern keeps all."""
    return calls.where(~F.col("chrom").rlike(pattern)) if pattern else calls


def keep_autosomes(calls: DataFrame, prefix: str = "chr") -> DataFrame:
    return calls.where(F.col("chrom").isin([f"{prefix}{n}" for n in AUTOSOMES]))


def sample_coverage(calls: DataFrame, fence_k: float = 3.0) -> DataFrame:
    """A row a sample: rows, median coverage, quartiles of log10 coverage over positive ones, and the upper fence as a coverage
    (infinite if no coverage is positive). Coverage has few distinct values, so exact percentiles stay small."""
    logs = F.when(F.col("cov") > 0, F.log10("cov"))
    stats = calls.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.expr("percentile(cov, 0.5)").alias("median_cov"), F.percentile(logs, F.array(F.lit(0.25), F.lit(0.75))).alias("q")
    )
    q25, q75 = F.get("q", F.lit(0)), F.get("q", F.lit(1))
    cutoff = F.coalesce(F.pow(F.lit(10.0), q75 + fence_k * (q75 - q25)), F.lit(float("inf")))
    return stats.select("sample_id", "n_rows", "median_cov", q25.alias("q25"), q75.alias("q75"), cutoff.alias("extreme_coverage_cutoff"))


def flag_calls(calls: DataFrame, coverage: DataFrame, min_coverage: float = 10) -> DataFrame:
    """calls with implied_cn, extreme_cov_flag, site_key, meets_min_coverage and per_sample_qc_pass."""
    joined = calls.join(F.broadcast(coverage.select("sample_id", "median_cov", "extreme_coverage_cutoff")), "sample_id")
    meets = F.coalesce(F.col("cov") >= min_coverage, F.lit(False))
    extreme = F.coalesce(F.col("cov") >= F.col("extreme_coverage_cutoff"), F.lit(False))
    return joined.select(
        *calls.columns, F.try_divide(2 * F.col("cov"), F.col("median_cov")).alias("implied_cn"),
        F.when(extreme, "extreme").otherwise("ok").alias("extreme_cov_flag"), F.concat_ws("*", "chrom", "begin_pos", "end_pos").alias("site_key"),
        meets.alias("meets_min_coverage"), (meets & ~extreme).alias("per_sample_qc_pass"),
    )


def sample_qc(raw: DataFrame, kept: DataFrame, flagged: DataFrame, coverage: DataFrame) -> DataFrame:
    """A row a sample: rows before and after the contig filter, type, median, fence, and counts of the flags."""
    before = raw.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_input_rows"))
    counts = flagged.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n_rows_after_chrom_filter"), F.min("type").alias("pb_cpg_type"),
        F.count_if(~F.col("meets_min_coverage")).alias("n_below_min_coverage"),
        F.count_if(F.col("extreme_cov_flag") == "extreme").alias("n_extreme_coverage"),
        F.count_if((F.col("extreme_cov_flag") == "extreme") & F.col("meets_min_coverage")).alias("n_extreme_coverage_after_min_coverage"),
        F.count_if("per_sample_qc_pass").alias("n_passing_per_sample_qc"),
    )
    joined = before.join(counts, "sample_id").join(coverage, "sample_id")
    return joined.select(
        "sample_id", "n_input_rows", "n_rows_after_chrom_filter", (F.col("n_input_rows") - F.col("n_rows_after_chrom_filter")).alias("n_removed_by_chrom_filter"),
        "pb_cpg_type", "median_cov", "extreme_coverage_cutoff", "n_below_min_coverage", "n_extreme_coverage", "n_extreme_coverage_after_min_coverage", "n_passing_per_sample_qc",
    )


def log_coverage_baseline(flagged: DataFrame, coverage: DataFrame, value_column: str = "mod_score", multiplier: float = 0.01) -> DataFrame:
    """flagged with value (the scaled column) and norm_log_cov, log1p coverage less that of the sample's median."""
    base = coverage.select("sample_id", F.log1p("median_cov").alias("__base"))
    value = finite(F.try_multiply(F.col(value_column).try_cast("double"), F.lit(multiplier)))
    return flagged.join(F.broadcast(base), "sample_id", "left").withColumns({"value": value, "norm_log_cov": F.log1p("cov") - F.col("__base")}).drop("__base")


def filter_sample_methylation(calls: DataFrame, pattern: str = "X|Y|M|_", min_coverage: float = 10, fence_k: float = 3.0) -> tuple[DataFrame, DataFrame]:
    """Flagged calls and the sample table of raw calls."""
    require_range("min_coverage", min_coverage, 0)
    require_range("fence_k", fence_k, 0)
    kept = filter_chroms(calls, pattern)
    coverage = sample_coverage(kept, fence_k)
    flagged = flag_calls(kept, coverage, min_coverage)
    return flagged, sample_qc(calls, kept, flagged, coverage)
