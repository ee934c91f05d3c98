"""Cohort work on methylation calls: metrics and filters of sites, imputation, normal scores."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import average_rank, finite, inverse_normal
from ..sources.shared import dealt
from .expect import require_range, require_some

SITE = ["chrom", "begin_pos", "end_pos", "site_key"]
REASONS = ["Insufficient minimum coverage", "Extreme coverage exclusion", "Low methylation MAD", "Pass all cohort filters"]


def required_samples(n_samples: int, fraction: float = 0.95, minimum: int = 0) -> int:
    """Samples that a site needs; in doubles, so 100 * 0.07 rounds up to 8."""
    return max(math.ceil(float(n_samples) * float(fraction)), minimum)


def _spread(name: str, x: Column, scope: str) -> list[Column]:
    x = finite(x)
    mean, sd = F.avg(x), F.stddev_samp(x)
    return [mean.alias(f"mean_{name}_{scope}"), sd.alias(f"sd_{name}_{scope}"), F.try_divide(sd, F.when(mean != 0, mean)).alias(f"cv_{name}_{scope}")]


def _metric_rows(calls: DataFrame) -> DataFrame:
    """calls with __passing (the value of a passing call) and __off, its distance from the site's median."""
    rows = calls.withColumn("__passing", F.when(F.col("per_sample_qc_pass"), finite(F.col("value"))))
    return rows.withColumn("__off", F.abs(F.col("__passing") - F.median("__passing").over(Window.partitionBy(*SITE))))


def _metrics(n_samples: int) -> list[Column]:
    ok = F.col("per_sample_qc_pass")
    n, alike = F.lit(float(n_samples)), lambda c: F.when(ok, F.col(c))
    count, n_min, n_ok = F.count(F.lit(1)), F.count_if("meets_min_coverage"), F.count_if(ok)
    return [
        count.alias("n_samples_observed"), (count / n).alias("fraction_samples_observed"),
        *_spread("cov", F.col("cov"), "all_calls"), *_spread("methylation", F.col("value"), "all_calls"),
        n_min.alias("n_samples_min_coverage"), (n_min / n).alias("fraction_samples_min_coverage"),
        n_ok.alias("n_samples_passing_per_sample_qc"), (n_ok / n).alias("fraction_samples_passing_per_sample_qc"),
        *_spread("cov", alike("cov"), "passing_per_sample_qc"),
        F.median(alike("cov")).alias("median_cov_passing_per_sample_qc"), F.min(alike("cov")).alias("min_cov_passing_per_sample_qc"),
        F.max(alike("cov")).alias("max_cov_passing_per_sample_qc"), *_spread("methylation", alike("value"), "passing_per_sample_qc"),
        F.median("__off").alias("methylation_mad_passing_per_sample_qc"),
    ]


def _ranked_pairs(rows: DataFrame) -> DataFrame:
    """rows with __x, __y (value and normalised log coverage of passing calls that have both) and their average ranks by site."""
    x, y = finite(F.col("value")), finite(F.col("norm_log_cov"))
    both = F.col("per_sample_qc_pass") & x.isNotNull() & y.isNotNull()
    rows = rows.withColumns({"__x": F.when(both, x), "__y": F.when(both, y)})
    return rows.withColumns({"__rx": average_rank("__x", *SITE), "__ry": average_rank("__y", *SITE)})


def _correlation() -> list[Column]:
    n = F.count("__x")
    enough = (n >= 3) & (F.min("__x") < F.max("__x")) & (F.min("__y") < F.max("__y"))
    # corr() divides by a spread of zero, and aggregates are worked out whatever a condition around them says
    rho = F.try_divide(F.covar_pop("__rx", "__ry"), F.stddev_pop("__rx") * F.stddev_pop("__ry"))
    return [n.alias("n_samples_coverage_methylation_correlation"), F.when(enough, rho).alias("coverage_methylation_spearman_rho")]


def site_metrics(calls: DataFrame, n_samples: int) -> DataFrame:
    """One row a site from calls with value and flags: counts, fractions of the cohort, and spreads over all and over passing calls.

    One shuffle by site: the median that the MAD needs is a window over the same key as the aggregate.
    """
    return _metric_rows(calls).groupBy(*SITE).agg(*_metrics(n_samples))


def coverage_correlation(calls: DataFrame) -> DataFrame:
    """Spearman correlation of value and normalised log coverage by site over passing calls; null below three pairs or two values. Sites
    without a pair have no row."""
    rows = _ranked_pairs(calls.repartition(*SITE))
    return rows.groupBy(*SITE).agg(*_correlation()).where("n_samples_coverage_methylation_correlation > 0")


def site_table(calls: DataFrame, n_samples: int) -> DataFrame:
    """site_metrics() and coverage_correlation() of every site, and n_values, its finite values of passing calls: calls are dealt out by
    site once, and every window and aggregate stays there."""
    rows = _ranked_pairs(_metric_rows(dealt(calls, *SITE)))
    return rows.groupBy(*SITE).agg(*_metrics(n_samples), *_correlation(), F.count("__passing").alias("n_values"))


def flag_sites(metrics: DataFrame, n_samples: int, required: int, min_mad: float = 0.003) -> DataFrame:
    """metrics with the filters, keep_site and failure_reason."""
    m, k, mad = F.col("n_samples_min_coverage"), F.col("n_samples_passing_per_sample_qc"), F.col("methylation_mad_passing_per_sample_qc")
    flags = {
        "n_samples_required": F.lit(required), "pass_minimum_coverage_filter": m >= required, "pass_sample_presence_filter": k >= required,
        "pass_methylation_mad_filter": F.coalesce(mad >= min_mad, F.lit(False)), "has_missing_or_low_coverage": m < n_samples, "has_extreme_coverage_loss": k < m,
    }
    rows = metrics.withColumns(flags)
    reason = (
        F.when(~F.col("pass_minimum_coverage_filter"), REASONS[0]).when(~F.col("pass_sample_presence_filter"), REASONS[1])
        .when(~F.col("pass_methylation_mad_filter"), REASONS[2]).otherwise(REASONS[3])
    )
    return rows.withColumns({"keep_site": F.col("pass_sample_presence_filter") & F.col("pass_methylation_mad_filter"), "failure_reason": reason})


def passing_sites(sites: DataFrame) -> DataFrame:
    return sites.where("keep_site")


def select_samples(long: DataFrame, samples: DataFrame, key: str = "sample_id") -> DataFrame:
    """Rows of the listed samples; a list of which none is there is an error."""
    out = long.join(samples.select(F.col("sample_id").alias(key)).distinct(), key, "left_semi")
    require_some(out, "listed samples")
    return out


def site_qc(sites: DataFrame) -> DataFrame:
    short = {"n_samples_passing_per_sample_qc": "n_samples_passing", "fraction_samples_passing_per_sample_qc": "fraction_samples_passing"}
    short |= {f"{x}_cov_passing_per_sample_qc": f"{x}_cov_passing" for x in ("median", "min", "max")}
    return sites.select(*SITE, *[F.col(a).alias(b) for a, b in short.items()], "n_samples_required", "keep_site")


def cohort_summary(sites: DataFrame) -> DataFrame:
    """One row of site counts."""
    counts = ["pass_minimum_coverage_filter", "pass_sample_presence_filter", "pass_methylation_mad_filter", "has_missing_or_low_coverage", "has_extreme_coverage_loss", "keep_site"]
    return sites.agg(F.count(F.lit(1)).alias("n_sites"), *[F.count_if(c).alias(f"n_{c}") for c in counts])


def failure_summary(sites: DataFrame) -> DataFrame:
    """Sites by reason, reasons without a site included, in fixed order."""
    levels = sites.sparkSession.createDataFrame(list(enumerate(REASONS)), "turn int, failure_reason string")
    return levels.join(sites.groupBy("failure_reason").count(), "failure_reason", "left").select("turn", "failure_reason", F.coalesce("count", F.lit(0)).alias("n_sites"))


def failure_patterns(sites: DataFrame) -> DataFrame:
    """Sites by which of four failures they have: a four-bit code, and its labels."""
    tests = [("has_missing_or_low_coverage", False), ("has_extreme_coverage_loss", False), ("pass_sample_presence_filter", True), ("pass_methylation_mad_filter", True)]
    code, labels = F.lit(0), []
    for bit, (name, negate) in enumerate(tests):
        hit = ~F.col(name) if negate else F.col(name)
        code = code + F.when(hit, 1 << bit).otherwise(0)
        labels.append(F.when(F.col("code").bitwiseAND(F.lit(1 << bit)) != 0, F.lit(name)))
    return sites.groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("n_sites")).withColumn("labels", F.concat_ws(";", *labels))


def cohort_arrays(calls: DataFrame, sites: DataFrame, samples: list[str], digits: int | None = None) -> DataFrame:
    """Every kept site with values (a passing call's, or null, for each of samples in order), filled (missing ones at the site's mean; null
    throughout where there is none) and ranks of filled among the site's, ties averaged (of values rounded to digits).

    Calls are shuffled once, by site; a site is one row from there on, and grid, means and ranks are arrays within it.
    """
    number = {s: i for i, s in enumerate(samples)}
    n = len(samples)
    passing = calls.where(F.col("per_sample_qc_pass")).select("site_key", "sample_id", finite(F.col("value")).alias("value")).where("value is not null")
    lists = passing.groupBy("site_key").agg(F.collect_list("sample_id").alias("names"), F.collect_list("value").alias("found"))
    rows = sites.where("keep_site").select(*SITE).join(lists, "site_key", "left").select(*SITE, "names", "found")

    def fill(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            names, found = batch.column("names"), batch.column("found")
            length = pa.compute.fill_null(pa.compute.list_value_length(names), 0).to_numpy(zero_copy_only=False)
            known = names.flatten().dictionary_encode()
            place = np.array([number.get(x, -1) for x in known.dictionary.to_pylist()], np.int64)[known.indices.to_numpy()]
            row, values = np.repeat(np.arange(batch.num_rows), length), np.full((batch.num_rows, n), np.nan)
            inside = place >= 0
            values[row[inside], place[inside]] = found.flatten().to_numpy()[inside]
            seen = ~np.isnan(values)
            some = seen.sum(1)
            mean = np.divide(np.where(seen, values, 0).sum(1), some, out=np.full(len(some), np.nan), where=some > 0)
            filled = np.where(seen, values, mean[:, None])
            key = filled if digits is None else np.round(filled, digits)
            order = np.argsort(key, 1, kind="stable")
            lined = np.take_along_axis(key, order, 1)
            new = np.concatenate([np.ones((len(lined), 1), bool), lined[:, 1:] != lined[:, :-1]], 1)
            first = np.maximum.accumulate(np.where(new, np.arange(n), 0), 1)
            last = n - 1 - np.maximum.accumulate(np.where(np.concatenate([new[:, 1:], np.ones((len(new), 1), bool)], 1)[:, ::-1], np.arange(n), 0), 1)[:, ::-1]
            ranks = np.empty_like(filled)
            np.put_along_axis(ranks, order, (first + last) / 2 + 1, 1)
            ranks[some == 0] = np.nan
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * n)
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.ravel(), mask=np.isnan(x.ravel()))) for x in (values, filled, ranks)]
            yield pa.record_batch([*batch.columns[: len(SITE)], *lists], [*SITE, "values", "filled", "ranks"])

    types = dict(sites.dtypes)
    return rows.mapInArrow(fill, ", ".join(f"{c} {types[c]}" for c in SITE) + ", values array<double>, filled array<double>, ranks array<double>")


def cohort_long(arrays: DataFrame, samples: list[str]) -> DataFrame:
    """cohort_arrays() as rows of a site and a sample: observed, value (filled), imputed and score, the inverse-normal score by site."""
    cells = F.posexplode(F.arrays_zip(F.col("values").alias("observed"), F.col("filled").alias("value"), F.col("ranks").alias("rank")))
    rows = arrays.select(*SITE, cells.alias("i", "c"))
    name = F.get(F.array(*map(F.lit, samples)), F.col("i"))
    score = inverse_normal((F.col("c.rank") - 0.5) / float(len(samples)))
    return rows.select(*SITE, name.alias("sample_id"), F.col("c.observed").alias("observed"), F.col("c.value").alias("value"), F.col("c.observed").isNull().alias("imputed"), score.alias("score"))


def complete_grid(calls: DataFrame, sites: DataFrame, samples: list[str]) -> DataFrame:
    """Every kept site with every sample: value of a passing call, or null."""
    return cohort_long(cohort_arrays(calls, sites, samples), samples).select(*SITE, "sample_id", F.col("observed").alias("value"))


def imputed_counts(sites: DataFrame, n_samples: int) -> DataFrame:
    """sites (with n_values) with n_samples_imputed_in_qtl_bed: the samples without a value at kept sites, zero at others."""
    n = F.when(F.col("keep_site"), n_samples - F.col("n_values")).otherwise(F.lit(0).cast("long"))
    return sites.withColumn("n_samples_imputed_in_qtl_bed", n).drop("n_values")


def merge_cohort(calls: DataFrame, n_samples: int, fraction: float = 0.95, min_mad: float = 0.003) -> DataFrame:
    """Site metadata of calls with value and norm_log_cov, in one shuffle by site."""
    require_range("fraction", fraction, 0, 1)
    require_range("min_mad", min_mad, 0)
    return imputed_counts(flag_sites(site_table(calls, n_samples), n_samples, required_samples(n_samples, fraction), min_mad), n_samples)
