"""Genotypes: long rows (chrom, pos, ref, alt, sample_id, gt)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .calls import AUTOSOMES

LONGEST_ALLELE = 50


def variant_id() -> Column:
    return F.concat(F.col("chrom"), F.lit(":"), F.col("pos"), F.lit("_"), F.col("ref"), F.lit("_"), F.col("alt"))


def autosomal(genotypes: DataFrame, longest: int | None = LONGEST_ALLELE) -> DataFrame:
    """Autosomal variants with their id; an allele longer than `longest` is an error, or with None allowed."""
    kept = genotypes.where(F.regexp_replace("chrom", "^chr", "").isin([str(n) for n in AUTOSOMES]))
    named = F.when(F.col("chrom").startswith("chr"), F.col("chrom")).otherwise(F.concat(F.lit("chr"), "chrom"))
    out = kept.withColumn("chrom", named).withColumn("variant_id", variant_id())
    if longest is None:
        return out
    fits = F.greatest(F.length("ref"), F.length("alt")) <= longest
    return out.withColumn("variant_id", F.when(fits, F.col("variant_id")).otherwise(F.raise_error(F.lit("an allele is too long"))))


def _alleles() -> Column:
    return F.split("gt", "[/|]")


def dosage() -> Column:
    """Alternative alleles of gt; null if an allele is missing."""
    called = ~F.exists(_alleles(), lambda a: a == ".")
    return F.when(called, F.size(F.filter(_alleles(), lambda a: a != "0")))


def allele_frequency(genotypes: DataFrame) -> DataFrame:
    """By variant: alternative and called alleles, and their ratio (null without calls)."""
    alt = F.sum(F.size(F.filter(_alleles(), lambda a: ~a.isin("0", "."))))
    called = F.sum(F.size(F.filter(_alleles(), lambda a: a != ".")))
    counts = genotypes.groupBy("variant_id").agg(alt.alias("alt_alleles"), called.alias("called_alleles"))
    return counts.withColumn("frequency", F.try_divide(F.col("alt_alleles"), F.col("called_alleles")))


def allele_count_filter(genotypes: DataFrame, samples: DataFrame, least: int) -> DataFrame:
    """Genotypes of the listed samples, of variants with at least so many alternative alleles among them."""
    kept = genotypes.join(samples, "sample_id", "left_semi")
    common = allele_frequency(kept).where(F.col("alt_alleles") >= least).select("variant_id")
    return kept.join(common, "variant_id", "left_semi")


def dosage_matrix(genotypes: DataFrame, samples: list[str]) -> DataFrame:
    return genotypes.withColumn("dosage", dosage()).groupBy("variant_id").pivot("sample_id", samples).agg(F.first("dosage"))
