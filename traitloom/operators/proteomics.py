"""Protein levels: filters, plate normalisation, QC lists, first plates. Long NPX rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Names of control samples, and the two proteins that are left out.
CONTROLS = "CONTROL_SAMPLE|Control|CONT"
LEFT_OUT = ("P32455", "Q02750")


def assays_only(npx: DataFrame) -> DataFrame:
    return npx.where((F.col("AssayType") == "assay") & ~F.col("SampleID").rlike(CONTROLS))


def reference_medians(npx: DataFrame, plate: str) -> DataFrame:
    return npx.where((F.col("PlateID") == plate) & F.col("NPX").isNotNull()).groupBy("OlinkID").agg(F.median("NPX").alias("reference_median"))


def normalize_plates(npx: DataFrame, plate: str) -> DataFrame:
    """npx with Adj_factor, the reference plate's median less the own plate's by assay, and PCNormalizedNPX."""
    own = npx.groupBy("PlateID", "OlinkID").agg(F.median("NPX").alias("plate_median"))
    factors = own.join(reference_medians(npx, plate), "OlinkID", "left").select("PlateID", "OlinkID", (F.col("reference_median") - F.col("plate_median")).alias("Adj_factor"))
    return npx.join(factors, ["PlateID", "OlinkID"]).withColumn("PCNormalizedNPX", F.col("NPX") + F.col("Adj_factor"))


def not_passing(npx: DataFrame) -> DataFrame:
    return npx.where((F.col("SampleQC") != "PASS") | (F.col("AssayQC") != "PASS"))


def failed_assays(npx: DataFrame) -> DataFrame:
    return npx.where(F.col("AssayQC") != "PASS").select("Assay").distinct()


def removed_samples(npx: DataFrame) -> DataFrame:
    """Samples that fail on a row whose assay did not fail."""
    return npx.where(F.col("SampleQC") != "PASS").join(failed_assays(npx), "Assay", "left_anti").select("SampleID").distinct()


def strip_suffix(ident: Column) -> Column:
    return F.regexp_replace(ident, "_.*", "")


def without_proteins(npx: DataFrame, excluded: tuple[str, ...] = LEFT_OUT) -> DataFrame:
    return npx.where(~F.col("UniProt").isin(*excluded))


def first_plates(npx: DataFrame) -> DataFrame:
    """(SampleID, PlateID): the least plate of each sample."""
    order = Window.partitionBy("SampleID").orderBy("PlateID")
    return npx.select("SampleID", "PlateID").distinct().withColumn("n", F.row_number().over(order)).where("n = 1").drop("n")


def normalize(npx: DataFrame, plate: str, excluded: tuple[str, ...] = LEFT_OUT) -> DataFrame:
    """From raw NPX to QC-filtered normalised rows, one plate a sample, without samples that lack a value."""
    rows = normalize_plates(assays_only(npx), plate)
    rows = rows.join(removed_samples(rows), "SampleID", "left_anti").join(failed_assays(rows), "Assay", "left_anti")
    rows = rows.withColumn("SampleID", strip_suffix(F.col("SampleID")))
    rows = rows.join(first_plates(rows), ["SampleID", "PlateID"], "left_semi")
    lacking = rows.where(F.col("NPX").isNull()).select("SampleID").distinct()
    return without_proteins(rows.join(lacking, "SampleID", "left_anti"), excluded)


def choose_id_column(long: DataFrame, samples: DataFrame, candidates=("SampleID", "ResearchID")) -> str:
    """The candidate that more rows of the sample list stand in; the first of equals; an error if none does."""
    present = [c for c in candidates if c in long.columns]
    found = {c: long.join(samples.select(F.col("sample_id").alias(c)), c, "left_semi").count() for c in present}
    best = max(present, key=lambda c: (found[c], -present.index(c)))
    if not found[best]:
        raise ValueError(f"no sample of the list is in {present}")
    return best


def protein_features(long: DataFrame, mapping: DataFrame, tss: DataFrame, value: str = "PCNormalizedNPX") -> DataFrame:
    """Long rows of located protein-gene pairs, feature UniProt_gene; a protein of several genes becomes several."""
    located = mapping.join(tss.select("gene_id", "chrom", "tss_start", "tss_end"), "gene_id", "left").where("chrom is not null")
    feature = F.concat_ws("_", "UniProt", "gene_id").alias("feature_id")
    return long.join(located, "UniProt").select("chrom", "tss_start", "tss_end", feature, "SampleID", F.col(value).alias("value"))
