"""Composite dataflows, and queries of them and of the operators that only composites use."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stats import finite, inverse_normal_sql
from ..operators import calls as C
from ..operators import clusters as K
from ..operators import cohort as H
from ..operators import connectivity as N
from ..operators import covariates as V
from ..operators import expect as Q
from ..operators import expression as E
from ..operators import genotype as G
from ..operators import intervals as I
from ..operators import linalg as L
from ..operators import proteomics as P
from ..operators import splicing as S
from ..sources import readers as R
from ..sources import writers as W
from ..sources.shared import dealt, keep, scratch
from .queries import ANNOTATION_SQL, CHROMS, FENCE, FINE, FRACTION, MAD, MIN_COV, PLATE, SQL, STEPS, TSS_SQL, Data, _connectivity_steps, _residual_sql, _vectors, query, rank_sql, sql_of


BRANCHES = ("INT", "scaled", "raw")


def without_outliers(long: DataFrame, value: str, threshold: float = -3.0) -> DataFrame:
    """Rows of samples whose connectivity over the value passes."""
    rows = keep(long.select("feature_id", "sample_id", F.col(value).alias("value")), "values")
    kept = keep(N.score_samples(rows, threshold).where("pass_connectivity_filter").select("sample_id"), "retained")
    return long.join(kept, "sample_id", "left_semi")


def phenotype_branches(long: DataFrame, value: str, log2: bool = False, threshold: float = -3.0) -> DataFrame:
    """Long rows (feature_id, sample_id, value) to (branch, feature_id, sample_id, value): inverse-normal scores and centred, scaled
    values (of log2(value + 1) where asked), each without the samples that are outliers in it, and the raw values of all samples."""
    rows = keep(long.select("feature_id", "sample_id", F.col(value).cast("double").alias("value")), "phenotypes")
    spread = dealt(rows, "feature_id")
    scored = E.rank_normal(spread, "feature_id", "value").select("feature_id", "sample_id", F.col("score").alias("value"))
    scaled = (E.log_scale if log2 else E.center_scale)(spread, "feature_id", "value").select("feature_id", "sample_id", F.col("scaled").alias("value"))
    parts = [without_outliers(scored, "value", threshold), without_outliers(scaled, "value", threshold), rows]
    return reduce(DataFrame.unionByName, [p.select(F.lit(name).alias("branch"), "feature_id", "sample_id", "value") for name, p in zip(BRANCHES, parts, strict=True)])


def prepare_expression(counts: DataFrame, samples: DataFrame, tss: DataFrame, threshold: float = -3.0, digits: int | None = None) -> DataFrame:
    """Counts of the listed samples to located branches: genes expressed enough, trimmed-mean factors, counts per million, branches, and
    the genes that have a start site, in order of place. digits rounds the counts per million."""
    kept = keep(E.expressed_genes(H.select_samples(counts, samples)), "expressed")
    Q.require_some(kept, "expressed genes")
    rows = E.cpm(kept, keep(E.tmm_factors(kept), "factors"))
    rows = rows.withColumn("cpm", F.round("cpm", digits)) if digits is not None else rows
    branches = phenotype_branches(rows.withColumnRenamed("gene_id", "feature_id"), "cpm", True, threshold)
    located = keep(E.locate(branches.withColumnRenamed("feature_id", "gene_id"), tss), "located")  # a sort reads its rows twice
    return located.orderBy("branch", "chrom", "tss_start", "gene_id", "sample_id")


def prepare_splicing(long: DataFrame, threshold: float = -3.0) -> DataFrame:
    """Junction ratios (chrom, start_pos, end_pos, phenotype_id, sample_id, value) to branches with the Ensembl id, in order of place."""
    places = long.select("chrom", "start_pos", "end_pos", F.col("phenotype_id").alias("feature_id")).distinct()
    rows = phenotype_branches(long.withColumnRenamed("phenotype_id", "feature_id"), "value", False, threshold).join(places, "feature_id")
    out = rows.select("branch", "chrom", "start_pos", "end_pos", F.col("feature_id").alias("phenotype_id"), S.ensembl_id(F.col("feature_id")).alias("ensg"), "sample_id", "value")
    return out.orderBy("branch", "chrom", "start_pos", "end_pos", F.col("ensg").asc_nulls_last())


def prepare_proteomics(normalised: DataFrame, mapping: DataFrame, tss: DataFrame, samples: DataFrame, threshold: float = -3.0) -> DataFrame:
    """Normalised proteins of the listed samples to located branches, a row a branch, feature and sample. The id column that the list
    speaks of is chosen."""
    ident = P.choose_id_column(normalised, samples)
    rows = P.protein_features(H.select_samples(normalised, samples, ident).withColumn("SampleID", F.col(ident)), mapping, tss)
    places = rows.select("feature_id", "chrom", "tss_start", "tss_end").distinct()
    return phenotype_branches(rows.withColumnRenamed("SampleID", "sample_id"), "value", False, threshold).join(places, "feature_id")


def prepare_genotypes(calls: DataFrame, samples: DataFrame, names: list[str], least: int) -> DataFrame:
    """Autosomal variants with enough alternative alleles among the samples: counts, frequency and a column of dosages a sample."""
    kept = keep(G.allele_count_filter(G.autosomal(calls), samples, least), "variants")
    return G.allele_frequency(kept).join(G.dosage_matrix(kept, names), "variant_id")


def aggregate_chromosomes(parts: list[DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Site tables of chromosomes as one, its sites by reason and by pattern of failures."""
    Q.require_same_schema(parts)
    sites = reduce(DataFrame.unionByName, parts)
    return sites, H.failure_summary(sites), H.failure_patterns(sites)


def filter_by_connectivity(long: DataFrame, representatives: DataFrame, threshold: float = -3.0) -> DataFrame:
    """sample_id, connectivity, zscore, pass_connectivity_filter from the representatives (feature_id) of long values."""
    Q.require(Q.missing_keys(representatives, long, "feature_id"), "a representative has no values")
    rows = long.join(representatives.select("feature_id").distinct(), "feature_id", "left_semi")
    return N.score_samples(rows, threshold)


def phenotype_pcs(features: DataFrame, samples: list[str]) -> tuple[DataFrame, DataFrame]:
    """PCs of samples: as many as the hard threshold keeps (one at least), and all."""
    scores, n = L.chosen_components(features, len(samples))
    return L.pcs_frame(features, scores, samples, n), L.pcs_frame(features, scores, samples, scores.shape[1])


def write_phenotype_pcs(features: DataFrame, samples: list[str], prefix: str) -> tuple[str, str]:
    """Both tables of PCs as TSV: the chosen ones, and all beside them. Returns their paths."""
    paths = f"{prefix}_phenotype_PCs.tsv", f"{prefix}_phenotype_PCs.all.tsv"
    for table, path in zip(phenotype_pcs(features, samples), paths, strict=True):
        W.write_table(table.orderBy("ID").coalesce(1), path)  # a row a sample
    return paths


class Stages:
    """Results of named stages under one folder. A stage that was written whole is read and not made again, so a job that died goes on
    from the last one; what is read has no lineage."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.made = spark, folder.rstrip("/"), []

    def whole(self, name: str) -> bool:
        done = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}/_SUCCESS")
        return done.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(done)

    def __call__(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        path = f"{self.folder}/{name}"
        if not self.whole(name):
            make().write.mode("overwrite").parquet(path)
            self.made.append(name)
        return self.spark.read.parquet(path)


def _pc_frame(scores: DataFrame, samples: list[str]) -> DataFrame:
    """PCs of samples from their scores (site_key, sample_id, value)."""
    wide = scores.groupBy("site_key").pivot("sample_id", samples).agg(F.first("value"))
    return phenotype_pcs(wide.select(F.array(*[F.col(f"`{s}`") for s in samples]).alias("vec")), samples)[0]


def run_cohort(
    spark: SparkSession, folder: str, calls: DataFrame, genes: DataFrame, islands: DataFrame, ccres: DataFrame, features: DataFrame, covariates: DataFrame, *,
    pattern: str = "X|Y|M|_", min_coverage: float = 10, fence_k: float = 3.0, fraction: float = 0.95, min_mad: float = 0.003, window: int = 2000, annotated: bool = True,
    window_bp: int = 1000, min_abs: float = 0.95, threshold: float = -3.0, digits: int | None = None,
) -> dict[str, DataFrame]:
    """A cohort from raw calls to covariates, stage by stage: calls and sample QC, sites, scores, failure counts, annotations of
    passing sites, covariates of correlation (PCs and the given ones), clusters and representatives of residuals, connectivity
    of samples, what is left of calls and scores without outliers, their PCs, and the merged covariates. digits rounds values before ranks."""
    for name, value, low, high in (("min_coverage", min_coverage, 0, None), ("fraction", fraction, 0, 1), ("min_mad", min_mad, 0, None), ("min_abs", min_abs, 1e-12, 1), ("window_bp", window_bp, 1, None)):
        Q.require_range(name, value, low, high)
    stage = Stages(spark, folder)
    kept = C.filter_chroms(calls, pattern)
    coverage = stage("coverage", lambda: C.sample_coverage(kept, fence_k))
    flagged = stage("calls", lambda: C.log_coverage_baseline(C.flag_calls(kept, coverage, min_coverage), coverage))
    sample_qc = stage("sample_qc", lambda: C.sample_qc(calls, kept, flagged, coverage))
    samples = [r["sample_id"] for r in sample_qc.select("sample_id").orderBy("sample_id").collect()]  # a row a sample
    n = len(samples)
    sites = stage("sites", lambda: H.merge_cohort(flagged, n, fraction, min_mad))
    scores = stage("scores", lambda: H.cohort_long(H.cohort_arrays(flagged, sites, samples, digits), samples).select(*H.SITE, "sample_id", F.col("score").alias("value")))
    out = {"calls": flagged, "sites": sites, "failures": stage("failures", lambda: H.failure_summary(sites)), "patterns": stage("patterns", lambda: H.failure_patterns(sites))}
    passing = H.passing_sites(sites).select("site_key", "chrom", (F.col("begin_pos") + 1).alias("start_pos"), "end_pos", "n_samples_imputed_in_qtl_bed")
    out["annotations"] = stage("annotations", lambda: I.annotate(passing, genes, islands, ccres, features, window)) if annotated else passing
    first = stage("correlation_covariates", lambda: V.correlation_covariates(_pc_frame(scores, samples), covariates))
    table = first.toPandas().set_index("sample_id")  # a row a sample
    used, design = L.reconcile(samples, table)
    wide = scores.groupBy("chrom", F.col("begin_pos").alias("start_pos"), "end_pos", F.col("site_key").alias("feature_id")).pivot("sample_id", used).agg(F.first("value"))
    vectors = wide.select("chrom", "start_pos", "end_pos", "feature_id", F.array(*[F.col(f"`{s}`") for s in used]).alias("vec"))
    groups: list[DataFrame] = []

    def clustered() -> DataFrame:
        groups.extend(K.correlated_clusters(vectors, window_bp, min_abs, design))
        return groups[1]

    out["clusters"] = stage("clusters", clustered)
    out["representatives"] = stage("representatives", lambda: groups[2] if groups else K.correlated_clusters(vectors, window_bp, min_abs, design)[2])
    values = scores.select(F.col("site_key").alias("feature_id"), "sample_id", "value")
    scored = stage("connectivity", lambda: filter_by_connectivity(values, out["representatives"], threshold))
    out["sample_qc"] = stage("final_sample_qc", lambda: sample_qc.join(scored, "sample_id", "left"))
    left = scored.where("pass_connectivity_filter").select("sample_id")
    Q.require_some(left, "samples after the connectivity filter")
    retained = [r["sample_id"] for r in left.orderBy("sample_id").collect()]
    out["scores"] = stage("final_scores", lambda: scores.join(left, "sample_id", "left_semi"))
    out["calls"] = stage("final_calls", lambda: flagged.join(left, "sample_id", "left_semi"))
    out["pcs"] = stage("pcs", lambda: _pc_frame(out["scores"], retained))
    out["covariates"] = stage("covariates", lambda: V.merge_covariates(covariates, out["pcs"]))
    return out


def _names(n: int) -> list[str]:
    return [f"S{i:02d}" for i in range(n)]


def _representatives(d: Data) -> DataFrame:
    return keep(d.chosen, "representatives")


def _width(d: Data) -> int:
    return _vectors(d).select(F.size("vec").alias("n")).first()["n"]


def _genotype_pcs(d: Data) -> DataFrame:
    """Dosages with missing ones at the variant's mean, then principal components of samples."""
    rows = d.autosomal.select("variant_id", "sample_id", G.dosage().cast("double").alias("v"))
    names = _names(20)
    wide = rows.groupBy("variant_id").pivot("sample_id", names).agg(F.first("v"))
    vec = F.array(*names)
    known = F.filter(vec, lambda x: x.isNotNull())
    mean = F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(known), F.lit(0))
    features = wide.select(F.transform(vec, lambda x: F.coalesce(x, mean)).alias("vec")).where(~F.exists("vec", lambda x: x.isNull()))
    scores, _ = L.principal_components(features, len(names))
    return L.pcs_frame(features, scores, names, 3)


def _checked_columns(d: Data) -> DataFrame:
    names = ["sample_id", "chrom", "begin_pos", "cov"]
    Q.require_columns(d.calls, names)
    return d.calls.select(names)


def _same_schemas(d: Data) -> DataFrame:
    parts = [d.calls.where("sample_id < 'S05'"), d.calls.where("sample_id >= 'S05'")]
    Q.require_same_schema(parts)
    return parts[0].unionByName(parts[1]).groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"))


def _safe(x: str) -> list:
    """Statistics of finite values only: the deviation needs two, the variation a mean other than zero."""
    v = finite(F.col(x))
    mean, sd = F.avg(v), F.stddev_samp(v)
    return [mean.alias("mean"), sd.alias("sd"), F.try_divide(sd, F.when(mean != 0, mean)).alias("cv"), F.median(v).alias("median"), F.min(v).alias("low"), F.max(v).alias("high")]


query("Q01_required_columns", sql_of("SELECT sample_id, chrom, begin_pos, cov FROM calls", "calls"))(_checked_columns)
query("Q09_same_schema", sql_of("SELECT sample_id, count(*) AS n FROM calls GROUP BY 1", "calls"))(_same_schemas)
query("A04_safe_statistics", sql_of("SELECT sample_id, avg(v) AS mean, stddev_samp(v) AS sd, stddev_samp(v) / nullif(avg(v), 0) AS cv, median(v) AS median, min(v) AS low, max(v) AS high FROM (SELECT sample_id, CASE WHEN cov <= 40 THEN mod_score END AS v FROM calls) GROUP BY 1", "calls", doubles=("mean", "sd", "cv", "median", "low", "high")))(
    lambda d: d.calls.withColumn("v", F.when(F.col("cov") > 45, float("inf")).when(F.col("cov") > 40, float("nan")).otherwise(F.col("mod_score"))).groupBy("sample_id").agg(*_safe("v"))
)
query("P15_choose_id_column", sql_of("SELECT 'ResearchID' AS chosen", "npx"))(
    lambda d: d.spark.createDataFrame([(P.choose_id_column(d.npx.select(F.lit("none").alias("SampleID"), P.strip_suffix(F.col("SampleID")).alias("ResearchID")), d.npx.select(P.strip_suffix(F.col("SampleID")).alias("sample_id")).distinct()),)], "chosen string")
)
query("P23_feature_subset", sql_of("SELECT gene_id, kind FROM (SELECT *, CASE p % 3 WHEN 0 THEN 'exon' WHEN 1 THEN 'CDS' ELSE 'five_prime_utr' END AS kind FROM (SELECT *, end_pos - start_pos AS p FROM genes)) WHERE kind IN ('five_prime_utr', '5UTR', 'CDS')", "genes"))(
    lambda d: d.genes.withColumn("p", (F.col("end_pos") - F.col("start_pos")) % 3).withColumn("kind", F.when(F.col("p") == 0, "exon").when(F.col("p") == 1, "CDS").otherwise("five_prime_utr")).transform(lambda x: I.of_types(x.withColumn("type", F.col("kind")), ["five_prime_utr", "5UTR", "CDS"])).select("gene_id", "kind")
)
query("Q16_reference_plate", sql_of(f"SELECT PlateID, count(*) AS n FROM npx WHERE PlateID = '{PLATE}' GROUP BY 1", "npx"))(lambda d: d.npx.where(F.col("PlateID") == PLATE).groupBy("PlateID").agg(F.count(F.lit(1)).alias("n")))
query("J09_covariates_all_required", SQL["X12_correlation_covariates"])(lambda d: V.correlation_covariates(E.library_sizes(d.expressed).withColumnRenamed("sample_id", "ID"), d.covariates))
query("J10_sample_intersection", sql_of("SELECT DISTINCT sample_id FROM calls INTERSECT SELECT sample_id FROM covariates WHERE gpc1 > 4400", "calls", "covariates"))(lambda d: d.samples.intersect(d.covariates.where("gpc1 > 4400").select("sample_id")))
query("J18_representative_values", sql_of("SELECT m.feature_id, sample_idx, value, selection_type FROM matrix m JOIN chosen c ON c.feature_id = m.feature_id", "matrix", "chosen", doubles=("value",)))(lambda d: K.representative_values(d.matrix, _representatives(d)).select("feature_id", "sample_idx", "value", "selection_type"))
query("J19_sample_qc_connectivity", sql_of("SELECT s.sample_id, c.connectivity FROM (SELECT DISTINCT sample_idx AS sample_id FROM matrix UNION ALL SELECT 999) s LEFT JOIN conn c USING (sample_id)", "matrix", "conn", doubles=("connectivity",)))(
    lambda d: d.matrix.select(F.col("sample_idx").alias("sample_id")).distinct().unionByName(d.spark.range(999, 1000).select(F.col("id").cast("int").alias("sample_id"))).join(N.connectivity(d.sample_rows), "sample_id", "left")
)
query("J20_retained_samples", sql_of("SELECT feature_id, sample_idx AS sample_id, value FROM matrix WHERE sample_idx IN (SELECT sample_id FROM conn QUALIFY (connectivity - avg(connectivity) OVER ()) / stddev_samp(connectivity) OVER () >= -1.5)", "matrix", "conn", doubles=("value",)))(
    lambda d: without_outliers(d.sample_rows, "value", -1.5).select("feature_id", "sample_id", "value")
)
query("J21_zero_filled_levels", SQL["A08_filter_summary"])(lambda d: H.failure_summary(d.sites))
query("O03_sort_junctions", sql_of("SELECT gene_id, chrom, start_pos, end_pos FROM genes ORDER BY chrom, start_pos, end_pos, gene_id", "genes"))(lambda d: d.genes.select("gene_id", "chrom", "start_pos", "end_pos").orderBy("chrom", "start_pos", "end_pos", "gene_id"))
query("O05_top_per_group", sql_of("SELECT sample_id, site_key, cov FROM flagged QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY cov DESC, site_key) = 1", "flagged"))(
    lambda d: d.flagged.groupBy("sample_id").agg(F.min_by(F.struct("site_key", "cov"), F.struct(-F.col("cov"), "site_key")).alias("t")).select("sample_id", "t.site_key", "t.cov")
)
query("O07_first_or_only_plate", SQL["W07_first_plate"])(lambda d: P.first_plates(d.qced))
query("O15_sample_subset", sql_of("SELECT site_key, sample_id, value FROM longs WHERE sample_id IN ('S02', 'S04')", "longs", doubles=("value",)))(lambda d: H.select_samples(d.longs, d.samples.where(F.col("sample_id").isin("S02", "S04"))).select("site_key", "sample_id", "value"))
query("O17_cluster_ids", sql_of("SELECT chrom, cluster_id, cluster_start, representative_cpg FROM clusters", "clusters"))(lambda d: d.clusters.select("chrom", "cluster_id", "cluster_start", "representative_cpg"))
query("M03_ceil_min_max", sql_of("SELECT site_key, CAST(ceil(n_samples_min_coverage * 0.95e0) AS BIGINT) AS c, greatest(n_samples_min_coverage, 5) AS g, least(n_samples_min_coverage, 5) AS l FROM metrics", "metrics"))(
    lambda d: d.metrics.select("site_key", F.ceil(F.col("n_samples_min_coverage") * 0.95).alias("c"), F.greatest("n_samples_min_coverage", F.lit(5).cast("long")).alias("g"), F.least("n_samples_min_coverage", F.lit(5).cast("long")).alias("l"))
)
query("M05_regex_functions", sql_of("SELECT DISTINCT SampleID, regexp_matches(SampleID, '^N1') AS m, regexp_replace(SampleID, '[0-9]+', '#') AS r, regexp_extract(SampleID, '[0-9]+') AS e FROM npx", "npx"))(
    lambda d: d.npx.select("SampleID", F.col("SampleID").rlike("^N1").alias("m"), F.regexp_replace("SampleID", "^([^0-9]*)[0-9]+", "$1#").alias("r"), F.regexp_extract("SampleID", "[0-9]+", 0).alias("e")).distinct()
)
query("M08_bit_masks", SQL["A09_failure_patterns"])(lambda d: H.failure_patterns(d.sites))
query("M11_boolean_text", "SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true ELSE NULL END AS b FROM supplier")(
    lambda d: d.spark.read.parquet(f"{d.sf_dir}/supplier.parquet").select("s_suppkey", _boolean(F.element_at(F.array(F.lit("TRUE"), F.lit("F"), F.lit("true"), F.lit(None)), (F.col("s_suppkey") % 4 + 1).cast("int"))).alias("b"))
)


def _boolean(text):
    """TRUE, true, T and FALSE, false, F; null stays null; anything else is an error."""
    return (
        F.when(text.isNull(), None).when(text.isin("TRUE", "true", "T"), True).when(text.isin("FALSE", "false", "F"), False)
        .otherwise(F.raise_error(F.concat(F.lit("not a logical value: "), text)).cast("boolean"))
    )


query("L13_genotype_pcs")(_genotype_pcs)


def _branch_steps(name: str, source: str, log2: bool) -> str:
    """Steps of branches over a source (feature_id, sample_idx, value), and SQL of its rows (branch, feature_id, sample_id, value)."""
    spread = "log2(value + 1)" if log2 else "value"
    STEPS[f"{name}int"] = ([source], f"SELECT feature_id, sample_idx, {inverse_normal_sql('(r - 0.375e0) / (n + 0.25e0)')} AS value FROM (SELECT *, {rank_sql('value', 'feature_id')} AS r, count(*) OVER (PARTITION BY feature_id) AS n FROM {source})")
    STEPS[f"{name}scaled"] = ([source], f"SELECT feature_id, sample_idx, (v - avg(v) OVER f) / nullif(stddev_samp(v) OVER f, 0) AS value FROM (SELECT *, {spread} AS v FROM {source}) WINDOW f AS (PARTITION BY feature_id)")
    parts = []
    for branch in ("int", "scaled"):
        _connectivity_steps(f"{name}{branch}", f"{name}{branch}")
        out = f"SELECT sample_id FROM {name}{branch}conn QUALIFY (connectivity - avg(connectivity) OVER ()) / stddev_samp(connectivity) OVER () < {CUT}"
        parts.append(f"SELECT '{'INT' if branch == 'int' else branch}' AS branch, feature_id, sample_idx AS sample_id, value FROM {name}{branch} WHERE sample_idx NOT IN ({out})")
    STEPS[f"{name}branches"] = ([source, *(f"{name}{b}{c}" for b in ("int", "scaled") for c in ("", "conn"))], " UNION ALL ".join([*parts, f"SELECT 'raw', feature_id, sample_idx, value FROM {source}"]))
    return f"{name}branches"


#: Connectivity below which a sample is left out in the queries: ten samples never have a z of -3.
CUT = -1.5
STEPS["shares"] = (["expressed", "libs"], "SELECT e.*, lib_size, cnt / lib_size AS share FROM expressed e JOIN libs USING (sample_id)")
STEPS["upper"] = (["shares"], "SELECT sample_id, quantile_cont(share, 0.75) AS uq FROM shares GROUP BY 1")
STEPS["mvalues"] = (["shares", "upper"], """SELECT sample_id, gene_id, log2(x.share / r.share) AS m, log2(x.share * r.share) / 2 AS a, (x.lib_size - x.cnt) / x.lib_size / x.cnt + (r.lib_size - r.cnt) / r.lib_size / r.cnt AS v
  FROM shares x JOIN (SELECT gene_id, cnt, lib_size, share FROM shares WHERE sample_id = (SELECT sample_id FROM (SELECT sample_id, abs(uq - avg(uq) OVER ()) AS off FROM upper) ORDER BY off, sample_id LIMIT 1)) r USING (gene_id) WHERE x.cnt > 0 AND r.cnt > 0""")
STEPS["trimmed"] = (["mvalues", "libs"], f"""SELECT sample_id, coalesce(f, 1) AS f FROM libs LEFT JOIN (SELECT sample_id, CASE WHEN max(abs(m)) < 1e-6 THEN 1 ELSE pow(2, sum(m / v) FILTER (WHERE inside) / sum(1 / v) FILTER (WHERE inside)) END AS f
  FROM (SELECT *, rm BETWEEN floor(n * 0.3) + 1 AND n + 1 - (floor(n * 0.3) + 1) AND ra BETWEEN floor(n * 0.05) + 1 AND n + 1 - (floor(n * 0.05) + 1) AS inside
    FROM (SELECT *, {rank_sql('m', 'sample_id')} AS rm, {rank_sql('a', 'sample_id')} AS ra, count(*) OVER (PARTITION BY sample_id) AS n FROM mvalues)) GROUP BY 1) USING (sample_id)""")
STEPS["tmm"] = (["trimmed"], "SELECT sample_id, f / exp(avg(ln(f)) OVER ()) AS factor FROM trimmed")
SQL["A12_tmm_factors"] = sql_of("SELECT * FROM tmm", "tmm", doubles=("factor",))
STEPS["tcpm"] = (["expressed", "libs", "tmm"], "SELECT gene_id AS feature_id, sample_id AS sample_idx, round(cnt / (lib_size * factor) * 1e6, 6) AS value FROM expressed JOIN libs USING (sample_id) JOIN tmm USING (sample_id)")
query("X01_prepare_expression", sql_of(f"SELECT branch, gene_id, sample_id, value, chrom, tss_start, tss_end FROM (SELECT branch, feature_id AS gene_id, sample_id, value FROM xbranches) JOIN ({TSS_SQL}) USING (gene_id)", _branch_steps("x", "tcpm", True), "genes", doubles=("value",)))(
    lambda d: prepare_expression(d.counts, d.samples, I.gene_tss(d.genes), CUT, 6)
)
STEPS["junctions"] = (["longs"], "SELECT chrom, begin_pos AS start_pos, end_pos, concat(site_key, ':clu_1_', CASE WHEN begin_pos % 3 = 0 THEN concat('ENSG', begin_pos) ELSE 'none' END) AS phenotype_id, sample_id, round(value, 9) AS value FROM longs WHERE site_key IN (SELECT site_key FROM longs GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT sample_id) FROM longs))")
STEPS["jvalues"] = (["junctions"], "SELECT phenotype_id AS feature_id, sample_id AS sample_idx, value FROM junctions")
query("X02_prepare_splicing", sql_of("SELECT branch, chrom, start_pos, end_pos, feature_id AS phenotype_id, nullif(regexp_extract(feature_id, 'ENSG[0-9]+'), '') AS ensg, sample_id, value FROM jbranches JOIN (SELECT DISTINCT chrom, start_pos, end_pos, phenotype_id AS feature_id FROM junctions) USING (feature_id)", _branch_steps("j", "jvalues", False), "junctions", doubles=("value",)))(
    lambda d: prepare_splicing(_junctions(d), CUT)
)


def _junctions(d: Data) -> DataFrame:
    """Sites that every sample has, a third of them with a gene's id."""
    rows = keep(d.longs.select("chrom", F.col("begin_pos").alias("start_pos"), "end_pos", "site_key", "sample_id", F.round("value", 9).alias("value")), "longs")
    whole = rows.groupBy("site_key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == rows.select("sample_id").distinct().count()).select("site_key")
    name = F.concat("site_key", F.lit(":clu_1_"), F.when(F.col("start_pos") % 3 == 0, F.concat(F.lit("ENSG"), "start_pos")).otherwise("none"))
    return rows.join(whole, "site_key", "left_semi").withColumn("phenotype_id", name).drop("site_key")


MAPPING = "SELECT gene_id, concat('UP', substr(gene_id, 11)) AS UniProt FROM genes"
NORMAL = """SELECT * FROM qced JOIN (SELECT SampleID, min(PlateID) AS PlateID FROM qced GROUP BY 1) USING (SampleID, PlateID)
WHERE SampleID NOT IN (SELECT SampleID FROM qced JOIN (SELECT SampleID, min(PlateID) AS PlateID FROM qced GROUP BY 1) USING (SampleID, PlateID) WHERE NPX IS NULL)"""
STEPS["proteins"] = (["qced", "genes"], f"SELECT concat_ws('_', q.UniProt, m.gene_id) AS feature_id, q.SampleID AS sample_idx, round(q.PCNormalizedNPX, 9) AS value, chrom, tss_start, tss_end FROM ({NORMAL}) q JOIN ({MAPPING}) m USING (UniProt) JOIN ({TSS_SQL}) t ON t.gene_id = m.gene_id")


def _proteomics(d: Data) -> DataFrame:
    npx, genes = d.npx, d.genes
    rows = keep(P.normalize(npx, PLATE), "normalised")
    mapping = genes.select("gene_id", F.concat(F.lit("UP"), F.substring("gene_id", 11, 9)).alias("UniProt"))
    return prepare_proteomics(rows.withColumn("PCNormalizedNPX", F.round("PCNormalizedNPX", 9)), mapping, I.gene_tss(genes), rows.select(F.col("SampleID").alias("sample_id")).distinct(), CUT)


query("X04_prepare_proteomics", sql_of("SELECT branch, feature_id, sample_id, value, chrom, tss_start, tss_end FROM pbranches JOIN (SELECT DISTINCT feature_id, chrom, tss_start, tss_end FROM proteins) USING (feature_id)", _branch_steps("p", "proteins", False), "proteins", doubles=("value",), digits=FINE), digits=FINE)(
    _proteomics
)
query("X07_aggregate_chromosomes", sql_of("SELECT site_key, failure_reason, count(*) OVER (PARTITION BY failure_reason) AS n_of_reason, count(*) OVER (PARTITION BY has_missing_or_low_coverage, has_extreme_coverage_loss, pass_sample_presence_filter, pass_methylation_mad_filter) AS n_of_pattern FROM sites", "sites"))(
    lambda d: _aggregated(d)
)


def _aggregated(d: Data) -> DataFrame:
    """Every chromosome's sites, kept apart and put together, each beside the counts of its reason and of its pattern of failures."""
    whole = keep(d.sites, "sites")
    parts = [whole.where(F.col("chrom") == r["chrom"]) for r in whole.select("chrom").distinct().collect()]  # a row a chromosome
    sites, reasons, patterns = aggregate_chromosomes(parts)
    bits = [F.col("has_missing_or_low_coverage"), F.col("has_extreme_coverage_loss"), ~F.col("pass_sample_presence_filter"), ~F.col("pass_methylation_mad_filter")]
    rows = sites.withColumn("code", sum((b.cast("int") * (1 << i) for i, b in enumerate(bits)), F.lit(0)))
    rows = rows.join(reasons.select("failure_reason", F.col("n_sites").alias("n_of_reason")), "failure_reason").join(patterns.select("code", F.col("n_sites").alias("n_of_pattern")), "code")
    return rows.select("site_key", "failure_reason", "n_of_reason", "n_of_pattern")

query("X10_filter_by_connectivity", sql_of("SELECT sample_id, connectivity, (connectivity - avg(connectivity) OVER ()) / stddev_samp(connectivity) OVER () AS zscore, NOT (zscore < -1.5) AS pass_connectivity_filter, 'correlation_pruned_full_wgcna_bicor' AS method FROM repconn", "repconn", doubles=("connectivity", "zscore")))(
    lambda d: filter_by_connectivity(d.sample_rows, _representatives(d), -1.5)
)
query("X11_phenotype_pcs")(lambda d: phenotype_pcs(_vectors(d), _names(_width(d)))[0])


def residualize_files(spark: SparkSession, bed: str, covariates: str | None, out: str) -> None:
    """A wide BED less its fit on the covariates (covariate-major TSV; none: not fitted), rows scaled, written as a wide BED of the
    samples that have complete covariates. Text that is no number is an error in the BED and a level of a factor in the covariates."""
    wide = R.tsv(spark, bed)
    if len(wide.columns) < 5:
        raise ValueError(f"{bed}: four columns of place and a sample are needed")
    place, samples = wide.columns[:4], wide.columns[4:]
    design = None
    if covariates:
        table = R.tsv(spark, covariates).toPandas()  # a row a covariate, a column a sample
        names, values = V.unique_names(list(table.iloc[:, 0])), table.iloc[:, 1:].T
        samples, design = L.reconcile(samples, values.set_axis(names, axis=1).mask(values.isin(R.MISSING).to_numpy()))
    number = lambda s: F.when(~F.col(f"`{s}`").isin(*R.MISSING), F.col(f"`{s}`")).cast("double")
    rows = wide.select(*[F.col(f"`{c}`") for c in place], F.array(*map(number, samples)).alias("vec"))
    rows = L.scale_rows(L.residualize(rows, design) if design is not None else rows)
    W.write_table(rows.select(*[F.col(f"`{c}`") for c in place], *[F.get("vec", F.lit(i)).alias(s) for i, s in enumerate(samples)]), out)


def _residual_files(d: Data) -> DataFrame:
    """A BED of 64 samples and covariates that lack one of them and a value of another."""
    names = [f"S{i + 1:02d}" for i in range(_width(d))]
    bed, table, out = (scratch(d.spark, x) for x in ("bed", "covariates", "residuals"))
    W.write_table(_vectors(d).select(F.col("chrom").alias("#chr"), F.col("start_pos").alias("start"), (F.col("start_pos") + 1).alias("end"), F.col("feature_id").cast("string").alias("phenotype_id"), *[F.get("vec", F.lit(i)).alias(n) for i, n in enumerate(names)]), bed)
    values = {"a cov": [i % 7 for i in range(len(names) - 1)], "b": [i**0.5 for i in range(len(names) - 1)]}
    values["b"][4] = None
    W.write_table(d.spark.createDataFrame([(k, *[None if x is None else repr(float(x)) for x in v]) for k, v in values.items()], "ID string, " + ", ".join(f"{n} string" for n in names[:-1])).coalesce(1), table)
    residualize_files(d.spark, bed, table, out)
    return R.scan_phenotype_bed(d.spark, out).select(F.col("phenotype_id").cast("long").alias("feature_id"), "sample_id", "value")


RESIDUAL_VALUES = "SELECT * FROM matrix WHERE sample_idx <> 5 AND sample_idx < (SELECT max(sample_idx) FROM matrix)"
query("X13_residualize", sql_of(f"SELECT feature_id, concat('S', lpad(CAST(sample_idx AS VARCHAR), 2, '0')) AS sample_id, (c - avg(c) OVER f) / nullif(stddev_samp(c) OVER f, 0) AS value FROM ({_residual_sql(f'({RESIDUAL_VALUES})')}) WINDOW f AS (PARTITION BY feature_id)", "matrix", doubles=("value",)))(_residual_files)
STEPS["scored"] = (["filled"], f"SELECT site_key, sample_id, {inverse_normal_sql('(r - 0.5e0) / n')} AS score FROM (SELECT *, {rank_sql('round(value, 9)', 'site_key')} AS r, count(*) OVER (PARTITION BY site_key) AS n FROM filled)")
STEPS["annotated"] = (["spots", "tss", "promoters", "gene_parts", "islands", "ccres"], ANNOTATION_SQL)
#: What of the annotation stands beside each score.
BESIDE = "nearest_tss_distance, nearest_tss_gene_id, genomic_context, gene_feature_context, cpg_island_context, n_overlapping_ccres"
query("X15_cohort_driver", sql_of(f"SELECT s.site_key, sample_id, score, {BESIDE}, n_samples_imputed_in_qtl_bed, 'Pass all cohort filters' AS failure_reason FROM scored s JOIN annotated USING (site_key) JOIN (SELECT site_key, count(*) FILTER (WHERE imputed) AS n_samples_imputed_in_qtl_bed FROM filled GROUP BY 1) USING (site_key)", "scored", "annotated", "filled", doubles=("score",)))(
    lambda d: _cohort(d)
)


def _cohort(d: Data) -> DataFrame:
    """Scores of the samples that are left (of ten all, as none can have a z of -3), with their sites' annotations and reasons."""
    found = run_cohort(
        d.spark, scratch(d.spark, "cohort"), d.calls, d.genes, d.islands, d.ccres, d.gene_parts, d.covariates, pattern=CHROMS, min_coverage=MIN_COV, fence_k=FENCE, fraction=FRACTION, min_mad=MAD, min_abs=0.8, digits=9
    )
    reasons = found["sites"].select("site_key", "failure_reason")
    rows = found["scores"].select("site_key", "sample_id", F.col("value").alias("score")).join(found["annotations"].select("site_key", *BESIDE.split(", "), "n_samples_imputed_in_qtl_bed"), "site_key")
    return rows.join(reasons, "site_key").join(found["sample_qc"].where("pass_connectivity_filter").select("sample_id"), "sample_id", "left_semi")


VARIANTS = "SELECT * FROM dosed WHERE sample_id < 'S15'"
query("X14_prepare_genotypes", sql_of(f"SELECT variant_id, CAST(sum(length(gt) - length(replace(gt, '1', ''))) AS BIGINT) AS alt_alleles, CAST(sum(2 - (length(gt) - length(replace(gt, '.', '')))) AS BIGINT) AS called_alleles, alt_alleles / nullif(called_alleles, 0) AS frequency, " + ", ".join(f"CAST(max(CASE WHEN sample_id = 'S{i:02d}' THEN dosage END) AS INT) AS S{i:02d}" for i in range(15)) + f" FROM ({VARIANTS}) GROUP BY 1 HAVING alt_alleles >= 2", "dosed", doubles=("frequency",)))(
    lambda d: prepare_genotypes(d.genotypes, d.genotypes.select("sample_id").where("sample_id < 'S15'").distinct(), _names(15), 2)
)


def _pcs_written(d: Data) -> DataFrame:
    """Rows (kind, ID, pc, value) of both tables, read back from their files."""
    out = []
    for kind, path in zip(("chosen", "all"), write_phenotype_pcs(_vectors(d), _names(_width(d)), scratch(d.spark, "pcs")), strict=True):
        wide = R.tsv(d.spark, path)
        out.append(wide.unpivot(["ID"], wide.columns[1:], "pc", "text").select(F.lit(kind).alias("kind"), "ID", "pc", F.col("text").cast("double").alias("value")))
    return reduce(DataFrame.unionByName, out)


query("K05_write_pcs")(_pcs_written)
