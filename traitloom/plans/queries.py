"""One query for each operator of the inventory over the fixture views, with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.stats import average_rank, centred, finite, inverse_normal, inverse_normal_sql, normal_scores
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
from ..operators import ordered
from ..operators import proteomics as P
from ..sources.shared import keep
from . import fixtures

#: Digits that results are rounded to; FINE where short decimals would meet ties at the sixth.
DIGITS, FINE = 6, 10
CHROMS, FENCE, MIN_COV, FRACTION, MAD = "X|Y|M|_|22", 0.1, 10.0, 0.6, 0.003
N_SAMPLES = 10
SAMPLES = [f"S{i:02d}" for i in range(N_SAMPLES)]
PAIR_BP, PAIR_R = 1000, 0.2
PLATE = "PLATE0"

#: Views that aggregate the largest table: written when first asked for, as most queries read them several times.
WRITTEN = ("calls", "counts", "npx")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Steps of the oracle, each a table of the SQL that follows it.
STEPS = {
    "kept": (["calls"], f"SELECT * FROM calls WHERE NOT regexp_matches(chrom, '{CHROMS}')"),
    "coverage0": (["kept"], "SELECT sample_id, count(*) AS n_rows, quantile_cont(cov, 0.5) AS median_cov, quantile_cont(log10(cov), 0.25) FILTER (WHERE cov > 0) AS q25, quantile_cont(log10(cov), 0.75) FILTER (WHERE cov > 0) AS q75 FROM kept GROUP BY 1"),
    "coverage": (["coverage0"], f"SELECT *, coalesce(pow(10e0, q75 + {FENCE}e0 * (q75 - q25)), CAST('inf' AS DOUBLE)) AS extreme_coverage_cutoff FROM coverage0"),
    "flagged": (["kept", "coverage"], f"""SELECT k.*, 2 * k.cov / c.median_cov AS implied_cn, CASE WHEN k.cov >= c.extreme_coverage_cutoff THEN 'extreme' ELSE 'ok' END AS extreme_cov_flag,
  concat_ws('*', chrom, begin_pos, end_pos) AS site_key, coalesce(k.cov >= {MIN_COV}, false) AS meets_min_coverage,
  coalesce(k.cov >= {MIN_COV}, false) AND NOT coalesce(k.cov >= c.extreme_coverage_cutoff, false) AS per_sample_qc_pass
  FROM kept k JOIN coverage c USING (sample_id)"""),
    "longs": (["flagged", "coverage"], "SELECT f.*, mod_score * 0.01e0 AS value, ln(1 + cov) - ln(1 + median_cov) AS norm_log_cov FROM flagged f JOIN (SELECT sample_id, median_cov FROM coverage) USING (sample_id)"),
    "metrics": (["longs"], f"""SELECT chrom, begin_pos, end_pos, site_key, count(*) AS n_samples_observed, count(*) / {N_SAMPLES}e0 AS fraction_samples_observed,
  avg(cov) AS mean_cov_all_calls, stddev_samp(cov) AS sd_cov_all_calls, stddev_samp(cov) / nullif(avg(cov), 0) AS cv_cov_all_calls,
  avg(value) AS mean_methylation_all_calls, stddev_samp(value) AS sd_methylation_all_calls, stddev_samp(value) / nullif(avg(value), 0) AS cv_methylation_all_calls,
  count(*) FILTER (WHERE meets_min_coverage) AS n_samples_min_coverage, count(*) FILTER (WHERE meets_min_coverage) / {N_SAMPLES}e0 AS fraction_samples_min_coverage,
  count(*) FILTER (WHERE per_sample_qc_pass) AS n_samples_passing_per_sample_qc, count(*) FILTER (WHERE per_sample_qc_pass) / {N_SAMPLES}e0 AS fraction_samples_passing_per_sample_qc,
  avg(cov) FILTER (WHERE per_sample_qc_pass) AS mean_cov_passing_per_sample_qc, stddev_samp(cov) FILTER (WHERE per_sample_qc_pass) AS sd_cov_passing_per_sample_qc,
  stddev_samp(cov) FILTER (WHERE per_sample_qc_pass) / nullif(avg(cov) FILTER (WHERE per_sample_qc_pass), 0) AS cv_cov_passing_per_sample_qc,
  median(cov) FILTER (WHERE per_sample_qc_pass) AS median_cov_passing_per_sample_qc, min(cov) FILTER (WHERE per_sample_qc_pass) AS min_cov_passing_per_sample_qc, max(cov) FILTER (WHERE per_sample_qc_pass) AS max_cov_passing_per_sample_qc,
  avg(value) FILTER (WHERE per_sample_qc_pass) AS mean_methylation_passing_per_sample_qc, stddev_samp(value) FILTER (WHERE per_sample_qc_pass) AS sd_methylation_passing_per_sample_qc,
  stddev_samp(value) FILTER (WHERE per_sample_qc_pass) / nullif(avg(value) FILTER (WHERE per_sample_qc_pass), 0) AS cv_methylation_passing_per_sample_qc,
  mad(value) FILTER (WHERE per_sample_qc_pass) AS methylation_mad_passing_per_sample_qc FROM longs GROUP BY 1, 2, 3, 4"""),
    "sites": (["metrics"], f"""SELECT *, CAST({H.required_samples(N_SAMPLES, FRACTION)} AS INT) AS n_samples_required, n_samples_min_coverage >= {H.required_samples(N_SAMPLES, FRACTION)} AS pass_minimum_coverage_filter,
  n_samples_passing_per_sample_qc >= {H.required_samples(N_SAMPLES, FRACTION)} AS pass_sample_presence_filter, coalesce(methylation_mad_passing_per_sample_qc >= {MAD}e0, false) AS pass_methylation_mad_filter,
  n_samples_min_coverage < {N_SAMPLES} AS has_missing_or_low_coverage, n_samples_passing_per_sample_qc < n_samples_min_coverage AS has_extreme_coverage_loss,
  n_samples_passing_per_sample_qc >= {H.required_samples(N_SAMPLES, FRACTION)} AND coalesce(methylation_mad_passing_per_sample_qc >= {MAD}e0, false) AS keep_site,
  CASE WHEN n_samples_min_coverage < {H.required_samples(N_SAMPLES, FRACTION)} THEN 'Insufficient minimum coverage' WHEN n_samples_passing_per_sample_qc < {H.required_samples(N_SAMPLES, FRACTION)} THEN 'Extreme coverage exclusion'
    WHEN NOT coalesce(methylation_mad_passing_per_sample_qc >= {MAD}e0, false) THEN 'Low methylation MAD' ELSE 'Pass all cohort filters' END AS failure_reason FROM metrics"""),
    "grid": (["longs", "sites"], """SELECT s.chrom, s.begin_pos, s.end_pos, s.site_key, p.sample_id, l.value FROM (SELECT * FROM sites WHERE keep_site) s CROSS JOIN (SELECT DISTINCT sample_id FROM longs) p
  LEFT JOIN (SELECT * FROM longs WHERE per_sample_qc_pass) l ON l.site_key = s.site_key AND l.sample_id = p.sample_id"""),
    "spearman": (["longs"], """SELECT chrom, begin_pos, end_pos, site_key, count(*) AS n_samples_coverage_methylation_correlation, CASE WHEN count(*) >= 3 AND min(x) < max(x) AND min(y) < max(y) THEN corr(rx, ry) END AS coverage_methylation_spearman_rho FROM (
    SELECT *, rank() OVER (PARTITION BY site_key ORDER BY x) + (count(*) OVER (PARTITION BY site_key, x) - 1) / 2e0 AS rx, rank() OVER (PARTITION BY site_key ORDER BY y) + (count(*) OVER (PARTITION BY site_key, y) - 1) / 2e0 AS ry
    FROM (SELECT *, value AS x, norm_log_cov AS y FROM longs WHERE per_sample_qc_pass)) GROUP BY 1, 2, 3, 4"""),
    "filled": (["grid"], "SELECT * REPLACE (coalesce(value, avg(value) OVER (PARTITION BY site_key)) AS value), value IS NULL AS imputed FROM grid"),
    "spots": (["calls"], "SELECT DISTINCT concat_ws('*', chrom, begin_pos, end_pos) AS site_key, chrom, begin_pos + 1 AS start_pos, end_pos FROM calls"),
    "tss": (["genes"], "SELECT *, CASE WHEN strand = '-' THEN end_pos ELSE start_pos END AS tss FROM genes"),
    "promoters": (["tss"], "SELECT gene_id, gene_name, chrom, greatest(1, tss - 2000) AS start_pos, tss + 2000 AS end_pos FROM tss"),
    "expressed": (["counts"], "SELECT * FROM counts WHERE gene_id IN (SELECT gene_id FROM counts GROUP BY 1 HAVING avg(CASE WHEN cnt > 6 THEN 1e0 ELSE 0e0 END) >= 0.2e0)"),
    "libs": (["expressed"], "SELECT sample_id, CAST(sum(cnt) AS DOUBLE) AS lib_size FROM expressed GROUP BY 1"),
    "cpms": (["expressed", "libs"], "SELECT e.*, cnt / lib_size * 1e6 AS cpm FROM expressed e JOIN libs USING (sample_id)"),
    "assays": (["npx"], "SELECT * FROM npx WHERE AssayType = 'assay' AND NOT regexp_matches(SampleID, 'CONTROL_SAMPLE|Control|CONT')"),
    "plated": (["assays"], f"""SELECT a.*, r.m - p.m AS Adj_factor, a.NPX + (r.m - p.m) AS PCNormalizedNPX FROM assays a
  JOIN (SELECT PlateID, OlinkID, median(NPX) AS m FROM assays GROUP BY 1, 2) p USING (PlateID, OlinkID)
  LEFT JOIN (SELECT OlinkID, median(NPX) AS m FROM assays WHERE PlateID = '{PLATE}' AND NPX IS NOT NULL GROUP BY 1) r USING (OlinkID)"""),
    "failed": (["plated"], "SELECT DISTINCT Assay FROM plated WHERE AssayQC <> 'PASS'"),
    "removed": (["plated", "failed"], "SELECT DISTINCT SampleID FROM plated WHERE SampleQC <> 'PASS' AND Assay NOT IN (SELECT Assay FROM failed)"),
    "qced": (["plated", "failed", "removed"], "SELECT * REPLACE (regexp_replace(SampleID, '_.*', '') AS SampleID) FROM plated WHERE SampleID NOT IN (SELECT SampleID FROM removed) AND Assay NOT IN (SELECT Assay FROM failed)"),
    "vecs": (["matrix"], "SELECT chrom, start_pos, feature_id, sample_idx, (value - avg(value) OVER f) AS c FROM matrix WINDOW f AS (PARTITION BY feature_id)"),
    "devs": (["matrix"], "SELECT *, value - median(value) OVER (PARTITION BY sample_idx) AS d FROM matrix"),
    "mads": (["devs"], "SELECT *, median(abs(d)) OVER (PARTITION BY sample_idx) AS mad FROM devs"),
    "weights": (["mads"], "SELECT feature_id, sample_idx AS sample_id, CASE WHEN abs(d / (9 * mad)) < 1 THEN d * pow(1 - (d / (9 * mad)) * (d / (9 * mad)), 2) ELSE 0 END AS w FROM mads"),
    "zs": (["weights"], "SELECT feature_id, sample_id, w / sqrt(sum(w * w) OVER (PARTITION BY sample_id)) AS z FROM weights"),
    "conn": (["zs"], "SELECT sample_id, sum(0.5e0 + 0.5e0 * b) - 1 AS connectivity FROM (SELECT x.sample_id, y.sample_id AS other, sum(x.z * y.z) AS b FROM zs x JOIN zs y USING (feature_id) GROUP BY 1, 2) GROUP BY 1"),
    "autosomal": (["genotypes"], "SELECT *, concat(chrom, ':', pos, '_', ref, '_', alt) AS variant_id FROM genotypes WHERE CAST(substr(chrom, 4) AS INT) <= 22"),
    "dosed": (["autosomal"], "SELECT *, CASE WHEN contains(gt, '.') THEN NULL ELSE length(gt) - length(replace(gt, '1', '')) END AS dosage FROM autosomal"),
}


def _cluster_steps(prefix: str, centred: str) -> None:
    """Steps from centred vectors (chrom, start_pos, feature_id, sample_idx, c) to clusters and representatives."""
    x = prefix
    STEPS[f"{x}units"] = ([centred], f"SELECT chrom, start_pos, feature_id, sample_idx, c / sqrt(sum(c * c) OVER (PARTITION BY feature_id)) AS z FROM {centred}")
    STEPS[f"{x}edges"] = ([f"{x}units"], f"""SELECT a.chrom, a.feature_id AS i, b.feature_id AS j, a.start_pos AS start_i, b.start_pos AS start_j, b.start_pos - a.start_pos AS distance, sum(a.z * b.z) AS r
  FROM {x}units a JOIN {x}units b ON a.chrom = b.chrom AND a.sample_idx = b.sample_idx AND (b.start_pos > a.start_pos OR (b.start_pos = a.start_pos AND b.feature_id > a.feature_id)) AND b.start_pos - a.start_pos <= {PAIR_BP}
  GROUP BY 1, 2, 3, 4, 5, 6 HAVING abs(sum(a.z * b.z)) >= {PAIR_R}e0""")
    STEPS[f"{x}ends"] = ([f"{x}edges"], f"SELECT chrom, i AS f, j AS g, start_i AS start_pos, r FROM {x}edges UNION ALL SELECT chrom, j, i, start_j, r FROM {x}edges")
    STEPS[f"{x}members"] = ([f"{x}ends"], f"""SELECT chrom, f AS feature_id, least(f, min(g)) AS component FROM (
  WITH RECURSIVE reach AS (SELECT chrom, f, g FROM {x}ends UNION SELECT reach.chrom, reach.f, e.g FROM reach JOIN {x}ends e ON e.chrom = reach.chrom AND e.f = reach.g) SELECT * FROM reach) GROUP BY chrom, f""")
    STEPS[f"{x}nodes"] = ([f"{x}members", f"{x}ends"], f"SELECT m.chrom, component, feature_id, any_value(start_pos) AS start_pos, sum(abs(r)) AS lc FROM {x}members m JOIN {x}ends e ON e.chrom = m.chrom AND e.f = m.feature_id GROUP BY 1, 2, 3")
    STEPS[f"{x}clusters"] = ([f"{x}nodes", f"{x}members", f"{x}edges"], f"""SELECT *, CAST(dense_rank() OVER (PARTITION BY chrom ORDER BY cluster_start, representative_cpg) AS INT) AS cluster_id FROM (
  SELECT n.*, p.* EXCLUDE (chrom, component), cluster_end - cluster_start AS cluster_span_bp, b.feature_id AS representative_cpg, b.start_pos AS representative_start, b.start_pos + 1 AS representative_end, b.lc AS representative_local_connectivity
  FROM (SELECT chrom, component, min(start_pos) AS cluster_start, max(start_pos) AS cluster_end, count(*) AS n_correlated_cpgs FROM {x}nodes GROUP BY 1, 2) n
  JOIN (SELECT e.chrom, component, count(*) AS n_correlated_pairs, avg(distance) AS mean_pair_distance_bp, max(distance) AS max_pair_distance_bp, avg(abs(r)) AS mean_abs_correlation, max(abs(r)) AS max_abs_correlation
    FROM {x}edges e JOIN {x}members m ON m.chrom = e.chrom AND m.feature_id = e.i GROUP BY 1, 2) p ON p.chrom = n.chrom AND p.component = n.component
  JOIN (SELECT * FROM {x}nodes QUALIFY row_number() OVER (PARTITION BY chrom, component ORDER BY lc DESC, start_pos, feature_id) = 1) b ON b.chrom = n.chrom AND b.component = n.component)""")
    STEPS[f"{x}chosen"] = ([f"{x}clusters", f"{x}members", centred], f"""SELECT chrom, representative_start AS start_pos, representative_end AS end_pos, representative_cpg AS feature_id, cluster_id, n_correlated_cpgs AS cluster_size, representative_local_connectivity AS local_connectivity, 'correlated_cluster' AS selection_type FROM {x}clusters
  UNION ALL SELECT DISTINCT chrom, start_pos, start_pos + 1, feature_id, NULL, 1, 0e0, 'singleton' FROM {centred} v ANTI JOIN {x}members m USING (chrom, feature_id)""")


def _connectivity_steps(prefix: str, source: str) -> None:
    """Steps from values (feature_id, sample_idx, value) to the connectivity of samples, over the features that both of a pair have."""
    x, pair = prefix, "WINDOW p AS (PARTITION BY s, t)"
    varying = f"SELECT feature_id, sample_idx, value FROM {source} WHERE value IS NOT NULL AND feature_id IN (SELECT feature_id FROM {source} GROUP BY 1 HAVING stddev_samp(value) > 0)"
    STEPS[f"{x}devs"] = ([source], f"SELECT s, t, a - median(a) OVER p AS a, b - median(b) OVER p AS b FROM (SELECT x.sample_idx AS s, y.sample_idx AS t, x.value AS a, y.value AS b FROM ({varying}) x JOIN ({varying}) y USING (feature_id)) {pair}")
    STEPS[f"{x}mads"] = ([f"{x}devs"], f"SELECT *, 9 * median(abs(a)) OVER p AS ma, 9 * median(abs(b)) OVER p AS mb FROM {x}devs {pair}")
    weight = lambda v: f"CASE WHEN abs({v} / m{v}) < 1 THEN {v} * pow(1 - ({v} / m{v}) * ({v} / m{v}), 2) ELSE 0 END"
    STEPS[f"{x}bicor"] = ([f"{x}mads"], f"SELECT s, t, sum(a * b) / sqrt(sum(a * a) * sum(b * b)) AS r FROM (SELECT s, t, {weight('a')} AS a, {weight('b')} AS b FROM {x}mads) GROUP BY 1, 2")
    STEPS[f"{x}conn"] = ([f"{x}bicor"], f"SELECT s AS sample_id, sum(0.5e0 + 0.5e0 * r) FILTER (WHERE s <> t) AS connectivity FROM {x}bicor GROUP BY 1")


def _residual_sql(source: str) -> str:
    """Residuals of values (…, feature_id, sample_idx, value) on an intercept and two covariates of samples, by normal equations over the
    values that are there."""
    mean = f"SELECT * EXCLUDE (value), value - avg(value) OVER f AS y, a - avg(a) OVER f AS a1, b - avg(b) OVER f AS b1 FROM (SELECT *, {COVARIATE_A} AS a, {COVARIATE_B} AS b FROM {source} WHERE value IS NOT NULL) WINDOW f AS (PARTITION BY feature_id)"
    sums = f"SELECT *, sum(a1 * a1) OVER f AS aa, sum(b1 * b1) OVER f AS bb, sum(a1 * b1) OVER f AS ab, sum(a1 * y) OVER f AS ay, sum(b1 * y) OVER f AS by_ FROM ({mean}) WINDOW f AS (PARTITION BY feature_id)"
    return f"SELECT * EXCLUDE (a, b, y, a1, b1, aa, bb, ab, ay, by_), y - (ay * bb - by_ * ab) / (aa * bb - ab * ab) * a1 - (by_ * aa - ay * ab) / (aa * bb - ab * ab) * b1 AS c FROM ({sums})"


#: Covariates of the residual queries, of a sample's index from 1.
COVARIATE_A, COVARIATE_B = "((sample_idx - 1) % 7)::DOUBLE", "sqrt(sample_idx - 1)"
_cluster_steps("", "vecs")
STEPS["resid"] = (["matrix"], _residual_sql("matrix"))
_cluster_steps("r", "resid")
STEPS["repvals"] = (["matrix", "chosen"], "SELECT m.feature_id, m.sample_idx, m.value FROM matrix m JOIN (SELECT feature_id FROM chosen) USING (feature_id)")
_connectivity_steps("rep", "repvals")


def sql_of(body: str, *steps: str, doubles: tuple[str, ...] = (), digits: int = DIGITS) -> str:
    """A statement with the steps (and all that they need) as its tables; doubles are rounded as in rounded()."""
    order: list[str] = []

    def need(name: str) -> None:
        if name in order:
            return
        for x in STEPS[name][0] if name in STEPS else ():
            need(x)
        order.append(name)

    for s in steps:
        need(s)
    tables = ", ".join(f"{n} AS ({STEPS[n][1] if n in STEPS else fixtures.view_sql(n)})" for n in order)
    if doubles:
        body = f"SELECT * REPLACE ({', '.join(f'round({d}, {digits}) AS {d}' for d in doubles)}) FROM ({body})"
    return f"WITH {tables} {body}" if tables else body


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


class Data:
    """The fixture views and, from them, the engine's intermediate tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in fixtures.VIEWS or name == "matrix":
            found = fixtures.view(self.spark, self.sf_dir, name)
            self.__dict__[name] = keep(found, name) if name in WRITTEN else found
            return self.__dict__[name]
        raise AttributeError(name)

    @property
    def kept(self) -> DataFrame:
        return C.filter_chroms(self.calls, CHROMS)

    @property
    def coverage(self) -> DataFrame:
        return C.sample_coverage(self.kept, FENCE)

    @property
    def flagged(self) -> DataFrame:
        return C.flag_calls(self.kept, self.coverage, MIN_COV)

    @property
    def longs(self) -> DataFrame:
        return C.log_coverage_baseline(self.flagged, self.coverage)

    @property
    def samples(self) -> DataFrame:
        return self.calls.select("sample_id").distinct()

    @property
    def metrics(self) -> DataFrame:
        return H.site_metrics(self.longs, N_SAMPLES)

    @property
    def sites(self) -> DataFrame:
        return H.flag_sites(self.metrics, N_SAMPLES, H.required_samples(N_SAMPLES, FRACTION), MAD)

    @property
    def grid(self) -> DataFrame:
        return H.complete_grid(self.longs, self.sites, SAMPLES)

    @property
    def filled(self) -> DataFrame:
        """Cells of the cohort with imputed values and scores of values rounded to nine digits."""
        return H.cohort_long(H.cohort_arrays(self.longs, self.sites, SAMPLES, 9), SAMPLES)

    @property
    def spots(self) -> DataFrame:
        return self.calls.select(F.concat_ws("*", "chrom", "begin_pos", "end_pos").alias("site_key"), "chrom", (F.col("begin_pos") + 1).alias("start_pos"), "end_pos").distinct()

    @property
    def expressed(self) -> DataFrame:
        return E.expressed_genes(self.counts)

    @property
    def cpms(self) -> DataFrame:
        return E.cpm(self.expressed)

    @property
    def plated(self) -> DataFrame:
        return P.normalize_plates(P.assays_only(self.npx), PLATE)

    @property
    def qced(self) -> DataFrame:
        rows = self.plated
        rows = rows.join(P.removed_samples(rows), "SampleID", "left_anti").join(P.failed_assays(rows), "Assay", "left_anti")
        return rows.withColumn("SampleID", P.strip_suffix(F.col("SampleID")))

    @property
    def features(self) -> DataFrame:
        return K.standardise(K.vectors(self.matrix))

    @property
    def edges(self) -> DataFrame:
        return K.correlated_pairs(self.features, PAIR_BP, PAIR_R)

    @property
    def members(self) -> DataFrame:
        return K.components(self.features, self.edges, PAIR_BP)

    @property
    def clusters(self) -> DataFrame:
        return K.cluster_table(self.features, self.edges, self.members)

    @property
    def chosen(self) -> DataFrame:
        members = self.members
        return K.representatives(self.features, members, K.cluster_table(self.features, self.edges, members))

    @property
    def sample_rows(self) -> DataFrame:
        return self.matrix.select("feature_id", F.col("sample_idx").alias("sample_id"), "value")

    @property
    def autosomal(self) -> DataFrame:
        return G.autosomal(self.genotypes)


def query(name: str, sql: str | None = None, digits: int = DIGITS):
    def register(f: Callable[[Data], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: rounded(f(Data(spark, sf_dir)), digits)
        if sql:
            SQL[name] = sql
        return f

    return register


# --- projections and filters -------------------------------------------------------------------------------------------

query("P01_chrom_regex_filter", sql_of("SELECT * FROM kept", "kept"))(lambda d: d.kept)
query("P02_autosome_filter", sql_of("SELECT * FROM genotypes WHERE CAST(substr(chrom, 4) AS INT) BETWEEN 1 AND 22", "genotypes"))(lambda d: C.keep_autosomes(d.genotypes))
query("P03_min_coverage_flag", sql_of("SELECT sample_id, site_key, meets_min_coverage FROM flagged", "flagged"))(lambda d: d.flagged.select("sample_id", "site_key", "meets_min_coverage"))
query("P04_extreme_coverage_flag", sql_of("SELECT sample_id, site_key, extreme_cov_flag FROM flagged", "flagged"))(lambda d: d.flagged.select("sample_id", "site_key", "extreme_cov_flag"))
query("P05_per_sample_qc_pass", sql_of("SELECT sample_id, site_key, per_sample_qc_pass FROM flagged", "flagged"))(lambda d: d.flagged.select("sample_id", "site_key", "per_sample_qc_pass"))
query("P06_implied_copy_number", sql_of("SELECT sample_id, site_key, implied_cn FROM flagged", "flagged", doubles=("implied_cn",)))(lambda d: d.flagged.select("sample_id", "site_key", "implied_cn"))
query("P07_site_key", sql_of("SELECT DISTINCT site_key, chrom FROM flagged", "flagged"))(lambda d: d.flagged.select("site_key", "chrom").distinct())
query("P08_value_scale", sql_of("SELECT sample_id, site_key, value FROM longs", "longs", doubles=("value",)))(lambda d: d.longs.select("sample_id", "site_key", "value"))
query("P09_low_count_gene_filter", sql_of("SELECT * FROM expressed", "expressed"))(lambda d: d.expressed)
query("P10_sample_select", sql_of("SELECT * FROM counts WHERE sample_id IN (SELECT sample_id FROM covariates WHERE gpc1 > 4500)", "counts", "covariates"))(
    lambda d: H.select_samples(d.counts, d.covariates.where("gpc1 > 4500"))
)
query("P11_assay_control_filter", sql_of("SELECT SampleID, PlateID, Assay, NPX FROM assays", "assays", doubles=("NPX",)))(lambda d: P.assays_only(d.npx).select("SampleID", "PlateID", "Assay", "NPX"))
query("P12_qc_status_filter", sql_of("SELECT SampleID, PlateID, Assay, SampleQC, AssayQC FROM npx WHERE SampleQC <> 'PASS' OR AssayQC <> 'PASS'", "npx"))(lambda d: P.not_passing(d.npx).select("SampleID", "PlateID", "Assay", "SampleQC", "AssayQC"))
query("P13_fixed_exclusion_list", sql_of("SELECT SampleID, PlateID, UniProt FROM npx WHERE UniProt NOT IN ('UP4', 'UP9')", "npx"))(lambda d: P.without_proteins(d.npx, ("UP4", "UP9")).select("SampleID", "PlateID", "UniProt"))
query("P14_strip_suffix", sql_of("SELECT DISTINCT regexp_replace(SampleID, '_.*', '') AS short, concat_ws('_', regexp_replace(SampleID, '_.*', ''), PlateID) AS joint_id FROM npx", "npx"))(
    lambda d: d.npx.select(P.strip_suffix(F.col("SampleID")).alias("short"), F.concat_ws("_", P.strip_suffix(F.col("SampleID")), "PlateID").alias("joint_id")).distinct()
)
query("P16_keep_passing_metadata", sql_of("SELECT site_key, failure_reason FROM sites WHERE keep_site", "sites"))(lambda d: H.passing_sites(d.sites).select("site_key", "failure_reason"))
query("P17_finite_predicate", sql_of("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity <= 25 THEN l_quantity / (CASE WHEN l_linenumber = 1 THEN NULL ELSE 2e0 END) END AS x FROM lineitem", doubles=("x",)))(
    lambda d: d.spark.read.parquet(f"{d.sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", finite(F.when(F.col("l_quantity") > 25, float("inf")).when(F.col("l_linenumber") == 1, float("nan")).otherwise(F.col("l_quantity").cast("double") / 2)).alias("x"))
)
query("P18_ensembl_id_extract", sql_of("SELECT gene_id, nullif(regexp_extract(concat(chrom, ':', start_pos, ':', CASE WHEN strand = '+' THEN gene_id ELSE 'none' END), 'ENSG[0-9]+'), '') AS ensg FROM genes", "genes"))(
    lambda d: d.genes.select("gene_id", F.nullif(F.regexp_extract(F.concat_ws(":", "chrom", "start_pos", F.when(F.col("strand") == "+", F.col("gene_id")).otherwise("none")), "ENSG[0-9]+", 0), F.lit("")).alias("ensg"))
)
query("P19_gene_tss", sql_of("SELECT gene_id, gene_name, chrom, strand, (CASE WHEN strand = '+' THEN start_pos ELSE end_pos END) - 1 AS tss_start, CASE WHEN strand = '+' THEN start_pos ELSE end_pos END AS tss_end FROM genes", "genes"))(lambda d: I.gene_tss(d.genes))
query("P20_annotation_tss", sql_of("SELECT * FROM tss", "tss"))(lambda d: I.annotation_tss(d.genes))
query("P21_promoter_interval", sql_of("SELECT * FROM promoters", "promoters"))(lambda d: I.promoters(d.genes))
query("P22_expand_interval", sql_of("SELECT chrom, greatest(1, start_pos - 4000) AS start_pos, end_pos + 4000 AS end_pos, name FROM islands", "islands"))(lambda d: I.expand(d.islands, 4000))
query("P24_variant_autosome_filter", sql_of("SELECT * FROM autosomal", "autosomal"))(lambda d: d.autosomal)
query("P25_allele_count_filter", sql_of(
    """SELECT * FROM autosomal WHERE sample_id < 'S15' AND variant_id IN (SELECT variant_id FROM autosomal WHERE sample_id < 'S15' GROUP BY 1 HAVING sum(length(gt) - length(replace(gt, '1', ''))) >= 2)""", "autosomal"))(
    lambda d: G.allele_count_filter(d.autosomal, d.autosomal.select("sample_id").where("sample_id < 'S15'").distinct(), 2).select(d.autosomal.columns)
)
query("P26_rename_reorder", sql_of("SELECT site_key AS phenotype_id, chrom AS chr, begin_pos AS start_pos, end_pos, mod_score FROM flagged", "flagged"))(lambda d: d.flagged.select(F.col("site_key").alias("phenotype_id"), F.col("chrom").alias("chr"), F.col("begin_pos").alias("start_pos"), "end_pos", "mod_score"))

# --- expectations: what breaks them ------------------------------------------------------------------------------------

query("Q02_blank_keys", "SELECT count(*) AS n FROM customer WHERE c_custkey % 7 = 0 HAVING count(*) > 0")(
    lambda d: Q.blank_keys(d.spark.read.parquet(f"{d.sf_dir}/customer.parquet").select(F.when(F.col("c_custkey") % 7 != 0, F.col("c_custkey").cast("string")).otherwise(" ").alias("k")), "k")
)
query("Q03_repeated_keys", "SELECT l_orderkey, l_suppkey, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")(lambda d: Q.repeated_keys(d.spark.read.parquet(f"{d.sf_dir}/lineitem.parquet"), "l_orderkey", "l_suppkey"))
query("Q04_unequal_keys", """SELECT c_custkey AS k, 'first' AS only_in FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 3 = 0)
UNION ALL SELECT DISTINCT o_custkey, 'second' FROM orders WHERE o_custkey % 3 = 0 AND o_custkey NOT IN (SELECT c_custkey FROM customer)""")(
    lambda d: Q.unequal_keys(d.spark.read.parquet(f"{d.sf_dir}/customer.parquet").select(F.col("c_custkey").alias("k")), d.spark.read.parquet(f"{d.sf_dir}/orders.parquet").where("o_custkey % 3 = 0").select(F.col("o_custkey").alias("k")), "k")
)
query("Q05_not_numeric", "SELECT p_partkey, p_name FROM part WHERE TRY_CAST(p_name AS DOUBLE) IS NULL")(lambda d: Q.not_numeric(d.spark.read.parquet(f"{d.sf_dir}/part.parquet").select("p_partkey", "p_name"), "p_name"))
query("Q06_bad_intervals", sql_of("SELECT gene_id, start_pos - 500 AS a, end_pos - 2000 AS b FROM genes WHERE start_pos - 500 < 0 OR end_pos - 2000 <= start_pos - 500", "genes"))(
    lambda d: Q.bad_intervals(d.genes.select("gene_id", (F.col("start_pos") - 500).alias("a"), (F.col("end_pos") - 2000).alias("b")), "a", "b")
)
query("Q07_mixed_types", sql_of("SELECT sample_id, count(DISTINCT CASE WHEN cov > 49 THEN 'other' ELSE type END) AS n_types FROM calls GROUP BY 1 HAVING n_types <> 1", "calls"))(
    lambda d: Q.mixed_types(d.calls.withColumn("type", F.when(F.col("cov") > 49, "other").otherwise(F.col("type"))))
)
query("Q08_bad_medians", sql_of("SELECT sample_id, median_cov - 36 AS median_cov FROM coverage WHERE median_cov - 36 <= 0", "coverage", doubles=("median_cov",)))(
    lambda d: Q.bad_medians(d.coverage.select("sample_id", (F.col("median_cov") - 36).alias("median_cov")))
)
query("Q10_unsorted_rows", sql_of("SELECT gene_id, chrom, start_pos FROM (SELECT *, lag(start_pos) OVER (PARTITION BY chrom ORDER BY gene_id) AS l FROM genes) WHERE start_pos < l", "genes"))(
    lambda d: Q.unsorted_rows(d.genes.select("gene_id", "chrom", "start_pos"), ["gene_id"], "chrom", "start_pos")
)
query("Q15_sites_without_values", sql_of("SELECT site_key, count(CASE WHEN per_sample_qc_pass THEN value END) AS n FROM longs GROUP BY 1 HAVING n = 0", "longs"))(
    lambda d: Q.sites_without_values(d.longs.select("site_key", F.when(F.col("per_sample_qc_pass"), F.col("value")).alias("value")))
)

# --- joins -------------------------------------------------------------------------------------------------------------

FLAGGED_DOUBLES = ("mod_score", "cov", "implied_cn")
query("J01_calls_sample_stats", sql_of("SELECT * FROM flagged", "flagged", doubles=FLAGGED_DOUBLES))(lambda d: d.flagged)
query("J02_log_coverage_baseline", sql_of("SELECT sample_id, site_key, value, norm_log_cov FROM longs", "longs", doubles=("value", "norm_log_cov")))(lambda d: d.longs.select("sample_id", "site_key", "value", "norm_log_cov"))
query("J03_semi_kept_sites", sql_of("SELECT sample_id, site_key, value FROM longs WHERE per_sample_qc_pass AND site_key IN (SELECT site_key FROM sites WHERE keep_site)", "longs", "sites", doubles=("value",)))(
    lambda d: d.longs.where("per_sample_qc_pass").join(d.sites.where("keep_site").select("site_key"), "site_key", "left_semi").select("sample_id", "site_key", "value")
)
query("J04_imputed_counts", sql_of("SELECT s.site_key, s.keep_site, coalesce(f.n, 0) AS n_samples_imputed_in_qtl_bed FROM sites s LEFT JOIN (SELECT site_key, count(*) FILTER (WHERE imputed) AS n FROM filled GROUP BY 1) f USING (site_key)", "sites", "filled"))(
    lambda d: H.merge_cohort(keep(d.longs, "longs"), N_SAMPLES, FRACTION, MAD).select("site_key", "keep_site", "n_samples_imputed_in_qtl_bed")
)
TSS_SQL = "SELECT gene_id, chrom, (CASE WHEN strand = '+' THEN start_pos ELSE end_pos END) - 1 AS tss_start, CASE WHEN strand = '+' THEN start_pos ELSE end_pos END AS tss_end FROM genes"
query("J05_expression_tss", sql_of(f"SELECT e.*, chrom, tss_start, tss_end FROM expressed e JOIN ({TSS_SQL}) USING (gene_id)", "expressed", "genes"))(lambda d: E.locate(d.expressed, I.gene_tss(d.genes)))
query("J06_mapping_tss", sql_of(f"SELECT m.*, chrom, tss_start FROM (SELECT DISTINCT gene_id, concat('UP', cnt) AS UniProt FROM counts) m LEFT JOIN ({TSS_SQL}) t USING (gene_id)", "counts", "genes"))(
    lambda d: d.counts.select("gene_id", F.concat(F.lit("UP"), "cnt").alias("UniProt")).distinct().join(I.gene_tss(d.genes).select("gene_id", "chrom", "tss_start"), "gene_id", "left")
)
query("J07_protein_fan_out", sql_of(
    f"""SELECT t.chrom, t.tss_start, t.tss_end, concat_ws('_', q.UniProt, m.gene_id) AS feature_id, q.SampleID, q.PCNormalizedNPX AS value FROM qced q
    JOIN (SELECT gene_id, concat('UP', substr(gene_id, 11)) AS UniProt FROM genes) m USING (UniProt) JOIN ({TSS_SQL}) t ON t.gene_id = m.gene_id""", "qced", "genes", doubles=("value",)))(
    lambda d: P.protein_features(d.qced, d.genes.select("gene_id", F.concat(F.lit("UP"), F.substring("gene_id", 11, 9)).alias("UniProt")), I.gene_tss(d.genes))
)
query("J08_merge_covariates", sql_of("SELECT DISTINCT c.*, lib_size FROM covariates c JOIN libs USING (sample_id)", "covariates", "libs", doubles=("gpc1", "gpc2", "lib_size")))(
    lambda d: V.merge_covariates(d.covariates, E.library_sizes(d.expressed).withColumnRenamed("sample_id", "ID"))
)
query("J11_anti_joins", sql_of("SELECT SampleID, PlateID, Assay, PCNormalizedNPX FROM qced", "qced", doubles=("PCNormalizedNPX",)))(lambda d: d.qced.select("SampleID", "PlateID", "Assay", "PCNormalizedNPX"))
query("J12_first_plate_semi", sql_of("SELECT SampleID, PlateID, Assay FROM qced JOIN (SELECT SampleID, min(PlateID) AS PlateID FROM qced GROUP BY 1) USING (SampleID, PlateID)", "qced"))(
    lambda d: d.qced.join(P.first_plates(d.qced), ["SampleID", "PlateID"], "left_semi").select("SampleID", "PlateID", "Assay")
)
query("J13_interval_overlap", sql_of("SELECT s.site_key, g.gene_id FROM spots s JOIN genes g ON s.chrom = g.chrom AND s.start_pos <= g.end_pos AND g.start_pos <= s.end_pos", "spots", "genes"))(
    lambda d: I.overlap_join(d.spots, d.genes).select("site_key", F.col("f_gene_id").alias("gene_id"))
)
query("J14_nearest_tss", sql_of(
    """SELECT s.site_key, t.d AS nearest_distance, t.gene_id, t.gene_name, t.strand FROM spots s LEFT JOIN (
    SELECT site_key, abs(tss - p.start_pos) AS d, g.gene_id, g.gene_name, g.strand FROM spots p JOIN tss g ON p.chrom = g.chrom
    QUALIFY row_number() OVER (PARTITION BY site_key ORDER BY abs(tss - p.start_pos), tss, g.gene_id) = 1) t USING (site_key)""", "spots", "tss"))(
    lambda d: I.nearest_point(d.spots, I.annotation_tss(d.genes), "tss", "gene_id", ["gene_id", "gene_name", "strand"]).select("site_key", "nearest_distance", "gene_id", "gene_name", "strand")
)
NEAR_ISLAND = "SELECT s.site_key, min(CASE WHEN i.start_pos IS NOT NULL THEN greatest(i.start_pos - s.end_pos, s.start_pos - i.end_pos, 0) END) AS nearest_distance FROM spots s LEFT JOIN islands i ON i.chrom = s.chrom GROUP BY 1"
query("J15_nearest_island", sql_of(NEAR_ISLAND, "spots", "islands"))(lambda d: I.nearest_interval(d.spots, d.islands, "name").select("site_key", "nearest_distance"))
query("J16_shore_shelf", sql_of(f"SELECT site_key, coalesce(nearest_distance <= 2000, false) AS near_shore, coalesce(nearest_distance <= 4000, false) AS near_shelf FROM ({NEAR_ISLAND})", "spots", "islands"))(
    lambda d: I.nearest_interval(d.spots, d.islands, "name").select("site_key", F.coalesce(F.col("nearest_distance") <= 2000, F.lit(False)).alias("near_shore"), F.coalesce(F.col("nearest_distance") <= 4000, F.lit(False)).alias("near_shelf"))
)
query("J17_local_pairs", sql_of(f"""SELECT a.chrom, a.feature_id AS i, b.feature_id AS j, b.start_pos - a.start_pos AS distance FROM (SELECT DISTINCT chrom, start_pos, feature_id FROM matrix) a
JOIN (SELECT DISTINCT chrom, start_pos, feature_id FROM matrix) b ON a.chrom = b.chrom AND (b.start_pos > a.start_pos OR (b.start_pos = a.start_pos AND b.feature_id > a.feature_id)) AND b.start_pos - a.start_pos <= {PAIR_BP}""", "matrix"))(
    lambda d: K.local_pairs(d.features, PAIR_BP).select("chrom", "i", "j", "distance")
)
query("J22_body_without_exon", sql_of(
    """SELECT s.site_key, array_to_string(list_sort(list(DISTINCT g.gene_id)), ';') AS intron_gene_id FROM spots s JOIN genes g ON s.chrom = g.chrom AND s.start_pos <= g.end_pos AND g.start_pos <= s.end_pos
    WHERE NOT (s.start_pos <= g.start_pos + 300 AND g.start_pos <= s.end_pos) GROUP BY 1""", "spots", "genes"))(
    lambda d: d.spots.join(_gene_ids(d.spots, d.genes, "body"), "site_key").join(_gene_ids(d.spots, d.genes.withColumn("end_pos", F.col("start_pos") + 300), "exon"), "site_key", "left")
    .select("site_key", F.array_join(F.array_except("body", F.coalesce("exon", F.array().cast("array<string>"))), ";").alias("intron_gene_id")).where("intron_gene_id <> ''")
)
query("J23_genotype_semi", sql_of("SELECT * FROM genotypes WHERE sample_id IN ('S01', 'S07')", "genotypes"))(lambda d: H.select_samples(d.genotypes, d.genotypes.where(F.col("sample_id").isin("S01", "S07"))).select(d.genotypes.columns))


def _gene_ids(spots: DataFrame, genes: DataFrame, name: str) -> DataFrame:
    return I.overlap_join(spots, genes).groupBy("site_key").agg(F.array_sort(F.collect_set("f_gene_id")).alias(name))


# --- aggregations ------------------------------------------------------------------------------------------------------

COVERAGE_DOUBLES = ("median_cov", "q25", "q75", "extreme_coverage_cutoff")
METRIC_DOUBLES = tuple(
    f"{s}_{n}_{scope}" for scope in ("all_calls", "passing_per_sample_qc") for n in ("cov", "methylation") for s in ("mean", "sd", "cv")
) + tuple(f"fraction_samples_{x}" for x in ("observed", "min_coverage", "passing_per_sample_qc")) + tuple(f"{x}_cov_passing_per_sample_qc" for x in ("median", "min", "max")) + ("methylation_mad_passing_per_sample_qc",)
query("A01_sample_coverage", sql_of("SELECT * FROM coverage", "coverage", doubles=COVERAGE_DOUBLES))(lambda d: d.coverage)
query("A02_sample_qc", sql_of(
    """SELECT sample_id, any_value(n_in) AS n_input_rows, count(*) AS n_rows_after_chrom_filter, any_value(n_in) - count(*) AS n_removed_by_chrom_filter, min(type) AS pb_cpg_type,
    any_value(median_cov) AS median_cov, any_value(extreme_coverage_cutoff) AS extreme_coverage_cutoff, count(*) FILTER (WHERE NOT meets_min_coverage) AS n_below_min_coverage, count(*) FILTER (WHERE extreme_cov_flag = 'extreme') AS n_extreme_coverage,
    count(*) FILTER (WHERE extreme_cov_flag = 'extreme' AND meets_min_coverage) AS n_extreme_coverage_after_min_coverage, count(*) FILTER (WHERE per_sample_qc_pass) AS n_passing_per_sample_qc
    FROM flagged f JOIN coverage USING (sample_id) JOIN (SELECT sample_id, count(*) AS n_in FROM calls GROUP BY 1) USING (sample_id) GROUP BY 1""", "flagged", "coverage", doubles=("median_cov", "extreme_coverage_cutoff")))(
    lambda d: C.sample_qc(d.calls, d.kept, d.flagged, d.coverage)
)
query("A03_site_metrics", sql_of("SELECT * FROM metrics", "metrics", doubles=METRIC_DOUBLES, digits=FINE), digits=FINE)(lambda d: d.metrics)
query("A05_site_mad", sql_of("SELECT site_key, methylation_mad_passing_per_sample_qc AS mad FROM metrics", "metrics", doubles=("mad",)))(lambda d: d.metrics.select("site_key", F.col("methylation_mad_passing_per_sample_qc").alias("mad")))
query("A06_site_spearman", sql_of("SELECT * FROM spearman", "spearman", doubles=("coverage_methylation_spearman_rho",)))(lambda d: H.coverage_correlation(d.longs))
query("A07_cohort_summary", sql_of("SELECT count(*) AS n_sites, " + ", ".join(f"count(*) FILTER (WHERE {c}) AS n_{c}" for c in ("pass_minimum_coverage_filter", "pass_sample_presence_filter", "pass_methylation_mad_filter", "has_missing_or_low_coverage", "has_extreme_coverage_loss", "keep_site")) + " FROM sites", "sites"))(lambda d: H.cohort_summary(d.sites))
query("A08_filter_summary", sql_of("SELECT turn, r AS failure_reason, (SELECT count(*) FROM sites WHERE failure_reason = r) AS n_sites FROM (VALUES (0, 'Insufficient minimum coverage'), (1, 'Extreme coverage exclusion'), (2, 'Low methylation MAD'), (3, 'Pass all cohort filters')) v(turn, r)", "sites"))(lambda d: H.failure_summary(d.sites))
query("A09_failure_patterns", sql_of(
    """SELECT CAST(code AS INT) AS code, count(*) AS n_sites, concat_ws(';', CASE WHEN code & 1 <> 0 THEN 'has_missing_or_low_coverage' END, CASE WHEN code & 2 <> 0 THEN 'has_extreme_coverage_loss' END, CASE WHEN code & 4 <> 0 THEN 'pass_sample_presence_filter' END, CASE WHEN code & 8 <> 0 THEN 'pass_methylation_mad_filter' END) AS labels
    FROM (SELECT (has_missing_or_low_coverage::INT) + 2 * (has_extreme_coverage_loss::INT) + 4 * ((NOT pass_sample_presence_filter)::INT) + 8 * ((NOT pass_methylation_mad_filter)::INT) AS code FROM sites) GROUP BY code""", "sites"))(lambda d: H.failure_patterns(d.sites))
query("A10_feature_means", sql_of("SELECT site_key, avg(value) AS mean, count(*) - count(value) AS n_imputed FROM grid GROUP BY 1", "grid", doubles=("mean",)))(lambda d: d.grid.groupBy("site_key").agg(F.avg("value").alias("mean"), (F.count(F.lit(1)) - F.count("value")).alias("n_imputed")))
query("A11_library_size_cpm", sql_of("SELECT * FROM cpms", "cpms", doubles=("cpm",)))(lambda d: d.cpms)
query("A12_tmm_factors")(lambda d: E.tmm_factors(d.expressed))
query("A13_reference_medians", sql_of(f"SELECT OlinkID, median(NPX) AS reference_median FROM assays WHERE PlateID = '{PLATE}' AND NPX IS NOT NULL GROUP BY 1", "assays", doubles=("reference_median",)))(lambda d: P.reference_medians(P.assays_only(d.npx), PLATE))
query("A14_plate_normalisation", sql_of("SELECT SampleID, PlateID, OlinkID, Adj_factor, PCNormalizedNPX FROM plated", "plated", doubles=("Adj_factor", "PCNormalizedNPX")))(lambda d: d.plated.select("SampleID", "PlateID", "OlinkID", "Adj_factor", "PCNormalizedNPX"))
query("A15_distinct_qc_lists", sql_of("SELECT 'assay' AS kind, Assay AS id FROM failed UNION ALL SELECT 'sample', SampleID FROM removed UNION ALL SELECT DISTINCT 'missing', regexp_replace(SampleID, '_.*', '') FROM plated WHERE NPX IS NULL", "failed", "removed"))(
    lambda d: P.failed_assays(d.plated).select(F.lit("assay").alias("kind"), F.col("Assay").alias("id")).unionByName(P.removed_samples(d.plated).select(F.lit("sample").alias("kind"), F.col("SampleID").alias("id")))
    .unionByName(d.plated.where("NPX is null").select(F.lit("missing").alias("kind"), P.strip_suffix(F.col("SampleID")).alias("id")).distinct())
)
query("A16_overlap_summary", sql_of(
    """SELECT s.site_key, coalesce(n, 0) AS n_genes, ids AS gene_id, names AS gene_name FROM spots s LEFT JOIN (SELECT site_key, count(*) AS n, array_to_string(list_sort(list(DISTINCT gene_id)), ';') AS ids, array_to_string(list_sort(list(DISTINCT gene_name)), ';') AS names
    FROM spots p JOIN genes g ON p.chrom = g.chrom AND p.start_pos <= g.end_pos AND g.start_pos <= p.end_pos GROUP BY 1) USING (site_key)""", "spots", "genes"))(
    lambda d: I.overlap_summary(d.spots, d.genes, "genes", {"gene_id": "gene_id", "gene_name": "gene_name"}).select("site_key", "n_genes", "gene_id", "gene_name")
)
CLUSTER_DOUBLES = ("mean_pair_distance_bp", "mean_abs_correlation", "max_abs_correlation", "representative_local_connectivity")
query("A17_cluster_stats", sql_of("SELECT * FROM clusters", "clusters", doubles=CLUSTER_DOUBLES))(lambda d: d.clusters)
query("A18_local_connectivity", sql_of("SELECT chrom, f AS feature_id, sum(abs(r)) AS local_connectivity FROM (SELECT chrom, i AS f, r FROM edges UNION ALL SELECT chrom, j, r FROM edges) GROUP BY 1, 2", "edges", doubles=("local_connectivity",)))(lambda d: K.local_connectivity(d.edges))
SUMMARY_DOUBLES = ("mean_cluster_size", "median_cluster_size", "mean_correlated_pair_distance_bp", "min_abs_correlation")
SUMMARY_SQL = f"""SELECT f.*, coalesce(n_correlated_pairs, 0) AS n_correlated_pairs, coalesce(n_clusters, 0) AS n_clusters, coalesce(n_cpgs_in_clusters, 0) AS n_cpgs_in_clusters, mean_cluster_size, median_cluster_size,
  mean_correlated_pair_distance_bp, max_correlated_pair_distance_bp, '' AS input_bed, '' AS covariates, {PAIR_BP} AS window_bp, {PAIR_R}e0 AS min_abs_correlation, (SELECT count(*) FROM chosen c WHERE c.chrom = f.chrom) AS n_representative_cpgs
  FROM (SELECT chrom, CAST(max(n) AS INT) AS n_samples_used, count(*) AS n_cpgs_processed, count(*) FILTER (WHERE flat) AS n_zero_variance_cpgs FROM (SELECT chrom, feature_id, count(*) AS n, sum(c * c) <= 0 AS flat FROM vecs GROUP BY 1, 2) GROUP BY 1) f
  LEFT JOIN (SELECT chrom, CAST(sum(n_correlated_pairs) AS BIGINT) AS n_correlated_pairs, count(*) AS n_clusters, CAST(sum(n_correlated_cpgs) AS BIGINT) AS n_cpgs_in_clusters, avg(n_correlated_cpgs) AS mean_cluster_size, median(n_correlated_cpgs) AS median_cluster_size,
    sum(mean_pair_distance_bp * n_correlated_pairs) / sum(n_correlated_pairs) AS mean_correlated_pair_distance_bp, max(max_pair_distance_bp) AS max_correlated_pair_distance_bp FROM clusters GROUP BY 1) c USING (chrom)"""
query("A19_correlation_summary", sql_of(SUMMARY_SQL, "clusters", "chosen", "vecs", doubles=SUMMARY_DOUBLES))(lambda d: K.correlation_summary(d.features, d.clusters, PAIR_BP, PAIR_R))
query("A20_sample_connectivity", sql_of("SELECT sample_id, connectivity, (connectivity - avg(connectivity) OVER ()) / stddev_samp(connectivity) OVER () AS zscore, NOT (zscore < -3) AS pass_connectivity_filter FROM conn", "conn", doubles=("connectivity", "zscore")))(
    lambda d: N.outliers(N.connectivity(N.varying_features(d.sample_rows)))
)
query("A21_connectivity_summary", sql_of("""SELECT (SELECT count(DISTINCT feature_id) FROM matrix) AS n_representative_cpgs, (SELECT count(*) FROM (SELECT feature_id FROM matrix GROUP BY 1 HAVING stddev_samp(value) > 0)) AS n_representative_cpgs_used,
'correlation_pruned_full_wgcna_bicor' AS method, count(*) AS n_samples_in_full_correlation, count(*) AS n_samples_before, count(*) FILTER (WHERE z < -2) AS n_samples_removed, count(*) FILTER (WHERE z >= -2) AS n_samples_retained, -2e0 AS z_threshold FROM (SELECT (connectivity - avg(connectivity) OVER ()) / stddev_samp(connectivity) OVER () AS z FROM conn)""", "matrix", "conn", doubles=("z_threshold",)))(
    lambda d: N.summary(d.sample_rows, N.varying_features(d.sample_rows), N.score_samples(d.sample_rows, -2.0), -2.0)
)
query("A22_lost_features", sql_of("SELECT count(DISTINCT e.gene_id) AS n_before, count(DISTINCT g.gene_id) AS n_after, n_before - n_after AS n_lost FROM expressed e LEFT JOIN (SELECT * FROM genes WHERE strand = '+') g USING (gene_id)", "expressed", "genes"))(
    lambda d: E.lost_features(d.expressed, E.locate(d.expressed, I.gene_tss(d.genes.where("strand = '+'"))))
)
query("A23_allele_frequency", sql_of("SELECT variant_id, CAST(sum(length(gt) - length(replace(gt, '1', ''))) AS BIGINT) AS alt_alleles, CAST(sum(2 - (length(gt) - length(replace(gt, '.', '')))) AS BIGINT) AS called_alleles, alt_alleles / nullif(called_alleles, 0) AS frequency FROM autosomal GROUP BY 1", "autosomal", doubles=("frequency",)))(lambda d: G.allele_frequency(d.autosomal))
query("A24_cohort_size", sql_of("SELECT count(DISTINCT sample_id) AS n_samples FROM calls", "calls"))(lambda d: d.samples.agg(F.count(F.lit(1)).alias("n_samples")))
query("A25_distinct_sites", sql_of("SELECT count(DISTINCT site_key) AS n_sites, count(DISTINCT sample_id) AS n_samples FROM longs", "longs"))(lambda d: d.longs.agg(F.count_distinct("site_key").alias("n_sites"), F.count_distinct("sample_id").alias("n_samples")))

# --- windows -----------------------------------------------------------------------------------------------------------


def rank_sql(value: str, by: str) -> str:
    return f"rank() OVER (PARTITION BY {by} ORDER BY {value}) + (count(*) OVER (PARTITION BY {by}, {value}) - 1) / 2e0"


SCALED = "SELECT *, ({v} - avg({v}) OVER f) / nullif(stddev_samp({v}) OVER f, 0) AS scaled FROM {t} WINDOW f AS (PARTITION BY {by})"
query("W01_int_methylation", sql_of(f"SELECT site_key, sample_id, {inverse_normal_sql('(r - 0.5e0) / n')} AS score FROM (SELECT *, {rank_sql('round(value, 9)', 'site_key')} AS r, count(*) OVER (PARTITION BY site_key) AS n FROM filled)", "filled", doubles=("score",)))(
    lambda d: d.filled.select("site_key", "sample_id", "score")
)
query("W02_average_rank", sql_of(f"SELECT sample_id, site_key, {rank_sql('cov', 'sample_id')} AS r FROM flagged", "flagged", doubles=("r",)))(lambda d: d.flagged.select("sample_id", "site_key", average_rank("cov", "sample_id").alias("r")))
query("W03_int_expression", sql_of(f"SELECT gene_id, sample_id, {inverse_normal_sql('(r - 0.375e0) / (n + 0.25e0)')} AS score FROM (SELECT *, {rank_sql('cnt', 'gene_id')} AS r, count(*) OVER (PARTITION BY gene_id) AS n FROM expressed)", "expressed", doubles=("score",)))(
    lambda d: E.rank_normal(d.expressed, "gene_id", "cnt").select("gene_id", "sample_id", "score")
)
query("W04_center_scale", sql_of(SCALED.format(v="cnt", t="expressed", by="gene_id"), "expressed", doubles=("scaled",)))(lambda d: E.center_scale(d.expressed, "gene_id", "cnt"))
query("W05_log2_scale", sql_of("SELECT gene_id, sample_id, (l - avg(l) OVER f) / nullif(stddev_samp(l) OVER f, 0) AS scaled FROM (SELECT *, log2(cpm + 1) AS l FROM cpms) WINDOW f AS (PARTITION BY gene_id)", "cpms", doubles=("scaled",)))(
    lambda d: E.log_scale(d.cpms, "gene_id", "cpm").select("gene_id", "sample_id", "scaled")
)
query("W06_scale_residual_rows", sql_of("SELECT site_key, sample_id, (value - avg(value) OVER f) / nullif(stddev_samp(value) OVER f, 0) AS scaled FROM grid WINDOW f AS (PARTITION BY site_key)", "grid", doubles=("scaled",)))(
    lambda d: d.grid.select("site_key", "sample_id", centred(F.col("value"), Window.partitionBy("site_key")).alias("scaled"))
)
query("W07_first_plate", sql_of("SELECT SampleID, min(PlateID) AS PlateID FROM qced GROUP BY 1", "qced"))(lambda d: P.first_plates(d.qced))
query("W08_connectivity_zscore", sql_of("SELECT sample_id, (connectivity - avg(connectivity) OVER ()) / stddev_samp(connectivity) OVER () AS zscore FROM conn", "conn", doubles=("zscore",)))(lambda d: N.outliers(N.connectivity(d.sample_rows)).select("sample_id", "zscore"))
query("W09_sliding_window", sql_of(f"SELECT chrom, feature_id, count(*) OVER (PARTITION BY chrom ORDER BY start_pos RANGE BETWEEN {PAIR_BP} PRECEDING AND CURRENT ROW) AS n_active FROM (SELECT DISTINCT chrom, start_pos, feature_id FROM matrix)", "matrix"))(
    lambda d: ordered.within_reach(d.matrix.select("chrom", "start_pos", "feature_id").distinct(), "chrom", "start_pos", PAIR_BP, "n_active").select("chrom", "feature_id", "n_active")
)
query("W10_segments", sql_of(f"SELECT chrom, start_pos, feature_id, CAST(sum(new) OVER (PARTITION BY chrom ORDER BY start_pos, feature_id) AS BIGINT) AS segment FROM (SELECT *, CASE WHEN start_pos - lag(start_pos) OVER (PARTITION BY chrom ORDER BY start_pos, feature_id) > {PAIR_BP} THEN 1 ELSE 0 END AS new FROM (SELECT DISTINCT chrom, start_pos, feature_id FROM matrix))", "matrix"))(
    lambda d: K.segments(d.matrix.select("chrom", "start_pos", "feature_id").distinct(), PAIR_BP)
)
query("W11_representatives", sql_of("SELECT chrom, cluster_id, representative_cpg, representative_start, representative_end FROM clusters", "clusters"))(lambda d: d.clusters.select("chrom", "cluster_id", "representative_cpg", "representative_start", "representative_end"))
query("W12_nearest_before_after", sql_of("""SELECT site_key, max(tss) FILTER (WHERE tss <= p.start_pos) AS before_pos, min(tss) FILTER (WHERE tss >= p.start_pos) AS after_pos,
  arg_min(gene_id, (-tss, gene_id)) FILTER (WHERE tss <= p.start_pos) AS before_gene, arg_min(gene_id, (tss, gene_id)) FILTER (WHERE tss >= p.start_pos) AS after_gene FROM spots p LEFT JOIN tss USING (chrom) GROUP BY 1""", "spots", "tss"))(
    lambda d: I.beside_points(d.spots, I.annotation_tss(d.genes), "tss", "gene_id", ["gene_id"]).select("site_key", F.col("before.pos").alias("before_pos"), F.col("after.pos").alias("after_pos"), F.col("before.p.gene_id").alias("before_gene"), F.col("after.p.gene_id").alias("after_gene"))
)

# --- sorts, sets, shapes -----------------------------------------------------------------------------------------------

query("O01_sort_sites", sql_of("SELECT chrom, begin_pos, end_pos, site_key FROM sites ORDER BY 1, 2, 3", "sites"))(lambda d: d.sites.select(*H.SITE).orderBy("chrom", "begin_pos", "end_pos"))
query("O02_sort_features", sql_of("SELECT gene_id, chrom, tss_start FROM (" + TSS_SQL + ") ORDER BY CAST(substr(chrom, 4) AS INT), tss_start, gene_id", "genes"))(
    lambda d: I.gene_tss(d.genes).select("gene_id", "chrom", "tss_start").orderBy(F.substring("chrom", 4, 3).try_cast("int"), "tss_start", "gene_id")
)
query("O04_sort_samples", sql_of("SELECT * FROM covariates ORDER BY sample_id", "covariates", doubles=("gpc1", "gpc2")))(lambda d: d.covariates.orderBy("sample_id"))
query("O06_union_shards", sql_of("SELECT * FROM calls", "calls"))(lambda d: d.calls.where("sample_id < 'S05'").unionByName(d.calls.where("sample_id >= 'S05'")))
query("O08_set_difference", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders")(lambda d: d.spark.read.parquet(f"{d.sf_dir}/customer.parquet").select(F.col("c_custkey").alias("k")).subtract(d.spark.read.parquet(f"{d.sf_dir}/orders.parquet").select("o_custkey")))
query("O09_distinct", sql_of("SELECT DISTINCT SampleID, PlateID FROM npx", "npx"))(lambda d: d.npx.select("SampleID", "PlateID").distinct())
PIVOT = ", ".join(f"max(CASE WHEN sample_id = '{s}' THEN {{v}} END) AS {s}" for s in SAMPLES)
query("O10_pivot", sql_of(f"SELECT site_key, {PIVOT.format(v='value')} FROM longs GROUP BY 1", "longs", doubles=tuple(SAMPLES)))(lambda d: d.longs.groupBy("site_key").pivot("sample_id", SAMPLES).agg(F.first("value")))
query("O11_unpivot", sql_of("SELECT sample_id, 'gpc1' AS ID, gpc1 AS value FROM covariates UNION ALL SELECT sample_id, 'gpc2', gpc2 FROM covariates", "covariates", doubles=("value",)))(lambda d: V.to_long(d.covariates))
query("O12_transpose", sql_of(f"SELECT 'gpc1' AS ID, {PIVOT.format(v='gpc1')} FROM covariates UNION ALL SELECT 'gpc2', {PIVOT.format(v='gpc2')} FROM covariates", "covariates", doubles=tuple(SAMPLES)))(lambda d: V.covariate_matrix(d.covariates, SAMPLES))
query("O13_complete_grid", sql_of("SELECT site_key, sample_id, value FROM grid", "grid", doubles=("value",)))(lambda d: d.grid.select("site_key", "sample_id", "value"))
query("O14_mean_impute", sql_of("SELECT site_key, sample_id, value, imputed FROM filled", "filled", doubles=("value",)))(lambda d: d.filled.select("site_key", "sample_id", "value", "imputed"))

# --- scalar functions --------------------------------------------------------------------------------------------------

query("M01_inverse_normal", f"SELECT l_orderkey, l_linenumber, round({inverse_normal_sql('(l_quantity - 0.5e0) / 50e0')}, {DIGITS}) AS q FROM lineitem")(
    lambda d: d.spark.read.parquet(f"{d.sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", inverse_normal((F.col("l_quantity").cast("double") - 0.5) / 50.0).alias("q"))
)
query("M02_logs_and_powers", sql_of("SELECT sample_id, site_key, log10(cov) AS a, ln(1 + cov) AS b, log2(cov) AS c, pow(10e0, cov / 100) AS e, sqrt(cov) AS f, abs(cov - 25) AS g FROM flagged", "flagged", doubles=tuple("abcefg")))(
    lambda d: d.flagged.select("sample_id", "site_key", F.log10("cov").alias("a"), F.log1p("cov").alias("b"), F.log2("cov").alias("c"), F.pow(F.lit(10.0), F.col("cov") / 100).alias("e"), F.sqrt("cov").alias("f"), F.abs(F.col("cov") - 25).alias("g"))
)
query("M04_island_context", sql_of(f"SELECT site_key, CASE WHEN nearest_distance = 0 THEN 'island' WHEN nearest_distance <= 2000 THEN 'shore' WHEN nearest_distance <= 4000 THEN 'shelf' ELSE 'open_sea' END AS context FROM ({NEAR_ISLAND})", "spots", "islands"))(
    lambda d: I.nearest_interval(d.spots, d.islands, "name").select("site_key", I.island_context(F.col("nearest_distance")).alias("context"))
)
CCRE_TYPES = "SELECT site_key, array_to_string(list_sort(list(DISTINCT ccre_type)), ';') AS t FROM spots p JOIN ccres g ON p.chrom = g.chrom AND p.start_pos <= g.end_pos AND g.start_pos <= p.end_pos GROUP BY 1"
query("M06_sorted_join", sql_of(CCRE_TYPES, "spots", "ccres"))(lambda d: I.overlap_summary(d.spots, d.ccres, "ccres", {"ccre_type": "t"}).where("n_ccres > 0").select("site_key", "t"))
query("M07_enhancer_like", sql_of(f"SELECT site_key, regexp_matches(t, '(^|,)(pELS|dELS)(,|$)') AS is_enhancer_like, regexp_matches(t, '(^|,)CTCF-only(,|$)') AS is_ctcf_only FROM ({CCRE_TYPES})", "spots", "ccres"))(
    lambda d: I.overlap_summary(d.spots, d.ccres, "ccres", {"ccre_type": "t"}).where("n_ccres > 0").select("site_key", I.is_enhancer_like(F.col("t")).alias("is_enhancer_like"), I.is_ctcf_only(F.col("t")).alias("is_ctcf_only"))
)
query("M10_dosage", sql_of("SELECT variant_id, sample_id, CAST(dosage AS INT) AS dosage FROM dosed", "dosed"))(lambda d: d.autosomal.select("variant_id", "sample_id", G.dosage().alias("dosage")))
query("M13_dot_product", sql_of("SELECT feature_id, sum(z * z) AS dot FROM units GROUP BY 1", "units", doubles=("dot",)))(lambda d: d.features.select("feature_id", K.dot("vec", "vec").alias("dot")))

# --- linear algebra and graphs -----------------------------------------------------------------------------------------


def _design(d: Data):
    import numpy as np
    import pandas as pd

    n = d.features.select(F.size("vec").alias("n")).first()["n"]
    return L.model_matrix(pd.DataFrame({"a": np.arange(n) % 7, "b": np.sqrt(np.arange(n))}))


def _vectors(d: Data) -> DataFrame:
    return K.vectors(d.matrix)


def _elements(df: DataFrame, vec: str = "vec") -> DataFrame:
    return df.select("feature_id", F.posexplode(vec).alias("i", "v")).select("feature_id", (F.col("i") + 1).alias("sample_idx"), "v")


def _pcs(d: Data, n: int = 3) -> DataFrame:
    vectors = _vectors(d)
    size = vectors.select(F.size("vec").alias("n")).first()["n"]
    scores, _ = L.principal_components(vectors, size)
    return L.pcs_frame(vectors, scores, [f"S{i:02d}" for i in range(size)], n)


query("L02_residualize", sql_of("SELECT feature_id, sample_idx, c AS v FROM resid", "resid", doubles=("v",)))(lambda d: _elements(L.residualize(_vectors(d), _design(d))))
MASKED = "SELECT * REPLACE (CASE WHEN (sample_idx - 1 + feature_id) % 9 <> 0 THEN value END AS value) FROM matrix"
query("L03_residualize_with_nulls", sql_of(f"SELECT m.feature_id, m.sample_idx, c AS v FROM matrix m LEFT JOIN ({_residual_sql(f'({MASKED})')}) r ON r.feature_id = m.feature_id AND r.sample_idx = m.sample_idx", "matrix", doubles=("v",)))(lambda d: _elements(L.residualize(_vectors(d).withColumn("vec", F.transform("vec", lambda v, i: F.when((i + F.col("feature_id")) % 9 != 0, v))), _design(d))))
query("L04_row_standardise", sql_of("SELECT feature_id, sample_idx, z AS v FROM units", "units", doubles=("v",)))(lambda d: _elements(d.features))
query("L05_pca")(_pcs)
query("L07_bicor_vectors", sql_of("SELECT * FROM zs", "zs", doubles=("z",)))(lambda d: N.bicor_vectors(d.sample_rows))
query("L08_connectivity", sql_of("SELECT * FROM conn", "conn", doubles=("connectivity",)))(lambda d: N.connectivity(d.sample_rows))
query("L09_pearson_pairs", sql_of("SELECT * FROM edges", "edges", doubles=("r",)))(lambda d: d.edges)
query("L10_components", sql_of("SELECT * FROM members", "members"))(lambda d: d.members)
query("L11_representatives", sql_of("SELECT * FROM chosen", "chosen", doubles=("local_connectivity",)))(lambda d: d.chosen)
query("L12_drop_constant", sql_of("SELECT feature_id, sample_idx AS sample_id, value FROM matrix WHERE feature_id IN (SELECT feature_id FROM matrix GROUP BY 1 HAVING stddev_samp(value) > 0)", "matrix", doubles=("value",)))(lambda d: N.varying_features(d.sample_rows))

# --- composites --------------------------------------------------------------------------------------------------------

query("X03_normalize_proteomics", sql_of(
    """SELECT SampleID, PlateID, Assay, PCNormalizedNPX FROM qced JOIN (SELECT SampleID, min(PlateID) AS PlateID FROM qced GROUP BY 1) USING (SampleID, PlateID)
    WHERE SampleID NOT IN (SELECT SampleID FROM qced JOIN (SELECT SampleID, min(PlateID) AS PlateID FROM qced GROUP BY 1) USING (SampleID, PlateID) WHERE NPX IS NULL) AND UniProt NOT IN ('P32455', 'Q02750')""", "qced", doubles=("PCNormalizedNPX",)))(
    lambda d: P.normalize(d.npx, PLATE).select("SampleID", "PlateID", "Assay", "PCNormalizedNPX")
)
QC_COLUMNS = "n_input_rows, n_rows_after_chrom_filter, n_below_min_coverage, n_passing_per_sample_qc"
query("X05_filter_sample_methylation", sql_of(f"""SELECT f.*, {QC_COLUMNS} FROM flagged f JOIN (SELECT sample_id, count(*) AS n_rows_after_chrom_filter, count(*) FILTER (WHERE NOT meets_min_coverage) AS n_below_min_coverage,
  count(*) FILTER (WHERE per_sample_qc_pass) AS n_passing_per_sample_qc FROM flagged GROUP BY 1) USING (sample_id) JOIN (SELECT sample_id, count(*) AS n_input_rows FROM calls GROUP BY 1) USING (sample_id)""", "flagged", doubles=FLAGGED_DOUBLES))(
    lambda d: (lambda calls, qc: calls.join(qc.select("sample_id", *QC_COLUMNS.split(", ")), "sample_id"))(*C.filter_sample_methylation(d.calls, CHROMS, MIN_COV, FENCE))
)
SITE_DOUBLES = METRIC_DOUBLES
query("X06_merge_cohort", sql_of(
    """SELECT s.*, coalesce(r.n_samples_coverage_methylation_correlation, 0) AS n_samples_coverage_methylation_correlation, r.coverage_methylation_spearman_rho, coalesce(i.n, 0) AS n_samples_imputed_in_qtl_bed
    FROM sites s LEFT JOIN spearman r USING (site_key) LEFT JOIN (SELECT site_key, count(*) FILTER (WHERE imputed) AS n FROM filled GROUP BY 1) i USING (site_key)""",
    "sites", "spearman", "filled", doubles=(*SITE_DOUBLES, "coverage_methylation_spearman_rho"), digits=FINE), digits=FINE)(
    lambda d: H.merge_cohort(keep(d.longs, "longs"), N_SAMPLES, FRACTION, MAD)
)
query("X06_cohort_scores", sql_of(f"SELECT chrom, begin_pos, end_pos, site_key, sample_id, value, imputed, {inverse_normal_sql('(r - 0.5e0) / n')} AS score FROM (SELECT *, {rank_sql('round(value, 9)', 'site_key')} AS r, count(*) OVER (PARTITION BY site_key) AS n FROM filled)", "filled", doubles=("value", "score")))(
    lambda d: d.filled.select(*H.SITE, "sample_id", "value", "imputed", "score")
)
query("X09_cluster_correlated_sites", sql_of("SELECT * FROM rclusters", "rclusters", doubles=CLUSTER_DOUBLES))(lambda d: K.correlated_clusters(_vectors(d), PAIR_BP, PAIR_R, _design(d))[1])
query("X12_correlation_covariates", sql_of("SELECT c.sample_id, lib_size, gpc1, gpc2 FROM covariates c JOIN libs USING (sample_id)", "covariates", "libs", doubles=("lib_size", "gpc1", "gpc2")))(
    lambda d: V.correlation_covariates(E.library_sizes(d.expressed).withColumnRenamed("sample_id", "ID"), d.covariates)
)
GENE_PARTS = {"promoter": "SELECT * FROM promoters", "gene_body": "SELECT * FROM genes"} | {
    label: f"SELECT * FROM gene_parts WHERE type IN ({', '.join(map(repr, types))})" for label, types in I.SUBFEATURES.items()
}
JOINED = "array_to_string(list_sort(list(DISTINCT nullif({0}, ''))), ';')"


def _hits_sql(label: str, source: str, columns: dict[str, str], n: str) -> str:
    lists = ", ".join(f"{JOINED.format('g.' + c)} AS {name}" for c, name in columns.items())
    return f"(SELECT site_key, count(*) AS {n}, {lists} FROM spots x JOIN ({source}) g ON x.chrom = g.chrom AND x.start_pos <= g.end_pos AND g.start_pos <= x.end_pos GROUP BY 1) {label}"


def _annotation_sql() -> str:
    joins, columns = [], []
    for label, source in GENE_PARTS.items():
        joins.append(_hits_sql(f"h_{label}", source, {"gene_id": f"{label}_gene_id", "gene_name": f"{label}_gene_name"}, "n"))
        columns += [f"coalesce(h_{label}.n, 0) AS n_{label}_genes", f"{label}_gene_id", f"{label}_gene_name", f"coalesce(h_{label}.n, 0) > 0 AS in_{label}"]
    inside = "SELECT x.site_key, g.gene_id, min(g.gene_name) AS gene_name FROM spots x JOIN {0} g ON x.chrom = g.chrom AND x.start_pos <= g.end_pos AND g.start_pos <= x.end_pos {1} GROUP BY 1, 2"
    introns = f"SELECT * FROM ({inside.format('genes', '')}) b ANTI JOIN ({inside.format('gene_parts', 'WHERE type = ' + repr('exon'))}) e USING (site_key, gene_id)"
    joins.append(f"(SELECT site_key, count(*) AS n, {JOINED.format('gene_id')} AS intron_gene_id, {JOINED.format('gene_name')} AS intron_gene_name FROM ({introns}) GROUP BY 1) h_intron")
    joins.append(_hits_sql("h_island", "SELECT * FROM islands", {"name": "cpg_island_name"}, "n"))
    joins.append(_hits_sql("h_ccre", "SELECT * FROM ccres", {c: c for c in ("ccre_v4_id", "ccre_v5_id", "ccre_type")}, "n"))
    columns += ["coalesce(h_intron.n, 0) AS n_intron_genes", "intron_gene_id", "intron_gene_name", "coalesce(h_intron.n, 0) > 0 AS in_intron"]
    columns += ["coalesce(h_island.n, 0) AS n_overlapping_cpg_islands", "cpg_island_name", "coalesce(h_island.n, 0) > 0 AS in_cpg_island", "near.nearest_distance AS nearest_cpg_island_distance"]
    columns += ["CASE WHEN near.nearest_distance = 0 THEN 'island' WHEN near.nearest_distance <= 2000 THEN 'shore' WHEN near.nearest_distance <= 4000 THEN 'shelf' ELSE 'open_sea' END AS cpg_island_context"]
    columns += ["coalesce(h_ccre.n, 0) AS n_overlapping_ccres", "ccre_v4_id", "ccre_v5_id", "ccre_type", "coalesce(h_ccre.n, 0) > 0 AS in_ccre"]
    columns += ["coalesce(regexp_matches(ccre_type, '(^|,)(pELS|dELS)(,|$)'), false) AS is_enhancer_like", "coalesce(regexp_matches(ccre_type, '(^|,)CTCF-only(,|$)'), false) AS is_ctcf_only"]
    columns += ["CASE WHEN h_promoter.n > 0 THEN 'promoter' WHEN h_gene_body.n > 0 THEN 'gene_body' ELSE 'intergenic' END AS genomic_context"]
    columns += ["CASE WHEN h_promoter.n > 0 THEN 'promoter' WHEN h_exon.n > 0 THEN 'exon' WHEN h_intron.n > 0 THEN 'intron' WHEN h_gene_body.n > 0 THEN 'gene_body_unclassified' ELSE 'intergenic' END AS gene_feature_context"]
    nearest = "(SELECT site_key, min(abs(tss - x.start_pos)) AS nearest_tss_distance, " + ", ".join(f"arg_min({c}, (abs(tss - x.start_pos), tss, gene_id)) AS nearest_tss_{c}" for c in ("gene_id", "gene_name", "strand")) + " FROM spots x JOIN tss USING (chrom) GROUP BY 1) t"
    # before a site the interval that ends last counts, after it the first one; then the greater name
    joins.append("(SELECT site_key, name AS nearest_cpg_island_name FROM (SELECT x.site_key, i.*, i.start_pos > x.start_pos AS after, greatest(i.start_pos - x.end_pos, x.start_pos - i.end_pos, 0) AS far FROM spots x JOIN islands i USING (chrom)) QUALIFY row_number() OVER (PARTITION BY site_key ORDER BY far, after, CASE WHEN after THEN start_pos ELSE -end_pos END, -end_pos, name DESC) = 1) nearest_island")
    every = [nearest, *joins, f"({NEAR_ISLAND}) near"]
    return f"SELECT site_key, s.chrom, s.start_pos, s.end_pos, nearest_tss_distance, nearest_tss_gene_id, nearest_tss_gene_name, nearest_tss_strand, nearest_cpg_island_name, {', '.join(columns)} FROM spots s " + " ".join(f"LEFT JOIN {x} USING (site_key)" for x in every)


ANNOTATION_SQL = _annotation_sql()
query("X08_annotate_sites", sql_of(ANNOTATION_SQL, "spots", "tss", "promoters", "gene_parts", "islands", "ccres"))(
    lambda d: I.annotate(d.spots, d.genes, d.islands, d.ccres, d.gene_parts)
)
query("X14_genotype_dosage_matrix", sql_of("SELECT variant_id, " + ", ".join(f"CAST(max(CASE WHEN sample_id = 'S{i:02d}' THEN dosage END) AS INT) AS S{i:02d}" for i in range(20)) + " FROM dosed GROUP BY 1", "dosed"))(
    lambda d: G.dosage_matrix(d.autosomal, [f"S{i:02d}" for i in range(20)])
)

#: The flagship: site metadata of a cohort, from raw calls.
FLAGSHIP = "X06_merge_cohort"
