"""Queries of sources and sinks: a fixture view is written as the outside tool writes it, and read back by the source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cohort as H
from ..operators import covariates as V
from ..operators import expect as Q
from ..operators import expression as E
from ..sources import readers as R
from ..sources import writers as W
from ..sources.shared import keep, scratch
from .queries import FINE, FLAGGED_DOUBLES, METRIC_DOUBLES, PIVOT, PLATE, SAMPLES, SQL, Data, query, sql_of


def _tsv(df: DataFrame, tag: str, header: bool = True) -> str:
    path = scratch(df.sparkSession, tag)
    # a comment sign that no field begins with, so that "#chrom" is not quoted
    df.write.options(sep="\t", header=header, nullValue="NA", compression="gzip", comment="\u0001").csv(path)
    return path


def _lines(parts: list[DataFrame], tag: str) -> str:
    """A folder of the text of one-column DataFrames, each in files of its own; readers tell lines apart by what they hold."""
    path = scratch(parts[0].sparkSession, tag)
    for part in parts:
        part.toDF("value").write.mode("append").text(path)
    return path


def _text(d: Data, *lines: str) -> DataFrame:
    return d.spark.createDataFrame([(x,) for x in lines], "value string")


def _wide(d: Data) -> DataFrame:
    return W.phenotype_bed(d.longs.select("chrom", F.col("begin_pos").alias("start_pos"), "end_pos", F.col("site_key").alias("phenotype_id"), "sample_id", "value"), SAMPLES)


def _gct(d: Data) -> str:
    wide = d.counts.groupBy("gene_id").pivot("sample_id", SAMPLES).agg(F.first("cnt")).fillna(0)
    rows = wide.select(F.concat_ws("\t", "gene_id", F.lit("gene"), *SAMPLES))
    return _lines([_text(d, "#1.2"), _text(d, f"rows\t{len(SAMPLES)}"), _text(d, "\t".join(["Name", "Description", *SAMPLES])), rows], "gct")


def _gtf(d: Data) -> str:
    attributes = F.concat(F.lit('gene_id "'), "gene_id", F.lit('"; gene_name "'), "gene_name", F.lit('";'))
    rows = d.genes.select(F.concat_ws("\t", "chrom", F.lit("src"), F.lit("gene"), "start_pos", "end_pos", F.lit("."), "strand", F.lit("."), attributes))
    return _lines([_text(d, "##gtf"), rows], "gtf")


def _vcf(d: Data) -> str:
    samples = [f"S{i:02d}" for i in range(20)]
    wide = d.genotypes.groupBy("chrom", "pos", "ref", "alt").pivot("sample_id", samples).agg(F.first("gt"))
    cells = [F.concat(F.coalesce(F.col(s), F.lit("./.")), F.lit(":1")) for s in samples]
    rows = wide.select(F.concat_ws("\t", "chrom", "pos", F.lit("."), "ref", "alt", F.lit("."), F.lit("."), F.lit("."), F.lit("GT:DP"), *cells))
    return _lines([_text(d, "##fileformat=VCFv4.2"), _text(d, "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *samples])), rows], "vcf")


def _call_files(d: Data) -> tuple[str, str]:
    """Two sets of call files: of even samples without a header, of odd ones with one and in another order of columns."""
    even, odd = (d.calls.where(f"CAST(substr(sample_id, 2) AS INT) % 2 = {k}") for k in (0, 1))
    plain = _tsv(even.select("chrom", "begin_pos", "end_pos", "mod_score", "type", "cov", F.lit(1).alias("x")), "calls", header=False)
    named = odd.select(F.col("chrom").alias("#chrom"), "cov", F.lit("x").alias("note"), F.col("begin_pos").alias("begin"), F.col("end_pos").alias("end"), "type", "mod_score")
    return plain, _tsv(named, "named-calls")


def _manifest(d: Data) -> str:
    """A manifest of a folder of calls a sample, in a folder beside them."""
    folder = scratch(d.spark, "manifest-calls")
    d.calls.select(F.col("sample_id").alias("sample"), "chrom", "begin_pos", "end_pos", "mod_score", "type", "cov").repartition("sample").write.partitionBy("sample").options(sep="\t", compression="gzip").csv(folder)
    rows = d.samples.select("sample_id", F.concat(F.lit(folder.rsplit("/", 1)[1] + "/sample="), "sample_id").alias("file_path"))
    return _tsv(rows.coalesce(1), "manifest")


query("S01_scan_calls", sql_of("SELECT chrom, begin_pos, end_pos, mod_score, type, cov FROM calls", "calls"))(lambda d: R.scan_calls(d.spark, list(_call_files(d))))
query("S02_scan_manifest", sql_of("SELECT sample_id, chrom, begin_pos, end_pos, mod_score, type, cov FROM calls", "calls"))(lambda d: R.scan_manifest_calls(d.spark, _manifest(d)))
query("S04_scan_path_list", sql_of("SELECT chrom, begin_pos, end_pos, mod_score, type, cov FROM calls", "calls"))(
    lambda d: R.scan_calls(d.spark, [r["file_path"] for r in R.scan_path_list(d.spark, _lines([_text(d, *_call_files(d))], "paths"), "call").collect()])
)
query("S03_scan_cohort_manifest", sql_of("SELECT sample_id, 'qc' AS sample_qc, concat('autosome', lpad(CAST(n AS VARCHAR), 2, '0')) AS autosome, concat(sample_id, '.', n) AS file_path FROM (SELECT DISTINCT sample_id FROM calls) CROSS JOIN range(1, 23) r(n)", "calls"))(
    lambda d: R.scan_cohort_manifest(d.spark, _tsv(d.samples.select("sample_id", F.lit("qc").alias("sample_qc"), *[F.concat("sample_id", F.lit(f".{n}")).alias(f"autosome{n:02d}") for n in range(1, 23)]), "cohort"))
)
query("S06_scan_sample_qc", SQL["A02_sample_qc"])(lambda d: _round_trip_qc(d))
query("S07_scan_cohort_samples", sql_of("SELECT DISTINCT sample_id FROM calls", "calls"))(lambda d: R.scan_cohort_samples(d.spark, _tsv(d.samples, "samples"), d.samples.count()))
query("S08_scan_gct", sql_of("SELECT g.gene_id, s.sample_id, CAST(coalesce(c.cnt, 0) AS DOUBLE) AS cnt FROM (SELECT DISTINCT gene_id FROM counts) g CROSS JOIN (SELECT DISTINCT sample_id FROM counts) s LEFT JOIN counts c ON c.gene_id = g.gene_id AND c.sample_id = s.sample_id", "counts"))(lambda d: R.scan_gct(d.spark, _gct(d)))
query("S09_scan_gtf", sql_of("SELECT chrom, 'gene' AS type, start_pos, end_pos, strand, gene_id, gene_name FROM genes", "genes"))(lambda d: R.scan_gtf(d.spark, _gtf(d)))
query("S10_scan_ccres", sql_of("SELECT chrom, start_pos - 1 AS ccre_begin, end_pos AS ccre_end, ccre_v4_id, ccre_v5_id, ccre_type FROM ccres", "ccres"))(
    lambda d: R.scan_ccres(d.spark, _tsv(d.ccres.select("chrom", F.col("start_pos") - 1, "end_pos", "ccre_v4_id", "ccre_v5_id", "ccre_type"), "ccres", header=False))
)
query("S11_scan_cpg_islands", sql_of("SELECT chrom, start_pos - 1 AS chrom_start, end_pos AS chrom_end, name FROM islands", "islands"))(
    lambda d: R.scan_islands(d.spark, _tsv(d.islands.select(F.lit(1).alias("bin"), "chrom", (F.col("start_pos") - 1).alias("a"), "end_pos", "name", *[F.lit(1).alias(f"x{i}") for i in range(6)]), "islands", header=False))
)
query("S14_scan_sample_list", sql_of("SELECT sample_id FROM covariates", "covariates"))(lambda d: R.scan_sample_list(d.spark, _tsv(d.covariates.select("sample_id"), "list", header=False), "no"))
query("S16_scan_phenotype_bed", sql_of("SELECT chrom, begin_pos AS start_pos, end_pos, site_key AS phenotype_id, sample_id, value FROM longs", "longs", doubles=("value",)))(
    lambda d: R.scan_phenotype_bed(d.spark, _tsv(_wide(d), "bed")).where("value is not null")
)
query("S15_scan_splice_bed", sql_of("SELECT site_key AS phenotype_id, sample_id, value FROM longs WHERE sample_id IN ('S01', 'S02')", "longs", doubles=("value",)))(
    lambda d: R.scan_phenotype_bed(d.spark, _tsv(_wide(d).select("#chr", "start", "end", "phenotype_id", "S01", "S02"), "splice")).where("value is not null").select("phenotype_id", "sample_id", "value")
)
query("S17_scan_covariate_matrix", sql_of("SELECT 'gpc1' AS ID, sample_id, gpc1 AS value FROM covariates UNION ALL SELECT 'gpc2', sample_id, gpc2 FROM covariates", "covariates", doubles=("value",)))(
    lambda d: R.scan_covariate_matrix(d.spark, _tsv(V.covariate_matrix(d.covariates, SAMPLES), "matrix"))
)
query("S18_scan_pcs", sql_of("SELECT sample_id AS ID, gpc1 AS PC1, gpc2 AS PC2 FROM covariates", "covariates", doubles=("PC1", "PC2")))(
    lambda d: R.tsv(d.spark, _tsv(d.covariates.toDF("ID", "PC1", "PC2"), "pcs"), "ID string, PC1 double, PC2 double")
)
query("S19_scan_passing_metadata", sql_of("SELECT chrom, begin_pos, end_pos, site_key, keep_site FROM sites WHERE keep_site", "sites"))(lambda d: _passing(d))
query("S20_scan_vcf", sql_of("SELECT * FROM genotypes WHERE gt <> './.'", "genotypes"))(lambda d: R.scan_vcf(d.spark, _vcf(d)).where("gt <> './.'"))


def _parquet(df: DataFrame, tag: str) -> str:
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return path


def _round_trip_qc(d: Data) -> DataFrame:
    from ..operators import calls as C

    qc = C.sample_qc(d.calls, d.kept, d.flagged, d.coverage)
    parts = [_tsv(qc.where(w), "sample-qc") for w in ("sample_id < 'S05'", "sample_id >= 'S05'")]
    return R.scan_sample_qc(d.spark, parts, ", ".join(f"{n} {t}" for n, t in qc.dtypes), d.samples.count())


def _long_calls(d: Data) -> DataFrame:
    """Filtered calls of two shards, written and read again."""
    flagged = keep(d.flagged, "flagged")  # two shards are made of it
    rows = flagged.withColumnsRenamed({"chrom": "#chrom", "begin_pos": "begin", "end_pos": "end"})
    rows = rows.select("sample_id", *[c for c in rows.columns if c != "sample_id"])
    paths = [scratch(d.spark, "long-calls") for _ in range(2)]
    for path, part in zip(paths, ("sample_id < 'S05'", "sample_id >= 'S05'"), strict=True):
        W.write_table(rows.where(part), path)
    return R.scan_long_calls(d.spark, paths, {n: t for n, t in flagged.dtypes if n not in R.LONG_CALLS}).select(flagged.columns)


def _bed_written(d: Data) -> DataFrame:
    path = scratch(d.spark, "bed")
    W.write_phenotype_bed(d.longs.select("chrom", F.col("begin_pos").alias("start_pos"), "end_pos", F.col("site_key").alias("phenotype_id"), "sample_id", "value"), SAMPLES, path)
    return R.tsv(d.spark, path, "`#chr` string, start bigint, end bigint, phenotype_id string, " + ", ".join(f"{s} double" for s in SAMPLES))


def _passing(d: Data) -> DataFrame:
    rows = d.sites.where("keep_site").select(*H.SITE, "keep_site")
    back = R.tsv(d.spark, _tsv(rows, "passing"), ", ".join(f"{n} {t}" for n, t in rows.dtypes))
    Q.require(back.where("not coalesce(keep_site, false)"), "a site does not pass")
    Q.require(Q.bad_intervals(back, "begin_pos", "end_pos"), "a site's place is wrong")
    return back


def _by_chrom(d: Data, form: str) -> DataFrame:
    path = scratch(d.spark, "by-chrom")
    W.write_by_chrom(d.flagged, path, form)
    schema = ", ".join(f"{n} {t}" for n, t in d.flagged.dtypes)
    back = d.spark.read.parquet(path) if form == "parquet" else d.spark.read.schema(schema).options(sep="\t", header=True, nullValue="NA").csv(path)
    return back.select(d.flagged.columns)


query("S05_scan_long_calls", sql_of("SELECT * FROM flagged", "flagged", doubles=FLAGGED_DOUBLES))(_long_calls)
query("S12_scan_npx", sql_of("SELECT * FROM npx", "npx", doubles=("NPX",)))(lambda d: R.scan_npx(d.spark, _parquet(d.npx, "npx"), PLATE))
query("S13_scan_protein", sql_of("SELECT SampleID, Assay, NPX FROM npx", "npx", doubles=("NPX",)))(lambda d: R.scan_protein(d.spark, _parquet(d.npx.select("SampleID", "Assay", "NPX"), "protein") + "/*.parquet"))
query("K01_write_by_chrom", sql_of("SELECT * FROM flagged", "flagged", doubles=FLAGGED_DOUBLES))(lambda d: _by_chrom(d, "tsv"))
query("K02_write_table", sql_of("SELECT * FROM metrics", "metrics", doubles=METRIC_DOUBLES, digits=FINE), digits=FINE)(lambda d: _table(d))
query("K03_write_phenotype_bed", sql_of(f"SELECT chrom AS \"#chr\", begin_pos AS start, end_pos AS \"end\", site_key AS phenotype_id, {PIVOT.format(v='value')} FROM longs GROUP BY 1, 2, 3, 4", "longs", doubles=tuple(SAMPLES)))(_bed_written)
MERGED = " UNION ALL ".join(f"SELECT '{c}' AS ID, {PIVOT.format(v=c)} FROM (SELECT DISTINCT c.*, lib_size FROM covariates c JOIN libs USING (sample_id))" for c in ("gpc1", "gpc2", "lib_size"))
query("X12_merge_covariates", sql_of(MERGED, "covariates", "libs", doubles=tuple(SAMPLES)))(lambda d: _merged_covariates(d))
query("K04_write_covariate_matrix", SQL["O12_transpose"])(lambda d: R.tsv(d.spark, _tsv(V.covariate_matrix(d.covariates, SAMPLES), "covariates"), "ID string, " + ", ".join(f"{s} double" for s in SAMPLES)))


def _merged_covariates(d: Data) -> DataFrame:
    """PCs (library sizes in their place) with the covariates of the same samples, covariate-major, written and read back."""
    path = scratch(d.spark, "merged")
    W.write_table(V.covariate_matrix(V.merge_covariates(d.covariates, E.library_sizes(d.expressed).withColumnRenamed("sample_id", "ID")), SAMPLES), path)
    return R.tsv(d.spark, path, "ID string, " + ", ".join(f"{s} double" for s in SAMPLES))


def _table(d: Data) -> DataFrame:
    path = scratch(d.spark, "table")
    W.write_table(d.metrics, path)
    return R.tsv(d.spark, path, ", ".join(f"{n} {t}" for n, t in d.metrics.dtypes))
