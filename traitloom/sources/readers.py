"""Text sources of the engine. Ids stay text; schemas are given, never inferred, but for sample columns, which come from the header."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import expect
from .shared import keep

CALLS = "chrom string, begin_pos long, end_pos long, mod_score double, type string, cov double"
CCRES = "chrom string, ccre_begin long, ccre_end long, ccre_v4_id string, ccre_v5_id string, ccre_type string"
ISLANDS = "bin int, chrom string, chrom_start long, chrom_end long, name string, length int, cpg_num int, gc_num int, per_cpg double, per_gc double, obs_exp double"
GTF = "seqname string, source string, type string, start_pos long, end_pos long, score string, strand string, frame string, attributes string"
MISSING = ("", "NA", "NaN", ".")


def tsv(spark: SparkSession, paths, schema: str | None = None, header: bool = True, comment: str | None = None) -> DataFrame:
    reader = spark.read.options(sep="\t", header=header, nullValue="NA", mode="FAILFAST" if schema else "PERMISSIVE")
    reader = reader.option("comment", comment) if comment else reader
    return (reader.schema(schema) if schema else reader).csv(paths)


def file_lines(spark: SparkSession, paths) -> DataFrame:
    """value and file: every line of the files and the path that it comes from."""
    return spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"))


def by_own_header(lines: DataFrame, wanted: dict[str, str], mark: str, rename: dict[str, str], bare: list[str] | None, label: str) -> DataFrame:
    """file and the wanted columns (name: type) of lines, each found by the header of its own file: the line that starts with mark. Files
    may differ in the order of their columns and in others. Without a header the columns are those of bare, or it is an error."""
    heads = lines.where(F.col("value").startswith(mark)).groupBy("file").agg(F.min(F.regexp_replace("value", "^#", "")).alias("head"))
    heads = heads.select("file", F.transform(F.split("head", "\t"), lambda n: F.coalesce(*[F.when(n == a, F.lit(b)) for a, b in rename.items()], n) if rename else n).alias("names"))
    lacking = heads.select("file", F.array_except(F.array(*map(F.lit, wanted)), "names").alias("lacking")).where(F.size("lacking") > 0)
    expect.require(lacking, f"{label} files lack columns")
    rows = lines.where(~F.col("value").startswith("#") & ~F.col("value").startswith(mark) & (F.trim("value") != "")).join(heads, "file", "left")  # a row a file
    names = F.coalesce("names", F.array(*map(F.lit, bare))) if bare else F.coalesce("names", F.raise_error(F.concat(F.lit(f"{label}: no header in "), "file")).cast("array<string>"))
    rows = rows.select("file", names.alias("names"), F.split("value", "\t", -1).alias("x"))
    text = lambda n: F.get("x", F.array_position("names", n).cast("int") - 1)
    short = F.size("x") < (F.lit(len(wanted)) if bare else F.size("names"))
    cells = [F.when(short, F.raise_error(F.concat(F.lit(f"{label}: a line has too few fields in "), "file")).cast(t)).otherwise(F.when(~text(n).isin(*MISSING[:3]), text(n)).cast(t)).alias(n) for n, t in wanted.items()]
    return rows.select("file", *cells)


def scan_calls(spark: SparkSession, paths, with_file: bool = False) -> DataFrame:
    """Call BED files: the six columns by the names of each file's header (#chrom, begin, end, mod_score, type, cov), in whatever order
    and among whatever others; comment lines start with #. Files without a header hold the six first."""
    wanted = dict(c.split() for c in CALLS.split(", "))
    rows = by_own_header(file_lines(spark, paths), wanted, "#chrom\t", {"begin": "begin_pos", "end": "end_pos"}, list(wanted), "call")
    return rows if with_file else rows.drop("file")


def resolved(spark: SparkSession, rows: DataFrame, folder: str, label: str, must_exist: bool) -> DataFrame:
    """rows with file_path whole: relative ones count from folder, ~ is the home folder; one that doesn't exist is an error."""
    home = os.path.expanduser("~")
    path = F.when(F.col("file_path").rlike("^~(/|$)"), F.concat(F.lit(home), F.substring("file_path", 2, 10_000)))
    path = path.when(F.col("file_path").rlike("^(/|[a-z0-9]+:)"), F.col("file_path")).otherwise(F.concat(F.lit(folder + "/"), "file_path"))
    out = rows.withColumn("file_path", path)
    if must_exist:
        hadoop, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
        lost = [r["file_path"] for r in out.select("file_path").toLocalIterator() if not (p := hadoop(r["file_path"])).getFileSystem(conf).exists(p)]  # a row a file
        if lost:
            raise ValueError(f"{label} files do not exist: {lost[:5]}")
    return out


def scan_path_list(spark: SparkSession, path: str, label: str = "listed", must_exist: bool = True) -> DataFrame:
    """file_path: the paths of a list, apart by white space; relative ones count from the list's folder. A list without any, or a file
    that is not there, is an error."""
    rows = spark.read.text(path).select(F.explode(F.split(F.trim("value"), r"\s+")).alias("file_path")).where("file_path <> ''")
    if rows.isEmpty():
        raise ValueError(f"{path} lists no paths")
    return resolved(spark, rows, path.rsplit("/", 1)[0], label, must_exist)


def scan_manifest(spark: SparkSession, path: str, must_exist: bool = True) -> DataFrame:
    """sample_id and file_path; relative paths count from the manifest's folder. Blank ids or paths, repeated ids and files that are
    not there are errors."""
    folder = path.rsplit("/", 1)[0]
    wide = tsv(spark, path)
    expect.require_columns(wide, ["sample_id", "file_path"])
    rows = wide.select(F.col("sample_id").cast("string").alias("sample_id"), F.col("file_path").cast("string").alias("file_path"))
    expect.require(expect.blank_keys(rows, "sample_id"), "blank sample ids in the manifest")
    expect.require(expect.blank_keys(rows, "file_path"), "blank paths in the manifest")
    expect.require(expect.repeated_keys(rows, "sample_id"), "repeated sample ids in the manifest")
    return resolved(spark, rows, folder, "manifest", must_exist)


def scan_manifest_calls(spark: SparkSession, path: str) -> DataFrame:
    """Calls of every sample of a manifest, each from its own file (or folder of parts), with sample_id. All files are one scan; a file's
    columns are those of its own header."""
    listed = [(r["sample_id"], r["file_path"]) for r in scan_manifest(spark, path).collect()]  # a row a sample
    hadoop, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    whole = [(s, hadoop(f).getFileSystem(conf).makeQualified(hadoop(f)).toString()) for s, f in listed]
    of = spark.createDataFrame(whole, "sample_id string, at string")
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    calls = scan_calls(spark, [f for _, f in listed], with_file=True).withColumn("file", plain("file"))
    own = of.withColumn("at", plain("at"))
    named = calls.select("file").distinct().withColumn("at", F.explode(F.array("file", F.regexp_replace("file", "/[^/]*$", "")))).join(own, "at").select("file", "sample_id")
    return calls.join(named, "file").drop("file")


#: Columns that every table of filtered calls has. Fixed values.
LONG_CALLS = {"sample_id": "string", "chrom": "string", "begin_pos": "bigint", "end_pos": "bigint", "cov": "double", "site_key": "string"}


def scan_long_calls(spark: SparkSession, paths, more: dict[str, str] | None = None) -> DataFrame:
    """Filtered calls of all shards: TSV files with the columns of LONG_CALLS and those of more (name: type), told by each file's header,
    all headers alike. A call that comes twice for a sample and site is an error."""
    wanted = LONG_CALLS | (more or {})
    lines = file_lines(spark, paths)
    heads = lines.where(F.col("value").startswith("sample_id\t")).select("value").distinct()
    expect.require(heads.agg(F.count(F.lit(1)).alias("headers")).where("headers > 1"), "tables of calls differ in their columns")
    parsed = by_own_header(lines, wanted, "sample_id\t", {"#chrom": "chrom", "begin": "begin_pos", "end": "end_pos"}, None, "filtered call").drop("file")
    rows = keep(parsed, "filtered-calls")  # texts are parsed once, for the check and for what reads the rows
    expect.require(expect.repeated_keys(rows, "sample_id", "site_key"), "a call comes twice")
    return rows


def scan_sample_qc(spark: SparkSession, paths, schema: str, total: int | None = None) -> DataFrame:
    """Sample tables of all shards as one: blank and repeated samples are errors, and so is another number of them than total."""
    rows = tsv(spark, paths, schema)
    expect.require_columns(rows, ["sample_id"])
    expect.require(expect.blank_keys(rows, "sample_id"), "blank sample ids")
    expect.require(expect.repeated_keys(rows, "sample_id"), "a sample comes twice")
    if total is not None and (n := rows.count()) != total:
        raise ValueError(f"{n} samples, where {total} are expected")
    return rows


def scan_cohort_samples(spark: SparkSession, path: str, total: int | None = None) -> DataFrame:
    return scan_sample_qc(spark, path, "sample_id string", total)


#: Columns of NPX files that the preparation reads. Fixed values.
NPX = ["SampleID", "PlateID", "AssayType", "OlinkID", "UniProt", "Assay", "SampleQC", "AssayQC", "NPX"]


def scan_npx(spark: SparkSession, folder: str, plate: str | None = None) -> DataFrame:
    """The Parquet files of a folder; one without rows or without a needed column is an error, and so is a reference plate that no
    row is of."""
    rows = spark.read.parquet(folder)
    expect.require_columns(rows, NPX)
    expect.require_some(rows, f"NPX rows in {folder}")
    if plate is not None:
        expect.require_some(rows.where(F.col("PlateID") == plate), f"rows of the reference plate {plate}")
    return rows


def scan_cohort_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row a sample and chromosome: sample_id, sample_qc, autosome, file_path."""
    wide = tsv(spark, path)
    return wide.unpivot(["sample_id", "sample_qc"], [c for c in wide.columns if c.startswith("autosome")], "autosome", "file_path")


def scan_gct(spark: SparkSession, path: str, samples: list[str] | None = None) -> DataFrame:
    """Long counts of a GCT file: its header line starts with Name and Description. Lines are told apart by their fields."""
    found = spark.read.text(path).where(F.col("value").startswith("Name\tDescription\t")).limit(1).collect()
    if not found:
        raise ValueError(f"{path}: no header line of a GCT file")
    head = found[0]["value"].split("\t")
    rows = spark.read.text(path).select(F.split("value", "\t", -1).alias("x")).where((F.size("x") == len(head)) & (F.get("x", F.lit(0)) != head[0]))
    wanted = [(i, s) for i, s in enumerate(head) if i > 1 and (samples is None or s in samples)]
    cells = F.explode(F.array(*[F.struct(F.lit(s).alias("sample_id"), F.get("x", F.lit(i)).cast("double").alias("cnt")) for i, s in wanted]))
    return rows.select(F.get("x", F.lit(0)).alias("gene_id"), cells.alias("c")).select("gene_id", "c.*")


def scan_gtf(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    rows = tsv(spark, path, GTF, header=False, comment="#")
    attribute = lambda name: F.nullif(F.regexp_extract("attributes", f'{name} "([^"]*)"', 1), F.lit("")).alias(name)
    rows = rows.select(F.col("seqname").alias("chrom"), "type", "start_pos", "end_pos", "strand", attribute("gene_id"), attribute("gene_name"))
    return rows.where(F.col("type") == kind) if kind else rows


def scan_ccres(spark: SparkSession, path: str) -> DataFrame:
    return tsv(spark, path, CCRES, header=False)


def scan_islands(spark: SparkSession, path: str) -> DataFrame:
    """CpG islands by named columns, or without a header in the browser's order."""
    first = spark.read.text(path).first()
    if first and "chromStart" in first.value:
        named = tsv(spark, path)
        return named.select("chrom", F.col("chromStart").cast("long").alias("chrom_start"), F.col("chromEnd").cast("long").alias("chrom_end"), "name")
    return tsv(spark, path, ISLANDS, header=False).select("chrom", "chrom_start", "chrom_end", "name")


def scan_sample_list(spark: SparkSession, path: str, header: str = "no") -> DataFrame:
    """First column of each line as sample_id. header: yes, no, or auto (the first line counts as one if it has a letter)."""
    if header == "auto":
        first = spark.read.text(path).first()
        header = "yes" if first and any(c.isalpha() for c in first.value) else "no"
    rows = tsv(spark, path, header=header == "yes")
    return rows.select(F.col(f"`{rows.columns[0]}`").cast("string").alias("sample_id"))


def scan_protein(spark: SparkSession, path: str) -> DataFrame:
    if path.endswith((".tsv", ".tsv.gz")):
        return tsv(spark, path)
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    raise ValueError(f"{path}: neither TSV nor Parquet")


def scan_phenotype_bed(spark: SparkSession, path: str, feature: str = "phenotype_id") -> DataFrame:
    """Long rows (chrom, start_pos, end_pos, feature, sample_id, value) of a wide BED; text that is no number is an error."""
    wide = spark.read.options(sep="\t", header=True).csv(path)
    samples = wide.columns[4:]
    named = wide.toDF("chrom", "start_pos", "end_pos", feature, *samples).withColumns({c: F.col(c).cast("long") for c in ("start_pos", "end_pos")})
    long = named.unpivot(["chrom", "start_pos", "end_pos", feature], samples, "sample_id", "text")
    value = F.when(F.col("text").isin(*MISSING), None).otherwise(F.col("text").cast("double"))
    return long.withColumn("value", value).drop("text")


def scan_covariate_matrix(spark: SparkSession, path: str) -> DataFrame:
    """Covariate-major text to long rows (ID, sample_id, value)."""
    wide = spark.read.options(sep="\t", header=True).csv(path)
    return wide.unpivot([wide.columns[0]], wide.columns[1:], "sample_id", "text").select(F.col(wide.columns[0]).alias("ID"), "sample_id", F.when(~F.col("text").isin(*MISSING), F.col("text")).cast("double").alias("value"))


def scan_vcf(spark: SparkSession, path: str) -> DataFrame:
    """Long genotypes (chrom, pos, ref, alt, sample_id, gt)."""
    lines = spark.read.text(path)
    head = lines.where(F.col("value").startswith("#CHROM")).first().value.split("\t")
    rows = lines.where(~F.col("value").startswith("#")).select(F.split("value", "\t").alias("x"))
    cells = rows.select("x", F.posexplode(F.slice("x", 10, len(head) - 9)).alias("i", "cell"))
    sample = F.get(F.array(*map(F.lit, head[9:])), F.col("i"))
    part = lambda i: F.get("x", F.lit(i))
    return cells.select(part(0).alias("chrom"), part(1).cast("long").alias("pos"), part(3).alias("ref"), part(4).alias("alt"), sample.alias("sample_id"), F.get(F.split("cell", ":"), F.lit(0)).alias("gt"))
