"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import number_text
from ..operators.calls import AUTOSOMES


def as_text(df: DataFrame) -> DataFrame:
    """df with doubles as the tables write them: NA, Inf and -Inf where they are no numbers."""
    return df.select(*[number_text(F.col(f"`{c}`")).alias(c) if t in ("double", "float") else F.col(f"`{c}`") for c, t in df.dtypes])


#: Base pairs of a chromosome that are written by one task.
SLICE = 10_000_000


def write_by_chrom(calls: DataFrame, path: str, form: str = "parquet", prefix: str = "chr") -> None:
    """One folder a chromosome, as Parquet or gzipped TSV; an autosome without calls has an empty table. Rows are dealt out by stretches
    of a chromosome first, so a folder holds as many files as it has stretches and no task a chromosome."""
    rows = calls if form == "parquet" else as_text(calls)
    write = lambda df: df.write.mode("errorifexists").options(**({} if form == "parquet" else {"sep": "\t", "header": True, "nullValue": "NA", "compression": "gzip", "comment": "\u0001"}))
    save = lambda writer, where: writer.parquet(where) if form == "parquet" else writer.csv(where)
    save(write(rows.repartition("chrom", F.floor(F.col("begin_pos") / SLICE))).partitionBy("chrom"), path)
    spark = calls.sparkSession
    hadoop, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    empty = spark.createDataFrame([], rows.drop("chrom").schema).coalesce(1)
    for n in AUTOSOMES:
        folder = f"{path}/chrom={prefix}{n}"
        if not (p := hadoop(folder)).getFileSystem(conf).exists(p):
            save(write(empty), folder)


def write_table(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """TSV with NA for null; an empty table still has its header."""
    as_text(df).write.mode("errorifexists").options(sep="\t", header=True, nullValue="NA", compression=compression, comment="\u0001").csv(path)


def write_phenotype_bed(long: DataFrame, samples: list[str], path: str, feature: str = "phenotype_id", value: str = "value") -> None:
    """A wide BED, sorted by place over its files; a sample without a value has a column of NA."""
    write_table(phenotype_bed(long, samples, feature, value), path)


def phenotype_bed(long: DataFrame, samples: list[str], feature: str = "phenotype_id", value: str = "value") -> DataFrame:
    """Long rows (chrom, start_pos, end_pos, feature, sample_id, value) to one column a sample, sorted by place."""
    wide = long.groupBy("chrom", "start_pos", "end_pos", feature).pivot("sample_id", samples).agg(F.first(value))
    return wide.orderBy("chrom", "start_pos", "end_pos", feature).withColumnsRenamed({"chrom": "#chr", "start_pos": "start", "end_pos": "end"})
