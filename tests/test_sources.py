"""Sources read back what sinks and other tools write."""

import gzip
import os

import pytest

from traitloom.plans import fixtures
from traitloom.sources import readers, writers

SF = "/root/testdata/sf0.001"


def test_calls(spark, tmp_path):
    text = "##version=1\n#chrom\tbegin\tend\tmod_score\ttype\tcov\tm\tn\to\nchr1\t5\t6\t12.5\ttotal\t11\t1\t2\t3\nchr2\t7\t8\t1\ttotal\tNA\t1\t2\t3\n"
    with gzip.open(tmp_path / "a.bed.gz", "wt") as f:
        f.write(text)
    rows = readers.scan_calls(spark, str(tmp_path / "a.bed.gz")).collect()
    assert [tuple(r) for r in rows] == [("chr1", 5, 6, 12.5, "total", 11.0), ("chr2", 7, 8, 1.0, "total", None)]


def test_manifests_and_lists(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("sample_id\tfile_path\n007\ta.bed\nb\t/x/b.bed\nc\ts3a://k/c.bed\n")
    assert [tuple(r) for r in readers.scan_manifest(spark, f"{tmp_path}/m.tsv", must_exist=False).collect()] == [("007", f"{tmp_path}/a.bed"), ("b", "/x/b.bed"), ("c", "s3a://k/c.bed")]
    (tmp_path / "c.tsv").write_text("sample_id\tsample_qc\tautosome01\tautosome02\ns\tq\tp1\tp2\n")
    assert {(r.autosome, r.file_path) for r in readers.scan_cohort_manifest(spark, f"{tmp_path}/c.tsv").collect()} == {("autosome01", "p1"), ("autosome02", "p2")}
    (tmp_path / "l.txt").write_text("S01\n02\n")
    (tmp_path / "d.txt").write_text("01\n02\n")
    read = lambda f, h: [r.sample_id for r in readers.scan_sample_list(spark, f"{tmp_path}/{f}", h).collect()]
    assert read("l.txt", "no") == ["S01", "02"] and read("l.txt", "yes") == ["02"] and read("l.txt", "auto") == ["02"] and read("d.txt", "auto") == ["01", "02"]


def test_counts_and_genes(spark, tmp_path):
    (tmp_path / "a.gct").write_text("#1.2\n2\t2\nName\tDescription\tA\tB\ng1\td\t3\t4\ng2\td\t5\t6\n")
    assert sorted(tuple(r) for r in readers.scan_gct(spark, f"{tmp_path}/a.gct", ["B"]).collect()) == [("g1", "B", 4.0), ("g2", "B", 6.0)]
    (tmp_path / "a.gtf").write_text('#x\nchr1\th\tgene\t5\t9\t.\t+\t.\tgene_id "E1"; gene_name "N";\nchr1\th\texon\t5\t6\t.\t+\t.\tgene_id "E1";\n')
    assert [tuple(r) for r in readers.scan_gtf(spark, f"{tmp_path}/a.gtf", "exon").collect()] == [("chr1", "exon", 5, 6, "+", "E1", None)]


def test_intervals(spark, tmp_path):
    (tmp_path / "named").write_text("name\tchrom\tchromStart\tchromEnd\nx\tchr1\t1\t2\n")
    (tmp_path / "bare").write_text("1\tchr1\t1\t2\tx\t1\t1\t1\t1\t1\t1\n")
    (tmp_path / "ccre").write_text("chr1\t1\t2\tA\tB\tdELS\n")
    assert [[tuple(r) for r in readers.scan_islands(spark, f"{tmp_path}/{f}").collect()] for f in ("named", "bare")] == [[("chr1", 1, 2, "x")]] * 2
    assert readers.scan_ccres(spark, f"{tmp_path}/ccre").first().ccre_type == "dELS"


def test_matrices_round_trip(spark, tmp_path):
    long = spark.createDataFrame([("chr1", 1, 2, "p", "S1", 0.5), ("chr1", 1, 2, "p", "S2", None), ("chr1", 0, 1, "q", "S1", -1.0)], "chrom string, start_pos long, end_pos long, phenotype_id string, sample_id string, value double")
    wide = writers.phenotype_bed(long, ["S1", "S2"])
    assert wide.columns == ["#chr", "start", "end", "phenotype_id", "S1", "S2"] and [r.phenotype_id for r in wide.collect()] == ["q", "p"]
    writers.write_table(wide.coalesce(1), f"{tmp_path}/bed")
    back = readers.scan_phenotype_bed(spark, f"{tmp_path}/bed").where("value is not null")
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in long.where("value is not null").collect())
    (tmp_path / "cov").write_text("ID\tS1\tS2\nage\t3\tNA\n")
    assert sorted((tuple(r) for r in readers.scan_covariate_matrix(spark, f"{tmp_path}/cov").collect()), key=str) == [("age", "S1", 3.0), ("age", "S2", None)]


def test_vcf_round_trip(spark, tmp_path):
    calls = [tuple(r) for r in fixtures.view(spark, SF, "genotypes").where("sample_id in ('S00', 'S01')").collect()]
    by_site = {}
    for chrom, pos, ref, alt, sample, gt in calls:
        by_site.setdefault((chrom, pos, ref, alt), {})[sample] = gt
    lines = ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS00\tS01"]
    lines += [f"{c}\t{p}\t.\t{r}\t{a}\t.\t.\t.\tGT:DP\t{g.get('S00', './.')}:1\t{g.get('S01', './.')}:2" for (c, p, r, a), g in by_site.items()]
    (tmp_path / "a.vcf").write_text("\n".join(lines) + "\n")
    back = {(r.chrom, r.pos, r.sample_id): r.gt for r in readers.scan_vcf(spark, f"{tmp_path}/a.vcf").collect()}
    assert all(back[c, p, s] == gt for c, p, _, _, s, gt in calls) and len(back) == 2 * len(by_site)


def test_partitioned_calls_and_protein(spark, tmp_path):
    calls = fixtures.view(spark, SF, "calls")
    writers.write_by_chrom(calls, f"{tmp_path}/calls.parquet")
    assert spark.read.parquet(f"{tmp_path}/calls.parquet").count() == calls.count() and (tmp_path / "calls.parquet" / "chrom=chr3").is_dir()
    assert readers.scan_protein(spark, f"{tmp_path}/calls.parquet").count() == calls.count()
    empty = calls.limit(0)
    writers.write_table(empty.coalesce(1), f"{tmp_path}/none")
    assert readers.tsv(spark, f"{tmp_path}/none").count() == 0


def test_calls_by_header_and_checks(spark, tmp_path):
    (tmp_path / "b.bed").write_text("#chrom\tcov\tnote\tbegin\tend\ttype\tmod_score\nchr1\t11\tx\t5\t6\ttotal\t12.5\n")
    assert [tuple(r) for r in readers.scan_calls(spark, str(tmp_path / "b.bed")).collect()] == [("chr1", 5, 6, 12.5, "total", 11.0)]
    (tmp_path / "c.bed").write_text("#chrom\tbegin\tend\nchr1\t5\t6\n")
    with pytest.raises(ValueError, match="mod_score"):
        readers.scan_calls(spark, str(tmp_path / "c.bed"))
    (tmp_path / "twice.tsv").write_text("sample_id\tfile_path\na\tx\na\ty\n")
    with pytest.raises(ValueError, match="repeated"):
        readers.scan_manifest(spark, f"{tmp_path}/twice.tsv")
    (tmp_path / "paths").write_text("/a\n\n b.bed  ~/q \n")
    (tmp_path / "none").write_text("\n")
    listed = sorted(r.file_path for r in readers.scan_path_list(spark, f"{tmp_path}/paths", must_exist=False).collect())
    assert listed == sorted(["/a", f"{tmp_path}/b.bed", f"{os.path.expanduser('~')}/q"])
    with pytest.raises(ValueError, match="do not exist.*/a"):
        readers.scan_path_list(spark, f"{tmp_path}/paths")
    for text, what in (("sample_id\tfile_path\na\tnowhere.bed\n", "do not exist"), ("sample_id\tfile_path\na\tNA\n", "blank paths"), ("sample_id\tpath\na\tx\n", "missing")):
        (tmp_path / "bad.tsv").write_text(text)
        with pytest.raises(ValueError, match=what):
            readers.scan_manifest(spark, f"{tmp_path}/bad.tsv")
    with pytest.raises(ValueError, match="no paths"):
        readers.scan_path_list(spark, f"{tmp_path}/none")


def test_ranges_names_and_numbers(spark):
    from pyspark.sql import functions as F

    from traitloom.functions.stats import number_text
    from traitloom.operators import covariates, expect

    expect.require_range("fraction", 0.5, 0, 1)
    for bad in (1.5, -1, float("nan")):
        with pytest.raises(ValueError, match="fraction"):
            expect.require_range("fraction", bad, 0, 1)
    with pytest.raises(ValueError, match="none is left"):
        expect.require_some(spark.range(0), "samples")
    expect.require_some(spark.range(1), "samples")
    assert covariates.unique_names(["a b", "a.b", "a b", "1x", "_y"]) == ["a.b", "a.b.1", "a.b.2", "X1x", "X_y"]
    frame = spark.createDataFrame([(1.5,), (None,), (float("nan"),), (float("inf"),), (float("-inf"),)], "x double")
    assert [r.t for r in frame.select(number_text(F.col("x")).alias("t")).collect()] == ["1.5", "NA", "NA", "Inf", "-Inf"]


def test_files_of_other_orders_in_one_call(spark, tmp_path):
    """Each file is read by its own header, or by none; what they hold beside the columns doesn't matter."""
    (tmp_path / "a.bed").write_text("#chrom\tbegin\tend\tmod_score\ttype\tcov\nchr1\t5\t6\t12.5\ttotal\t11\n")
    (tmp_path / "b.bed").write_text("##x\n#chrom\tcov\ttype\tmod_score\tend\tbegin\tmore\nchr2\t7\ttotal\t1.5\t9\t8\tz\n")
    (tmp_path / "c.bed").write_text("chr3\t1\t2\tNA\ttotal\t3\n")
    rows = readers.scan_calls(spark, [f"{tmp_path}/{f}.bed" for f in "abc"]).collect()
    assert sorted(tuple(r) for r in rows) == [("chr1", 5, 6, 12.5, "total", 11.0), ("chr2", 8, 9, 1.5, "total", 7.0), ("chr3", 1, 2, None, "total", 3.0)]
    (tmp_path / "m.tsv").write_text("file_path\tsample_id\na.bed\t01\nb.bed\tx\n")
    assert sorted((r.sample_id, r.chrom, r.begin_pos) for r in readers.scan_manifest_calls(spark, f"{tmp_path}/m.tsv").collect()) == [("01", "chr1", 5), ("x", "chr2", 8)]
    (tmp_path / "d.bed").write_text("chr3\t1\t2\n")
    with pytest.raises(Exception, match="too few fields"):
        readers.scan_calls(spark, f"{tmp_path}/d.bed").collect()


def test_tables_of_shards_are_checked(spark, tmp_path):
    head = "sample_id\t#chrom\tbegin\tend\tcov\tsite_key"
    (tmp_path / "a.tsv").write_text(f"{head}\n01\tchr1\t1\t2\t5\tk\n")
    (tmp_path / "b.tsv").write_text(f"{head}\n02\tchr1\t1\t2\tNA\tk\n")
    (tmp_path / "again.tsv").write_text(f"{head}\n01\tchr1\t1\t2\t6\tk\n")
    (tmp_path / "other.tsv").write_text("sample_id\tcov\t#chrom\tbegin\tend\tsite_key\n03\t5\tchr1\t1\t2\tk\n")
    (tmp_path / "less.tsv").write_text("sample_id\t#chrom\n03\tchr1\n")
    read = lambda *f: readers.scan_long_calls(spark, [f"{tmp_path}/{x}.tsv" for x in f])
    assert sorted((r.sample_id, r.cov) for r in read("a", "b").collect()) == [("01", 5.0), ("02", None)]
    for files, what in ((("a", "again"), "twice"), (("a", "other"), "differ"), (("less",), "lack columns")):
        with pytest.raises(ValueError, match=what):
            read(*files)
    (tmp_path / "q1").write_text("sample_id\tn\n01\t3\n")
    (tmp_path / "q2").write_text("sample_id\tn\n01\t4\n")
    assert readers.scan_sample_qc(spark, f"{tmp_path}/q1", "sample_id string, n int", 1).first().sample_id == "01"
    with pytest.raises(ValueError, match="twice"):
        readers.scan_sample_qc(spark, [f"{tmp_path}/q1", f"{tmp_path}/q2"], "sample_id string, n int")
    with pytest.raises(ValueError, match="1 samples, where 2"):
        readers.scan_sample_qc(spark, f"{tmp_path}/q1", "sample_id string, n int", 2)
    npx = fixtures.view(spark, SF, "npx")
    npx.write.parquet(f"{tmp_path}/npx")
    assert readers.scan_npx(spark, f"{tmp_path}/npx", "PLATE0").count() == npx.count()
    with pytest.raises(ValueError, match="reference plate"):
        readers.scan_npx(spark, f"{tmp_path}/npx", "PLATE9")


def test_empty_autosomes_and_numbers_in_files(spark, tmp_path):
    calls = spark.createDataFrame([("chr2", 5, 6, 1.5), ("chr2", 30_000_000, 30_000_001, float("inf")), ("chr2", 8, 9, float("nan")), ("chr2", 9, 10, None)], "chrom string, begin_pos long, end_pos long, cov double")
    writers.write_by_chrom(calls, f"{tmp_path}/out", "tsv")
    assert len([x for x in (tmp_path / "out").iterdir() if x.name.startswith("chrom=")]) == 22
    one = readers.tsv(spark, f"{tmp_path}/out/chrom=chr7", "begin_pos long, end_pos long, cov double")
    assert one.count() == 0 and next((tmp_path / "out" / "chrom=chr7").glob("part*")).stat().st_size > 20  # its header
    back = readers.tsv(spark, f"{tmp_path}/out/chrom=chr2", "begin_pos long, end_pos long, cov double")
    assert {r.begin_pos: r.cov for r in back.collect()} == {5: 1.5, 30_000_000: float("inf"), 8: None, 9: None}
    writers.write_by_chrom(calls, f"{tmp_path}/parquet")
    assert spark.read.parquet(f"{tmp_path}/parquet").count() == 4 and (tmp_path / "parquet" / "chrom=chr22").is_dir()
    with pytest.raises(Exception, match="already exists"):
        writers.write_by_chrom(calls, f"{tmp_path}/out", "tsv")
