"""Joins of genomic intervals, 1-based and closed, and site annotation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ordered


def from_bed(df: DataFrame, start: str, end: str) -> DataFrame:
    """0-based half-open to 1-based closed."""
    return df.withColumns({start: F.col(start) + 1, end: F.col(end)})


def gene_tss(genes: DataFrame) -> DataFrame:
    """Start on +, otherwise end, as a 0-based one-base interval."""
    tss = F.when(F.col("strand") == "+", F.col("start_pos")).otherwise(F.col("end_pos"))
    return genes.select("gene_id", "gene_name", "chrom", "strand", (tss - 1).alias("tss_start"), tss.alias("tss_end"))


def annotation_tss(genes: DataFrame) -> DataFrame:
    """End on -, otherwise start."""
    return genes.withColumn("tss", F.when(F.col("strand") == "-", F.col("end_pos")).otherwise(F.col("start_pos")))


def promoters(genes: DataFrame, window: int = 2000) -> DataFrame:
    with_tss = annotation_tss(genes)
    return with_tss.select("gene_id", "gene_name", "chrom", F.greatest(F.lit(1), F.col("tss") - window).alias("start_pos"), (F.col("tss") + window).alias("end_pos"))


def expand(df: DataFrame, bases: int, start: str = "start_pos", end: str = "end_pos") -> DataFrame:
    return df.withColumns({start: F.greatest(F.lit(1), F.col(start) - bases), end: F.col(end) + bases})


def _bins(start: Column, end: Column, size: int) -> Column:
    return F.explode(F.sequence(F.floor(start / size), F.floor(end / size)))


def overlap_join(sites: DataFrame, features: DataFrame, bin_size: int = 5000) -> DataFrame:
    """Pairs of sites (chrom, start_pos, end_pos, …) and features (the same) that overlap; columns of features come with the prefix f_.

    Both sides meet by (chrom, bin) and each pair is kept in the first bin that it shares, so the join is a hash join on keys
    that cut chromosomes into pieces, never a product.
    """
    a = sites.withColumn("__bin", _bins(F.col("start_pos"), F.col("end_pos"), bin_size))
    b = features.select(F.col("chrom"), *[F.col(c).alias(f"f_{c}") for c in features.columns if c != "chrom"])
    b = b.withColumn("__bin", _bins(F.col("f_start_pos"), F.col("f_end_pos"), bin_size))
    first = F.floor(F.greatest("start_pos", "f_start_pos") / bin_size)
    joined = a.join(b, ["chrom", "__bin"]).where((F.col("start_pos") <= F.col("f_end_pos")) & (F.col("f_start_pos") <= F.col("end_pos")) & (F.col("__bin") == first))
    return joined.drop("__bin")


def _names(column: str, only: Column | None = None) -> Column:
    """Aggregate: the sorted distinct values of a column, of rows that `only` picks, without blank ones, joined."""
    picked = F.col(column) != ""
    return F.array_join(F.array_sort(F.collect_set(F.when(picked if only is None else only & picked, F.col(column)))), ";")


def overlap_summary(sites: DataFrame, features: DataFrame, label: str, columns: dict[str, str]) -> DataFrame:
    """sites with n_<label> (overlapping feature rows) and, for each of columns (feature column: name), its sorted distinct values."""
    hits = overlap_join(sites.select("site_key", "chrom", "start_pos", "end_pos"), features)
    found = hits.groupBy("site_key").agg(F.count(F.lit(1)).alias(f"n_{label}"), *[_names(f"f_{c}").alias(name) for c, name in columns.items()])
    return sites.join(found, "site_key", "left").fillna(0, [f"n_{label}"])


def beside_points(sites: DataFrame, points: DataFrame, pos: str, ident: str, keep: list[str]) -> DataFrame:
    """site_key and at of each site, with before and after: the nearest points (pos, p: keep) at or before it and at or after it. Of
    points at one position the least id counts."""
    best = points.groupBy("chrom", pos).agg(F.min_by(F.struct(ident, *[c for c in keep if c != ident]), ident).alias("p"))
    marks = best.select("chrom", F.col(pos).alias("at"), F.struct(F.col(pos).alias("pos"), "p").alias("point"), F.lit(None).cast("string").alias("site_key"))
    rows = sites.select("chrom", F.col("start_pos").alias("at"), F.lit(None).cast(marks.schema["point"].dataType).alias("point"), "site_key").unionByName(marks)
    return ordered.neighbours(rows, "chrom", "at", "point").where("site_key is not null").select("site_key", "at", "before", "after")


def nearest_points(sites: DataFrame, points: DataFrame, pos: str, ident: str, keep: list[str]) -> DataFrame:
    """site_key, nearest_distance and keep of the nearest point of its contig; null without any. Of equals the lower position, then id."""
    found = beside_points(sites, points, pos, ident, keep)
    left, right = F.col("at") - F.col("before.pos"), F.col("after.pos") - F.col("at")
    pick = F.when(F.col("after").isNull() | (left <= right), F.struct(left.alias("distance"), F.col("before.p").alias("p"))).otherwise(F.struct(right.alias("distance"), F.col("after.p").alias("p")))
    return found.select("site_key", pick.alias("pick")).select("site_key", F.col("pick.distance").alias("nearest_distance"), *[F.col(f"pick.p.{c}").alias(c) for c in keep])


def nearest_point(sites: DataFrame, points: DataFrame, pos: str, ident: str, keep: list[str]) -> DataFrame:
    """sites with nearest_points()."""
    return sites.join(nearest_points(sites, points, pos, ident, keep), "site_key", "left")


def nearest_intervals(sites: DataFrame, features: DataFrame, ident: str) -> DataFrame:
    """site_key, nearest_distance to the nearest interval of its contig, 0 if they overlap, and nearest_id; null without any.

    The interval that ends last among those that start before, and the first that starts after, are carried along.
    """
    marks = features.groupBy("chrom", F.col("start_pos").alias("at")).agg(F.max(F.struct(F.col("end_pos").alias("end"), F.col(ident).alias("id"))).alias("f"))
    marks = marks.select("chrom", "at", F.struct("at", "f.end", "f.id").alias("f"), F.lit(None).cast("string").alias("site_key"), F.lit(None).cast("long").alias("site_end"))
    rows = sites.select("chrom", F.col("start_pos").alias("at"), F.lit(None).cast(marks.schema["f"].dataType).alias("f"), "site_key", F.col("end_pos").alias("site_end")).unionByName(marks)
    known = F.when(F.col("f").isNotNull(), F.struct(F.col("f.end").alias("end"), F.col("f.id").alias("id")))
    found = ordered.running_max(ordered.neighbours(rows, "chrom", "at", "f"), "chrom", "at", known, "b").where("site_key is not null").select("site_key", "at", "site_end", "b", F.col("after").alias("a"))
    # greatest() skips nulls, so a side without an interval has to stay null
    left = F.when(F.col("b").isNotNull(), F.greatest(F.col("at") - F.col("b.end"), F.lit(0)))
    right = F.when(F.col("a").isNotNull(), F.greatest(F.col("a.at") - F.col("site_end"), F.lit(0)))
    pick = F.when(F.col("a").isNull() | (left <= right), F.struct(left.alias("d"), F.col("b.id").alias("id"))).otherwise(F.struct(right.alias("d"), F.col("a.id").alias("id")))
    return found.select("site_key", pick.alias("pick")).select("site_key", F.col("pick.d").alias("nearest_distance"), F.col("pick.id").alias("nearest_id"))


def nearest_interval(sites: DataFrame, features: DataFrame, ident: str) -> DataFrame:
    """sites with nearest_intervals()."""
    return sites.join(nearest_intervals(sites, features, ident), "site_key", "left")


def island_context(distance: Column, shore: int = 2000, shelf: int = 4000) -> Column:
    return F.when(distance == 0, "island").when(distance <= shore, "shore").when(distance <= shelf, "shelf").otherwise("open_sea")


def is_enhancer_like(types: Column) -> Column:
    """pELS or dELS between commas of the joined types; a semicolon is no boundary."""
    return F.coalesce(types.rlike("(^|,)(pELS|dELS)(,|$)"), F.lit(False))


def is_ctcf_only(types: Column) -> Column:
    return F.coalesce(types.rlike("(^|,)CTCF-only(,|$)"), F.lit(False))


#: Sub-features of genes: label, and the types of annotation rows that it takes. Fixed values.
SUBFEATURES = {
    "exon": ["exon"], "cds": ["CDS"], "five_prime_utr": ["five_prime_utr", "5UTR"], "three_prime_utr": ["three_prime_utr", "3UTR"], "utr": ["UTR"],
}


def of_types(features: DataFrame, types: list[str]) -> DataFrame:
    """Rows of an annotation whose type is one of types; none of them is an empty set, not an error."""
    return features.where(F.col("type").isin(types)).drop("type")


def intron_genes(sites: DataFrame, genes: DataFrame, exons: DataFrame) -> DataFrame:
    """site_key, n_intron_genes, intron_gene_id and intron_gene_name: genes whose body holds the site and none of whose exons does."""
    spots = sites.select("site_key", "chrom", "start_pos", "end_pos")
    body = overlap_join(spots, genes).groupBy("site_key", F.col("f_gene_id").alias("gene")).agg(F.min("f_gene_name").alias("name")).where("gene <> ''")
    inside = overlap_join(spots, exons).select("site_key", F.col("f_gene_id").alias("gene")).distinct()
    left = body.join(inside, ["site_key", "gene"], "left_anti")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(F.col(c) != "", F.col(c)))), ";")
    return left.groupBy("site_key").agg(F.count(F.lit(1)).alias("n_intron_genes"), joined("gene").alias("intron_gene_id"), joined("name").alias("intron_gene_name"))


def _tagged(rows: DataFrame, tag: Column, *columns: str) -> DataFrame:
    """Features of the tagged table: tag, place, and up to three columns of text."""
    text = [F.col(c).cast("string") if c else F.lit(None).cast("string") for c in (*columns, "", "", "")[:3]]
    return rows.select(tag.alias("tag"), "chrom", "start_pos", "end_pos", *[c.alias(f"t{i}") for i, c in enumerate(text)])


def tagged_features(genes: DataFrame, islands: DataFrame, ccres: DataFrame, features: DataFrame, window: int) -> DataFrame:
    """All that a site may overlap as one table. A row of the annotation has as many tags as take its type."""
    tags = F.explode(F.filter(F.array(*[F.when(F.col("type").isin(types), F.lit(label)) for label, types in SUBFEATURES.items()]), lambda t: t.isNotNull()))
    parts = features.withColumn("tag", tags)
    named = ("gene_id", "gene_name")
    tables = [
        _tagged(promoters(genes, window), F.lit("promoter"), *named), _tagged(genes, F.lit("gene_body"), *named), _tagged(parts, F.col("tag"), *named),
        _tagged(islands, F.lit("island"), "name"), _tagged(ccres, F.lit("ccre"), "ccre_v4_id", "ccre_v5_id", "ccre_type"),
    ]
    return reduce(DataFrame.unionByName, tables)


#: Labels of genes: what a site is in, each with a count and the genes' ids and names.
GENE_LABELS = ["promoter", "gene_body", *SUBFEATURES]


def overlaps_by_site(sites: DataFrame, tagged: DataFrame) -> DataFrame:
    """A row a site that overlaps any tagged feature: counts and names by tag, and introns (genes whose body holds the site and none of
    whose exons does). One join by bins and one aggregate by site, whatever the number of tags."""
    hits = overlap_join(sites.select("site_key", "chrom", "start_pos", "end_pos"), tagged)
    of = lambda tag: F.col("f_tag") == tag
    columns = []
    named = lambda tag, column, name: F.when(F.count_if(of(tag)) > 0, _names(column, of(tag))).alias(name)
    for label in GENE_LABELS:
        columns += [F.count_if(of(label)).alias(f"n_{label}_genes"), named(label, "f_t0", f"{label}_gene_id"), named(label, "f_t1", f"{label}_gene_name")]
    columns += [F.count_if(of("island")).alias("n_overlapping_cpg_islands"), named("island", "f_t0", "cpg_island_name"), F.count_if(of("ccre")).alias("n_overlapping_ccres")]
    columns += [named("ccre", f"f_t{i}", name) for i, name in enumerate(("ccre_v4_id", "ccre_v5_id", "ccre_type"))]
    body = F.array_sort(F.collect_set(F.when(of("gene_body") & (F.col("f_t0") != ""), F.struct(F.col("f_t0").alias("gene"), F.col("f_t1").isNull().alias("unnamed"), F.col("f_t1").alias("name")))))
    exons = F.collect_set(F.when(of("exon"), F.col("f_t0")))
    found = hits.groupBy("site_key").agg(*columns, body.alias("__body"), exons.alias("__exons"))
    # the first of a gene's names, in order
    first = F.filter("__body", lambda g, i: (i == 0) | (F.get("__body", i - 1)["gene"] != g["gene"]))
    found = found.withColumn("__introns", F.filter(first, lambda g: ~F.array_contains("__exons", g["gene"])))
    some = F.size("__introns") > 0
    names = F.array_sort(F.array_distinct(F.filter(F.transform("__introns", lambda g: g["name"]), lambda n: n.isNotNull() & (n != ""))))
    introns = {
        "n_intron_genes": F.size("__introns").cast("long"), "intron_gene_id": F.when(some, F.array_join(F.transform("__introns", lambda g: g["gene"]), ";")),
        "intron_gene_name": F.when(some, F.array_join(names, ";")),
    }
    return found.withColumns(introns).drop("__body", "__exons", "__introns")


def annotate(sites: DataFrame, genes: DataFrame, islands: DataFrame, ccres: DataFrame, features: DataFrame, window: int = 2000) -> DataFrame:
    """sites (site_key, chrom, start_pos, end_pos) with nearest TSS, promoter, gene-body and sub-feature genes (features: rows of the
    annotation with type, chrom, start_pos, end_pos, gene_id, gene_name), both gene contexts, islands and regulatory elements.

    All labels are one tagged table, met by one interval join, so the plan does not grow with the labels.
    """
    tss = nearest_points(sites, annotation_tss(genes), "tss", "gene_id", ["gene_id", "gene_name", "strand"])
    tss = tss.withColumnsRenamed({"nearest_distance": "nearest_tss_distance", "gene_id": "nearest_tss_gene_id", "gene_name": "nearest_tss_gene_name", "strand": "nearest_tss_strand"})
    island = nearest_intervals(sites, islands, "name").withColumnsRenamed({"nearest_distance": "nearest_cpg_island_distance", "nearest_id": "nearest_cpg_island_name"})
    hits = overlaps_by_site(sites, tagged_features(genes, islands, ccres, features, window))
    out = sites.join(tss, "site_key", "left").join(hits, "site_key", "left").join(island, "site_key", "left").fillna(0, [c for c in hits.columns if c.startswith("n_")])
    inside = {f"in_{label}": F.col(f"n_{label}_genes") > 0 for label in (*GENE_LABELS, "intron")}
    inside |= {"in_cpg_island": F.col("n_overlapping_cpg_islands") > 0, "in_ccre": F.col("n_overlapping_ccres") > 0}
    out = out.withColumns(inside | {"cpg_island_context": island_context(F.col("nearest_cpg_island_distance"))})
    coarse = F.when(F.col("in_promoter"), "promoter").when(F.col("in_gene_body"), "gene_body").otherwise("intergenic")
    fine = (
        F.when(F.col("in_promoter"), "promoter").when(F.col("in_exon"), "exon").when(F.col("in_intron"), "intron")
        .when(F.col("in_gene_body"), "gene_body_unclassified").otherwise("intergenic")
    )
    return out.withColumns({"genomic_context": coarse, "gene_feature_context": fine, "is_enhancer_like": is_enhancer_like(F.col("ccre_type")), "is_ctcf_only": is_ctcf_only(F.col("ccre_type"))})
