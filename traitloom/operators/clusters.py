"""Clusters of locally correlated features: rows (chrom, start_pos, feature_id, vec), vec the feature's values in fixed sample order."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import keep
from . import ordered
from .expect import missing_keys, repeated_keys, require, require_range
from .linalg import residualize

#: Base pairs in which components are joined first, and how many times wider each further level is.
JOIN_BIN, WIDER = 1 << 20, 16


def vectors(long: DataFrame) -> DataFrame:
    """Long rows (chrom, start_pos, feature_id, sample_idx, value) to one array a feature."""
    pairs = F.array_sort(F.collect_list(F.struct("sample_idx", "value")))
    return long.groupBy("chrom", "start_pos", "feature_id").agg(F.transform(pairs, lambda p: p["value"]).alias("vec"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def standardise(features: DataFrame) -> DataFrame:
    """vec centred and of unit length; valid is false (and vec null) without variance."""
    mean = F.array(_sum(F.col("vec")) / F.size("vec"))  # bound by a lambda, so that it is worked out once a vector and not once an element
    centre = F.get(F.transform(mean, lambda m: F.transform("vec", lambda x: x - m)), F.lit(0))
    rows = features.withColumn("__c", centre).withColumn("__n", F.sqrt(_sum(F.transform("__c", lambda x: x * x))))
    ok = F.col("__n") > 1e-12
    return rows.withColumns({"valid": ok, "vec": F.when(ok, F.transform("__c", lambda x: x / F.col("__n")))}).drop("__c", "__n")


def dot(a: str, b: str) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x * y))


def local_pairs(features: DataFrame, window_bp: int = 1000) -> DataFrame:
    """Pairs i before j on one contig with starts at most window_bp apart: a range join by buckets of the window's width."""
    bucket = F.floor(F.col("start_pos") / window_bp)
    left = features.select("chrom", F.col("feature_id").alias("i"), F.col("start_pos").alias("start_i"), F.col("vec").alias("vec_i"), F.explode(F.array(bucket, bucket + 1)).alias("bucket"))
    right = features.select("chrom", F.col("feature_id").alias("j"), F.col("start_pos").alias("start_j"), F.col("vec").alias("vec_j"), bucket.alias("bucket"))
    gap = F.col("start_j") - F.col("start_i")
    ordered = (gap > 0) | ((gap == 0) & (F.col("i") < F.col("j")))
    return left.join(right, ["chrom", "bucket"]).where(ordered & (gap <= window_bp)).withColumn("distance", gap).drop("bucket")


def correlated_pairs(features: DataFrame, window_bp: int = 1000, min_abs: float = 0.95) -> DataFrame:
    """(chrom, i, j, start_i, start_j, distance, r) of local pairs with absolute correlation of at least min_abs."""
    pairs = local_pairs(features.where("valid"), window_bp).withColumn("r", dot("vec_i", "vec_j"))
    return pairs.where(F.abs("r") >= min_abs).select("chrom", "i", "j", "start_i", "start_j", "distance", "r")


def local_connectivity(edges: DataFrame) -> DataFrame:
    ends = edges.select("chrom", F.explode(F.array("i", "j")).alias("feature_id"), F.abs("r").alias("r"))
    return ends.groupBy("chrom", "feature_id").agg(F.sum("r").alias("local_connectivity"))


def segments(features: DataFrame, window_bp: int = 1000) -> DataFrame:
    """features with segment: a new one after every gap wider than window_bp. No component crosses one."""
    return ordered.islands(features, "chrom", "start_pos", "feature_id", window_bp, "segment")


def least_reached(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the least one that edges a - b lead to: roots are hooked on lesser ones, and paths halved, until no edge
    has two roots."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while True:
            further = root[root]
            if (further == root).all():
                break
            root = further


def _joined(edges: DataFrame, by: list[str], kind: str) -> DataFrame:
    """(chrom, node, label) of the ends of edges (…, i, j): the least node reached by edges of the same group."""

    def join(table: pa.Table) -> pa.Table:
        ends = pa.chunked_array([*table.column("i").chunks, *table.column("j").chunks]).combine_chunks()
        nodes = ends.unique()
        nodes = nodes.take(pa.compute.array_sort_indices(nodes))
        place = pa.compute.index_in(ends, nodes).to_numpy()
        half = len(place) // 2
        root = least_reached(place[:half], place[half:], len(nodes))
        return pa.table({"chrom": pa.array([table.column("chrom")[0].as_py()] * len(nodes), pa.string()), "node": nodes, "label": nodes.take(pa.array(root))})

    return edges.groupBy(*by).applyInArrow(join, f"chrom string, node {kind}, label {kind}")


def _relabelled(rows: DataFrame, columns: list[str], labels: DataFrame) -> DataFrame:
    """rows with each of columns replaced by its label, where it has one."""
    for c in columns:
        of = labels.select("chrom", F.col("node").alias(c), F.col("label").alias("__label"))
        rows = rows.join(of, ["chrom", c], "left").withColumn(c, F.coalesce("__label", c)).drop("__label")
    return rows


def components(features: DataFrame, edges: DataFrame, window_bp: int = 1000, bin_bp: int = JOIN_BIN) -> DataFrame:
    """(chrom, feature_id, component): component is the least feature joined, of those with an edge.

    Edges are short, so labels contract along positions: first within bins, then, level by level, the few edges that cross from one
    bin to the next join the labels on both sides within bins that are WIDER times as wide, until no edge crosses. A group holds
    the edges of a bin at first and those around its parts' borders later, however long the component is.
    """
    kind = features.schema["feature_id"].dataType.simpleString()
    size = max(bin_bp, window_bp)
    rows = keep(edges.select("chrom", "i", "j", "start_i", "start_j"), "edges")
    bins = lambda width: (F.floor(F.col("start_i") / width), F.floor(F.col("start_j") / width))
    inside = lambda df, width: df.withColumn("__bin", bins(width)[0]).where(bins(width)[0] == bins(width)[1])
    labels = keep(_joined(inside(rows, size), ["chrom", "__bin"], kind), "labels")
    crossing = rows.where(bins(size)[0] != bins(size)[1])
    nodes = labels.unionByName(crossing.select("chrom", F.explode(F.array("i", "j")).alias("node")).distinct().join(labels.select("chrom", "node"), ["chrom", "node"], "left_anti").withColumn("label", F.col("node")))
    crossing = keep(_relabelled(crossing, ["i", "j"], labels).where("i <> j").distinct(), "crossing")
    nodes = nodes.withColumnRenamed("label", "component")
    while not crossing.isEmpty():
        size *= WIDER
        more = keep(_joined(inside(crossing, size), ["chrom", "__bin"], kind).where("node <> label"), "labels")
        nodes = _relabelled(nodes, ["component"], more)
        crossing = keep(_relabelled(crossing.where(bins(size)[0] != bins(size)[1]), ["i", "j"], more).where("i <> j").distinct(), "crossing")
    return nodes.select("chrom", F.col("node").alias("feature_id"), "component")


def cluster_table(features: DataFrame, edges: DataFrame, members: DataFrame) -> DataFrame:
    """A row a cluster: extent by starts, sizes, pair distances and correlations, and its representative: of largest local connectivity,
    then of least start, then of least id. An end_pos of features gives representative_end; without it, it is the base after the start."""
    end = F.col("end_pos") if "end_pos" in features.columns else F.col("start_pos") + 1
    nodes = members.join(features.select("chrom", "feature_id", "start_pos", end.alias("end_pos")), ["chrom", "feature_id"]).join(local_connectivity(edges), ["chrom", "feature_id"])
    best = F.min_by(F.struct("feature_id", "start_pos", "end_pos", "local_connectivity"), F.struct(-F.col("local_connectivity"), "start_pos", "feature_id"))
    by_node = nodes.groupBy("chrom", "component").agg(
        F.min("start_pos").alias("cluster_start"), F.max("start_pos").alias("cluster_end"), F.count(F.lit(1)).alias("n_correlated_cpgs"), best.alias("b")
    )
    of_pair = edges.join(members.select("chrom", F.col("feature_id").alias("i"), "component"), ["chrom", "i"])
    by_pair = of_pair.groupBy("chrom", "component").agg(
        F.count(F.lit(1)).alias("n_correlated_pairs"), F.avg("distance").alias("mean_pair_distance_bp"), F.max("distance").alias("max_pair_distance_bp"),
        F.avg(F.abs("r")).alias("mean_abs_correlation"), F.max(F.abs("r")).alias("max_abs_correlation"),
    )
    number = F.dense_rank().over(Window.partitionBy("chrom").orderBy("cluster_start", "representative_cpg"))
    rows = by_node.join(by_pair, ["chrom", "component"]).withColumns(
        {"cluster_span_bp": F.col("cluster_end") - F.col("cluster_start"), "representative_cpg": F.col("b.feature_id"), "representative_start": F.col("b.start_pos"), "representative_end": F.col("b.end_pos"), "representative_local_connectivity": F.col("b.local_connectivity")}
    )
    return rows.drop("b").withColumn("cluster_id", number)


def representatives(features: DataFrame, members: DataFrame, clusters: DataFrame) -> DataFrame:
    """Best feature of each cluster, and every valid feature without a correlated neighbour."""
    end = F.col("end_pos") if "end_pos" in features.columns else F.col("start_pos") + 1
    best = clusters.select("chrom", F.col("representative_start").alias("start_pos"), F.col("representative_end").alias("end_pos"), F.col("representative_cpg").alias("feature_id"), "cluster_id", F.col("n_correlated_cpgs").alias("cluster_size"), F.col("representative_local_connectivity").alias("local_connectivity"), F.lit("correlated_cluster").alias("selection_type"))
    alone = features.where("valid").join(members.select("chrom", "feature_id"), ["chrom", "feature_id"], "left_anti")
    alone = alone.select("chrom", "start_pos", end.alias("end_pos"), "feature_id", F.lit(None).cast("int").alias("cluster_id"), F.lit(1).cast("long").alias("cluster_size"), F.lit(0.0).alias("local_connectivity"), F.lit("singleton").alias("selection_type"))
    return best.unionByName(alone)


def correlated_clusters(features: DataFrame, window_bp: int = 1000, min_abs: float = 0.95, design: np.ndarray | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Standardised vectors, clusters and representatives of features (chrom, start_pos, feature_id, vec), covariates of the design
    taken out of the vectors first."""
    require_range("window_bp", window_bp, 1)
    require_range("min_abs", min_abs, 1e-12, 1)
    rows = keep(standardise(residualize(features, design) if design is not None else features), "features")
    edges = keep(correlated_pairs(rows, window_bp, min_abs), "pairs")
    members = keep(components(rows, edges, window_bp), "members")
    clusters = keep(cluster_table(rows, edges, members), "clusters")
    return rows, clusters, representatives(rows, members, clusters)


def representative_values(values: DataFrame, chosen: DataFrame, key: str = "feature_id") -> DataFrame:
    """Values of the representatives; one without values, or named twice, is an error."""
    require(repeated_keys(chosen, key), "a representative comes more than once")
    require(missing_keys(chosen, values, key), "a representative has no values")
    return values.join(chosen.select(key, "selection_type"), key)


def correlation_summary(features: DataFrame, clusters: DataFrame, window_bp: int = 1000, min_abs: float = 0.95, source: str = "", covariates: str = "") -> DataFrame:
    """A row a contig: where the values come from, samples, thresholds, features, clusters, representatives, cluster sizes, and pair
    distances weighted by pairs. A contig without clusters has zeros and nulls."""
    pairs = F.col("n_correlated_pairs")
    by_cluster = clusters.groupBy("chrom").agg(
        F.sum(pairs).alias("n_correlated_pairs"), F.count(F.lit(1)).alias("n_clusters"), F.sum("n_correlated_cpgs").alias("n_cpgs_in_clusters"), F.avg("n_correlated_cpgs").alias("mean_cluster_size"),
        F.median("n_correlated_cpgs").alias("median_cluster_size"), (F.sum(F.col("mean_pair_distance_bp") * pairs) / F.sum(pairs)).alias("mean_correlated_pair_distance_bp"), F.max("max_pair_distance_bp").alias("max_correlated_pair_distance_bp"),
    )
    counts = features.groupBy("chrom").agg(F.max(F.size("vec")).alias("n_samples_used"), F.count(F.lit(1)).alias("n_cpgs_processed"), F.count_if(~F.col("valid")).alias("n_zero_variance_cpgs"))
    joined = counts.join(by_cluster, "chrom", "left").fillna(0, ["n_correlated_pairs", "n_clusters", "n_cpgs_in_clusters"])
    chosen = F.col("n_cpgs_processed") - F.col("n_zero_variance_cpgs") - F.col("n_cpgs_in_clusters") + F.col("n_clusters")
    return joined.withColumns(
        {"input_bed": F.lit(source), "covariates": F.lit(covariates), "window_bp": F.lit(window_bp), "min_abs_correlation": F.lit(min_abs), "n_representative_cpgs": chosen}
    )
