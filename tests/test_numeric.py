"""What SQL can't say is held against NumPy, and edges of the definitions against small cases."""

import math
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from traitloom.functions import stats
from traitloom.operators import calls, clusters, cohort, connectivity, covariates, expect, expression, genotype, intervals, linalg, proteomics, ranks
from traitloom.sources import shared


def test_quantiles_interpolate(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)], "x double")
    assert df.agg(F.expr("percentile(x, array(0.25, 0.5, 0.75))").alias("q")).first().q == [1.75, 2.5, 3.25]


def test_spearman_of_three(spark):
    rows = [("chr1", 1, 2, "k", v, float(c), True) for v, c in ((0.1, 1), (0.4, 2), (0.8, 3))]
    df = spark.createDataFrame(rows, "chrom string, begin_pos long, end_pos long, site_key string, value double, norm_log_cov double, per_sample_qc_pass boolean")
    r = cohort.coverage_correlation(df).first()
    assert r.n_samples_coverage_methylation_correlation == 3 and r.coverage_methylation_spearman_rho == pytest.approx(1, abs=1e-12)
    assert cohort.coverage_correlation(df.limit(2)).first().coverage_methylation_spearman_rho is None


def test_inverse_normal(spark):
    known = {0.5: 0.0, 0.975: 1.959963984540054, 0.01: -2.3263478740408408, 0.999: 3.090232306167813}
    df = spark.createDataFrame([(p,) for p in [*known, 0.0, 1.0]], "p double").select("p", stats.inverse_normal(F.col("p")).alias("q"))
    for r in df.collect():
        assert r.q is None if r.p in (0.0, 1.0) else r.q == pytest.approx(known[r.p], abs=1e-7)


def test_required_samples():
    assert cohort.required_samples(100, 0.07) == 8 and cohort.required_samples(10, 0.95) == 10 and cohort.required_samples(10, 0.1, 4) == 4


def test_thresholds_are_inclusive(spark):
    schema = "sample_id string, chrom string, begin_pos long, end_pos long, mod_score double, type string, cov double"
    rows = [("a", "chr1", i, i + 1, 1.0, "t", c) for i, c in enumerate([10.0, 9.999, 100.0, None, 10.0, 10.0, 10.0])]
    df = spark.createDataFrame(rows, schema)
    cover = calls.sample_coverage(df, 3.0)
    flags = {r.begin_pos: (r.meets_min_coverage, r.extreme_cov_flag, r.per_sample_qc_pass) for r in calls.flag_calls(df, cover, 10).collect()}
    assert flags[0][0] is True and flags[1][0] is False and flags[2] == (True, "extreme", False) and flags[3] == (False, "ok", False)
    none = calls.sample_coverage(spark.createDataFrame([("a", "chr1", 1, 2, 1.0, "t", 0.0)], schema))
    assert none.first().extreme_coverage_cutoff == float("inf")


def long_matrix(spark, x):
    rows = [(f, s, float(x[f, s])) for f in range(x.shape[0]) for s in range(x.shape[1])]
    return spark.createDataFrame(rows, "feature_id long, sample_id long, value double")


def test_bicor_connectivity(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 7))
    x[3] = 5.0
    used = np.delete(x, 3, axis=0)
    med = np.median(used, 0)
    u = (used - med) / (9 * np.median(np.abs(used - med), 0))
    w = (used - med) * (1 - u**2) ** 2 * (np.abs(u) < 1)
    z = w / np.sqrt((w**2).sum(0))
    want = (0.5 + 0.5 * z.T @ z).sum(1) - 1
    long = long_matrix(spark, x)
    got = {r.sample_id: r.connectivity for r in connectivity.connectivity(connectivity.varying_features(long)).collect()}
    assert [got[i] for i in range(7)] == pytest.approx(want, abs=1e-10)
    scored = {r.sample_id: r.zscore for r in connectivity.outliers(connectivity.connectivity(connectivity.varying_features(long))).collect()}
    assert [scored[i] for i in range(7)] == pytest.approx((want - want.mean()) / want.std(ddof=1), abs=1e-9)


def vector_frame(spark, x):
    return spark.createDataFrame([("chr1", 100 * i, i, [None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)], "chrom string, start_pos long, feature_id long, vec array<double>")


def test_residuals(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(20, 9))
    x[4, 2] = np.nan
    x[5, 1:] = np.nan
    design = linalg.model_matrix(pd.DataFrame({"a": rng.normal(size=9), "b": list("uvwuvwuvw")}))
    assert design.shape == (9, 4)
    got = {r.feature_id: r.vec for r in linalg.residualize(vector_frame(spark, x), design).collect()}
    for i, row in enumerate(x):
        seen = ~np.isnan(row)
        if i == 5:
            assert all(v is None for v in got[i])
            continue
        want = row[seen] - design[seen] @ np.linalg.lstsq(design[seen], row[seen], rcond=None)[0]
        assert [v for v in got[i] if v is not None] == pytest.approx(want, abs=1e-9) and (got[i][2] is None) == (i == 4)
    with pytest.raises(ValueError):
        linalg.model_matrix(pd.DataFrame({"a": [1.0, 2.0]}))


def test_samples_are_reconciled():
    """Samples without covariates, or with an incomplete row of them, go; the others keep their order; text is a factor."""
    table = pd.DataFrame({"age": ["30", "41", None, "52", "63", "29"], "site": list("xyxyxz")}, index=list("abcdef"))
    kept, design = linalg.reconcile(["f", "q", "a", "b", "c", "d", "e"], table)
    assert kept == ["f", "a", "b", "d", "e"] and design.shape == (5, 4)
    assert design[:, 1].tolist() == [29, 30, 41, 52, 63] and design[:, 3].tolist() == [1, 0, 0, 0, 0]
    with pytest.raises(ValueError, match="no sample"):
        linalg.reconcile(["q"], table)
    whole, complete = linalg.design_matrix(pd.DataFrame({"a": [1.0, None, 3.0, 5.0]}))
    assert whole[:, 1].tolist() == [1, 3, 5] and complete.tolist() == [True, False, True, True]


def test_residuals_by_pattern_of_missing_samples(spark):
    """Rows that lack the same samples share a factorisation; patterns beyond what a task remembers are worked out again."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 12))
    x[rng.random(x.shape) < 0.3] = np.nan
    x[0] = np.nan
    design = linalg.model_matrix(pd.DataFrame({"a": rng.normal(size=12), "b": np.arange(12) % 2}))
    got = {r.feature_id: r.vec for r in linalg.residualize(vector_frame(spark, x).repartition(3), design).collect()}
    for i, row in enumerate(x):
        seen = ~np.isnan(row)
        if seen.sum() <= (np.linalg.matrix_rank(design[seen]) if seen.any() else 0):
            assert all(v is None for v in got[i])
            continue
        want = row[seen] - design[seen] @ np.linalg.lstsq(design[seen], row[seen], rcond=None)[0]
        assert [v for v in got[i] if v is not None] == pytest.approx(want, abs=1e-9) and [v is not None for v in got[i]] == seen.tolist()


def test_scaled_rows(spark):
    x = np.array([[1.0, 2.0, np.nan, 6.0], [3.0, 3.0, 3.0, 3.0], [np.nan, np.nan, np.nan, 1.0], [np.nan] * 4])
    got = {r.feature_id: r.vec for r in linalg.scale_rows(vector_frame(spark, x)).collect()}
    y = x[0, [0, 1, 3]]
    assert [got[0][k] for k in (0, 1, 3)] == pytest.approx((y - y.mean()) / y.std(ddof=1)) and got[0][2] is None
    assert all(v is None for i in (1, 2, 3) for v in got[i])


def test_components_of_samples(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 3)) @ rng.normal(size=(3, 8)) * 5 + rng.normal(size=(60, 8)) * 0.1
    scores, deviations = linalg.principal_components(vector_frame(spark, x).repartition(4), 8)
    centred = (x - x.mean(1, keepdims=True)).T
    u, s, _ = np.linalg.svd(centred, full_matrices=False)
    assert np.abs(scores[:, :3]) == pytest.approx(np.abs(u[:, :3] * s[:3]), abs=1e-6) and deviations[:3] == pytest.approx(s[:3] / np.sqrt(7), abs=1e-6)
    assert all(scores[np.abs(scores[:, k]).argmax(), k] > 0 for k in range(3)) and linalg.component_count(deviations, 8, 60) <= 3
    assert linalg.pcs_frame(vector_frame(spark, x), scores, list("abcdefgh"), 2).columns == ["ID", "PC1", "PC2"]


def test_random_components(spark):
    """Subspace iteration gives the leading components of the Gram matrix."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 5)) @ np.diag([9, 7, 5, 4, 3]) @ rng.normal(size=(5, 40)) + rng.normal(size=(400, 40)) * 0.5
    frame = vector_frame(spark, x).repartition(3)
    scores, deviations = linalg.principal_components(frame, 40)
    some, fewer = linalg.random_components(frame, 40, 5)
    assert fewer == pytest.approx(deviations[:5], rel=1e-6) and some == pytest.approx(scores[:, :5], abs=1e-3 * np.abs(scores).max())


def test_sums_in_parts(spark, monkeypatch):
    """Arrays larger than a part are put together again."""
    x = np.random.default_rng(7).normal(size=(50, 30))
    monkeypatch.setattr(linalg, "PART", 64)
    assert linalg.added_up(vector_frame(spark, x).repartition(5), (30, 30), lambda v: v.T @ v) == pytest.approx(x.T @ x)


def test_registered_components(spark):
    """The queries of components, whole: all of L05's and X11's rows, and both tables of K05, against NumPy."""
    from traitloom.plans import pipelines, queries

    sf = "/root/testdata/sf0.001"
    rows = [r["embedding"] for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("embedding").collect()]
    x = np.array(rows, float)
    centred = (x - x.mean(1, keepdims=True)).T
    u, s, _ = np.linalg.svd(centred, full_matrices=False)
    want = u * s
    want *= np.sign(want[np.abs(want).argmax(0), np.arange(want.shape[1])])
    chosen = queries.QUERIES["X11_phenotype_pcs"](spark, sf).orderBy("ID").toPandas()
    n = chosen.shape[1] - 1
    assert n == max(1, linalg.component_count(s / np.sqrt(len(want) - 1), len(want), len(x)))
    names = [f"S{i:02d}" for i in range(len(want))]
    assert chosen["ID"].tolist() == names and chosen.iloc[:, 1:].to_numpy() == pytest.approx(want[:, :n], abs=1e-5)
    assert queries.QUERIES["L05_pca"](spark, sf).orderBy("ID").toPandas().iloc[:, 1:].to_numpy() == pytest.approx(want[:, :3], abs=1e-5)
    written = queries.QUERIES["K05_write_pcs"](spark, sf).toPandas()
    every = written[written["kind"] == "all"].pivot(index="ID", columns="pc", values="value")
    last = want.shape[1] - 1  # features are centred over samples, so the last component is nothing
    assert every[[f"PC{k + 1}" for k in range(last)]].to_numpy() == pytest.approx(want[:, :last], abs=1e-4)
    assert written[written["kind"] == "chosen"]["pc"].nunique() == n and every.shape == want.shape
    assert pipelines.phenotype_pcs


def test_missing_values_are_left_out_pair_by_pair(spark):
    """Biweight correlation over the features that both samples have, blocks of samples meeting."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(60, 9)) + rng.normal(size=(60, 1))
    x[rng.random(x.shape) < 0.15] = np.nan
    x[:, 8] = np.where(np.isnan(x[:, 8]), np.nan, 2.0)  # no variance: correlates with nothing
    want = np.zeros(9)
    for i in range(9):
        for j in range(9):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = x[both, i], x[both, j]
            pair = []
            for v in (a, b):
                d = v - np.median(v)
                mad = np.median(np.abs(d))
                w = v - v.mean() if mad == 0 else d * (1 - (d / (9 * mad)) ** 2) ** 2 * (np.abs(d / (9 * mad)) < 1)
                pair.append(w)
            length = np.sqrt((pair[0] ** 2).sum() * (pair[1] ** 2).sum())
            want[i] += (0.5 + 0.5 * (pair[0] @ pair[1]) / length if length > 0 else 0) if i != j else 0
    rows = [(f, s, None if np.isnan(x[f, s]) else float(x[f, s])) for f in range(60) for s in range(9)]
    long = spark.createDataFrame(rows, "feature_id long, sample_id long, value double")
    for size in (2, 32):
        blocks = connectivity.BLOCK
        connectivity.BLOCK = size
        try:
            got = {r.sample_id: r.connectivity for r in connectivity.connectivity(long).collect()}
        finally:
            connectivity.BLOCK = blocks
        assert [got[i] for i in range(9)] == pytest.approx(want, abs=1e-9)


def test_too_few_samples_or_features(spark):
    for x in (np.arange(8.0).reshape(4, 2), np.vstack([np.ones((3, 4)), np.arange(4.0)])):
        scored = connectivity.score_samples(long_matrix(spark, x)).collect()
        assert all(r.pass_connectivity_filter and r.connectivity is None and r.method == connectivity.NOT_COMPUTED for r in scored) and len(scored) == x.shape[1]
    same = np.repeat(np.random.default_rng(1).normal(size=(9, 1)), 4, axis=1) + np.array([0.0, 0.0, 0.0, 1e-13])
    assert {r.pass_connectivity_filter for r in connectivity.score_samples(long_matrix(spark, same)).collect()} == {True}


def test_quantiles_by_narrowing(spark):
    """Exact for any number of values that one task may order, with ties, runs of one value, infinities of scale and single values."""
    from traitloom.operators import ranks

    rng = np.random.default_rng(9)
    groups = {"a": rng.normal(size=5000), "b": np.round(rng.normal(size=4001), 1), "c": np.full(3000, 7.0), "d": np.array([3.0]), "e": np.concatenate([rng.normal(size=2000) * 1e-9, [1e12, -1e12]])}
    df = spark.createDataFrame([(k, float(v)) for k, x in groups.items() for v in x] + [("a", None), ("f", None)], "k string, v double")
    for few, ranges in ((100, 16), (1_000_000, 16)):
        got = {(r.k, r.p): r.quantile for r in ranks.quantiles(df, "k", "v", [0.0, 0.25, 0.5, 1.0], few, ranges).collect()}
        assert set(got) == {(k, p) for k in groups for p in (0.0, 0.25, 0.5, 1.0)}
        for (k, p), q in got.items():
            assert q == pytest.approx(np.quantile(groups[k], p), rel=1e-12, abs=1e-18), (k, p)


def test_scans_over_bins(spark):
    """What is carried over empty and full bins equals one ordered pass."""
    from traitloom.operators import ordered

    rng = np.random.default_rng(10)
    places = np.sort(rng.choice(3000, 200, replace=False))
    rows = [("c1", int(p), i, float(rng.normal()) if rng.random() < 0.2 else None) for i, p in enumerate(places)] + [("c2", 5, 999, None)]
    df = spark.createDataFrame(rows, "chrom string, at long, id long, mark double")
    by = {}
    last = None
    most = None
    for _, p, i, m in rows[:-1]:
        last, most = (m, max(m, most if most is not None else m)) if m is not None else (last, most)
        by[i] = [last, most]
    nxt = None
    for _, p, i, m in reversed(rows[:-1]):
        nxt = m if m is not None else nxt
        by[i].append(nxt)
    for size in (16, 1 << 16):
        got = {r.id: [r.before, r.most, r.after] for r in ordered.running_max(ordered.neighbours(df, "chrom", "at", "mark", size), "chrom", "at", F.col("mark"), "most", size).collect()}
        assert got.pop(999) == [None, None, None] and got == by
        jumps = np.cumsum(np.diff(places, prepend=places[0]) > 20)
        assert [r.n for r in ordered.islands(df.where("chrom = 'c1'"), "chrom", "at", "id", 20, "n", size).orderBy("id").collect()] == jumps.tolist()
    counts = {r.id: r.n for r in ordered.within_reach(df, "chrom", "at", 100, "n").collect()}
    assert all(counts[i] == ((places >= p - 100) & (places <= p)).sum() for _, p, i, _ in rows[:-1])


def test_one_long_contig_is_many_tasks(spark):
    """Ten million rows of one contig: the scan is dealt out over its bins, and no task holds more than a few of them."""
    from traitloom.operators import ordered

    n = 10_000_000
    df = spark.range(n).select(F.lit("c").alias("chrom"), F.col("id").alias("at"), F.when(F.col("id") % 1000 == 7, F.col("id")).alias("mark"))
    set_ = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        told = ordered.neighbours(df, "chrom", "at", "mark")
        right = F.coalesce(F.col("before"), F.lit(-1)) == F.when(F.col("at") >= 7, F.col("at") - (F.col("at") - 7) % 1000).otherwise(-1)
        rows = told.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"), F.count_if(right).alias("ok")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", set_[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", set_[1])
    assert sum(r.n for r in rows) == n and sum(r.ok for r in rows) == n and len(rows) >= 90 and max(r.n for r in rows) < n / 20


def test_component_along_a_contig(spark):
    """A chain of a million nodes is one component, found level by level; a gap in it makes two."""
    n = 1_000_000
    nodes = spark.range(n).select(F.lit("c").alias("chrom"), (F.col("id") * 500).alias("start_pos"), F.col("id").alias("feature_id"))
    edges = nodes.where(F.col("feature_id") != 600_000).select("chrom", F.col("feature_id").alias("i"), (F.col("feature_id") + 1).alias("j"), F.col("start_pos").alias("start_i"), (F.col("start_pos") + 500).alias("start_j")).where(F.col("j") < n)
    found = clusters.components(nodes, edges, 1000).groupBy("component").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {r.component: r.n for r in found} == {0: 600_001, 600_001: n - 600_001}


def test_components_in_small_bins(spark):
    """Random local graphs: any width of the first bins gives the components of the whole."""
    rng = np.random.default_rng(11)
    places = np.sort(rng.integers(0, 20_000, 300))
    pairs = [(int(a), int(b)) for a in range(300) for b in range(a + 1, 300) if places[b] - places[a] <= 200 and rng.random() < 0.25]
    root = list(range(300))
    for _ in range(300):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    nodes = spark.createDataFrame([("c", int(p), i) for i, p in enumerate(places)], "chrom string, start_pos long, feature_id long")
    edges = spark.createDataFrame([("c", a, b, int(places[a]), int(places[b])) for a, b in pairs], "chrom string, i long, j long, start_i long, start_j long")
    for width in (200, 4096, 1 << 20):
        assert {r.feature_id: r.component for r in clusters.components(nodes, edges, 200, width).collect()} == {x: root[x] for pair in pairs for x in pair}
    assert clusters.components(nodes, edges.limit(0), 200).count() == 0


def test_annotation_plan_does_not_grow_with_labels(spark):
    """One join of intervals whatever the labels: a bounded number of relations in the analysed plan."""
    from traitloom.plans.queries import Data

    d = Data(spark, "/root/testdata/sf0.001")
    plan = intervals.annotate(d.spots, d.genes, d.islands, d.ccres, d.gene_parts)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Relation [") <= 24


def test_a_stage_that_is_whole_is_not_made_again(spark, tmp_path):
    from traitloom.plans.pipelines import Stages

    first = Stages(spark, f"file://{tmp_path}/run")
    assert first("a", lambda: spark.range(3)).count() == 3 and first.made == ["a"]
    (tmp_path / "run" / "b").mkdir()  # begun and not ended
    again = Stages(spark, f"file://{tmp_path}/run")
    assert again("a", lambda: spark.range(9)).count() == 3 and again("b", lambda: spark.range(4)).count() == 4 and again.made == ["b"]


def test_clusters(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 6))
    x = np.repeat(base, 3, axis=0) + rng.normal(size=(36, 6)) * 0.05
    x[7] = 1.0
    places = np.sort(rng.integers(0, 4000, 36))
    frame = spark.createDataFrame([("chr1", int(p), i, list(map(float, r))) for i, (p, r) in enumerate(zip(places, x, strict=True))], "chrom string, start_pos long, feature_id long, vec array<double>")
    std = clusters.standardise(frame)
    edges = clusters.correlated_pairs(std, 300, 0.95)
    r = np.corrcoef(np.delete(x, 7, 0))
    index = [i for i in range(36) if i != 7]
    want = {(min(a, b), max(a, b)) for i, a in enumerate(index) for j, b in enumerate(index) if a < b and places[b] - places[a] <= 300 and abs(r[i, j]) >= 0.95}
    assert {(min(e.i, e.j), max(e.i, e.j)) for e in edges.collect()} == want and want
    root = {i: i for i in range(36)}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in want:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    members = clusters.components(std, edges, 300)
    got = {m.feature_id: m.component for m in members.collect()}
    assert got == {i: find(i) for pair in want for i in pair}
    table = clusters.cluster_table(std, edges, members)
    assert sum(c.n_correlated_pairs for c in table.collect()) == len(want)
    chosen = clusters.representatives(std, members, table).collect()
    assert 7 not in {c.feature_id for c in chosen} and len(chosen) == len({find(i) for i in range(36) if i != 7})


def test_tmm(spark):
    rng = np.random.default_rng(4)
    y = rng.poisson(rng.gamma(2, 30, 300)[:, None] * np.array([1, 1.5, 0.7, 2])).astype(float)
    y[:30, 2] *= 8
    rows = [(f"g{g}", f"s{s}", int(y[g, s])) for g in range(300) for s in range(4)]
    got = {r.sample_id: r.factor for r in expression.tmm_factors(spark.createDataFrame(rows, "gene_id string, sample_id string, cnt long")).collect()}
    n = y.sum(0)
    quartile = np.quantile(y / n, 0.75, axis=0)
    ref = int(np.abs(quartile - quartile.mean()).argmin())
    factors = []
    for k in range(4):
        ok = (y[:, k] > 0) & (y[:, ref] > 0)
        a, b = y[ok, k], y[ok, ref]
        m, e = np.log2((a / n[k]) / (b / n[ref])), 0.5 * np.log2((a / n[k]) * (b / n[ref]))
        v = (n[k] - a) / n[k] / a + (n[ref] - b) / n[ref] / b
        if np.abs(m).max() < 1e-6:
            factors.append(1.0)
            continue
        rank = lambda x: pd.Series(x).rank().to_numpy()
        size = len(m)
        lm, la = np.floor(size * 0.3) + 1, np.floor(size * 0.05) + 1
        keep = (rank(m) >= lm) & (rank(m) <= size + 1 - lm) & (rank(e) >= la) & (rank(e) <= size + 1 - la)
        factors.append(2 ** ((m[keep] / v[keep]).sum() / (1 / v[keep]).sum()))
    want = np.array(factors) / np.exp(np.log(factors).mean())
    assert [got[f"s{k}"] for k in range(4)] == pytest.approx(want, rel=1e-9)


def test_nearest_and_overlap_edges(spark):
    spots = spark.createDataFrame([("a", "1", 100, 100), ("b", "1", 1, 1), ("c", "2", 5, 5)], "site_key string, chrom string, start_pos long, end_pos long")
    parts = spark.createDataFrame([("x", "1", 90, 99), ("y", "1", 101, 120), ("z", "1", 100, 30_000)], "name string, chrom string, start_pos long, end_pos long")
    near = {r.site_key: r.nearest_distance for r in intervals.nearest_interval(spots, parts, "name").collect()}
    assert near == {"a": 0, "b": 89, "c": None}
    assert [(r.site_key, r.f_name) for r in intervals.overlap_join(spots, parts, 10).collect()] == [("a", "z")]
    points = spark.createDataFrame([("g2", "1", 102), ("g1", "1", 98), ("g0", "1", 98)], "gene_id string, chrom string, tss long")
    best = {r.site_key: (r.nearest_distance, r.gene_id) for r in intervals.nearest_point(spots, points, "tss", "gene_id", ["gene_id"]).collect()}
    assert best == {"a": (2, "g0"), "b": (97, "g0"), "c": (None, None)}
    assert [r.x for r in spark.sql("SELECT 'dELS;PLS' t UNION ALL SELECT 'PLS,dELS'").select(intervals.is_enhancer_like(F.col("t")).alias("x")).collect()] == [False, True]


def test_expectations(spark):
    df = spark.createDataFrame([("a", "1.5"), ("a", "x"), (None, None)], "k string, v string")
    with pytest.raises(ValueError):
        expect.require(expect.repeated_keys(df, "k"), "keys repeat")
    with pytest.raises(ValueError):
        expect.require_columns(df, ["k", "zz"])
    with pytest.raises(ValueError):
        expect.require_same_schema([df, df.select("k")])
    assert [r.v for r in expect.not_numeric(df, "v").collect()] == ["x"] and expect.blank_keys(df, "k").first().n == 1


def test_ids_and_covariates(spark):
    protein = spark.createDataFrame([("s1", "r1"), ("s2", "r2")], "SampleID string, ResearchID string")
    names = lambda *x: spark.createDataFrame([(i,) for i in x], "sample_id string")
    assert proteomics.choose_id_column(protein, names("r1", "r2", "s1")) == "ResearchID" and proteomics.choose_id_column(protein, names("s1", "r1")) == "SampleID"
    with pytest.raises(ValueError):
        proteomics.choose_id_column(protein, names("q"))
    pcs, extra = spark.createDataFrame([("a", 1.0)], "ID string, PC1 double"), spark.createDataFrame([("a", 2.0), ("b", 3.0)], "sample_id string, age double")
    assert covariates.correlation_covariates(pcs, extra).collect()[0].asDict() == {"sample_id": "a", "PC1": 1.0, "age": 2.0}
    with pytest.raises(ValueError):
        covariates.correlation_covariates(extra.withColumnRenamed("sample_id", "ID").withColumnRenamed("age", "PC1"), pcs.withColumnRenamed("ID", "sample_id").withColumnRenamed("PC1", "age"))


def test_genotypes(spark):
    df = spark.createDataFrame([("chr1", 5, "A", "G", f"s{i}", gt) for i, gt in enumerate(["0/0", "0|1", "1/1", "./.", "1/2"])], "chrom string, pos long, ref string, alt string, sample_id string, gt string")
    rows = genotype.autosomal(df)
    assert [r.d for r in rows.select("sample_id", genotype.dosage().alias("d")).orderBy("sample_id").collect()] == [0, 1, 2, None, 2]
    r = genotype.allele_frequency(rows).first()
    assert (r.variant_id, r.alt_alleles, r.called_alleles, r.frequency) == ("chr1:5_A_G", 5, 8, 0.625)
    with pytest.raises(Exception, match="too long"):
        genotype.autosomal(df.withColumn("ref", F.lit("A" * 60))).collect()


def test_spearman_of_constant_and_two_value_sites(spark):
    """A site with one value or one coverage has no correlation; one with two values has."""
    site = lambda k, xs, ys: [("chr1", 1, 2, k, x, y, True) for x, y in zip(xs, ys, strict=True)]
    rows = site("flat", [0.5] * 4, [1.0, 2.0, 3.0, 4.0]) + site("even", [0.1, 0.2, 0.3], [2.0] * 3) + site("two", [0.1, 0.1, 0.9, 0.9], [1.0, 2.0, 3.0, 4.0]) + site("few", [0.1, 0.2], [1.0, 2.0])
    from traitloom.operators import cohort

    frame = spark.createDataFrame(rows, "chrom string, begin_pos long, end_pos long, site_key string, value double, norm_log_cov double, per_sample_qc_pass boolean")
    rho = {r.site_key: r.coverage_methylation_spearman_rho for r in cohort.coverage_correlation(frame).collect()}
    assert rho["flat"] is None and rho["even"] is None and rho["few"] is None and abs(rho["two"] - 0.894427191) < 1e-9


def test_registry_without_the_corpus_operators(tmp_path):
    """The rest works once the corpus operators, their tests and the pipeline are deleted, with the pipeline's file or without."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    shutil.copytree(root / "traitloom", tmp_path / "traitloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (root / name).exists():
            shutil.copy(root / name, tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 150 and set(e.oracle_sql()) <= set(q) and 'pipeline' not in q and not [n for n in q if n.startswith('op')]"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)


def test_cohort_in_one_shuffle(spark):
    """All metrics, the correlation and the imputed counts of a cohort need calls to be dealt out by site once."""
    from traitloom.plans.queries import FRACTION, MAD, N_SAMPLES, Data
    from traitloom.sources.shared import keep

    longs = keep(Data(spark, "/root/testdata/sf0.001").longs, "longs")
    plan = cohort.merge_cohort(longs, N_SAMPLES, FRACTION, MAD)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


def test_arrays_of_a_site(spark):
    """Grid, means and average ranks of sites with ties, gaps, samples outside the cohort, values that aren't finite, and none at all."""
    calls_ = [
        ("k1", "a", 0.5, True), ("k1", "b", 0.25, True), ("k1", "d", 0.5, True), ("k1", "c", 0.9, False), ("k1", "z", 0.7, True), ("k2", "a", float("nan"), True), ("k2", "b", 0.1, True),
        ("k3", "a", 0.2, False), ("k4", "a", 0.1, True), ("k5", "d", 0.3, True), ("k5", "c", 0.30000000001, True), ("k5", "b", 0.2, True),
    ]
    longs = spark.createDataFrame(calls_, "site_key string, sample_id string, value double, per_sample_qc_pass boolean")
    sites = spark.createDataFrame([("c", i, i + 1, f"k{i}", i != 4) for i in range(1, 6)], "chrom string, begin_pos long, end_pos long, site_key string, keep_site boolean")
    got = {r.site_key: r for r in cohort.cohort_arrays(longs, sites, list("abcd"), 9).collect()}
    assert set(got) == {"k1", "k2", "k3", "k5"}
    mean = (0.5 + 0.25 + 0.5) / 3
    assert got["k1"].values == [0.5, 0.25, None, 0.5] and got["k1"].filled == pytest.approx([0.5, 0.25, mean, 0.5]) and got["k1"].ranks == [3.5, 1.0, 2.0, 3.5]
    assert got["k2"].filled == [0.1] * 4 and got["k2"].ranks == [2.5] * 4 and got["k2"].values == [None, 0.1, None, None]
    assert got["k3"].values == got["k3"].filled == got["k3"].ranks == [None] * 4
    assert got["k5"].ranks == [2.0, 1.0, 3.5, 3.5]  # alike to nine digits; the mean lies between
    long = {(r.site_key, r.sample_id): (r.imputed, r.score) for r in cohort.cohort_long(cohort.cohort_arrays(longs, sites, list("abcd"), 9), list("abcd")).collect()}
    assert len(long) == 16 and long["k1", "c"][0] and not long["k1", "a"][0] and long["k2", "a"][1] == pytest.approx(0, abs=1e-9) and long["k3", "a"] == (True, None)
    assert cohort.cohort_arrays(longs.limit(0), sites, list("abcd")).count() == 4


def test_ends_of_trimmed_ranks(spark):
    """The values whose average rank lies inside are those between the ends, with ties, few values, and groups over several rounds."""
    rng = np.random.default_rng(4)
    groups = {"ties": rng.integers(0, 9, 400) / 1.0, "apart": rng.normal(size=300), "alike": np.ones(50), "two": np.array([1.0, 2.0]), "three": np.array([1.0, 1.0, 2.0])}
    rows = [(k, float(x)) for k, v in groups.items() for x in v]
    frame = spark.createDataFrame(rows, "g string, v double")
    for trim in (0.3,):
        for few in (20, 50_000):
            ends = {r.g: (r.low, r.high) for r in ranks.central(frame, "g", "v", trim, few=few, ranges=8).collect()}
            for k, v in groups.items():
                rank = pd.Series(v).rank().to_numpy()
                cut = math.floor(len(v) * trim) + 1
                assert (((v >= ends[k][0]) & (v <= ends[k][1])) == ((rank >= cut) & (rank <= len(v) + 1 - cut))).all(), (k, trim, few)


def test_windows_are_dealt_by_rows(spark):
    """Tasks of windows by feature grow in number, not in size; no plan coalesces them."""
    rows = shared.keep(spark.range(12_000).select((F.col("id") / 4).cast("long").alias("feature_id"), F.col("id").alias("v")), "rows")
    assert shared.dealt(rows, "feature_id", rows=1_000).rdd.getNumPartitions() == 12
    held = shared.dealt(rows, "feature_id", rows=1_000).groupBy(F.spark_partition_id().alias("t")).agg(F.count("*").alias("n"), F.count_distinct("feature_id").alias("f")).collect()
    assert max(r.n for r in held) < 2_000 and sum(r.f for r in held) == 3_000


def test_long_vectors_are_standardised_in_one_pass(spark):
    """The mean is worked out once a vector: vectors of 20,000 values take no time that grows with their square."""
    frame = spark.range(8).select(F.transform(F.sequence(F.lit(0), F.lit(19_999)), lambda i: (i * 7919 % 10_007 + F.col("id")).cast("double")).alias("vec"))
    began = time.monotonic()
    for row in clusters.standardise(shared.keep(frame, "long-vectors")).collect():
        x = np.array(row.vec)
        assert row.valid and abs(x.sum()) < 1e-9 and abs(x @ x - 1) < 1e-9
    assert time.monotonic() - began < 30
