"""Nearest neighbours by inner product: vantage-point trees over shards, pruned by the triangle inequality."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

TOP, EVERY = 20, 20
#: One restores exact search; greater ones prune as if bounds were that much farther off.
FACTOR = 1.0
#: Vectors of a shard, and queries that are searched for in it together.
SHARD, QUERIES = 4096, 4096
#: Vectors that shards are fitted on, at most so many shards' centres (larger shards are dealt out), and rounds of fitting.
SAMPLE, CENTRES, ROUNDS = 8192, 1024, 4
LEAF = 64
#: Slack of bounds against the vectors' length, far above rounding.
SLACK = 1e-6


def raised(x: np.ndarray, most: float) -> np.ndarray:
    """Vectors with one more coordinate that brings all to the length `most`: of these, the nearest to a query raised by zero is the
    one of largest inner product."""
    return np.column_stack([x, np.sqrt(np.maximum(most * most - (x * x).sum(1), 0))])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each row of a from each of b."""
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0))


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows with rows, summed from the first component to the last, so that equal vectors give equal sums."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


def reach(queries: np.ndarray, score: np.ndarray, most: float) -> np.ndarray:
    """How far a raised vector of that inner product with the query is from it; without bound for a score of minus infinity."""
    return np.sqrt(np.maximum((queries * queries).sum(1) + most * most - 2 * score, 0))


class Tree:
    """A vantage-point tree of vectors no longer than `most`, raised to that length: a node's members are halved by their distance
    from one of them, and each half keeps the range of these."""

    def __init__(self, vectors: np.ndarray, most: float, leaf: int = LEAF):
        self.vectors, self.most, self.leaf = vectors, most, leaf
        self.points = raised(vectors, most)
        self.root = self._grow(np.arange(len(vectors)))

    def _grow(self, own: np.ndarray):
        if len(own) <= self.leaf:
            return own
        centre = self.points[own].mean(0, keepdims=True)
        vantage = own[distances(self.points[own], centre)[:, 0].argmax()]
        far = distances(self.points[own], self.points[vantage : vantage + 1])[:, 0]
        order = np.argsort(far, kind="stable")
        half = len(own) // 2
        parts = order[:half], order[half:]
        return vantage, [(far[p[0]], far[p[-1]], self._grow(np.sort(own[p]))) for p in parts]

    def search(self, asked: np.ndarray, k: int, least: np.ndarray, factor: float = 1.0) -> tuple[np.ndarray, np.ndarray, int]:
        """For each query the k vectors of largest inner product (largest first, ties to the lower index, -1: none) among those of at
        least `least`, and how many distances were worked out. A half is left out where the least distance that the triangle
        inequality allows, times factor, is farther than the k-th found can be."""
        n = len(asked)
        queries = np.column_stack([asked, np.zeros(n)])
        best, index = np.full((n, k), -np.inf), np.full((n, k), -1)
        slack = SLACK * max(self.most, np.sqrt((asked * asked).sum(1).max()) if n else 0)
        limit, worked = reach(asked, least, self.most) + slack, 0
        leaf_of = np.zeros(n, np.int64)

        def look(own: np.ndarray, active: np.ndarray) -> None:
            nonlocal worked
            worked += len(own) * len(active)
            near = distances(queries[active], self.points[own]) <= limit[active, None]
            some = np.flatnonzero(near.any(1))
            if not len(some):
                return
            row, column = np.nonzero(near[some])
            rows = active[some]
            fresh = np.full((len(rows), len(own)), -np.inf)
            fresh[row, column] = inner_products(asked[rows[row]], self.vectors[own[column]])
            score = np.concatenate([best[rows], fresh], 1)
            spot = np.concatenate([index[rows], np.where(fresh > -np.inf, own, -1)], 1)
            order = np.argsort(spot, 1, kind="stable")  # ties of score stay in order of the index
            score, spot = np.take_along_axis(score, order, 1), np.take_along_axis(spot, order, 1)
            order = np.argsort(-score, 1, kind="stable")
            score, spot = np.take_along_axis(score, order, 1), np.take_along_axis(spot, order, 1)
            best[rows], index[rows] = score[:, :k], spot[:, :k]
            limit[rows] = np.minimum(limit[rows], reach(asked[rows], best[rows, -1], self.most) + slack)

        def down(node, active: np.ndarray, home: bool) -> None:
            """First each query's own leaf (home), then every other one that may hold something nearer."""
            nonlocal worked
            if not len(active):
                return
            if isinstance(node, np.ndarray):
                fresh = active if home else active[leaf_of[active] != id(node)]
                if home:
                    leaf_of[active] = id(node)
                if len(fresh):
                    look(node, fresh)
                return
            vantage, halves = node
            worked += len(active)
            at = distances(queries[active], self.points[vantage : vantage + 1])[:, 0]
            if home:
                inner = at <= (halves[0][1] + halves[1][0]) / 2
                down(halves[0][2], active[inner], True)
                down(halves[1][2], active[~inner], True)
                return
            for low, high, part in halves:
                bound = np.maximum(np.maximum(low - at, at - high), 0)
                down(part, active[bound * factor <= limit[active]], False)

        down(self.root, np.arange(n), True)
        down(self.root, np.arange(n), False)
        return best, index, worked


def _matrix(column) -> np.ndarray:
    """A list column of equal lengths as rows of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1)


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of rows that can take part: neither null nor zero, and all components finite."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where(F.col("embedding").isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists("embedding", lambda x: x != 0))


def _fit(sample: np.ndarray, n: int) -> np.ndarray:
    """n centres by a few rounds of means over the sample, which is in order of a hash, so that its first rows are a fair choice."""
    centres = sample[:n].copy()
    for _ in range(ROUNDS):
        of = distances(sample, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, of, sample)
        size = np.bincount(of, minlength=len(centres))
        centres[size > 0] = sums[size > 0] / size[size > 0, None]
    return centres


class _Index:
    """Shards of distinct vectors of one dimension, in the shared folder, and what is needed to say which ones a query has to see."""

    def __init__(self, spark: SparkSession, distinct: DataFrame, dim: int, shard: int):
        self.spark, self.dim = spark, dim
        told = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)).alias("most")).first()
        self.most = float(np.sqrt(told["most"])) * (1 + SLACK)
        drawn = distinct.orderBy(F.xxhash64("embedding"), "embedding").limit(SAMPLE).select("embedding").collect()
        sample = raised(np.array([r["embedding"] for r in drawn], float), self.most)
        self.centres = _fit(sample, min(CENTRES, len(sample), max(1, told["n"] // shard)))
        sent = spark.sparkContext.broadcast((self.centres, self.most))

        def assign(batches):
            centres, most = sent.value
            for batch in batches:
                if batch.num_rows:
                    far = distances(raised(_matrix(batch.column("embedding")), most), centres)
                    of = far.argmin(1)
                    yield pa.record_batch([*batch.columns, pa.array(of, pa.int32()), pa.array(far[np.arange(len(of)), of])], [*batch.schema.names, "cell", "far"])

        cells = common.stash(distinct.mapInArrow(assign, "embedding array<double>, ids array<long>, cell int, far double"), "neighbours-cells")
        self.sizes, self.radius = np.zeros(len(self.centres), np.int64), np.full(len(self.centres), -1.0)
        for row in cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect():  # a row a centre
            self.sizes[row["cell"]], self.radius[row["cell"]] = row["n"], row["far"]
        self.deals = np.maximum(1, -(-self.sizes // (2 * shard)))
        deals = F.element_at(F.lit([int(x) for x in self.deals]), F.col("cell") + 1)
        self.shards = cells.select("cell", F.pmod(F.xxhash64("embedding"), deals).cast("int").alias("deal"), "embedding", "ids")

    def route(self, queries: DataFrame, home: bool, factor: float) -> DataFrame:
        """A row for each shard of the cells that a query (query, embedding, least) has to see: of its own cell, or of the others
        whose bounds, times factor, are within reach of a vector that scores `least`."""
        sent = self.spark.sparkContext.broadcast((self.centres, self.most, self.sizes, self.radius, self.deals))
        schema = "query long, embedding array<double>, least double, cell int, deal int"

        def look(batches):
            centres, most, sizes, radius, deals = sent.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _matrix(batch.column("embedding"))
                at = distances(np.column_stack([x, np.zeros(len(x))]), centres)
                mine = np.zeros(at.shape, bool)
                mine[np.arange(len(x)), np.where(sizes > 0, at, np.inf).argmin(1)] = True
                if not home:
                    # a member lies within its cell's radius, and nearer to its own centre than to this query's
                    bound = np.maximum(np.maximum(at - radius, (at - at.min(1, keepdims=True)) / 2), 0)
                    limit = reach(x, batch.column("least").to_numpy(), most) + SLACK * most
                    mine = ~mine & (sizes > 0) & (bound * factor <= limit[:, None])
                row, cell = np.nonzero(mine)
                times = deals[cell]
                row, cell = np.repeat(row, times), np.repeat(cell, times)
                deal = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                yield pa.record_batch([*batch.take(pa.array(row)).columns, pa.array(cell, pa.int32()), pa.array(deal, pa.int32())], ["query", "embedding", "least", "cell", "deal"])

        return queries.select("query", "embedding", "least").mapInArrow(look, schema)

    def nearest(self, routed: DataFrame, top: int, factor: float) -> DataFrame:
        """(query, vec_id, score): of each shard that a query was sent to, the ids of its nearest distinct vectors. Queries of a
        shard are searched for in blocks, each with a tree of the shard's vectors."""
        most, k = self.most, top + 1
        routed = common.stash(routed, "neighbours-routed")
        asked = routed.groupBy("cell", "deal").agg(F.count(F.lit(1)).alias("asked"))
        blocks = F.ceil(F.col("asked") / QUERIES).cast("int")
        routed = routed.join(asked, ["cell", "deal"]).withColumn("block", F.pmod(F.xxhash64("query"), blocks).cast("int")).drop("asked")
        points = self.shards.join(asked, ["cell", "deal"]).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).drop("asked")
        key = ["cell", "deal", "block"]
        schema = pa.schema([("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

        def look(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return schema.empty_table()
            # in order of the least id, so that ties of index are ties of id
            ids = left.column("ids").combine_chunks()
            order = np.argsort(pa.compute.list_element(ids, 0).to_numpy(), kind="stable")
            ids = ids.take(pa.array(order))
            best, spot, _ = Tree(_matrix(left.column("embedding"))[order], most).search(_matrix(right.column("embedding")), k, right.column("least").to_numpy(), factor)
            row, column = np.nonzero(spot >= 0)
            taken = ids.take(pa.array(spot[row, column]))
            times = pa.compute.list_value_length(taken).to_numpy(zero_copy_only=False)
            return pa.table([np.repeat(right.column("query").to_numpy()[row], times), taken.flatten(), np.repeat(best[row, column], times)], schema=schema)

        found = points.groupBy(*key).cogroup(routed.groupBy(*key)).applyInArrow(look, "query long, vec_id long, score double")
        return common.top_ranked(found, ["query"], [F.desc("score"), F.asc("vec_id")], k, F.col("vec_id"), 1).drop("rank")


def nearest_neighbours(vectors: DataFrame, every: int = EVERY, top: int = TOP, factor: float = FACTOR, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: for each vector whose vec_id `every` divides, the `top` others of largest inner product.

    vectors holds vec_id (long) and embedding; extra columns don't matter. Vectors that are null, zero, or hold a null or a number
    that isn't finite take no part, nor do rows without an id; vectors of different lengths are never compared. Of equal vectors
    (one may be a third of all rows) only the top + 1 least ids can be among a query's nearest, so only these are indexed, and
    equal queries are searched for once. Equal scores go by vec_id; rows that repeat an id are one candidate if equal, else several. An
    empty table gives no rows.

    Shards are the cells of centres fitted on a sample of at most SAMPLE vectors; every vector is indexed, and a cell above two shards'
    size is dealt out. A query looks into its own cell first, and then into those that the triangle inequality can't rule out
    at the distance found; with factor 1 the result is exact, greater factors look at less.
    """
    spark = vectors.sparkSession
    whole = common.stash(whole_vectors(vectors).where("vec_id is not null"), "neighbours")
    some = common.top_ranked(whole.dropDuplicates(["embedding", "vec_id"]), ["embedding"], [F.asc("vec_id")], top + 1, F.col("vec_id"))
    distinct = common.stash(some.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "neighbours-distinct")
    asking = whole.where(F.col("vec_id") % every == 0)
    asked = asking.select("embedding").distinct().select(F.monotonically_increasing_id().alias("query"), "embedding")
    asked = common.stash(asked, "neighbours-queries")
    out = None
    for (dim,) in distinct.select(F.size("embedding")).distinct().collect():  # lengths of vectors, one in most tables
        own = asked.where(F.size("embedding") == dim)
        index = _Index(spark, distinct.where(F.size("embedding") == dim), dim, shard)
        none = F.lit(float("-inf"))
        near = common.stash(index.nearest(index.route(own.withColumn("least", none), True, factor), top, factor), "neighbours-home")
        least = near.groupBy("query").agg(F.when(F.count(F.lit(1)) > top, F.min("score")).alias("least"))
        again = own.join(least, "query", "left").withColumn("least", F.coalesce("least", none))
        both = near.unionByName(index.nearest(index.route(again, False, factor), top, factor))
        best = common.top_ranked(both, ["query"], [F.desc("score"), F.asc("vec_id")], top + 1, F.col("vec_id"), 1)
        out = best if out is None else out.unionByName(best)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = asking.select(F.col("vec_id").alias("query_id"), "embedding").distinct().join(asked, "embedding").join(out.drop("rank"), "query")
    found = found.where("vec_id <> query_id").select("query_id", "vec_id", "score")
    ranked = common.top_ranked(found, ["query_id"], [F.desc("score"), F.asc("vec_id")], top, F.col("vec_id"), 1)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th one of embeddings."""
    return nearest_neighbours(common.table(spark, sf_dir, "embeddings"))


OP13_SQL = f"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
pairs AS (SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.x, v.x) AS score FROM v q JOIN v ON len(v.x) = len(q.x) AND v.vec_id <> q.vec_id WHERE q.vec_id % {EVERY} = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM pairs QUALIFY rank <= {TOP}
"""
