"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

WEIGHTS, MAX_REPEAT, SEED = (5, 2, 1), 3, 20240601
#: Rows of one size and source that one task ranks; more are dealt over further buckets.
BUCKET_ROWS = 16_384


def offset(seed: int = SEED) -> float:
    """The one random offset of a mix."""
    return round(random.Random(seed).random(), 9)


def source_targets(totals: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """totals (source, source_size) with each source's target words.

    Sources in code-point order, null last, take the weights in turn. All words are shared by weight; a target
    stops at max_repeat times its source and the excess is reshared by weight, so a target is
    min(cap, level * weight) with one water level, found from running sums over sources by cap per weight.
    One row a source: the windows hold sources, never documents.
    """
    every = Window.partitionBy(F.lit(0))
    order = every.orderBy(F.col("source").asc_nulls_last())
    cap = F.col("source_size") * max_repeat
    ranked = totals.withColumn("i", F.row_number().over(order) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("i") % len(weights) + 1).cast("int"))
    ).withColumn("cap", cap.cast("double")).withColumn("ratio", F.col("cap") / F.col("weight"))
    filling = every.orderBy("ratio", "i")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(every).cast("double")
    levels = ranked.withColumn("turn", F.row_number().over(filling)).withColumn(
        "lam",
        (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
    )
    level = F.min(F.when(F.col("lam") <= F.col("ratio"), F.struct("turn", "lam"))).over(every)
    return levels.withColumn("level", level).select(
        "source", "source_size", F.least("cap", F.col("level.lam") * F.col("weight")).alias("target")
    )


def plan_mix(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = SEED) -> DataFrame:
    """How often the mix takes each row of docs (doc_id, text, source): all columns of docs, then
    mix_size, mix_source_size, mix_target, mix_copies.

    Each document of a source has the same expected number of copies, target over source size. Documents of a
    source stand by falling size, so the words taken are off the target by about one large document at most;
    a document's prefix sum is its rank times the rate; it is emitted once per integer that its
    stretch of the prefix sum, shifted by the offset, crosses.

    Ranks are counted in pieces: a histogram by source and size, then by bucket within a size, gives each piece's start and a
    window only ranks rows of one piece, so a source of any number of rows is dealt over many tasks. Very long texts count whole.
    Null text has size 0; null source is a source; documents of equal source, size, id and text share their
    copies in any order; an empty table gives an empty result. Existing mix_* columns are replaced.
    """
    keep = [c for c in docs.columns if c not in ("mix_size", "mix_source_size", "mix_target", "mix_copies")]
    sized = docs.select(
        *keep,
        F.coalesce(F.regexp_count("text", F.lit(common.SPACE_WORD)), F.lit(0)).cast("long").alias("mix_size"),
        F.xxhash64("text").alias("__tie"),
    )
    return _ranked(sized, keep, weights, max_repeat, seed)


def _ranked(sized: DataFrame, keep: list[str], weights, max_repeat: int, seed: int) -> DataFrame:
    """sized: keep, mix_size and __tie. One shuffle of the rows: the window and the join share their keys."""
    key = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null")).alias("__key")
    small = common.stash(sized.select("doc_id", "source", "mix_size", "__tie"), "mix-sizes")
    buckets = 1 + small.count() // BUCKET_ROWS
    bucket = F.pmod(F.xxhash64("doc_id", "__tie"), F.lit(buckets)).alias("__bucket")
    hist = common.stash(small.groupBy(key, "source", "mix_size", bucket).count(), "mix-histogram")
    totals = hist.groupBy("source").agg(F.sum(F.col("mix_size") * F.col("count")).alias("source_size"))
    targets = source_targets(totals, weights, max_repeat).withColumn("__key", key).drop("source")
    # Two prefix sums: over the sizes of a source, which are few however many rows it has, and over the buckets of one size.
    ahead = Window.partitionBy("__key").orderBy(F.desc("mix_size")).rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("__key", "mix_size").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = hist.groupBy("__key", "mix_size").agg(F.sum("count").alias("n"))
    sizes = sizes.select("__key", "mix_size", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("__ahead"))
    starts = (
        hist.join(sizes, ["__key", "mix_size"]).withColumn("__start", F.col("__ahead") + F.coalesce(F.sum("count").over(within), F.lit(0)))
        .join(targets, "__key").select("__key", "mix_size", "__bucket", "__start", "source_size", "target")
    )
    piece = ["__key", "mix_size", "__bucket"]
    rows = (sized if set(keep) - {"doc_id", "source"} else small).select("*", key, bucket)
    rows = rows.withColumn("__rank", F.row_number().over(Window.partitionBy(*piece).orderBy("doc_id", "__tie")) - 1)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    place, u = (F.col("__start") + F.col("__rank")).cast("double"), F.lit(offset(seed))
    copies = F.least(F.lit(max_repeat).cast("long"), F.floor((place + 1.0) * rate + u) - F.floor(place * rate + u))
    own = [rows[c].alias(f"__keep_{c}") for c in keep]  # names of the caller never meet ours
    rows = rows.select(*own, *piece, "__rank")
    return rows.join(starts, piece).select(
        *[F.col(f"`__keep_{c}`").alias(c) for c in keep], "mix_size", F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"), copies.cast("long").alias("mix_copies"),
    )


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row of plan_mix() as often as it is taken, without the mix_* columns."""
    keep = [c for c in mixed.columns if not c.startswith("mix_")]
    return mixed.where("mix_copies > 0").select(*keep, F.explode(F.sequence(F.lit(1).cast("long"), "mix_copies")).alias("__copy")).select(*keep)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: what it takes of each."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sized = docs.select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(common.SPACE_WORD)), F.lit(0)).cast("long").alias("mix_size"),
        F.xxhash64("text").alias("__tie"),
    )
    mixed = _ranked(sized, ["doc_id", "source"], WEIGHTS, MAX_REPEAT, SEED)
    return mixed.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.round("mix_target", 4).alias("target"), (F.col("mix_copies") * F.col("mix_size")).alias("taken"),
        F.col("mix_copies").alias("copies"),
    )


OP3_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM totals
), weighed AS (
  SELECT *, CAST(CASE i % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight, CAST(source_size * 3 AS DOUBLE) AS cap FROM ranked
), levels AS (
  SELECT *, row_number() OVER f AS turn,
    (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER (ORDER BY cap / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lam
  FROM weighed WINDOW f AS (ORDER BY cap / weight, i)
), targets AS (
  SELECT source, source_size, least(cap, weight * (SELECT arg_min(lam, turn) FROM levels WHERE lam <= cap / weight)) AS target FROM levels
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    CAST(row_number() OVER (PARTITION BY s.source ORDER BY s.size DESC, s.doc_id) - 1 AS DOUBLE) AS place
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), taken AS (
  SELECT *, least(3, CAST(floor((place + 1.0) * rate + {offset()}) - floor(place * rate + {offset()}) AS BIGINT)) AS copies FROM placed
)
SELECT doc_id, size, source_size, round(target, 4) AS target, copies * size AS taken, copies FROM taken
"""
