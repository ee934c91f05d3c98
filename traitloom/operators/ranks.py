"""Exact quantiles by group without a group in one task: values are counted by ranges, and ranges narrowed until the rank is found."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import keep

#: Ranges that a group's values are counted in at a time, and values that are ordered in one task at most.
RANGES, FEW = 4096, 50_000


def _wanted(bounds: DataFrame, probabilities: list[float]) -> DataFrame:
    """Rows (key, p, rank, n) of the one or two order statistics, from 0, that each quantile lies between."""
    p = F.explode(F.array(*[F.lit(float(x)) for x in probabilities]))
    rows = bounds.withColumn("p", p).withColumn("at", F.col("p") * (F.col("n") - 1))
    return rows.withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at"))))).drop("at")


def quantiles(df: DataFrame, by: str, value: str, probabilities: list[float], few: int = FEW, ranges: int = RANGES) -> DataFrame:
    """(by, p, quantile) with linear interpolation, of values that aren't null; a group without values has no row.

    Each round counts the values of a group in equal ranges between the least and the greatest that are still in question, with
    partial sums where the rows lie, and goes on with the range that holds the wanted rank; what is left is ordered once it is
    at most `few` values a range. Values alike end in a range of one value and need no order at all.
    """
    rows = df.select(F.col(by).alias("key"), F.col(value).cast("double").alias("v")).where("v is not null")
    bounds = keep(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")), "bounds")
    if (bounds.agg(F.max("n")).first()[0] or 0) <= few:  # each group fits into a task as it is
        p = F.array(*[F.lit(float(x)) for x in probabilities])
        every = rows.groupBy("key").agg(F.arrays_zip(p.alias("p"), F.percentile("v", p).alias("quantile")).alias("q"))
        return every.select(F.col("key").alias(by), F.explode("q").alias("q")).select(by, "q.p", "q.quantile")
    pair = _selected(rows, bounds, _wanted(bounds, probabilities), few, ranges)
    at = F.col("p") * (F.col("n") - 1)
    pair = pair.groupBy("key", "p", "n").agg(F.min_by("v", "rank").alias("a"), F.max_by("v", "rank").alias("b"))
    return pair.select(F.col("key").alias(by), "p", (F.col("a") + (F.col("b") - F.col("a")) * (at - F.floor(at))).alias("quantile"))


def _selected(rows: DataFrame, bounds: DataFrame, wanted: DataFrame, few: int, ranges: int) -> DataFrame:
    """(key, p, n, rank, v): of rows (key, v) the values of the ranks of wanted (bounds with p and rank, from 0)."""
    # below: values of the group that are less than low
    open_ = keep(wanted.withColumns({"below": F.lit(0).cast("long"), "held": F.col("n")}), "ranks")
    done = None
    step = (F.col("high") - F.col("low")) / ranges
    place = F.least(F.lit(ranges - 1), F.floor((F.col("v") - F.col("low")) / step))
    while True:
        small = (F.col("low") == F.col("high")) | (F.col("held") <= few)
        ready = open_.where(small)
        done = ready if done is None else done.unionByName(ready)
        open_ = open_.where(~small)
        if open_.isEmpty():
            break
        spans = open_.select("key", "low", "high").distinct()
        inside = rows.join(spans, "key").where(F.col("v").between(F.col("low"), F.col("high")))
        told = inside.withColumn("range", place).groupBy("key", "low", "high", "range").agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("least"), F.max("v").alias("most"))
        before = F.sum("c").over(Window.partitionBy("key", "low", "high").orderBy("range")) - F.col("c")  # at most `ranges` rows a span
        told = told.withColumn("before", before)
        next_ = open_.join(told, ["key", "low", "high"]).where((F.col("rank") >= F.col("below") + F.col("before")) & (F.col("rank") < F.col("below") + F.col("before") + F.col("c")))
        open_ = keep(next_.select("key", "n", F.col("least").alias("low"), F.col("most").alias("high"), "p", "rank", (F.col("below") + F.col("before")).alias("below"), F.col("c").alias("held")), "ranks")
    flat = done.where("low = high").select("key", "p", "n", "rank", F.col("low").alias("v"))
    spans = done.where("low <> high")
    left = rows.join(spans.select("key", "low", "high").distinct(), "key").where(F.col("v").between(F.col("low"), F.col("high")))
    placed = left.withColumn("i", F.row_number().over(Window.partitionBy("key", "low", "high").orderBy("v")) - 1)
    found = spans.join(placed, ["key", "low", "high"]).where(F.col("i") == F.col("rank") - F.col("below")).select("key", "p", "n", "rank", "v")
    return flat.unionByName(found)


def central(df: DataFrame, by: str, value: str, trim: float, few: int = FEW, ranges: int = RANGES) -> DataFrame:
    """(by, low, high): the least and the greatest value whose average rank among the n values of its group is from
    floor(n * trim) + 1 to n - floor(n * trim); low is above high where none is. No task holds a group.

    Average ranks grow with the values, so an end is the value of the first such rank or, where its ties rank lower on average,
    the one next to it.
    """
    rows = df.select(F.col(by).alias("key"), F.col(value).cast("double").alias("v")).where("v is not null")
    bounds = keep(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")), "bounds")
    cut = F.floor(F.col("n") * F.lit(trim)).cast("long")
    ends = bounds.withColumn("e", F.explode(F.array(F.struct(F.lit(0.0).alias("p"), cut.alias("rank")), F.struct(F.lit(1.0).alias("p"), (F.col("n") - 1 - cut).alias("rank")))))
    ends = ends.select("key", "n", "low", "high", "e.p", "e.rank").where("rank between 0 and n - 1")
    found = keep(_selected(rows, bounds, ends, few, ranges).groupBy("key", "n").agg(F.max(F.when(F.col("p") == 0, F.col("v"))).alias("x"), F.max(F.when(F.col("p") == 1, F.col("v"))).alias("y")), "ends")
    v, x, y = (F.col(c) for c in "vxy")
    told = rows.join(F.broadcast(found), "key").groupBy("key", "n", "x", "y").agg(
        F.count_if(v < x).alias("below"), F.count_if(v == x).alias("at_x"), F.min(F.when(v > x, v)).alias("after"),
        F.count_if(v < y).alias("until"), F.count_if(v == y).alias("at_y"), F.max(F.when(v < y, v)).alias("before"),
    )
    rank_x, rank_y = F.col("below") + (F.col("at_x") + 1) / 2, F.col("until") + (F.col("at_y") + 1) / 2
    none = F.lit(float("inf"))
    low = F.when(rank_x >= cut + 1, x).otherwise(F.coalesce("after", none))
    high = F.when(rank_y <= F.col("n") - cut, y).otherwise(F.coalesce("before", -none))
    return told.select(F.col("key").alias(by), low.alias("low"), high.alias("high"))


def medians(df: DataFrame, by: str, value: str, name: str, few: int = FEW) -> DataFrame:
    """(by, name)."""
    return quantiles(df, by, value, [0.5], few).select(by, F.col("quantile").alias(name))
