"""Scans along a contig in two levels: within bins of positions, and over one row a bin. No task holds a contig."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Base pairs of a bin. A contig of 250 million has 3,815 bins, which is what its second level orders.
BIN = 1 << 16


def binned(rows: DataFrame, by: str, at: str, size: int = BIN) -> DataFrame:
    """rows with __bin, dealt out by contig and bin, so that what follows within bins needs no further shuffle."""
    return rows.withColumn("__bin", F.floor(F.col(at) / size)).repartition(by, "__bin")


def carried(rows: DataFrame, by: str, summary: dict[str, Column], carry: dict[str, Column]) -> DataFrame:
    """binned rows with what each of carry says of the other bins: window expressions over the bins' summary, in order of bins."""
    bins = rows.groupBy(by, "__bin").agg(*[c.alias(name) for name, c in summary.items()])
    return rows.join(bins.select(by, "__bin", *[c.alias(name) for name, c in carry.items()]), [by, "__bin"])


def earlier(by: str) -> Window:
    """Over bins: those before this one."""
    return Window.partitionBy(by).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)


def later(by: str) -> Window:
    """Over bins: those after this one, the farthest first."""
    return Window.partitionBy(by).orderBy(F.desc("__bin")).rowsBetween(Window.unboundedPreceding, -1)


def neighbours(rows: DataFrame, by: str, at: str, mark: str, size: int = BIN) -> DataFrame:
    """rows with before and after: the last mark (a column that is null on most rows, at most one of a position) at or before each
    row's position and the first at or after it."""
    dealt = binned(rows, by, at, size)
    place = F.when(F.col(mark).isNotNull(), F.col(at))
    told = carried(
        dealt, by, {"__last": F.max_by(mark, place), "__first": F.min_by(mark, place)},
        {"__b": F.last("__last", ignorenulls=True).over(earlier(by)), "__a": F.last("__first", ignorenulls=True).over(later(by))},
    )
    along, back = Window.partitionBy(by, "__bin").orderBy(at), Window.partitionBy(by, "__bin").orderBy(F.desc(at))
    grows = lambda w: F.last(mark, ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, 0))
    return told.withColumns({"before": F.coalesce(grows(along), "__b"), "after": F.coalesce(grows(back), "__a")}).drop("__bin", "__a", "__b")


def running_max(rows: DataFrame, by: str, at: str, value: Column, name: str, size: int = BIN) -> DataFrame:
    """rows with the greatest value at or before each row's position, nulls aside."""
    dealt = binned(rows.withColumn("__v", value), by, at, size)
    told = carried(dealt, by, {"__most": F.max("__v")}, {"__b": F.max("__most").over(earlier(by))})
    own = F.max("__v").over(Window.partitionBy(by, "__bin").orderBy(at).rangeBetween(Window.unboundedPreceding, 0))
    return told.withColumn(name, F.greatest(own, "__b")).drop("__v", "__b", "__bin")


def islands(rows: DataFrame, by: str, at: str, ident: str, gap: int, name: str, size: int = BIN) -> DataFrame:
    """rows with their number of gaps wider than `gap` so far on the contig: gaps within the bin, and those before it."""
    dealt = binned(rows, by, at, size)
    along = Window.partitionBy(by, "__bin").orderBy(at, ident)
    inner = F.when(F.col(at) - F.lag(at).over(along) > gap, 1).otherwise(0)
    dealt = dealt.withColumn("__new", inner)
    edge = F.coalesce((F.col("__low") - F.lag("__high").over(Window.partitionBy(by).orderBy("__bin")) > gap).cast("int"), F.lit(0))
    bins = dealt.groupBy(by, "__bin").agg(F.min(at).alias("__low"), F.max(at).alias("__high"), F.sum("__new").alias("__n")).withColumn("__edge", edge)
    before = F.coalesce(F.sum(F.col("__n") + F.col("__edge")).over(earlier(by)), F.lit(0)) + F.col("__edge")
    told = dealt.join(bins.select(by, "__bin", before.alias("__before")), [by, "__bin"])
    return told.withColumn(name, F.sum("__new").over(along) + F.col("__before")).drop("__new", "__before", "__bin")


def within_reach(rows: DataFrame, by: str, at: str, reach: int, name: str) -> DataFrame:
    """rows with how many rows of the contig lie at most `reach` before them, themselves and their peers included. Bins are as wide as
    the reach at least, so a row counts in its own bin and in the next."""
    size = max(BIN, reach)
    own = F.floor(F.col(at) / size)
    copies = rows.select("*", F.explode(F.array(F.struct(own.alias("bin"), F.lit(True).alias("own")), F.struct((own + 1).alias("bin"), F.lit(False).alias("own")))).alias("__c"))
    copies = copies.select(*rows.columns, F.col("__c.bin").alias("__bin"), F.col("__c.own").alias("__own"))
    seen = F.count(F.lit(1)).over(Window.partitionBy(by, "__bin").orderBy(at).rangeBetween(-reach, 0))
    return copies.withColumn(name, seen).where("__own").drop("__bin", "__own")
