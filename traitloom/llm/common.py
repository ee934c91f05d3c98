"""What several training-data operators share: shared-folder tables, word tables and graph components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: bytes.translate table: A-Z to a-z, nothing else.
LOWER_ASCII = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: As above, and every ASCII character that is no letter or digit becomes a space.
LETTERS_DIGITS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Java and DuckDB pattern of a word between ASCII white space.
SPACE_WORD = r"[^\x20\x09-\x0D]+"
#: Java and DuckDB pattern of a word of letters and digits (all of non-ASCII counts), once A-Z are lower-cased.
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Whether Spark takes the shuffle files of a query away at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of a compiled method beyond which Spark makes several of it; the JVM leaves longer ones uncompiled.
METHOD = "spark.sql.codegen.hugeMethodLimit"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; on one machine, a temporary one where the session names none."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="traitloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_folder(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/traitloom-{tag}-{uuid.uuid4().hex}"


def stash(df: DataFrame, tag: str, compression: str = "snappy") -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors, computes once."""
    spark = df.sparkSession
    meant = {CLEANUP: "true", METHOD: "8000"}  # what is written is not shuffled again, so its shuffle files go at once
    path, before = new_folder(spark, tag), {k: spark.conf.get(k, None) for k in meant}
    for k, v in meant.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path, compression=compression)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(col):
    """A-Z to a-z only, unlike lower()."""
    return F.translate(col, UPPER, LOWER)


#: Groups into which each ranking is dealt before its best rows meet.
DEALT = 64


def top_ranked(df: DataFrame, by: list[str], order: list[Column], top: int, spread: Column, dealt: int = DEALT) -> DataFrame:
    """df's first `top` rows of each group in order, with rank from 1. A group is dealt out by spread first (with dealt 1 not: for
    groups of bounded size), so one that holds most rows is ranked by many tasks, and only the best of each meet. A null is a
    group like any other."""
    some = df
    if dealt > 1:
        first = F.row_number().over(Window.partitionBy(*by, "__deal").orderBy(*order))
        some = df.withColumn("__deal", F.pmod(F.xxhash64(spread), F.lit(dealt))).withColumn("__first", first).where(F.col("__first") <= top).drop("__deal", "__first")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)


def components(edges: DataFrame, tag: str = "components", max_rounds: int = 60) -> DataFrame:
    """Connected components of edges (a, b): rows (node, component), component being the least node reached.

    Alternates the large-star and small-star steps, which need a logarithmic number of rounds. Every round is
    one aggregate and one join on the node and is written to the shared folder; hubs are pre-aggregated
    before their shuffle. Null ends and self-loops are dropped; no edges give no rows.
    """
    both = lambda e: e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    now = stash(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        f"{tag}-edges",
    )
    for _ in range(max_rounds):
        # large star: every greater neighbour of a node points at the node's least neighbour
        all_ways = both(now)
        least = all_ways.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = all_ways.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its lesser neighbours point at the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b").where("a <> b").distinct()
        )
        after = stash(small, f"{tag}-round")
        same = (
            after.select("a", "b", F.lit(1).alias("n")).unionByName(now.select("a", "b", F.lit(-1).alias("n")))
            .groupBy("a", "b").agg(F.sum("n").alias("n")).where("n <> 0").limit(1).count() == 0
        )
        now = after
        if same:
            break
    else:
        raise RuntimeError(f"components: no fixed point after {max_rounds} rounds")
    pairs = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pairs.unionByName(roots)
