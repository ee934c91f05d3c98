"""Secret scans: single-part secrets, and weak parts of credentials that are told only when complementary parts stand near."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Code points between two parts of one credential at most.
SCOPE = 200
#: Kind: pattern, group whose length counts, least length of that group, role, whether it is told on its own.
#: The first three are the base kinds, in the order in which equal starts are told.
KINDS = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 2, 6, "secret", True),
    "access": (r"AKIA[A-Z0-9]+", 0, 20, "identifier", True),
    "hex": (r"[0-9a-f]+", 0, 24, "secret", True),
    "user": (r"""(?i:\b(?:user(?:name)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9_.@+-]{3,})""", 0, 1, "identifier", False),
    "blob": (r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[a-z0-9+/_=-]*[A-Z])(?=[A-Z0-9+/_=-]*[a-z])[A-Za-z0-9+/_=-]{32,}", 0, 32, "secret", False),
    "endpoint": (r"""https?://[^\x20\x09-\x0D"'<>]+|\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]+)?\b""", 0, 7, "endpoint", False),
}
#: As KINDS has it, but with no match that would be dropped for its length anyway; whole runs match either way.
FOUND_BY = {"hex": r"[0-9a-f]{24,}"}


def matches(text: Column, kind: str) -> Column:
    """All matches of a kind, leftmost first and not overlapping."""
    return F.regexp_extract_all(text, F.lit(FOUND_BY.get(kind, KINDS[kind][0])), F.lit(0))


def pieces(text: Column, found: Column, kind: str) -> Column:
    """For each match: its kind and place in turn, the code points since the last match, its own, and those that count."""
    pattern, group, *_ = KINDS[kind]
    pattern = FOUND_BY.get(kind, pattern)
    counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.split(text, pattern, -1)
    every = F.arrays_zip(F.sequence(F.lit(0), F.size(found) - 1).alias("k"), found.alias("m"), counted.alias("c"), F.slice(gaps, F.lit(1), F.size(found)).alias("g"))
    made = F.transform(
        every, lambda x: F.struct(F.lit(kind).alias("kind"), x["k"].alias("k"), F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("len"), F.length(x["c"]).alias("counted"))
    )
    return F.when(F.size(found) > 0, made).otherwise(F.array().cast("array<struct<kind:string,k:int,gap:int,len:int,counted:int>>"))


def by_kind(of) -> Column:
    """A column of the row's kind: of(kind) for each."""
    case = None
    for kind in KINDS:
        case = F.when(F.col("kind") == kind, of(kind)) if case is None else case.when(F.col("kind") == kind, of(kind))
    return case


def parts(docs: DataFrame) -> DataFrame:
    """One row a match: row (of docs), doc_id, kind, start, end (code points, end exclusive); matches that are too short, and one
    row for each row without any, have null kind. Matching is by row; then one shuffle of places, without texts, by row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text.alias("text"))
    rows = rows.select("*", *[matches(F.col("text"), kind).alias(f"m_{kind}") for kind in KINDS])
    rows = rows.select("row", "doc_id", F.concat(*[pieces(F.col("text"), F.col(f"m_{kind}"), kind) for kind in KINDS]).alias("p"))
    one = rows.select("row", "doc_id", F.explode_outer("p").alias("p")).select("row", "doc_id", "p.*").repartition("row")
    so_far = Window.partitionBy("row", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("len")).over(so_far)
    long_enough = F.col("counted") >= by_kind(lambda kind: F.lit(KINDS[kind][2]))
    placed = one.select("row", "doc_id", "kind", (end - F.col("len")).alias("start"), end.alias("end"), long_enough.alias("ok"))
    return placed.select("row", "doc_id", *[F.when(F.col("ok"), F.col(c)).alias(c) for c in ("kind", "start", "end")])


def link(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """parts() with told: base kinds always, weak ones only when complementary parts stand within scope.

    A weak identifier needs a secret, a weak secret an identifier, an endpoint both. The interval join of parts with
    parts within scope is a sweep by start: of each role, the part that ends furthest so far and the one that starts next are
    the nearest, so each part has at most one partner of each other role (partners: gap, turn, kind, start, end) however many
    parts a row has. Weak parts inside a base span are left out. Of parts that start alike the one that ends first, then
    the kind first by name comes first.
    """
    role, base = by_kind(lambda k: F.lit(KINDS[k][3])), by_kind(lambda k: F.lit(KINDS[k][4]))
    sweep = Window.partitionBy("row").orderBy("start", "end", "kind")
    back = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("end"), F.desc("kind"))  # frames that only grow
    before, after = sweep.rowsBetween(Window.unboundedPreceding, -1), back.rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)

    def near(wanted: str) -> Column:
        """The nearest part of a role within scope: gap, kind, start and end; of equally near ones the one before."""
        mine = F.col("role") == wanted
        last = F.max(F.when(mine, F.struct("end", "start", "kind"))).over(before)
        following = F.min(F.when(mine, F.struct("start", "end", "kind"))).over(after)

        def partner(found: Column, gap: Column, turn: int) -> Column:
            gap = F.greatest(gap, F.lit(0))
            return F.when(gap <= scope, F.struct(gap.alias("gap"), F.lit(turn).alias("turn"), found["kind"].alias("kind"), found["start"].alias("start"), found["end"].alias("end")))

        behind = F.when(last.isNotNull(), partner(last, F.col("start") - last["end"], 0))
        ahead = F.when(following.isNotNull(), partner(following, following["start"] - F.col("end"), 1))
        return F.least(behind, ahead)

    roles = ("identifier", "secret", "endpoint")
    rows = found.select("*", role.alias("role"), base.alias("base")).select("*", *[near(r).alias(f"by_{r}") for r in roles])
    covered = F.coalesce(F.max(F.when(F.col("base"), F.col("end"))).over(upto) >= F.col("end"), F.lit(False))
    has = {r: F.col(f"by_{r}").isNotNull() for r in roles}
    complete = F.when(F.col("role") == "identifier", has["secret"]).when(F.col("role") == "secret", has["identifier"]).otherwise(has["identifier"] & has["secret"])
    told = F.coalesce(F.col("base") | (complete & ~covered), F.lit(False))
    partners = F.array_compact(F.array(*[F.when(F.col("role") != r, F.col(f"by_{r}")) for r in roles]))
    return rows.select("row", "doc_id", "kind", "start", "end", "base", told.alias("told"), F.when(told, partners).alias("partners"))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, found (array of structs start, turn, end, kind, base, partners), sorted.

    Null text is empty; null or repeated doc_ids are rows of their own; texts of any length are read whole; other columns are
    ignored, whatever their names; an empty table gives no rows.
    """
    linked = link(parts(docs), scope)
    turn = by_kind(lambda kind: F.lit(list(KINDS).index(kind)))
    span = F.when(F.col("told"), F.struct("start", turn.alias("turn"), "end", "kind", "base", "partners"))
    return linked.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(span)).alias("found")).drop("row")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _links(found: Column) -> Column:
    """span>partner for each partner of each span."""
    name = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    return F.array_join(F.flatten(F.transform(found, lambda s: F.transform(s["partners"], lambda p: F.concat(name(s), F.lit(">"), name(p))))), ",")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, and which parts of a credential belong together."""
    found = scan(common.table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(_joined(F.filter("found", lambda s: s["base"])), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"), _links(F.col("found")).alias("links"),
    )
