"""Phrase collocations: padded windows of the longest order are counted, and ROLLUP sums their prefixes for all shorter orders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

ORDER, MIN_COUNT, SHARE, TOP = 5, 100, 100, 2000
#: Columns of a window.
WORDS = [f"w{i}" for i in range(ORDER)]
#: Buckets of the filter of frequent words and word pairs, as a power of two; its bitmap (8 MB) is all that is sent to every task.
BUCKET_BITS, PART_BITS = 26, 15
#: Bytes of text whose words a task holds at once.
CHUNK = 4 << 20
_LOWER = {b: b + 32 for b in range(65, 91)}
_CUT = dict.fromkeys(b".,;:!?\x0b\x0c\r", 10)
#: Windows that a task holds before it adds up equal ones, and the parts into which it packs them for the shuffle.
HELD, PARTS = 1 << 20, 256
#: bytes.translate table: A-Z to a-z, the ends of pieces to a line feed, a tab to a space.
PIECES = bytes((_LOWER | _CUT | {9: 32}).get(b, b) for b in range(256))
_ODD, _ODD2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Chunk:
    """Words of some pieces: ids into words, the language of each word as an index into langs, and whether the next one follows in
    the same piece."""

    def __init__(self, words: list[bytes], sizes: list[int], owners: list[str], bits: int = BUCKET_BITS):
        found = pa.array(words, pa.binary()).dictionary_encode()
        self.ids, self.words = found.indices.to_numpy().astype(np.int64), found.dictionary
        self.langs = sorted(set(owners))
        number = {x: i for i, x in enumerate(self.langs)}
        self.lang = np.repeat(np.array([number[x] for x in owners], np.int64), sizes)
        self.inner = np.ones(len(words), bool)
        self.inner[np.cumsum(sizes) - 1] = False
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in self.words.to_pylist()], np.uint64)
        seeds = np.array([xxhash.xxh3_64_intdigest(x, 1) for x in self.langs], np.uint64)
        with np.errstate(over="ignore"):
            one = (hashes[self.ids] ^ seeds[self.lang]) * _ODD
            self.one = one ^ (one >> np.uint64(29))
        self.shift = np.uint64(64 - bits)

    def buckets(self, order: int) -> np.ndarray:
        """The bucket of the words from each place on, as many as order says; of no meaning where the piece ends before."""
        n = len(self.one)
        key = self.one.copy()
        with np.errstate(over="ignore"):
            for k in range(1, min(order, n)):
                key[: n - k] = (key[: n - k] * _ODD2 + self.one[k:]) * _ODD
                key ^= key >> np.uint64(31)
            return (key * _ODD2 + np.uint64(order) * _ODD >> self.shift).astype(np.uint32)

    def runs(self, joined: np.ndarray, order: int) -> np.ndarray:
        """Whether all words of that order from each place on are joined to the next (joined: place by place)."""
        n = len(joined)
        out = np.ones(n, bool)
        ahead = np.append(joined, np.zeros(order, bool))
        for k in range(order - 1):
            out &= ahead[k : k + n]
        return out


def in_bitmap(bitmap: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    return (bitmap[bucket >> np.uint32(3)] >> (bucket & np.uint32(7)).astype(np.uint8)) & 1 > 0


def links(chunk: Chunk, short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By the bitmap of words and pairs: which words may be frequent, and which may be so together with the next one of their piece."""
    known = in_bitmap(short, chunk.buckets(1))
    link = chunk.inner & known & in_bitmap(short, chunk.buckets(2))
    link[:-1] &= known[1:]
    return known, link


def chunks(batches, bits: int = BUCKET_BITS, most: int = CHUNK) -> Iterator[Chunk]:
    """Batches (text, lang) as chunks of about `most` bytes. Windows never cross pieces, so a long text goes on in the next chunk."""
    words: list[bytes] = []
    sizes: list[int] = []
    owners: list[str] = []
    held = 0
    for batch in batches:
        for text, lang in zip(batch.column("text").cast(pa.binary()), batch.column("lang").to_pylist(), strict=True):
            for piece in (text.as_py() or b"").translate(PIECES).split(b"\n"):
                if own := piece.split():
                    words += own
                    sizes.append(len(own))
                    owners.append(lang)
                    held += len(piece)
                    if held >= most:
                        yield Chunk(words, sizes, owners, bits)
                        words, sizes, owners, held = [], [], [], 0
    if words:
        yield Chunk(words, sizes, owners, bits)


def frequent_buckets(docs: DataFrame, min_count: int = MIN_COUNT, bits: int = BUCKET_BITS, short: bytes | None = None) -> bytes:
    """A bitmap of the buckets in which words and pairs of words of one language stand min_count times or more; with the bitmap of
    these (short), one of the buckets of three to five words, of which only those along frequent pairs are counted.

    A phrase is never more frequent than its parts, so what is left out here can't be part of a frequent phrase; what shares a bucket
    stays and is counted exactly later. Tasks send saturated counters, compressed, and those of a part of the buckets are added up
    where they meet: neither the counters of a task nor the bitmap grow with the input. On inputs whose words and pairs fill
    the buckets (some 30 GB of text for 2**26), less and less is left out and windows cost what they do without a filter.
    """
    kind = np.uint8 if min_count < 256 else np.uint32
    width = 1 << PART_BITS
    parts = 1 << (bits - PART_BITS)
    sent = docs.sparkSession.sparkContext.broadcast(short) if short else None

    def count(batches):
        counters = np.zeros(1 << bits, kind)
        told = np.frombuffer(sent.value, np.uint8) if sent else None
        for chunk in chunks(batches, bits):
            if told is None:
                found = [chunk.buckets(1), chunk.buckets(2)[chunk.inner]]
            else:
                link = links(chunk, told)[1]
                found = [chunk.buckets(k)[chunk.runs(link, k)] for k in range(3, ORDER + 1)]
            bucket, n = np.unique(np.concatenate(found), return_counts=True)
            counters[bucket] = np.minimum(counters[bucket].astype(np.int64) + n, min_count)
        pack = zstandard.ZstdCompressor(level=1).compress
        some = np.flatnonzero(counters.reshape(parts, width).any(1))
        for at in range(0, len(some), 256):
            own = some[at : at + 256]
            yield pa.record_batch([pa.array(own, pa.int32()), pa.array([pack(counters[p * width : (p + 1) * width]) for p in own], pa.binary())], ["part", "counters"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                more = np.frombuffer(unpack(packed), kind).astype(np.uint32)
                sums[part] = np.minimum(sums[part] + more, min_count) if part in sums else more
        packed = [np.packbits(x >= min_count, bitorder="little").tobytes() for x in sums.values()]
        yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array(packed, pa.binary())], ["part", "bits"])

    told = docs.mapInArrow(count, "part int, counters binary").repartition("part").mapInArrow(add, "part int, bits binary")
    bitmap = bytearray(1 << (bits - 3))
    for row in told.collect():  # 2,048 rows of 4 KB at most
        at = row["part"] * (width // 8)
        bitmap[at : at + width // 8] = row["bits"]
    return bytes(bitmap)


def _distinct(columns: list[np.ndarray], size: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of columns (values from -1 to size - 1) and how often each occurs."""
    key = columns[0]
    for more in columns[1:]:
        key = np.unique(key, return_inverse=True)[1] * (size + 1) + more + 1
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    return [c[first] for c in columns], n


def _packed(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_table(table)
    return out.getvalue().to_pybytes()


def windows(docs: DataFrame, min_count: int = MIN_COUNT, bits: int = BUCKET_BITS) -> DataFrame:
    """(lang, w0 to w4, c): every word of docs (text, lang) begins one window, which is padded with '' where its piece ends or
    where with the next word it can't be frequent; c counts equal windows, packed where they lie and added up where they meet. Of a word that can't be frequent
    only the count is kept, in a window of pads."""
    spark = docs.sparkSession
    short = frequent_buckets(docs, min_count, bits)
    sent = spark.sparkContext.broadcast((short, frequent_buckets(docs, min_count, bits, short)))

    def look(batches):
        for table in summed(some_windows(batches)):
            rows = zip(*(table.column(c).to_pylist() for c in ["lang", *WORDS]), strict=True)
            part = np.array([xxhash.xxh3_64_intdigest(" ".join(r)) % PARTS for r in rows], np.int32)
            order = np.argsort(part, kind="stable")
            table, part = table.take(pa.array(order)), part[order]
            some, first = np.unique(part, return_index=True)
            packed = [_packed(table.slice(f, e - f)) for f, e in zip(first, np.append(first[1:], len(part)), strict=True)]
            yield pa.record_batch([pa.array(some), pa.array(packed, pa.binary())], ["part", "windows"])

    def meet(batches):
        for table in summed(t for batch in batches for x in batch.column(1).to_pylist() for t in pa.ipc.open_stream(x)):
            yield from table.to_batches()

    def summed(batches) -> Iterator[pa.Table]:
        """Windows with those that are equal added up, as far as HELD goes."""
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= HELD:
                table = added(held)
                held, n = table.to_batches(), table.num_rows
                if n > HELD // 2:
                    yield table
                    held, n = [], 0
        if held:
            yield added(held)

    def added(held: list[pa.RecordBatch]) -> pa.Table:
        sums = pa.Table.from_batches(held).group_by(["lang", *WORDS], use_threads=False).aggregate([("c", "sum")])
        return sums.rename_columns([{"c_sum": "c"}.get(n, n) for n in sums.column_names]).select(["lang", *WORDS, "c"])

    def some_windows(batches):
        short, long = (np.frombuffer(x, np.uint8) for x in sent.value)
        for chunk in chunks(batches, bits):
            n, size = len(chunk.ids), len(chunk.words)
            known, link = links(chunk, short)
            ahead = np.append(chunk.ids, np.full(ORDER, -1))
            follows, columns = link, [chunk.lang, chunk.ids]
            for j in range(1, ORDER):
                columns.append(np.where(follows, ahead[j : j + n], -1))
                if j + 1 < ORDER:
                    follows = follows & chunk.runs(link, j + 2) & in_bitmap(long, chunk.buckets(j + 2))
            base = np.full(n, -1)
            rare, alone = [chunk.lang[~known]], [c[known & ~link] for c in columns[:2]]
            for rows in (rare, alone, [c[link] for c in columns]):
                if not len(rows[0]):
                    continue
                own, times = _distinct(rows, max(size, len(chunk.langs)))
                own += [base[: len(times)]] * (len(columns) - len(own))
                text = [chunk.words.take(pa.array(np.maximum(c, 0))) for c in own[1:]]
                text = [pa.compute.if_else(pa.array(c >= 0), t, pa.scalar(b"", pa.binary())) for c, t in zip(own[1:], text, strict=True)]
                yield pa.record_batch([pa.array(chunk.langs, pa.string()).take(pa.array(own[0])), *[t.cast(pa.string()) for t in text], pa.array(times, pa.int64())], ["lang", *WORDS, "c"])

    packed = docs.mapInArrow(look, "part int, windows binary").repartition("part")
    return packed.mapInArrow(meet, "lang string, " + ", ".join(f"{w} string" for w in WORDS) + ", c long")


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, bits: int = BUCKET_BITS) -> DataFrame:
    """(lang, size, phrase, f): frequent phrases of one to five words, joined by spaces, and with size 0 each lang's words."""
    top = windows(docs, min_count, bits).groupBy("lang", *WORDS).agg(F.sum("c").alias("c"))
    # a prefix of j words leaves the last 5 - j grouping bits set
    rolled = docs.sparkSession.sql(
        f"SELECT lang, {', '.join(WORDS)}, grouping_id() AS left_out, sum(c) AS f FROM {{top}} GROUP BY lang, ROLLUP({', '.join(WORDS)})", top=top
    )
    size = F.lit(ORDER) - F.bit_count("left_out")
    words = F.slice(F.array(*WORDS), F.lit(1), size)
    rows = rolled.select("lang", size.cast("int").alias("size"), words.alias("words"), "f")
    return rows.where((F.col("size") == 0) | ((F.col("f") >= min_count) & (F.element_at("words", -1) != ""))).select("lang", "size", F.array_join("words", " ").alias("phrase"), "f")


def _part(words, begin, length):
    return F.array_join(F.slice(words, begin, length), " ")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, share: int = SHARE, top: int = TOP, bits: int = BUCKET_BITS) -> DataFrame:
    """Each language's top phrases of two to five words by score: lang, rank, phrase, a, l, r, n, score.

    docs holds text and lang; extra columns don't matter. Null and empty texts have no words, a null lang is und, rows that repeat
    count again, very long texts are read piece by piece, ties go by a and then by the phrase's bytes, and an empty table gives no
    rows. A phrase is dropped where a longer candidate that holds it is as frequent (share in hundredths); as phrases
    within phrases are at least as frequent, candidates longer by one word decide.
    """
    rows = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    counts = common.stash(phrase_counts(rows, min_count, bits), "phrases")
    words = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    parts = counts.where("size > 0").select("lang", "phrase", "f")
    found = counts.where("size > 1").select("lang", "phrase", F.split("phrase", " ").alias("words"), "size", F.col("f").alias("a"))
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", _part("words", F.lit(1), F.col("k")).alias("left"), _part("words", F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]).join(words, "lang")
    wide = lambda c: F.col(c).cast("decimal(19,0)")  # noqa: E731  products of two longs don't fit into a third
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * wide("a") * wide("n"), wide("l") * wide("r"))
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = F.explode(F.array(_part("words", F.lit(1), F.col("size") - 1), _part("words", F.lit(2), F.col("size") - 1)))
    longer = found.where("size > 2").select("lang", inner.alias("phrase"), F.col("a").alias("more")).groupBy("lang", "phrase").agg(F.max("more").alias("more"))
    kept = best.join(longer, ["lang", "phrase"], "left").where(F.coalesce(F.lit(100) * F.col("more") < share * F.col("a"), F.lit(True)))
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    ranked = common.top_ranked(kept, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top, F.xxhash64("phrase"))
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of each language of documents."""
    return collocations(common.table(spark, sf_dir, "documents"))


OP11_SQL = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{common.UPPER}', '{common.LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM d),
starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM p),
grams AS (SELECT lang, ws[i : i + k - 1] AS p FROM starts JOIN (SELECT unnest(range(1, {ORDER + 1})) AS k) ON i + k - 1 <= len(ws)),
f AS (SELECT lang, p, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE len(p) = 1 GROUP BY 1),
c AS (SELECT lang, p, f AS a FROM f WHERE f >= {MIN_COUNT} AND len(p) > 1),
cuts AS (SELECT c.lang, c.p, a, k, l.f AS l, r.f AS r, n, (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, len(p))) AS k FROM c) c JOIN f l ON l.lang = c.lang AND l.p = c.p[1 : k] JOIN f r ON r.lang = c.lang AND r.p = c.p[k + 1 :] JOIN n ON n.lang = c.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inside AS (SELECT lang, p[i : i + k - 1] AS p, max(a) AS more FROM (SELECT *, unnest(range(1, len(p) + 1)) AS i FROM c) c JOIN (SELECT unnest(range(2, {ORDER})) AS k) ON i + k - 1 <= len(p) AND k < len(p) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank, array_to_string(p, ' ') AS phrase,
  a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM best LEFT JOIN inside USING (lang, p) WHERE more IS NULL OR 100 * more < {SHARE} * a QUALIFY rank <= {TOP}
"""
