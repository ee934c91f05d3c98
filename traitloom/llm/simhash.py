"""SimHash near-dedup over a segment-popcount embedding.

A fingerprint's 64 bits are cut into 32 segments of two bits; its point is the number of set bits of each segment. The
Manhattan distance of two points never exceeds the fingerprints' Hamming distance, so pairs within d bits lie within d on
that grid. The segments stand in eight groups of four: points within distance 4 agree in at least four whole groups, so
the grid cells to join are the 70 choices of four groups, each with the counts in it. Pairs that meet in a cell
are held to the Manhattan bound over all segments and then to the exact distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SHINGLE, DISTANCE, SEED = 4, 4, 42
GROUPS = 8
#: Fingerprints of a cell that one task compares; larger cells are cut by a finer grid first.
CELL = 4_096
#: One of so many rows or more makes a fingerprint frequent, so there are at most so many of these.
FREQUENT = 10_000
EVEN = 0x5555555555555555


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprints(texts: list[bytes | None], shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit SimHash of each text's word shingles, as int64."""
    out = np.zeros(len(texts), np.int64)
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    sizes = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = text.translate(common.LOWER_ASCII).split() if text else []
        if not words:
            continue
        before = len(hashes)
        if len(words) <= shingle:
            hashes.append(digest(b" ".join(words), SEED))
        else:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            begins = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1).tolist()
            stops = (ends - 1).tolist()
            hashes += [digest(joined[b:e], SEED) for b, e in zip(begins, stops[shingle - 1 :], strict=False)]
        sizes[i] = len(hashes) - before
    if not hashes:
        return out
    bits_of = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    has = np.flatnonzero(sizes)
    starts = np.concatenate([[0], np.cumsum(sizes[has])[:-1]])
    ends = starts + sizes[has]
    counts = np.zeros((len(has), 64), np.int64)
    step, at = 1 << 16, 0  # of texts at once about so many shingles are spread to bits
    while at < len(has):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + step)))
        if ends[at] - starts[at] > step:
            for x in range(starts[at], ends[at], step):
                counts[at] += np.unpackbits(bits_of[x : min(x + step, ends[at])], axis=1, bitorder="little").sum(0)
            to = at + 1
        else:
            spread = np.unpackbits(bits_of[starts[at] : ends[to - 1]], axis=1, bitorder="little")
            counts[at:to] = np.add.reduceat(spread, starts[at:to] - starts[at], axis=0, dtype=np.int64)
        at = to
    ones = (counts * 2 > sizes[has][:, None]).astype(np.uint8)
    out[has] = np.packbits(ones, axis=1, bitorder="little").view("<u8").ravel().view(np.int64)
    return out


def fingerprint(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (long) of each row of docs (doc_id, text); null and wordless texts have 0."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                fps = fingerprints(batch.column(1).cast(pa.binary()).to_pylist(), shingle)
                yield pa.record_batch([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(read, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def packed_counts(fp: np.ndarray) -> np.ndarray:
    """The embedding: the number of set bits of each two-bit segment, in place of the segment."""
    half = fp >> np.uint64(1)
    return (half & fp & np.uint64(EVEN)) << np.uint64(1) | (half ^ fp) & np.uint64(EVEN)


def packed_counts_of(fp: Column) -> Column:
    """The same of a column of longs."""
    half = F.shiftrightunsigned(fp, 1)
    both = half.bitwiseAND(fp).bitwiseAND(F.lit(EVEN))
    return F.shiftleft(both, 1).bitwiseOR(half.bitwiseXOR(fp).bitwiseAND(F.lit(EVEN)))


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of packed embeddings: counts differ by two where only the high bit differs, by one where the low bit does."""
    x = packed_counts(a) ^ packed_counts(b)
    low = x & np.uint64(EVEN)
    return np.bitwise_count(low).astype(np.int64) + 2 * np.bitwise_count((x >> np.uint64(1)) & np.uint64(EVEN) & ~low)


def _masks(pieces: list[int], take: int) -> list[int]:
    return [sum(c) for c in combinations(pieces, take)]


#: Bits of each group, and the masks of the cells of the first grid.
GROUP_BITS = [0xFF << (8 * g) for g in range(GROUPS)]
FIRST = _masks(GROUP_BITS, GROUPS - DISTANCE)


def finer(mask: int) -> list[int]:
    """Masks of the second grid inside a cell of mask: the other groups are halved, and at least half of the halves agree."""
    halves = [0xF << (4 * h) for h in range(16) if not mask >> (4 * h) & 1]
    return _masks(halves, len(halves) - DISTANCE)


def first_cells(fps: DataFrame) -> DataFrame:
    """(cell, grid, fp): each fingerprint in the cells of the first grid."""
    masks = F.array(*[F.lit(signed(m)) for m in FIRST])
    counts = packed_counts_of(F.col("fp"))
    rows = fps.select("fp", counts.alias("counts"), F.posexplode(masks).alias("grid", "mask"))
    return rows.select(F.xxhash64(F.col("counts").bitwiseAND(F.col("mask")), "grid").alias("cell"), "grid", "fp")


def finer_cells(rows: DataFrame) -> DataFrame:
    """The same of rows (cell, grid, fp) of large cells, on the second grid."""
    masks = F.element_at(F.array(*[F.array(*[F.lit(signed(x)) for x in finer(m)]) for m in FIRST]), F.col("grid") + 1)
    made = rows.select("cell", "fp", packed_counts_of(F.col("fp")).alias("counts"), F.posexplode(masks).alias("part", "mask"))
    cell = F.xxhash64("cell", F.col("counts").bitwiseAND(F.col("mask")), "part").alias("cell")
    return made.select(cell, F.lit(0).alias("grid"), "fp")


def links(cells: DataFrame, cell: int | None, distance: int = DISTANCE) -> DataFrame:
    """Rows (a, b, grid, cell) of cells (cell, grid, fp): links with null cell; or, of cells with more than `cell` members, the
    members (a) with their cell, for the finer grid. A task streams its sorted cells and holds one at a time."""

    def rows(a, b, grid, key) -> pa.RecordBatch:
        n = len(a)
        columns = [pa.array(a, pa.int64()), pa.array(b, pa.int64()) if b is not None else pa.nulls(n, pa.int64())]
        columns += [pa.array(grid, pa.int32()) if grid is not None else pa.nulls(n, pa.int32())]
        columns += [pa.array(key, pa.int64()) if key is not None else pa.nulls(n, pa.int64())]
        return pa.record_batch(columns, ["a", "b", "grid", "cell"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_grid, held, spilling = None, 0, [], False

        def close():
            if held and not spilling and sum(map(len, held)) > 1:
                yield from one_cell(np.concatenate(held))

        def one_cell(members: np.ndarray):
            a, b = star_links(np.unique(members), distance)
            if len(a):
                yield rows(a.view(np.int64), b.view(np.int64), None, None)

        for batch in batches:
            if not batch.num_rows:
                continue
            key, grid, fp = (batch.column(i).to_numpy() for i in range(3))
            fp = fp.view(np.uint64)
            edge = np.flatnonzero(np.diff(key)) + 1
            begin, end = np.concatenate([[0], edge]), np.concatenate([edge, [len(key)]])
            if held_key is not None and key[0] == held_key:  # the last cell of the batch before goes on
                first, begin, end = end[0], begin[1:], end[1:]
            else:
                first = 0
            if first:
                held.append(fp[:first])
                if cell is not None and (spilling or sum(map(len, held)) > cell):
                    members = np.concatenate(held)
                    yield rows(members.view(np.int64), None, np.full(len(members), held_grid), np.full(len(members), held_key))
                    held, spilling = [], True
            if not len(begin):
                continue
            yield from close()
            size = end - begin
            # the last cell may go on in the next batch; others of two are compared all at once, larger ones one by one
            pairs = begin[:-1][size[:-1] == 2]
            x, y = fp[pairs], fp[pairs + 1]
            near = (x != y) & (manhattan(x, y) <= distance) & (np.bitwise_count(x ^ y) <= distance)
            if near.any():
                yield rows(x[near].view(np.int64), y[near].view(np.int64), None, None)
            for i in np.flatnonzero(size[:-1] > 2):
                if cell is not None and size[i] > cell:
                    members = fp[begin[i] : end[i]]
                    yield rows(members.view(np.int64), None, np.full(len(members), grid[begin[i]]), np.full(len(members), key[begin[i]]))
                else:
                    yield from one_cell(fp[begin[i] : end[i]])
            held_key, held_grid, held, spilling = int(key[-1]), int(grid[-1]), [fp[begin[-1] :]], False
            if cell is not None and len(held[0]) > cell:
                yield rows(held[0].view(np.int64), None, np.full(len(held[0]), held_grid), np.full(len(held[0]), held_key))
                held, spilling = [], True
        yield from close()

    return cells.mapInArrow(read, "a long, b long, grid int, cell long")


def star_links(fps: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what the pairs of fps (distinct) within distance join.

    A member is compared only with those that no component has reached yet: each is linked once, to the member that reached
    it, so a dense group makes as many links as it has members and never lists its pairs.
    """
    left, a, b = fps, [], []
    while len(left) > 1:
        front, left = [left[:1]], left[1:]
        while front and len(left):
            members = front.pop()
            for i in range(len(members)):
                x = members[i : i + 1]
                near = manhattan(left, x) <= distance
                if near.any():
                    near[near] = np.bitwise_count(left[near] ^ x) <= distance
                    found = left[near]
                    if not len(found):
                        continue
                    a.append(found)
                    b.append(np.repeat(x, len(found)))
                    front.append(found)
                    left = left[~near]
                    if not len(left):
                        break
    if not a:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(a), np.concatenate(b)


def near_links(fps: DataFrame, cell: int = CELL) -> DataFrame:
    """Links (a, b) between distinct fingerprints (fp), enough to join all that pairs within DISTANCE bits join."""
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fps = fps.repartition(parts, "fp")  # 70 rows each come of them: not in the few tasks that hold them
    found = common.stash(links(first_cells(fps).repartition("cell").sortWithinPartitions("cell"), cell), "simhash-links")
    large = found.where("cell is not null").select("cell", "grid", F.col("a").alias("fp"))
    again = links(finer_cells(large).repartition("cell").sortWithinPartitions("cell"), None)
    return found.where("cell is null").select("a", "b").unionByName(again.select("a", "b"))


def near_dedup(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp, component_id of each row of docs (doc_id, text): the least doc_id that links of at most DISTANCE bits reach.

    Exact copies are one fingerprint before anything is joined. Null texts and texts without words have fingerprint 0 and
    link like any other; null doc_ids are never the least unless a component has no other; repeated rows stay
    rows; other columns are ignored; an empty table gives no rows.
    """
    fps = common.stash(fingerprint(docs, shingle), "simhash-fps")
    least = common.stash(fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")), "simhash-least")
    many = max(1.0, (least.agg(F.sum("rows")).first()[0] or 0) / FREQUENT)
    joined = common.components(near_links(fps.select("fp").distinct()), "simhash")
    of = joined.join(least, joined["node"] == least["fp"]).select("node", "component", "least")
    roots = of.groupBy("component").agg(F.min("least").alias("component_id"))
    known = joined.join(roots, "component").select(F.col("node").alias("fp"), "component_id")
    ids = common.stash(least.join(known, "fp", "left").select("fp", "rows", F.coalesce("component_id", "least").alias("component_id")), "simhash-ids")
    # rows of a fingerprint that many share stay where they are; at most FREQUENT of these go to every task
    hot = F.broadcast(ids.where(F.col("rows") > many).select("fp", "component_id"))
    rest = fps.join(hot.select("fp"), "fp", "left_anti").join(ids.where(F.col("rows") <= many).drop("rows"), "fp")
    return fps.join(hot, "fp").unionByName(rest).select("doc_id", "fp", "component_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_dedup(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
