"""Removal of repeated passages with a sparse enhanced suffix array.

A window is a string of LENGTH bytes of one text. Every window has an anchor: the least-hashed of its GRAM-byte strings, which
depends on the window's bytes alone, so equal windows have their anchors at the same place. A stretch is a run of windows with
one anchor. Stretches meet by the hash of their anchor's gram; those of equal bytes are one class, whose first
occurrence stands for all. Where classes of different bytes share a gram, their suffixes from the anchor on are
sorted with the lengths of their common prefixes; a stack scan of these gives the tree of common-prefix intervals; within an
interval the texts left of the anchor are sorted and scanned in the same way, so that each group of both trees is one set of equal
strings with all its occurrences, told apart where their left extensions differ. In each group all windows but those of
the first occurrence are repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

LENGTH, GRAM = 100, 32
SPAN = LENGTH - GRAM + 1  # grams of a window
LEFT = SPAN - 1  # bytes left of an anchor at most
WIDTH = LEFT + LENGTH  # bytes of a stretch's context
#: Bytes that a task hashes at once; longer texts are read in overlapping pieces.
PIECE = 1 << 20
#: Stretches among which a task tells repeats before anything is shuffled.
SEEN = 1 << 20
#: Classes of one gram that a task holds; beyond it their windows are dealt out one by one.
CLASSES = 20_000
NO_ID = (1 << 63) - 1
_MIX, _BASE = np.uint64(0xFF51AFD7ED558CCD), 0x9E3779B97F4A7C15


@lru_cache(1)
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random word for each byte value, powers of an odd base and of its inverse, modulo 2**64."""
    n = PIECE * 2 + LENGTH
    values = np.random.default_rng(20240607).integers(0, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return values, np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def stretches(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """text number, gram hash, hash of the bytes, first window, bytes from it to the anchor, windows less one: of each stretch."""
    values, up, down = _powers()
    arr = np.frombuffer(b"".join(texts), np.uint8)
    n = len(arr)
    if n < LENGTH:
        return tuple(np.empty(0, np.int64) for _ in range(6))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values[arr] * up[:n], out=sums[1:])
    gram = _mixed((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])
    low = np.uint64((1 << 24) - 1)
    least = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)  # of equals the leftmost
    size = 1
    while size * 2 <= SPAN:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < SPAN:
        least = np.minimum(least[: n - LENGTH + 1], least[SPAN - size : SPAN - size + n - LENGTH + 1])
    anchor = (least & low).astype(np.int64)
    lengths = np.array([len(t) for t in texts])
    ends = np.cumsum(lengths)
    inside = np.repeat(ends, lengths)[: len(anchor)] >= np.arange(len(anchor)) + LENGTH
    edge = np.empty(len(anchor) + 1, bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
    cuts = np.flatnonzero(edge)
    first, last = cuts[:-1], cuts[1:] - 1
    keep = inside[first]
    first, last = first[keep], last[keep]
    whole = _mixed((sums[last + LENGTH] - sums[first]) * down[first] + (last - first).astype(np.uint64))
    text = np.searchsorted(ends, first, side="right")
    at = anchor[first]
    return text, gram[at].view(np.int64), (whole >> np.uint64(32)).astype(np.uint32).view(np.int32), first - (ends - lengths)[text], at - first, last - first


def _pack(first, before, more):
    """One long: first window, bytes from it to the anchor, windows less one."""
    return first << 14 | before << 7 | more


def _unpack(packed: np.ndarray) -> tuple[np.ndarray, ...]:
    return packed >> 14, packed >> 7 & 127, packed & 127


def prepared(docs: DataFrame) -> DataFrame:
    """id (null doc_ids last), number (64-bit hash of the text, for repeated ids), doc_id, bytes of the text."""
    data = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    number = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), number.alias("number"), "doc_id", data.alias("data"))


def find_stretches(rows: DataFrame) -> DataFrame:
    """gram, bytes hash, id, number and packed place of each stretch of prepared() rows; gram is null for a stretch whose bytes the same
    task has already seen at an earlier place, which no later step needs to compare."""

    def first_of_class(found: list[tuple]) -> pa.RecordBatch:
        gram, whole, ids, number, packed = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((packed, number, ids, whole, gram))
        gram, whole, ids, number, packed = (x[order] for x in (gram, whole, ids, number, packed))
        new = np.concatenate([[True], (gram[1:] != gram[:-1]) | (whole[1:] != whole[:-1])])
        start = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        again = (ids != ids[start]) | (number != number[start]) | (packed != packed[start])
        return pa.record_batch([pa.array(gram, pa.int64(), mask=again), pa.array(whole, pa.int32()), pa.array(ids, pa.int64()), pa.array(number, pa.int64()), pa.array(packed, pa.int64())], ["gram", "whole", "id", "number", "packed"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hashed():
            text, gram, whole, first, before, more = stretches(pieces)
            owner, number, base = (np.array(x, np.int64) for x in (owners, numbers, bases))
            return gram, whole, owner[text], number[text], _pack(base[text] + first, before, more)

        found, count = [], 0
        pieces, owners, numbers, bases, held = [], [], [], [], 0
        for batch in batches:
            for i, n, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                data = data.as_py()
                for at in range(0, max(1, len(data) - LENGTH + 1), PIECE):
                    piece = data[at : at + PIECE + LENGTH - 1]
                    if len(piece) < LENGTH:
                        continue
                    if held + len(piece) > PIECE * 2:
                        found.append(hashed())
                        count += len(found[-1][0])
                        pieces, owners, numbers, bases, held = [], [], [], [], 0
                        if count >= SEEN:
                            yield first_of_class(found)
                            found, count = [], 0
                    pieces.append(piece)
                    owners.append(i)
                    numbers.append(n)
                    bases.append(at)
                    held += len(piece)
        if pieces:
            found.append(hashed())
        if found:
            yield first_of_class(found)

    return rows.select("id", "number", "data").mapInArrow(read, "gram long, whole int, id long, number long, packed long")


def find_classes(sorted_rows: DataFrame) -> DataFrame:
    """Of rows sorted by (gram, whole, id, number, packed): those of null gram and those that repeat the first of their class (gram null), and the first of
    each class of a gram that has several (gram kept). A task streams its rows and keeps one."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram_now = whole_now = None
        first_now, pending, many = (0, 0, 0), None, False
        for mixed in batches:
            known = mixed.column(0).is_null()
            if len(seen := mixed.filter(known)):
                yield pa.record_batch([seen.column(2), seen.column(3), seen.column(4), seen.column(0)], ["id", "number", "packed", "gram"])
            batch = mixed.filter(pc.invert(known))
            if not batch.num_rows:
                continue
            gram, whole, ids, number, packed = (batch.column(i).to_numpy() for i in range(5))
            new_gram = np.concatenate([[gram_now is None or gram[0] != gram_now], gram[1:] != gram[:-1]])
            new = new_gram | np.concatenate([[whole_now is None or whole[0] != whole_now], whole[1:] != whole[:-1]])
            start = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
            first_id = np.where(start < 0, first_now[0], ids[start])
            first_number = np.where(start < 0, first_now[1], number[start])
            first_packed = np.where(start < 0, first_now[2], packed[start])
            again = ~new & ((ids != first_id) | (number != first_number) | (packed != first_packed))
            starts = np.flatnonzero(new)
            run = np.cumsum(new_gram[starts])  # 0: goes on from the batch before
            runs = int(np.cumsum(new_gram)[-1])
            count = np.bincount(run, minlength=runs + 1)
            count[0] += 0 if gram_now is None or new_gram[0] else (2 if many else 1)
            told = starts[count[run] > 1]
            out = [(ids[again], number[again], packed[again], None), (ids[told], number[told], packed[told], gram[told])]
            if pending is not None and count[0] > 1:
                out.append(tuple(np.array([x]) for x in (*pending, gram_now)))
                pending = None
            if runs:  # another gram is the last
                pending = None
            many = bool(count[runs] > 1)
            if not many and (mine := starts[run == runs]).size:
                pending = (ids[mine[0]], number[mine[0]], packed[mine[0]])
            gram_now, whole_now, first_now = gram[-1], whole[-1], (first_id[-1], first_number[-1], first_packed[-1])
            for i, t, p, g in out:
                if len(i):
                    yield pa.record_batch([pa.array(i, pa.int64()), pa.array(t, pa.int64()), pa.array(p, pa.int64()), pa.nulls(len(i), pa.int64()) if g is None else pa.array(g, pa.int64())], ["id", "number", "packed", "gram"])

    return sorted_rows.mapInArrow(read, "id long, number long, packed long, gram long")


def find_contexts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """gram, id, number, packed and the bytes around the anchor of each wanted (id, number, places) of prepared() rows."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                grams, ids, numbers, packs, contexts = [], [], [], [], []
                for i, n, data, places in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                    for p in places:
                        first, before, more = _unpack(p["packed"])
                        piece = data[first : first + more + LENGTH]
                        contexts.append(b"\xff" * (LEFT - before) + piece + b"\xff" * (WIDTH - LEFT + before - len(piece)))
                        grams.append(p["gram"])
                        ids.append(i)
                        numbers.append(n)
                        packs.append(p["packed"])
                yield pa.record_batch([pa.array(grams, pa.int64()), pa.array(ids, pa.int64()), pa.array(numbers, pa.int64()), pa.array(packs, pa.int64()), pa.array(contexts, pa.binary())], ["gram", "id", "number", "packed", "context"])

    joined = rows.select("id", "number", "data").join(wanted.hint("shuffle_hash"), ["id", "number"])
    return joined.select("id", "number", "data", "places").mapInArrow(read, "gram long, id long, number long, packed long, context binary")


def intervals(lcp: list[int], n: int) -> Iterator[tuple[int, int, int, int]]:
    """The common-prefix intervals of n sorted strings, of which neighbours i-1 and i share lcp[i]: (length, parent's length,
    first, last). One stack scan; an interval is told when it closes."""
    stack = [(-1, 0)]
    for i in range(1, n + 1):
        now = lcp[i] if i < n else -1
        begin = i - 1
        while stack[-1][0] > now:
            length, begin = stack.pop()
            yield length, max(now, stack[-1][0]), begin, i - 1
        if now > stack[-1][0]:
            stack.append((now, begin))


def _shared(rows: np.ndarray) -> np.ndarray:
    """Equal leading bytes of each row and the one before it; 0 for the first."""
    same = rows[1:] == rows[:-1]
    length = np.where(same.all(1), rows.shape[1], same.argmin(1))
    return np.concatenate([[0], length])


def repeat_groups(context: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Groups of equal strings of LENGTH around an anchor in the contexts (n, WIDTH): (least, most bytes left of the anchor, members).

    Every set of rows that share bytes left of the anchor and bytes right of it, LENGTH together, is told once for each
    run of such left lengths in which the set stays the same.
    """
    right = context[:, LEFT:]
    order = np.array(sorted(range(len(right)), key=[r.tobytes() for r in right].__getitem__))
    for length, parent, a, b in intervals(_shared(right[order]).tolist(), len(order)):
        low, high = LENGTH - length, min(LEFT, LENGTH - 1 - max(parent, 0))
        if low > high:
            continue
        members = order[a : b + 1]
        left = context[members, :LEFT][:, ::-1]
        inner = np.array(sorted(range(len(left)), key=[r.tobytes() for r in left].__getitem__))
        for deep, above, c, d in intervals(_shared(left[inner]).tolist(), len(inner)):
            least, most = max(low, above + 1), min(high, deep)  # a shallower interval tells shorter left parts
            if least <= most:
                yield least, most, members[inner[c : d + 1]]


def find_repeats(sorted_rows: DataFrame, classes: int = CLASSES) -> DataFrame:
    """Of contexts sorted by gram: id, number, start, end of bytes that repeat (window null), or of grams with more than `classes`
    classes each window by itself (window: its hash)."""

    def pairs(context, ids, number, packed):
        """Grams with two classes, all at once."""
        _, before, more = _unpack(packed)
        a, b = np.arange(0, len(ids), 2), np.arange(1, len(ids), 2)
        same = context[a] == context[b]
        right = same[:, LEFT:]
        right = np.where(right.all(1), LENGTH, right.argmin(1))
        left = same[:, :LEFT][:, ::-1]
        left = np.where(left.all(1), LEFT, left.argmin(1))
        after = np.where(number[a] == number[b], packed[a] > packed[b], number[a] > number[b])
        later = np.where(np.where(ids[a] == ids[b], after, ids[a] > ids[b]), a, b)
        low = np.maximum(LENGTH - right, before[later] - more[later])
        high = np.minimum(left, before[later])
        ok = (low <= high) & ((ids[a] != ids[b]) | (number[a] != number[b]) | (packed[a] != packed[b]))
        return later[ok], low[ok], high[ok]

    def rows(ids, number, packed, low, high, window=None):
        first, before, _ = _unpack(packed)
        at = first + before
        columns = [ids, number, at - high, at - low + LENGTH]
        return pa.record_batch([pa.array(np.asarray(c), pa.int64()) for c in columns] + [pa.nulls(len(ids), pa.int64()) if window is None else pa.array(window, pa.int64())], ["id", "number", "start", "end", "window"])

    def several(context, ids, number, packed):
        found, low, high = [], [], []
        _, before, more = _unpack(packed)
        for least, most, members in repeat_groups(context):
            first = min(members, key=lambda i: (ids[i], number[i], packed[i]))
            for i in members:
                lo, hi = max(least, before[i] - more[i]), min(most, before[i])
                if lo <= hi and (ids[i], number[i], packed[i]) != (ids[first], number[first], packed[first]):
                    found.append(i)
                    low.append(lo)
                    high.append(hi)
        return np.array(found, np.int64), np.array(low, np.int64), np.array(high, np.int64)

    def each_window(context, ids, number, packed):
        _, before, more = _unpack(packed)
        for shift in range(SPAN):  # bytes left of the anchor
            has = np.flatnonzero((shift <= before) & (shift >= before - more))
            if len(has):
                text = np.ascontiguousarray(context[has, LEFT - shift : LEFT - shift + LENGTH])
                digest = np.array([int.from_bytes(hashlib.blake2b(t.tobytes(), digest_size=8).digest(), "little", signed=True) for t in text])
                yield rows(ids[has], number[has], packed[has], np.full(len(has), shift), np.full(len(has), shift), digest)

    def told(context, ids, number, packed):
        found, low, high = several(context, ids, number, packed)
        if len(found):
            yield rows(ids[found], number[found], packed[found], low, high)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, spilling = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            gram, ids, number, packed = (batch.column(i).to_numpy() for i in range(4))
            context = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(-1, WIDTH)
            if held is not None:
                spilling = spilling and held[0][0] == gram[0]
                gram, ids, number, packed, context = (np.concatenate(x) for x in zip(held, (gram, ids, number, packed, context), strict=True))
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(gram)) + 1, [len(gram)]])
            begin, size = cuts[:-1], np.diff(cuts)
            done = begin[:-1]  # the last gram may go on
            two = done[size[:-1] == 2]
            if len(two):
                pick = np.stack([two, two + 1], 1).ravel()
                later, low, high = pairs(context[pick], ids[pick], number[pick], packed[pick])
                if len(later):
                    yield rows(ids[pick][later], number[pick][later], packed[pick][later], low, high)
            for b, n in zip(done, size[:-1], strict=True):
                if n > 2 or (spilling and b == 0):
                    part = slice(b, b + n)
                    hot = n > classes or (spilling and b == 0)
                    yield from (each_window if hot else told)(context[part], ids[part], number[part], packed[part])
            if len(done):
                spilling = False
            held = tuple(x[begin[-1] :] for x in (gram, ids, number, packed, context))
            if len(held[0]) > classes or (spilling and len(held[0]) > 1):
                yield from each_window(held[4], *held[1:4])
                held, spilling = tuple(x[:1] for x in held), True  # one row stays to know the gram; told again, it changes nothing
        if held is not None and len(held[0]) > 1:
            yield from (each_window if spilling else told)(held[4], *held[1:4])

    return sorted_rows.mapInArrow(read, "id long, number long, start long, end long, window long")


def repeated_spans(rows: DataFrame, classes: int = CLASSES) -> DataFrame:
    """id, number, start, end: bytes of prepared() rows that windows cover which also start earlier; they may overlap."""
    keys = ["gram", "whole", "id", "number", "packed"]
    dealt = find_stretches(rows).repartition(F.coalesce("gram", F.xxhash64("id", "number", "packed")))
    found = common.stash(find_classes(dealt.sortWithinPartitions(*keys)), "repeat-classes")
    first = F.shiftright("packed", 14)
    whole = found.where("gram is null").select("id", "number", first.alias("start"), (first + F.col("packed").bitwiseAND(127) + LENGTH).alias("end"))
    places = F.collect_list(F.struct("gram", "packed")).alias("places")
    wanted = found.where("gram is not null").groupBy("id", "number").agg(places)
    told = common.stash(find_repeats(find_contexts(rows, wanted).repartition("gram").sortWithinPartitions("gram"), classes), "repeat-spans")
    parts = told.where("window is null").select("id", "number", "start", "end")
    windows = told.where("window is not null").distinct()
    place = F.struct("id", "number", "start")
    earliest = windows.groupBy("window").agg(F.min(place).alias("first"))
    hot = windows.join(earliest, "window").where(place > F.col("first")).select("id", "number", "start", "end")
    return whole.unionByName(parts).unionByName(hot)


def merged(spans: np.ndarray) -> np.ndarray:
    """Disjoint runs (start, end) of spans, each start << 32 | length; spans that overlap or touch are one run."""
    spans = np.sort(spans)
    start, end = spans >> 32, np.maximum.accumulate((spans >> 32) + (spans & 0xFFFFFFFF))
    new = np.concatenate([[True], start[1:] > end[:-1]])
    return np.stack([start[new], end[np.concatenate([new[1:], [True]])]], 1)


def cut_repeats(docs: DataFrame, kept: bool = True, classes: int = CLASSES) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, spans
    [start, end, ...] and, with kept, the bytes that stay.

    A byte goes if a string of LENGTH bytes over it also starts earlier, in a row of lesser doc_id or before in
    the same; null doc_ids come last. Null text is empty. Rows of one doc_id and text are one document; rows of one
    doc_id with different texts come in any order. Matches never cross rows; other columns are ignored; an empty
    table gives no rows.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                batch, out = whole.slice(first, 512), []
                for data, found in zip(batch.column(1), batch.column(2), strict=True):
                    data, runs = data.as_py(), []
                    if found.is_valid:
                        runs = merged(found.values.to_numpy(zero_copy_only=False)).tolist()
                    at, parts = 0, []
                    for b, e in runs:
                        parts.append(data[at:b])
                        at = e
                    left = b"".join([*parts, data[at:]])
                    out.append((len(data), len(data) - len(left), len(runs), hashlib.sha256(left).hexdigest(), [x for r in runs for x in r], left if kept else None))
                kinds = [pa.int64()] * 3 + [pa.string(), pa.list_(pa.int64()), pa.binary()]
                made = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
                yield pa.record_batch([batch.column(0), *made], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    rows = prepared(docs)
    span = F.shiftleft("start", 32).bitwiseOR(F.col("end") - F.col("start"))
    spans = repeated_spans(rows, classes).groupBy("id", "number").agg(F.collect_list(span).alias("found"))
    joined = rows.join(spans.hint("shuffle_hash"), ["id", "number"], "left").select("doc_id", "data", "found")
    kind = docs.schema["doc_id"].dataType.simpleString()
    result = joined.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>, kept binary")
    return result if kept else result.drop("kept")


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that a 100-byte string covers which also starts earlier, taken out."""
    cut = cut_repeats(common.table(spark, sf_dir, "documents"), kept=False)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
