"""Benchmark decontamination by a prefix-filtered set join over item-sized windows."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

WINDOW, SHINGLE = 10, 3
#: Bytes of benchmark text that one pass over the documents holds in memory; more items take more passes.
BLOCK_BYTES = 8 << 20

#: Blocks whose searches run in one pass; after so many the documents are written with what was found.
WRITE_EVERY = 4


class Windows:
    """The windows of one block of benchmark items, and, once rarity() is told, the index of their prefixes."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW, shingle: int = SHINGLE):
        self.vocab: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[int]] = {}
        self.items = sorted({i for i, _ in items})
        number = {x: i for i, x in enumerate(self.items)}
        for item, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in text.translate(common.LETTERS_DIGITS).split()]
            length = min(window, len(ids))
            for at in range(len(ids) - length + 1 if ids else 0):
                found.setdefault(tuple(ids[at : at + length]), set()).add(number[item])
        self.windows, self.owners = list(found), [sorted(x) for x in found.values()]
        self.base = len(self.vocab) + 1
        self.shingle = shingle
        self.sizes = {min(shingle, len(w)) for w in found}
        # A shingle's code holds its ids plus one as digits; of over two million words it wraps around, and codes that meet then
        # only make more places to verify.
        self.codes = np.unique(np.array([c for w in self.windows for c in self._shingles(w)], dtype=np.int64))

    def _shingles(self, window: tuple[int, ...]) -> list[int]:
        k, out = min(self.shingle, len(window)), []
        for at in range(len(window) - k + 1):
            code = 0
            for x in window[at : at + k]:
                code = code * self.base + x + 1
            out.append((code + (1 << 63)) % (1 << 64) - (1 << 63))
        return out

    def rarity(self, documents: dict[int, int]) -> Windows:
        """Order each window's shingles by the number of documents that hold them; containment asks for all
        shingles, so the necessary prefix is the rarest one."""
        rows = []
        for n, window in enumerate(self.windows):
            codes = self._shingles(window)
            at = min(range(len(codes)), key=lambda i: (documents.get(codes[i], 0), codes[i], i))
            rows.append((codes[at], n, at))
        rows.sort()
        prefix = np.array([r[0] for r in rows], dtype=np.int64)
        self.prefix, first = np.unique(prefix, return_index=True)
        self.first = np.append(first, len(rows)).astype(np.int64)
        self.window_of = np.array([r[1] for r in rows], dtype=np.int64)
        self.offset_of = np.array([r[2] for r in rows], dtype=np.int64)
        self.length = np.array([len(w) for w in self.windows] or [0], dtype=np.int64)
        width = int(self.length.max())
        self.words = np.array([w + (-2,) * (width - len(w)) for w in self.windows] or [()], dtype=np.int64)
        self.owner_at = np.cumsum([0, *map(len, self.owners)])
        self.owner = np.array([o for x in self.owners for o in x], dtype=np.int64)
        return self

    def read(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Word ids of all texts one after another (-1: no benchmark word), and where each text starts."""
        get, ids, starts = self.vocab.get, [], [0]
        for text in texts:
            words = text.translate(common.LETTERS_DIGITS).split() if text else []
            ids.append(np.array(list(map(get, words, repeat(-1))), dtype=np.int64))
            starts.append(starts[-1] + len(words))
        return (np.concatenate(ids) if ids else np.empty(0, np.int64)), np.array(starts, dtype=np.int64)

    def places(self, ids: np.ndarray, starts: np.ndarray, wanted: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(positions, codes) of the shingles of 1 to self.shingle words that are among the sorted wanted codes."""
        if not len(wanted):
            return
        code, ok = np.zeros(len(ids), np.int64), np.ones(len(ids), bool)
        left = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(ids))  # words to the end of the text
        for k in range(self.shingle):
            nxt = ids[k:]
            if not len(nxt):
                return
            code = code[: len(nxt)] * self.base + nxt + 1
            ok = ok[: len(nxt)] & (nxt >= 0) & (left[: len(nxt)] > k)
            if k + 1 not in self.sizes:
                continue
            at = np.flatnonzero(ok)
            spot = np.searchsorted(wanted, code[at])
            spot[spot == len(wanted)] = 0
            hit = wanted[spot] == code[at]
            yield at[hit], code[at][hit]

    def search(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Verified occurrences: start position and window, for all texts at once."""
        out_at, out_window = [], []
        end_of = np.repeat(starts[1:], np.diff(starts))
        start_of = np.repeat(starts[:-1], np.diff(starts))
        for at, code in self.places(ids, starts, self.prefix):
            spot = np.searchsorted(self.prefix, code)
            n = self.first[spot + 1] - self.first[spot]
            entry = np.repeat(self.first[spot] - np.cumsum(n) + n, n) + np.arange(n.sum())
            at = np.repeat(at, n)
            window, begin = self.window_of[entry], at - self.offset_of[entry]
            # length and positional bounds: the whole window fits into the text around the shingle
            fits = (begin >= start_of[at]) & (begin + self.length[window] <= end_of[at])
            window, begin = window[fits], begin[fits]
            same = np.ones(len(begin), bool)
            for j in range(self.words.shape[1]):
                want = self.words[window, j]
                same &= (want == -2) | (ids[np.minimum(begin + j, len(ids) - 1)] == want)
            out_at.append(begin[same])
            out_window.append(window[same])
        if not out_at:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(out_at), np.concatenate(out_window)


def _texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def _rarity(docs: DataFrame, index: Windows) -> dict[int, int]:
    """In how many documents each benchmark shingle stands; at most one row for each distinct shingle of the block."""

    def count(batches):
        for batch in batches:
            ids, starts = index.read(_texts(batch.column(0)))
            doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            pairs = [np.unique(np.stack([code, doc[at]]), axis=1)[0] for at, code in index.places(ids, starts, index.codes)]
            code, n = np.unique(np.concatenate(pairs) if pairs else np.empty(0, np.int64), return_counts=True)
            yield pa.record_batch([pa.array(code), pa.array(n, pa.int64())], ["code", "n"])

    rows = docs.select("text").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    return {r["code"]: r["n"] for r in rows.collect()}


RESULT = "n_words long, n_hit long, items array<string>, spans array<int>"


def _hits(docs: DataFrame, index: Windows, again: bool, more: bool) -> DataFrame:
    """One pass: each row's words, hit words, items and merged spans [start, end, ...]; with again, on top of
    what an earlier pass found; with more, the text stays for the next pass."""
    schema = "doc_id " + docs.schema["doc_id"].dataType.simpleString() + (", text string, " if more else ", ") + RESULT

    def look(batches):
        for batch in batches:
            ids, starts = index.read(_texts(batch.column("text")))
            at, window = index.search(ids, starts)
            rows = len(starts) - 1
            edge = np.zeros(len(ids) + 1, np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + index.length[window], -1)
            row = np.searchsorted(starts, at, side="right") - 1
            n = index.owner_at[window + 1] - index.owner_at[window] if len(window) else np.empty(0, np.int64)
            owner = index.owner[np.repeat(index.owner_at[window] - np.cumsum(n) + n, n) + np.arange(n.sum())] if len(window) else np.empty(0, np.int64)
            items: list[set[str]] = [set() for _ in range(rows)]
            for r, o in np.unique(np.stack([np.repeat(row, n), owner]), axis=1).T if len(owner) else ():
                items[r].add(index.items[o])
            if again:
                for r, (old, spans) in enumerate(zip(batch.column("items").to_pylist(), batch.column("spans").to_pylist(), strict=True)):
                    items[r] |= set(old)
                    for b, e in zip(spans[::2], spans[1::2], strict=True):
                        edge[starts[r] + b] += 1
                        edge[starts[r] + e] -= 1
            hit = np.cumsum(edge[:-1]) > 0
            n_hit = np.add.reduceat(np.append(hit, False), starts[:-1]) * (np.diff(starts) > 0) if rows else []
            spans = [[] for _ in range(rows)]
            for r in np.flatnonzero(n_hit):
                own = np.diff(np.concatenate([[0], hit[starts[r] : starts[r + 1]].astype(np.int8), [0]]))
                spans[r] = np.stack([np.flatnonzero(own == 1), np.flatnonzero(own == -1)], 1).ravel().tolist()
            columns = {"doc_id": batch.column("doc_id")} | ({"text": batch.column("text")} if more else {})
            columns |= {
                "n_words": pa.array(np.diff(starts), pa.int64()), "n_hit": pa.array(np.asarray(n_hit, np.int64), pa.int64()),
                "items": pa.array([sorted(x) for x in items], pa.list_(pa.string())), "spans": pa.array(spans, pa.list_(pa.int32())),
            }
            yield pa.record_batch(list(columns.values()), list(columns))

    return docs.mapInArrow(look, schema)


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (doc_id, n_words, n_hit, items, spans), one for each row of docs (doc_id, text); spans are [start, end, ...] in words.

    benchmark (item_id, text) is read in blocks of at most about block_bytes of text (or one item), each held
    by every task; the documents pass once by each block to count how rare its shingles are and once to be
    searched, row by row and without a shuffle, so neither a long or hot document nor a frequent passage
    meets in one task. Null texts have no words and items without words no windows; a null item_id is reported as the
    empty string; equal item_ids are one item; extra columns are ignored; empty tables give no hits.
    """
    docs = docs.select("doc_id", "text")
    texts = docs  # rarity is counted on these, never on what earlier blocks made of them
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.encode("text", "UTF-8").alias("text")).where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + total // block_bytes
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    for n in range(blocks):
        rows = items.where(block == n) if blocks > 1 else items
        index = Windows([(r["item"], bytes(r["text"])) for r in rows.collect()], window)
        index.rarity(_rarity(texts, index))
        docs = _hits(docs, index, n > 0, n < blocks - 1)
        if n % WRITE_EVERY == WRITE_EVERY - 1 and n < blocks - 1:
            docs = common.stash(docs, "decontaminate")
    return docs


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """overlaps() with the columns n_items, items_sha256 and contaminated in place of items and spans."""
    return overlaps(docs, benchmark, window).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a window of a benchmark item."""
    return decontaminate(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{common.UPPER}', '{common.LOWER}'), '{common.ALNUM_WORD}')"
OP5_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS words FROM benchmark),
starts AS (SELECT item, words, least({WINDOW}, len(words)) AS k, unnest(range(1, len(words) - least({WINDOW}, len(words)) + 2)) AS i FROM b WHERE len(words) > 0),
windows AS (SELECT DISTINCT item, k, array_to_string(words[i : i + k - 1], ' ') AS s FROM starts),
places AS (SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS p FROM d CROSS JOIN (SELECT DISTINCT k FROM windows)),
hits AS (SELECT doc_id, p, places.k, item FROM places JOIN windows ON places.k = windows.k AND array_to_string(words[p : p + places.k - 1], ' ') = s),
covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hits) GROUP BY 1),
found AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY 1)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""
