"""Ranked lexical search: documents of a block are grouped by the mask of an item's terms that they hold, and masks are taken by what
they can score at most, until none can reach the item's best documents any more."""

from __future__ import annotations

import math
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

TOP = 50
#: Bytes of items that one pass over the documents looks for; more items take more passes.
BLOCK_BYTES = 8 << 20
#: Documents that are grouped together.
DOCUMENTS = 4096
SCALE, NORM = 1_000_000_000, 20


def _words(text: bytes) -> list[bytes]:
    return text.translate(common.LETTERS_DIGITS).split()


def _read(docs: DataFrame, vocab: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats), and of the terms in vocab the ids, ascending, with their counts."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(vocab)

    def look(batches):
        get = sent.value.get
        for batch in batches:
            n, terms, counts = [], [], []
            for text in batch.column("text").cast(pa.binary()):
                words = _words(text.as_py() or b"")
                ids = np.array(list(map(get, words, repeat(-1))), np.int32)
                own, times = np.unique(ids[ids >= 0], return_counts=True)
                n.append(len(words))
                terms.append(own)
                counts.append(times)
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))], ["doc_id", "n", "terms", "counts"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(look, f"doc_id {kind}, n long, terms array<int>, counts array<long>")


class Best:
    """An item's best documents so far: score descending, then doc_id ascending, null last."""

    def __init__(self, top: int):
        self.top, self.rows = top, []

    def full(self) -> bool:
        return len(self.rows) >= self.top

    def least(self) -> int:
        return -self.rows[-1][0] if self.full() else 1

    def add(self, scores: np.ndarray, ids: list) -> None:
        self.rows += [(-int(s), d is None, d if d is not None else 0) for s, d in zip(scores, ids, strict=True)]
        self.rows = sorted(self.rows)[: self.top]


def _masks(docs: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of n documents, and for each term those that hold it: the documents that hold any, their distinct masks (rows of 64-bit
    words, term j being bit j) and which mask each of them has."""
    masks = np.zeros((n, -(-len(docs) // 64)), np.uint64)
    for j, own in enumerate(docs):
        masks[own, j >> 6] |= np.uint64(1) << np.uint64(j & 63)
    some = np.flatnonzero(masks.any(1))
    rows = masks[some]
    if rows.shape[1] == 1:
        distinct, of = np.unique(rows[:, 0], return_inverse=True)
        return some, distinct[:, None], of
    distinct, of = np.unique(rows, axis=0, return_inverse=True)
    return some, distinct, of.ravel()


def _evaluate(best: Best, docs: list[np.ndarray], parts: list[np.ndarray], n: int, ids: list) -> None:
    """Adds to best what the documents of one block score; docs and parts hold, for each term, the documents with it and the term's
    share of their score."""
    some, masks, of = _masks(docs, n)
    bits = np.unpackbits(masks.view(np.uint8), axis=1, bitorder="little")[:, : len(docs)]
    # sums stay far below 2**53, so that doubles hold them exactly
    most = bits.astype(float) @ np.array([p.max() for p in parts], float)
    order = np.argsort(-most, kind="stable")
    by_mask = np.argsort(of, kind="stable")
    first = np.searchsorted(of[by_mask], np.arange(len(masks) + 1))
    scores = None
    for at in range(0, len(order), 64):
        turn = order[at : at + 64]
        turn = turn[most[turn] >= best.least()]  # one that ties may hold a lower doc_id
        if not len(turn):
            return
        if scores is None:
            scores = np.zeros(n, np.int64)
            for own, part in zip(docs, parts, strict=True):
                scores[own] += part
        rows = some[by_mask[np.concatenate([np.arange(first[m], first[m + 1]) for m in turn])]]
        rows = rows[scores[rows] >= best.least()]
        if len(rows) > best.top:
            cut = np.partition(scores[rows], -best.top)[-best.top]
            rows = rows[scores[rows] >= cut]
        best.add(scores[rows], [ids[r] for r in rows])


def _search(read: DataFrame, items: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(item, doc_id, score): each task's best documents of each item, an index into items."""
    sent = read.sparkSession.sparkContext.broadcast((items, weights))
    kind = read.schema["doc_id"].dataType

    def look(batches):
        items, weights = sent.value
        found = [Best(top) for _ in items]
        for whole in batches:
            for at in range(0, whole.num_rows, DOCUMENTS):
                batch = whole.slice(at, DOCUMENTS)
                sizes, lists = batch.column("n").to_numpy(), batch.column("terms")
                length = np.diff(lists.offsets.to_numpy())
                term, tf = lists.flatten().to_numpy(), batch.column("counts").flatten().to_numpy()
                doc = np.repeat(np.arange(len(sizes)), length)
                m = 50 + (50 * sizes * n_docs) // max(n_terms, 1)
                part = weights[term] * ((SCALE * tf) // (1000 * tf + NORM * m[doc]))
                order = np.argsort(term, kind="stable")
                term, doc, part = term[order], doc[order], part[order]
                known, first = np.unique(term, return_index=True)
                ends = np.append(first[1:], len(term))
                ids = batch.column("doc_id").to_pylist()
                for best, own in zip(found, items, strict=True):
                    spot = np.searchsorted(known, own)
                    spot = spot[(spot < len(known)) & (known[np.minimum(spot, len(known) - 1)] == own)] if len(known) else spot[:0]
                    spans = [slice(first[s], ends[s]) for s in spot]
                    if spans and sum(float(part[s].max()) for s in spans) >= best.least():
                        _evaluate(best, [doc[s] for s in spans], [part[s] for s in spans], len(sizes), ids)
        rows = [(i, None if absent else d, -s) for i, best in enumerate(found) for s, absent, d in best.rows]
        out = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.record_batch([pa.array(out[0], pa.int32()), pa.array(out[1], types[0]), pa.array(out[2], pa.int64())], ["item", "doc_id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(kind)]
    return read.mapInArrow(look, f"item int, doc_id {kind.simpleString()}, score long")


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: for each item of queries (item_id, text) its best documents of docs (doc_id, text).

    Items are read in blocks of about block_bytes of text (or one item); for each block the documents are read once for their
    terms and lengths, which are written, and from these the items' documents are scored where they lie. A task keeps `top`
    documents an item; only these are shuffled, so neither a frequent term nor an item meets its documents in one task.
    Null and empty texts have no terms; equal item_ids (null being one) are one item with the terms of all; rows of docs that repeat are
    as many documents, whose order among themselves does not show; equal scores go by doc_id, null last; extra columns don't
    matter; very long texts are read whole, one at a time; empty tables give no rows.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    asked = queries.select("item_id", F.encode("text", "UTF-8").alias("text")).where("text is not null")
    blocks = 1 + (asked.agg(F.sum(F.length("text"))).first()[0] or 0) // block_bytes
    out = None
    for number in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number) if blocks > 1 else asked
        vocab: dict[bytes, int] = {}
        terms: dict = {}
        for row in rows.toLocalIterator():
            terms.setdefault(row["item_id"], set()).update(vocab.setdefault(w, len(vocab)) for w in _words(bytes(row["text"])))
        read = common.stash(_read(docs, vocab), "search")
        total = read.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        df = np.zeros(len(vocab), np.int64)
        for row in read.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
            df[row["term"]] = row["count"]  # a row for each term of the block
        weights = np.array([math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        names = list(terms)
        found = _search(read, [np.array(sorted(terms[x]), np.int32) for x in names], weights, total["docs"], total["terms"], top)
        kind = queries.schema["item_id"].dataType.simpleString()
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        best = common.top_ranked(found, ["item"], order, top, F.col("doc_id"))
        of = spark.createDataFrame([(i, x) for i, x in enumerate(names)], f"item int, item_id {kind}")
        part = best.join(of, "item").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    return out


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for each benchmark item."""
    return search(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{common.UPPER}', '{common.LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS i, doc_id, {_TERMS} AS ws FROM documents),
total AS (SELECT count(*) AS N, sum(len(ws))::BIGINT AS L FROM d WHERE len(ws) > 0),
items AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
tf AS (SELECT i, term, count(*) AS tf FROM (SELECT i, unnest(ws) AS term FROM d) WHERE term IN (SELECT term FROM items) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * N + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term, N),
part AS (SELECT i, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + ((50 * len(ws) * N) // L)))) AS part FROM tf JOIN w USING (term) JOIN d USING (i), total),
scored AS (SELECT item_id, i, sum(part)::BIGINT AS score FROM items JOIN part USING (term) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored JOIN d USING (i) WHERE score > 0 QUALIFY rank <= {TOP}
"""
