import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from traitloom.llm import search
from traitloom.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, top=50):
    tf = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, total = sum(1 for _, c in tf if c), sum(sum(c.values()) for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in asked.items():
        scored = []
        for doc, c in tf:
            m = 50 + (50 * sum(c.values()) * n_docs) // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in own & set(c))
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, k + 1, row[3], -row[0]) for k, row in enumerate(sorted(scored, key=lambda x: x[:3])[:top])]
    return sorted(out, key=str)


def told(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("top", [3, 50])
def test_against_brute_force(spark, real, benchmark_rows, top, monkeypatch):
    monkeypatch.setattr(search, "DOCUMENTS", 16)  # blocks whose masks are cut short by what blocks before them found
    docs, items = spark.createDataFrame(real), spark.createDataFrame(benchmark_rows)
    assert told(search.search(docs, items, top)) == brute([(r["doc_id"], r["text"]) for r in real], [(r["item_id"], r["text"]) for r in benchmark_rows], top)


def test_sql(spark):
    df = QUERIES["op12_search"](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = con.execute(SQL["op12_search"])
    order = [df.columns.index(c[0]) for c in cursor.description]
    assert sorted(tuple(r[i] for i in order) for r in df.collect()) == sorted(cursor.fetchall())


def test_odd_rows_and_items(spark, odd, odd_rows):
    """Nulls, ties and repeated rows; items that repeat, are null, empty or without an id."""
    items = [(1, "the Mit LICENSE"), (1, "under é"), (2, None), (3, ""), (4, "!!"), (None, "a b c l"), (5, "absent"), (6, "É ünïcode 中文字")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r[0], r[1]) for r in odd_rows]
    for top in (2, 50):
        assert told(search.search(odd, frame, top)) == brute(docs, items, top)


def test_blocks_of_items_and_wide_masks(spark):
    """Items of more than 64 terms, in blocks; documents that are equal but for their ids."""
    random.seed(5)
    words = [f"w{i}" for i in range(300)]
    docs = [(i, " ".join(random.choices(words, k=random.randint(0, 120)))) for i in range(150)] + [(200 + i, "w1 w2 w2 w299") for i in range(70)]
    items = [(i, " ".join(random.sample(words, 90))) for i in range(12)] + [(50, "w1 w2 w299")]
    found = search.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), 10, block_bytes=1500)
    assert told(found) == brute(docs, items, 10)


def test_masks_end_early(monkeypatch):
    """Once the best are full, masks that can't reach them are not looked at."""
    best, seen = search.Best(1), []
    add = best.add
    monkeypatch.setattr(best, "add", lambda s, i: (seen.extend(i), add(s, i)))
    docs = [np.arange(0, 100), np.arange(0, 1)]
    search._evaluate(best, docs, [np.full(100, 5), np.array([100])], 100, list(range(100)))
    search._evaluate(best, docs, [np.full(100, 5), np.array([99])], 100, list(range(100, 200)))
    assert best.rows == [(-105, False, 0)] and len(seen) == 1


def test_empty(spark, empty, odd):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert search.search(odd, none).count() == 0
    assert search.search(empty, some).count() == 0
    assert search.search(empty, some).columns == ["item_id", "rank", "doc_id", "score"]
