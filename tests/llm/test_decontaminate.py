import hashlib
import re

import numpy as np

from traitloom.llm import decontaminate

from .conftest import SF

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute(docs, items, n=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(len(w) - min(n, len(w)) + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    sizes = sorted({len(w) for w in windows})
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if (t := tuple(w[i : i + size])) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[t]
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def same(df, want):
    assert sorted(map(tuple, df.collect()), key=str) == want


def test_real(spark, real, benchmark_rows):
    want = brute([(r.doc_id, r.text) for r in real], [(r.item_id, r.text) for r in benchmark_rows])
    assert any(r[-1] for r in want) and not all(r[-1] for r in want)
    same(decontaminate.op5_decontaminate(spark, SF), want)


def test_sql(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = con.sql(decontaminate.OP5_SQL)
    df = decontaminate.op5_decontaminate(spark, SF)
    assert sorted(map(tuple, df.select(*cursor.columns).collect())) == sorted(cursor.fetchall())


def test_blocks_agree(spark, real, benchmark_rows):
    """A benchmark too large for one block gives the same rows in several passes."""
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    want = {r.doc_id: (r.n_words, r.n_hit, sorted(r["items"]), r.spans) for r in decontaminate.overlaps(docs, items).collect()}
    got = {r.doc_id: (r.n_words, r.n_hit, sorted(r["items"]), r.spans) for r in decontaminate.overlaps(docs, items, block_bytes=3000).collect()}
    assert got == want


def test_odd_rows(spark, odd, odd_rows, empty):
    items = [(1, "C D E F g"), (2, "the MIT license"), (None, "ünïcode ß"), (3, None), (4, "?!"), (5, "one"), (5, "a b c d e f g h i j k"), (7, "mit license under ab cd éf 9x the mit license under ab cd")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(r[0], r[1]) for r in odd_rows]
    same(decontaminate.decontaminate(odd, bench), brute(rows, items))
    assert decontaminate.decontaminate(empty, bench).count() == 0
    same(decontaminate.decontaminate(odd, bench.limit(0)), brute(rows, []))


def test_a_block_of_very_many_words():
    """With billions of words as digits the codes of shingles wrap around, and every window is still found, and no other."""
    words = [f"{i:x}" for i in range(3_000)]
    index = decontaminate.Windows([("a", " ".join(words).encode())])
    index.base = 1 << 31
    index.codes = np.unique(np.array([c for w in index.windows for c in index._shingles(w)], dtype=np.int64))
    index.rarity({})
    ids, starts = index.read([" ".join([*words[-15:], "zz", *words[:9]]).encode(), None])
    at, window = index.search(ids, starts)
    assert sorted(at.tolist()) == list(range(6)) and len(set(window.tolist())) == 6
