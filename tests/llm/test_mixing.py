import re
from collections import defaultdict

import duckdb
import pytest

from traitloom.llm import mixing

from .conftest import SF


def water_fill(sizes, weights=(5, 2, 1), most=3):
    """Reshare the excess round by round."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = sum(sizes.values())
    target, capped = dict.fromkeys(names, 0.0), set()
    for _ in range(len(names) + 1):
        free = [s for s in names if s not in capped]
        left = total - sum(target[s] for s in capped)
        for s in free:
            target[s] = left * weight[s] / sum(weight[x] for x in free)
        over = [s for s in free if target[s] > most * sizes[s] + 1e-9]
        if not over:
            break
        for s in over:
            target[s] = most * sizes[s]
            capped.add(s)
    return target


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_and_copies(spark, real):
    rows = mixing.op3_mixing(spark, SF).collect()
    sizes, source = defaultdict(int), {}
    for r in real:
        sizes[r.source] += words(r.text)
        source[r.doc_id] = r.source
    want = water_fill(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s], abs=1e-3) and 0 <= r.taken <= 3 * r["size"]
        taken[s] += r.taken
        largest[s] = max(largest[s], r["size"])
    assert all(abs(taken[s] - want[s]) <= largest[s] + 1 for s in sizes)
    assert sorted(rows) == sorted(mixing.op3_mixing(spark, SF).collect())


def test_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cursor = con.sql(mixing.OP3_SQL)
    df = mixing.op3_mixing(spark, SF)
    assert sorted(map(tuple, df.select(*cursor.columns).collect())) == sorted(cursor.fetchall())


def test_odd_rows(spark, odd, empty):
    mixed = mixing.plan_mix(odd)
    rows = mixed.collect()
    assert len(rows) == 12 and {c for c in odd.columns} <= set(mixed.columns)
    want = water_fill({"a": words(" \t\n") + 12 + 3 + 5, "b": 3 * words(rows[0].text or "") or 3 * 24000, None: 1, "c": 6 + 12})
    for r in rows:
        assert r.mix_size == words(r.text) and r.mix_copies <= 3
        if r.source in ("a", None):
            assert r.mix_source_size == {"a": 20, None: 1}[r.source]
    assert want.keys() == {r.source for r in rows}
    assert mixing.emit(mixed).count() == sum(r.mix_copies for r in rows)
    assert mixing.plan_mix(empty).count() == 0


def test_many_buckets(spark, real, monkeypatch):
    """Small pieces: prefix sums over sizes and buckets give the ranks of one order by size, bucket, id and text hash."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(mixing, "BUCKET_ROWS", 5)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(docs.where("doc_id % 3 = 0")).withColumn("source", F.when(F.col("doc_id") % 2 == 0, "one").otherwise(F.col("source")))
    buckets = 1 + docs.count() // 5
    tie = F.xxhash64("text")
    rows = docs.select("doc_id", "source", "text", tie.alias("tie"), F.pmod(F.xxhash64("doc_id", tie), F.lit(buckets)).alias("bucket")).collect()
    by_source = defaultdict(list)
    for r in rows:
        by_source[r.source].append((-words(r.text), r.bucket, r.doc_id, r.tie))
    targets, u, want = water_fill({s: -sum(x[0] for x in xs) for s, xs in by_source.items()}), mixing.offset(), []
    for s, xs in by_source.items():
        rate = targets[s] / -sum(x[0] for x in xs)
        want += [(s or "", x[2], min(3, int((i + 1) * rate + u) - int(i * rate + u))) for i, x in enumerate(sorted(xs))]
    got = [(r.source or "", r.doc_id, r.mix_copies) for r in mixing.plan_mix(docs).collect()]
    assert buckets > 40 and sorted(got) == sorted(want)
