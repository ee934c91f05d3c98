import re
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest

from traitloom.llm import phrases
from traitloom.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count, share=100, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, 6):
                f.update((lang or "und", tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    found = {key: a for key, a in f.items() if a >= min_count and len(key[1]) > 1}
    dropped = set()
    for (lang, p), a in found.items():
        for k in range(2, len(p)):
            dropped |= {(lang, p[i : i + k]) for i in range(len(p) - k + 1) if 100 * a >= share * found[lang, p[i : i + k]]}
    by = defaultdict(list)
    for (lang, p), a in found.items():
        if (lang, p) not in dropped:
            score, _, left, right = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            by[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, own in by.items() for i, (s, a, p, left, right) in enumerate(sorted(own)[:top]))


def told(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("min_count", "share", "top"), [(2, 100, 2000), (5, 80, 20)])
def test_against_brute_force(spark, real, min_count, share, top):
    docs = spark.createDataFrame(real)
    rows = [(r["text"], r["lang"]) for r in real]
    assert told(phrases.collocations(docs, min_count, share, top)) == brute(rows, min_count, share, top)


def test_sql(spark):
    df = QUERIES["op11_phrases"](spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cursor = con.execute(SQL["op11_phrases"])
    order = [df.columns.index(c[0]) for c in cursor.description]
    assert sorted(tuple(r[i] for i in order) for r in df.collect()) == sorted(cursor.fetchall())


def test_odd_rows(spark, odd, odd_rows):
    rows = [(r[1], r[2]) for r in odd_rows]
    assert told(phrases.collocations(odd, 2)) == brute(rows, 2)


def test_long_texts_in_small_chunks(spark):
    """A piece longer than a chunk, pieces cut into many chunks, runs of one word, and separators side by side."""
    rows = [("a " * 500 + "b\x0b\x0cA\ta.,;c\x1cd " + "x y z. " * 200, "en"), ("a b" * 40, None), ("a b", "und"), ("!?", "en")]
    table = pa.record_batch({"text": [r[0] for r in rows], "lang": [r[1] or "und" for r in rows]})
    read = [[(c.langs[g], c.words[i].as_py(), bool(k)) for c in phrases.chunks([table], most=n) for g, i, k in zip(c.lang, c.ids, c.inner, strict=True)] for n in (64, 1 << 20)]
    assert read[0] == read[1] and sum(1 for _ in phrases.chunks([table], most=64)) > 10
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(1)
    assert told(phrases.collocations(docs, 3)) == brute(rows, 3)


def test_filter_of_few_buckets_keeps_everything(spark, real):
    """Words that share a bucket with others stay in the windows and are counted exactly."""
    docs = spark.createDataFrame(real[:80])
    assert told(phrases.collocations(docs, 3, bits=phrases.PART_BITS)) == brute([(r["text"], r["lang"]) for r in real[:80]], 3)


def test_products_beyond_64_bits(spark):
    """Scores of counts near 10**12 are those of exact arithmetic."""
    from pyspark.sql import functions as F

    row = spark.sql("SELECT 999999999989L AS a, 9999999999971L AS n, 1000000000039L AS l, 999999999989L AS r")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    score = row.select(F.call_function("div", F.lit(1000).cast("decimal(4,0)") * wide("a") * wide("n"), wide("l") * wide("r"))).first()[0]
    assert score == 1000 * 999999999989 * 9999999999971 // (1000000000039 * 999999999989)


def test_empty(spark, empty):
    assert phrases.collocations(empty).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert phrases.collocations(empty).count() == 0
