import math
import re

from traitloom.llm import licenses

from .conftest import SF

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(doc_id, text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    at, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        found = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        at += found
        labels |= {label} if found else set()
    return doc_id, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def check(rows, want):
    assert sorted((tuple(r)[:6] for r in rows), key=str) == sorted(want, key=str)
    for r in rows:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1


def test_real(spark, real):
    want = [brute(r.doc_id, r.text) for r in real]
    assert sum(w[2] for w in want) > 0
    check(licenses.op10_licenses(spark, SF).collect(), want)


def _query(docs):
    from unittest import mock

    with mock.patch.object(licenses.common, "table", lambda *a: docs):
        return licenses.op10_licenses(docs.sparkSession, "")


def test_odd_rows(spark, odd_rows, empty):
    texts = [
        "CC BY-NC, cc by nc CC-BY-NC 4.0", "Under the MIT License under the mit license", "apache license, version 2.0 É Apache-License version 2",
        "This work is licensed under the GNU General Public License, version 3.", "permission is hereby granted, free of charge, to any",
        "x Permission Is hereby granted free of charge to any person obtaining a copy of this software", "mit under the apache license version 3",
    ]
    rows = [(r[0], r[1]) for r in odd_rows] + [(100 + i, t) for i, t in enumerate(texts)]
    out = _query(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check(out, [brute(*r) for r in rows])
    labels = {r.doc_id: (r.labels, r.score) for r in out}
    assert labels[103][0] == "gpl-3" and labels[104][0] == labels[105][0] == "mit" and labels[104][1] < labels[105][1] and labels[106] == ("", 0.0)
    assert _query(empty).count() == 0


def brute_labels(rows):
    """labels and score of (doc_id, text) rows by plain search, rarities over all of them."""
    split = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW)) for _, t in rows]
    vocabulary = {w for _, t, k in licenses.TEMPLATES for w in (t + " " + k).split()} | {w for p in licenses.BASE for w in p.split()}
    seen = [vocabulary & set(w) for w in split]
    idf = {v: math.log((len(rows) + 1) / (sum(v in x for x in seen) + 1)) for v in vocabulary}
    out = []
    for (doc_id, text), w in zip(rows, split, strict=True):
        labels = set(filter(None, brute(doc_id, text)[5].split(",")))
        best, base = 0.0, bool(labels)
        for label, template, key in licenses.TEMPLATES:
            t, k = template.split(), key.split()
            shift = next(j for j in range(len(t)) if t[j : j + len(k)] == k)
            for at in [i for i in range(len(w)) if w[i : i + len(k)] == k]:
                labels.add(label)
                hit = sum(idf[x] for j, x in enumerate(t) if 0 <= at - shift + j < len(w) and w[at - shift + j] == x)
                best = max(best, hit / (sum(idf[x] for x in t) or 1.0))
        out.append((doc_id, ",".join(sorted(labels)), min(1.0, max(best, 0.5) if base else best)))
    return out


def test_labels_and_score_against_brute_force(spark, real):
    texts = [f"{'word ' * (i % 7)}{t if i % 3 else ' '.join(t.split()[: 6 + i % 5])} {'tail ' * (i % 4)}" for i in range(5) for _, t, _ in licenses.TEMPLATES]
    rows = [(r.doc_id, r.text) for r in real] + [(10**6 + i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, None)]
    got = [(r.doc_id, r.labels, round(r.score, 5)) for r in _query(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    want = [(d, x, round(s, 5)) for d, x, s in brute_labels(rows)]
    assert len({x for _, x, _ in want}) > 10 and sorted(got, key=str) == sorted(want, key=str)


def test_clashing_columns(spark, odd):
    from pyspark.sql import functions as F

    extra = odd.withColumns({c: F.lit("x") for c in ("words", "posts", "base", "found", "every", "best", "word", "b0", "t0")})
    assert sorted(map(str, _query(extra).collect())) == sorted(map(str, _query(odd.select("doc_id", "text")).collect()))
