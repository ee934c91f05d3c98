"""License scans with a positional index of the rarest words of license texts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Phrases whose every place counts, and their labels. Fixed values.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Label, characteristic text, mandatory key phrase within it; in lower-cased words. Wording of the public licenses.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("mit", "released under the mit license", "the mit license"),
    ("apache-2", "licensed under the apache license version 2 0", "the apache license version 2"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("proprietary", "all rights reserved", "all rights reserved"),
]


def words_of(text: Column) -> Column:
    """Words of the text. lower() also changes letters beyond A-Z, but splits no word and makes no word of the tables from another,
    but for the Kelvin sign, which becomes k."""
    return F.regexp_extract_all(F.lower(text), F.lit(common.ALNUM_WORD), F.lit(0))


def rarity(words: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """Inverse document frequency of each word of the vocabulary over all rows (words)."""
    listed = F.array(*map(F.lit, vocabulary))
    seen = words.select(F.explode(F.array_intersect("words", listed)).alias("word")).groupBy("word").count()
    counts = {r["word"]: r["count"] for r in seen.collect()}  # at most the vocabulary
    n = words.count()
    return {w: math.log((n + 1) / (counts.get(w, 0) + 1)) for w in vocabulary}


def _array(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def anchors_of(phrase: list[str], idf: dict[str, float]) -> list[int]:
    """Places in the phrase of its two rarest words, the rarest first."""
    return sorted(range(len(phrase)), key=lambda i: (-idf[phrase[i]], i))[:2]


def postings(words: Column, anchors: list[str]) -> Column:
    """The row's positional index: word and place of each of its words that anchors a phrase. Most rows have none."""
    every = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at"))), lambda x: x["word"].isin(anchors))
    return F.when(F.arrays_overlap(words, _array(anchors)), every).otherwise(F.array().cast("array<struct<word:string,at:int>>"))


def places(posts: Column, words: Column, phrase: list[str], idf: dict[str, float]) -> Column:
    """Where the phrase starts in words: postings of its two rarest words, less their places in the phrase, are intersected; what is
    left is verified word by word."""

    def starts(i: int) -> Column:
        return F.transform(F.filter(posts, lambda x: x["word"] == phrase[i]), lambda x: x["at"] - i)

    ranked = anchors_of(phrase, idf)
    found = F.array_intersect(starts(ranked[0]), starts(ranked[-1]))
    return F.filter(found, lambda at: (at >= 0) & (F.slice(words, F.greatest(at, F.lit(0)) + 1, F.lit(len(phrase))) == _array(phrase)))


def cover(words: Column, starts: Column, template: list[str], shift: int, idf: dict[str, float]) -> Column:
    """The best share of the template's summed rarity that stands at the right relative place around one of the starts."""
    total = sum(idf[w] for w in template) or 1.0

    def share(at: Column) -> Column:
        hits = [F.when(F.try_element_at(words, F.when(at - shift + j >= 0, at - shift + j + 1)) == w, idf[w] / total).otherwise(0.0) for j, w in enumerate(template)]
        every = hits[0]
        for h in hits[1:]:
            every = every + h
        return every

    return F.array_max(F.transform(starts, share))


def scan(docs: DataFrame, templates=tuple(TEMPLATES)) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_words, base (starts by phrase), found (label and cover of each template whose key phrase stands).

    Two passes: rarity of the license words over all documents, then each row by itself, without a shuffle. Null text has no
    words; null or repeated doc_ids are rows of their own; texts of any length are read whole; words of equal rarity rank by place;
    other columns are ignored, whatever their names; an empty table gives no rows.
    """
    rows = docs.select("doc_id", words_of(F.coalesce(F.col("text"), F.lit(""))).alias("words"))
    split = [(label, text.split(), key.split()) for label, text, key in templates]
    phrases = [p.split() for p in BASE]
    idf = rarity(rows, sorted({w for _, t, k in split for w in t + k} | {w for p in phrases for w in p}))
    words, posts = F.col("words"), F.col("posts")
    anchors = sorted({p[i] for p in [*phrases, *[k for _, _, k in split]] for i in anchors_of(p, idf)})
    rows = rows.withColumn("posts", postings(words, anchors))
    rows = rows.select("doc_id", "words", *[places(posts, words, p, idf).alias(f"b{i}") for i, p in enumerate(phrases)], *[places(posts, words, k, idf).alias(f"t{i}") for i, (_, _, k) in enumerate(split)])
    covers = []
    for i, (label, text, key) in enumerate(split):
        shift = next(j for j in range(len(text)) if text[j : j + len(key)] == key)
        covers.append(F.when(F.size(f"t{i}") > 0, F.struct(F.lit(label).alias("label"), cover(words, F.col(f"t{i}"), text, shift, idf).alias("cover"))))
    return rows.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.array(*[f"b{i}" for i in range(len(phrases))]).alias("base"),
        F.filter(F.array(*covers), lambda x: x.isNotNull()).alias("found"),
    )


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases, labels and best cover of every document."""
    rows = scan(common.table(spark, sf_dir, "documents"))
    every = F.flatten("base")
    labels = F.array(*[F.when(F.size(F.get("base", F.lit(i))) > 0, F.lit(label)) for i, label in enumerate(BASE.values())])
    base = F.array_sort(F.array_distinct(F.array_compact(labels)))
    best = F.coalesce(F.array_max(F.transform("found", lambda x: x["cover"])), F.lit(0.0))
    rows = rows.select("doc_id", "n_words", every.alias("every"), base.alias("base"), "found", best.alias("best"))
    return rows.select(
        "doc_id", "n_words", F.size("every").cast("long").alias("n_base"),
        F.array_min("every").cast("long").alias("first_word"), F.array_max("every").cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.transform("found", lambda x: x["label"]))), ",").alias("labels"),
        F.least(F.lit(1.0), F.round(F.when(F.size("base") > 0, F.greatest("best", F.lit(0.5))).otherwise(F.col("best")), 6)).alias("score"),
    )
