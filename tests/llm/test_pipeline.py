from collections import Counter, defaultdict

import corpus_pipeline
from traitloom.llm import langid, mixing

from .conftest import DOCUMENTS, SF
from .test_decontaminate import brute as benchmark_hits
from .test_mixing import water_fill, words
from .test_simhash import components, fingerprint
from .test_tokenfiles import brute as token_rows


def test_against_brute_force(spark, real, benchmark_rows):
    rows = [r for r in real if any(c.isalpha() for c in r.text or "")]
    roots = {d: least for d, _, least in components([(r.doc_id, fingerprint(r.text)) for r in rows])}
    rows = [r for r in rows if roots[r.doc_id] == r.doc_id]
    hit = {h[0] for h in benchmark_hits([(r.doc_id, r.text) for r in rows], [(b.item_id, b.text) for b in benchmark_rows]) if h[-1]}
    rows = [r for r in rows if r.doc_id not in hit]
    assert hit and len(rows) < len(real)
    by_source = defaultdict(list)
    for r in rows:
        by_source[r.source].append(r)
    target = water_fill({s: sum(words(r.text) for r in rs) for s, rs in by_source.items()})
    copies, u = Counter(), mixing.offset()
    for s, rs in by_source.items():
        size = sum(words(r.text) for r in rs)
        rate = target[s] / size if size else 0
        for i, r in enumerate(sorted(rs, key=lambda r: (-words(r.text), r.doc_id))):
            copies[r.doc_id] = min(3, int((i + 1) * rate + u) - int(i * rate + u))
    mixed = [(r.doc_id, r.text) for r in rows for _ in range(copies[r.doc_id])]
    got = sorted((tuple(r) for r in corpus_pipeline.run(spark, SF).collect()), key=lambda r: r[1])
    assert got == token_rows(mixed)


def test_stages_keep_columns_and_odd_rows(spark, odd, empty):
    for docs in (odd, empty):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == corpus_pipeline.COLUMNS and (out.count() <= n or name == "mixing")
        tokens = corpus_pipeline.write_tokens(spark, docs, SF).collect()
        assert len(tokens) == n and sorted(r.start for r in tokens) == [sum(r.n_tokens for r in tokens if r.start < s) for s in sorted(r.start for r in tokens)]
    left = corpus_pipeline.identify_language(spark, odd, SF).collect()
    assert {r.lang for r in left} <= {"en", "fr", "de"}
    assert {r.doc_id for r in left} == {4, 5, 6, 7, 8, 9, None} and langid.UNDETERMINED == "und"
    kept = corpus_pipeline.drop_near_copies(spark, odd, SF).collect()
    assert {r.doc_id for r in kept} == {1, 4, 5, 7, 8, 10, None}


def test_stages_decide_by_row(spark, benchmark_rows):
    """Rows of null or repeated doc_id neither take clean rows with them nor escape the dedup."""
    leak = max((b.text for b in benchmark_rows), key=len)
    clean = [" ".join(f"{x}{i}" for i in range(60)) for x in ("alder", "birch", "cedar", "elm", "fir")]
    frame = lambda rows: spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], DOCUMENTS)
    kept = lambda stage, rows: sorted(((r.doc_id, r.text) for r in stage(spark, frame(rows), SF).collect()), key=str)
    rows = [(None, clean[0]), (None, leak), (5, clean[1]), (5, leak), (6, clean[2])]
    assert kept(corpus_pipeline.drop_benchmark_copies, rows) == sorted([r for r in rows if r[1] != leak], key=str)
    rows = [(1, clean[0]), (None, clean[0].upper()), (None, clean[1]), (None, clean[1].upper()), (None, clean[2]), (2, clean[3]), (2, clean[3]), (3, clean[4]), (3, clean[0])]
    got = kept(corpus_pipeline.drop_near_copies, rows)
    assert sorted((i or 0, t.lower()) for i, t in got) == sorted([(1, clean[0]), (0, clean[1]), (0, clean[2]), (2, clean[3]), (3, clean[4])])
