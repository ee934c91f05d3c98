import math
import zlib

import numpy as np

from traitloom.llm import langid

from .conftest import SF


def test_automaton_is_complete():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 3, 60).tolist()
    moves = langid.automaton(codes)
    subs = {tuple(codes[i:j]) for i in range(60) for j in range(i + 1, 61)}
    for probe in {tuple(rng.integers(0, 3, n)) for n in range(1, 8) for _ in range(40)} | set(list(subs)[:200]):
        state = 0
        for c in probe:
            state = moves[state].get(c) if state is not None else None
        assert (state is not None) == (probe in subs)


def phrases(text, sample):
    """Greedy longest matches; a letter that the sample lacks is one."""
    count, i, sample = 0, 0, f" {sample} "
    while i < len(text):
        n = 1
        while i + n < len(text) and text[i : i + n + 1] in sample:
            n += 1
        i += n
        count += 1
    return count


def test_phrases_match_brute_force():
    sample = (("x", "the cat sat on the mat and the rat"), ("y", "le chat est sur la table et le rat"), ("z", "\u4e2d\u6587 \u5b57 the"))
    model = langid.Models(sample)
    rng = np.random.default_rng(3)
    texts = ["The CAT zat!! on \xdf mat", "le chat", "a", "  Rat  rat 12 r\xe4t", "\u4e2d\u6587\u5b57 cat \xdf"]
    texts += ["".join(rng.choice(list("thecar. \xe9"), n)) for n in (1500, 511, 510, 5000)] + ["the cat sat on the mat " * 100]
    got = model.phrases([model.codes(t) for t in texts])
    for i, text in enumerate(texts):
        clean = " " + langid.normal(text) + " "
        assert len(model.codes(text)) == len(clean)
        assert got[i].tolist() == [phrases(clean, s) for _, s in sample], text


def test_predictions_match_brute_force(spark, real):
    """Whole documents against models of a short sample: language and score by plain parsing."""
    sample = tuple((lang, text[:1500]) for lang, text in langid.fit(spark.read.parquet(f"{SF}/documents.parquet")))
    rows = [r for r in real if len(r.text or "") < 4000][:60]
    langs, scores = langid.Models(sample).predict([r.text for r in rows])
    for r, lang, score in zip(rows, langs, scores, strict=True):
        clean = " " + langid.normal(r.text or "") + " "
        if not clean.strip():
            assert (lang, score) == ("und", 0.0)
            continue
        cost = sorted((phrases(clean, s) * math.log2(len(s) + 2) / len(clean), name) for name, s in sample)
        assert lang == cost[0][1] and math.isclose(score, min(1, max(0, 1 - cost[0][0] / cost[1][0])), abs_tol=1e-12)


def test_many_letters_stay_bounded(monkeypatch):
    monkeypatch.setattr(langid, "TABLE_BYTES", 1 << 16)
    model = langid.Models((("x", "".join(chr(0x4E00 + i % 900) for i in range(5000))), ("y", "the cat sat on the mat")))
    assert all(t.nbytes <= 1 << 16 for t in model.tables) and model.predict(["\u4e00\u4e01\u4e02", "the mat"])[0] == ["x", "y"]


def test_held_out_accuracy(spark, real):
    rows = {r.doc_id: r for r in langid.op1_langid(spark, SF).collect()}
    right = n = 0
    for r in real:
        got = rows[r.doc_id]
        assert got.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= got.score <= 1
        if got.held_out:
            n, right = n + 1, right + (got.lang_pred == r.lang)
    assert right / n > 0.95


def test_odd_rows(spark, odd, odd_rows, empty):
    sample = langid.fit(odd)
    assert {lang for lang, _ in sample} <= {"en", "de", "fr"}
    rows = langid.identify(odd, sample).collect()
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert len(rows) == 12 and {1, 2, 3, 10} <= und and all(math.isfinite(r.score) for r in rows)
    assert langid.fit(empty) == () and langid.identify(empty, sample).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, ()).collect()} == {"und"}


def test_periodic_texts_take_linear_time():
    """Runs and repeated patterns, whose blocks never settle, give the phrases of one parse and don't grow with the square."""
    import time

    import numpy as np

    model = langid.Models((("x", "abracadabra alakazam aaa aab baa hokus pokus"), ("y", "the quick brown fox aaaaa zaz")))

    def straight(codes, k):
        table, own, state, n = model.tables[k], model.own[k], 0, 0
        for c in own[codes]:
            entry = int(table[state + c])
            n, state = n + (entry & 3), entry >> 2
        return n + (state != 0)

    rng = np.random.default_rng(1)
    texts = ["a" * 20_000, "abrac" * 5_000, "za" * 9_000 + "the fox " * 2_000, "".join(rng.choice(list("abz "), 30_000)), "aab " * 7_777, "a"]
    codes = [model.codes(t) for t in texts]
    assert model.phrases(codes).tolist() == [[straight(c, k) for k in range(2)] for c in codes]
    began = time.time()
    model.phrases([model.codes("a" * 5_000_000), model.codes("abra cad " * 300_000)])
    assert time.time() - began < 20


def test_tables_share_one_budget(monkeypatch):
    """Many languages of large alphabets: all tables together stay within the budget."""
    monkeypatch.setattr(langid, "TABLE_BYTES", 4 << 20)
    sample = tuple((f"l{i}", "".join(chr(0x4E00 + (i * 97 + j * j) % 900) for j in range(2_000))) for i in range(10))
    assert sum(t.nbytes for t in langid.Models(sample).tables) <= 4 << 20
