import hashlib

import numpy as np
import pytest
import xxhash

from traitloom.llm import repeats

from .conftest import SF


def brute(rows, n=100):
    """Every window of every text, in order."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        fresh = []
        for p in range(len(data) - n + 1):
            w = data[p : p + n]
            if w in seen:
                gone[p : p + n] = True
            else:
                seen.add(w)
                fresh.append(w)
        kept = bytes(b for b, g in zip(data, gone, strict=False) if not g)
        runs = int(((np.diff(np.concatenate([[0], gone.astype(int)]))) == 1).sum())
        out.append((doc_id, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def test_real(spark, real):
    want = brute([(r.doc_id, r.text) for r in real])
    assert sum(r[2] for r in want) > 0
    assert got(repeats.op6_repeats(spark, SF)) == want


def planted():
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdeé "), int(rng.integers(2, 9))))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(int(k)) for k in (14, 22, 40, 160)]
    rows = []
    for i in range(150):
        parts = [text(int(rng.integers(0, 60)))]
        for _ in range(int(rng.integers(0, 4))):
            p = passages[int(rng.integers(0, 4))]
            a = int(rng.integers(0, max(1, len(p) // 3)))
            parts += [p[a : len(p) - int(rng.integers(0, max(1, len(p) // 3)))], text(int(rng.integers(0, 9)))]
        rows.append((i * 3 % 151, "".join(parts)))
    rows += [(900, "ab" * 400), (901, "x" * 350), (902, "x" * 99), (903, "x" * 100), (904, None), (905, "")]
    rows += [(906, rows[0][1]), (907, rows[0][1] + "!")]
    return rows


@pytest.mark.parametrize("classes", [20_000, 3])
def test_planted(spark, classes):
    """Cut, nested and periodic repeats; and the way of grams with many classes."""
    rows = planted()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(repeats.cut_repeats(frame, classes=classes)) == brute(rows)


def test_long_texts_in_pieces(spark, monkeypatch):
    rows = planted()[:60]
    monkeypatch.setattr(repeats, "PIECE", 300)
    repeats._powers.cache_clear()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    result = [tuple(r) for r in _local(frame.collect())]
    repeats._powers.cache_clear()
    whole = {}
    for r in result:
        whole.setdefault((r[0], r[1]), 0)
    assert whole  # windows of a piece are those of the whole text
    windows = {(i, p + k) for i, p, more in result for k in range(more + 1)}
    assert windows == {(i, p) for i, t in rows for p in range(max(0, len(t.encode()) - 99))}


def _local(rows):
    for r in rows:
        data = r.text.encode()
        for at in range(0, max(1, len(data) - repeats.LENGTH + 1), repeats.PIECE):
            piece = data[at : at + repeats.PIECE + repeats.LENGTH - 1]
            _, _, _, first, _, more = repeats.stretches([piece])
            for f, m in zip(first.tolist(), more.tolist(), strict=True):
                yield r.doc_id, at + f, m


def test_groups_hold_all_occurrences():
    """Each window that several contexts share is in one group with all of them."""
    rng = np.random.default_rng(4)
    base = rng.integers(97, 99, repeats.WIDTH).astype(np.uint8)
    contexts = np.stack([base.copy() for _ in range(24)])
    for c in contexts:
        for at in rng.choice(repeats.WIDTH, int(rng.integers(0, 3))):
            c[at] ^= 1
    want = {}
    for shift in range(repeats.SPAN):
        groups = {}
        for i, c in enumerate(contexts):
            groups.setdefault(c[repeats.LEFT - shift : repeats.LEFT - shift + 100].tobytes(), set()).add(i)
        want |= {(shift, frozenset(g)): 1 for g in groups.values() if len(g) > 1}
    found = {(s, frozenset(map(int, m))): 1 for low, high, m in repeats.repeat_groups(contexts) for s in range(low, high + 1)}
    assert found == want


def test_odd_rows(spark, odd, odd_rows, empty):
    rows = [(r[0], r[1]) for r in odd_rows]
    once = brute(list(dict.fromkeys(rows)))
    twice = next(r for r in once if r[0] == 6)
    assert got(repeats.cut_repeats(odd)) == sorted([*once, twice], key=str)
    assert repeats.cut_repeats(empty).count() == 0


def test_texts_of_one_id_whose_hashes_share_low_bits(spark):
    """Of two texts of null doc_id whose hashes agree in 18 bits, the one that repeats nothing stays whole."""
    passage = "the passage that an earlier row holds " * 4
    seen = {}
    for i in range(100_000):
        text = f"{i} {passage if i % 2 else passage.swapcase()[::-1]}{i}"
        other = seen.setdefault(xxhash.xxh64_intdigest(text, 42) & 0x3FFFF, text)
        if other[-1] in "02468" and text[-1] in "13579" or other[-1] in "13579" and text[-1] in "02468":
            break
    rows = [(1, passage), (None, other), (None, text)]
    want = brute(rows)
    assert len({r[2] for r in want if r[0] is None}) == 2
    assert got(repeats.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string"))) == want
