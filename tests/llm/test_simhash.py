import re

import numpy as np
import pytest
import xxhash

from traitloom.llm import simhash

from .conftest import SF

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]), 42) for i in range(max(1, len(words) - n + 1))] if words else []
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def components(pairs, distance=4):
    """(doc_id, fp) rows to (doc_id, hex, least id)."""
    fps = sorted({f for _, f in pairs})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    least = {}
    for d, f in pairs:
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    return sorted(((d, f"{f:016x}", least.get(find(f))) for d, f in pairs), key=str)


def test_real(spark, real):
    got = sorted((tuple(r) for r in simhash.op2_simhash(spark, SF).collect()), key=str)
    want = components([(r.doc_id, fingerprint(r.text)) for r in real])
    assert got == want and len({r[2] for r in want}) < len(want)


def test_odd_rows(spark, odd, odd_rows, empty):
    got = simhash.near_dedup(odd).collect()
    want = components([(r[0], fingerprint(r[1])) for r in odd_rows])
    assert sorted(((r.doc_id, f"{r.fp % (1 << 64):016x}", r.component_id) for r in got), key=str) == want
    assert simhash.near_dedup(empty).count() == 0


@pytest.mark.parametrize("cell", [4096, 8])
def test_dense_groups(spark, cell):
    """Clouds around centres, chains, and cells that are over the limit and go to the finer grid."""
    rng = np.random.default_rng(5)
    fps = set()
    for _ in range(12):
        centre = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        for _ in range(40):
            x = centre
            for b in rng.choice(64, int(rng.integers(0, 7)), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
        chain = centre ^ (1 << 40)
        for b in range(0, 60, 4):
            chain ^= 0xF << b
            fps.add(chain)
    fps = sorted(fps)
    frame = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    n_links = 0
    for r in simhash.near_links(frame, cell).collect():
        a, b = r.a % (1 << 64), r.b % (1 << 64)
        assert (a ^ b).bit_count() <= 4
        n_links += 1
        root[find(a)] = find(b)
    groups = {}
    for f in fps:
        groups.setdefault(find(f), set()).add(f)
    want = {}
    for i, (f, h, least) in enumerate(components([(i, f) for i, f in enumerate(fps)])):
        want.setdefault(least, set()).add(int(h, 16))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_grid_is_complete():
    """Any two fingerprints within four bits share a cell of the first grid, and of the finer one inside it."""
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = int(rng.integers(0, 1 << 63))
        b = a
        for bit in rng.choice(63, 4, replace=False):
            b ^= 1 << int(bit)
        pa, pb = (int(simhash.packed_counts(np.array([x], np.uint64))[0]) for x in (a, b))
        shared = [m for m in simhash.FIRST if pa & m == pb & m]
        assert shared and all(any(pa & f == pb & f for f in simhash.finer(m)) for m in shared)
        assert int(simhash.manhattan(np.array([a], np.uint64), np.array([b], np.uint64))[0]) <= 4
