import re

import numpy as np
import pytest
import xxhash

from vitalair.llm import golay
from vitalair.llm import q06_simhash as q
from vitalair.llm.components import components


def brute_fp(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("which", ["docs", "odd_docs"])
def test_against_brute_force(which, request):
    df = request.getfixturevalue(which)
    rows = df.select("doc_id", "text").collect()
    fps = [brute_fp(r.text) for r in rows]
    comp = brute_components(fps)
    least = {}
    for c, r in zip(comp, rows):
        if r.doc_id is not None:
            least[c] = min(least.get(c, r.doc_id), r.doc_id)
    want = [(r.doc_id, f"{f:016x}", least.get(c)) for r, f, c in zip(rows, fps, comp)]
    assert sorted(map(tuple, q.near_duplicates(df).collect()), key=repr) == sorted(want, key=repr)


def test_golay_is_perfect():
    words = np.arange(1 << 12, dtype=np.uint32) << 11
    heads, _ = golay._tables()
    codewords = words | heads
    rng = np.random.default_rng(0)
    for _ in range(30):
        e = sum(1 << int(b) for b in rng.choice(23, 3, replace=False))
        assert (golay.index(codewords ^ np.uint32(e)) == np.arange(1 << 12)).all()


def test_four_bits_always_share_a_key():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**63, 3000, dtype=np.int64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 5), replace=False)) for _ in a], dtype=np.uint64).view(np.int64)
    for x, y in zip(q.fuzzy_keys(a), q.fuzzy_keys(a ^ flips)):
        assert (set(x) - {-1}) & (set(y) - {-1})


def test_long_runs_are_linked_through_shared_neighbours(spark, monkeypatch):
    rng = np.random.default_rng(9)
    base = rng.integers(0, 2**62, 4)
    fps = sorted({int(b) ^ sum(1 << int(k) for k in rng.choice(60, rng.integers(0, 5), replace=False)) for b in base for _ in range(40)})
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    comp = brute_components(fps)
    sizes = sorted(np.bincount(np.unique(comp, return_inverse=True)[1]).tolist())
    # short runs of one key go by the direct way; with the limit at 2 the same pairs come through words within two bits
    keys = q.fuzzy_keys(np.array(fps, dtype=np.int64))
    import pandas as pd

    flat = sorted((k, f) for f, row in zip(fps, keys) for k in row if k >= 0)
    monkeypatch.setattr(q, "RUN", 2)
    crowd = {int(a) for out in q._linked(iter([pd.DataFrame(flat, columns=["key", "fp"])])) for a, b in zip(out["a"], out["b"]) if pd.isna(b)}
    assert len(crowd) > 50
    around = {}
    for out in q._ball(iter([pd.DataFrame({"fp": sorted(crowd)})])):
        for z, f in zip(out["z"], out["fp"]):
            around.setdefault(z, []).append(f)
    pairs = [(f, min(v)) for v in around.values() for f in v if f != min(v)]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 4 for a, b in pairs)
    direct = [tuple(map(int, r)) for r in q.links(df).collect()]
    for found in (direct, direct + pairs):
        roots = {r.node: r.root for r in components(spark.createDataFrame(found, "a long, b long"), "a", "b").collect()}
        got = sorted(np.unique([roots.get(f, f) for f in fps], return_counts=True)[1].tolist())
        assert got == sizes


def test_chains_and_hubs(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 60)}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0
