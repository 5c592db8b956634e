import hashlib

import numpy as np
import pytest

from vitalair.llm import edit_embedding as ee
from vitalair.llm.q01_fingerprints import edit_fingerprints


@pytest.mark.parametrize("which", ["docs", "odd_docs"])
def test_against_brute_force(which, request):
    df = request.getfixturevalue(which)
    rows = sorted(((r.doc_id, r.text or "", r.text is not None) for r in df.collect()), key=lambda r: (-(r[0] if r[0] is not None else -(10**18)), r[2], r[1]))
    want = []
    for k, (i, t, _) in enumerate(rows):
        nxt, n = rows[(k + 1) % len(rows)][1], len(t) // 2
        e = t[: len(t) - n] + nxt[:n]
        a, b, c = ee.fingerprint_batch([t]), ee.fingerprint_batch([e]), ee.fingerprint_batch([nxt])
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), a.tobytes().hex(), b.tobytes().hex(), float(ee.likeness(a, b)[0]), float(ee.likeness(a, c)[0])))
    got = sorted(map(tuple, edit_fingerprints(df).collect()), key=repr)
    assert got == sorted(want, key=repr)


def test_edits_change_little_and_batches_do_not_matter():
    rng = np.random.default_rng(1)
    t = "".join(rng.choice(list("abcdefghij klmnop"), 5000))
    few = list(t)
    for p in rng.integers(0, 4900, 10):
        few[p] = "Z"
        del few[p + 3]
    other = "".join(rng.choice(list("abcdefghij klmnop"), 5000))
    p = ee.fingerprint_batch([t, "".join(few), other, "", t])
    assert ee.likeness(p[:1], p[1:2])[0] > 0.75 and ee.likeness(p[:1], p[2:3])[0] < 0.1
    assert (p[0] == p[4]).all() and not p[3].any() and (ee.fingerprint_batch([t])[0] == p[0]).all()


def test_empty_table(docs):
    assert edit_fingerprints(docs.limit(0)).count() == 0


def test_near_pairs_find_copies_with_edits(spark):
    rng = np.random.default_rng(2)
    base = ["".join(rng.choice(list("abcdefgh ijklmnop"), 3000)) for _ in range(12)]
    texts = base + [b[:1500] + "edit" + b[1500:] for b in base[:6]] + base[:3] + [None]
    got = ee.near_pairs(spark.createDataFrame([(t,) for t in texts], "text string"), threshold=0.7).collect()
    assert len(got) == 6 and all(r.likeness >= 0.7 for r in got)


def test_crowded_buckets_lose_no_link(spark, monkeypatch):
    rng = np.random.default_rng(5)
    letters = list("abcdefgh ijklmnop")
    base = ["".join(rng.choice(letters, 400)) for _ in range(3)]
    texts = [b[:200] + "".join(rng.choice(letters, k % 40)) + b[200:] for b in base for k in range(60)] + ["", None]
    fps = sorted({p.tobytes().hex() for p in ee.fingerprint_batch([t or "" for t in texts])})
    cells = ee.from_hex(fps)
    keys = ee.band_keys().func(fps)
    near = lambda i, j: ee.likeness(cells[i : i + 1], cells[j : j + 1])[0] >= 0.8 and (keys[i] == keys[j]).any()
    want = _groups(fps, [(fps[i], fps[j]) for i in range(len(fps)) for j in range(i) if near(i, j)])
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for run in (2000, 7):  # whole buckets, and buckets in blocks
        monkeypatch.setattr(ee, "RUN", run)
        got = ee.near_pairs(df).collect()
        assert all(r.likeness >= 0.8 and r.fingerprint_a < r.fingerprint_b for r in got)
        assert _groups(fps, [(r.fingerprint_a, r.fingerprint_b) for r in got]) == want
    assert ee.near_pairs(df.limit(0)).count() == 0


def _plain_mix(x):
    for shift, factor in ((30, ee._M[1]), (27, ee._M[2])):
        x = (x ^ (x >> shift)) * int(factor) % 2**64
    return x ^ (x >> 31)


def plain_fingerprint(text):
    """The embedding by a plain loop: anchors, one walk after the other, the least rank of each cell."""
    m0, m1, m2 = (int(m) for m in ee._M)
    codes = [(ord(c) + 1) * m0 % 2**64 for c in text + "\0" * 2 * ee.GRAM]
    grams = []
    for i in range(len(text)):
        g = 0
        for k in range(ee.GRAM):
            g = (g * m1 + codes[i + k]) % 2**64
        grams.append(_plain_mix(g))
    begins = [i for i in range(len(text)) if i == 0 or grams[i] % ee.ANCHOR == 0]
    best = [None] * ee.CELLS
    for begin, stop in zip(begins, [*begins[1:], len(text)]):
        for a in range(begin, stop, ee.LONGEST):
            seed, at, j = m0 if a == 0 else grams[a], a, 0
            while at < min(stop, a + ee.LONGEST):
                here = codes[at] ^ ((j + 1) * m2 % 2**64)
                e = _plain_mix((here + seed) % 2**64)
                cell, rank = e % ee.CELLS, e >> 7
                best[cell] = rank if best[cell] is None else min(best[cell], rank)
                at, j = at + 1 + (here * m1 % 2**64 >> 63), j + 1
    out = []
    for i in range(ee.CELLS):
        far = next((d for d in range(ee.CELLS) if best[(i + d) % ee.CELLS] is not None), None)
        rank = None if far is None else best[(i + far) % ee.CELLS]
        out.append(0 if far is None else _plain_mix((rank + (m0 if far == 0 else far * m2)) % 2**64) & 255)
    return bytes(out)


def test_the_walk_against_a_plain_loop():
    rng = np.random.default_rng(8)
    texts = ["", "a", "the of", "日本語 😀" * 30, "x" * 5000, "".join(rng.choice(list("abcdefgh ijkl\n"), 4000))]
    assert [p.tobytes() for p in ee.fingerprint_batch(texts)] == [plain_fingerprint(t) for t in texts]


def test_recall_on_planted_edits(spark):
    """Of all pairs whose fingerprints are alike at 0.8 or more, found over all pairs, the bands' links hold at least 0.9 together."""
    rng = np.random.default_rng(4)
    letters, texts = list("abcdefgh ijklmnop"), []
    for _ in range(150):
        base = list(rng.choice(letters, 1500))
        texts.append("".join(base))
        for p in rng.integers(0, 1400, int(rng.integers(2, 30))):
            base[p] = str(rng.choice(letters))
            if rng.random() < 0.3:
                del base[p + 5]
        texts.append("".join(base))
    cells = ee.fingerprint_batch(texts)
    hexes = ee.to_hex(cells)
    wanted = [(hexes[i], hexes[j]) for i in range(len(texts)) for j in range(i) if ee.likeness(cells[i : i + 1], cells[j : j + 1])[0] >= 0.8]
    links = ee.near_pairs(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    group = {fp: k for k, own in enumerate(_groups(sorted(set(hexes)), [(r.fingerprint_a, r.fingerprint_b) for r in links])) for fp in own}
    found = sum(group[a] == group[b] for a, b in wanted)
    assert len(wanted) > 50 and found / len(wanted) >= 0.9


def test_groups_of_documents(spark):
    rng = np.random.default_rng(6)
    base = ["".join(rng.choice(list("abcdefgh ijklmnop"), 2000)) for _ in range(4)]
    rows = [(10 * k + i, (b[: 500 * i] + "edit" + b[500 * i :]) if i else b) for k, b in enumerate(base) for i in range(3)] + [(None, base[0]), (100, None), (101, ""), (None, "alone")]
    prints = edit_fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {(r.doc_id, r.n_chars): r.near_group for r in ee.with_groups(prints).collect()}
    texts = sorted({t or "" for _, t in rows})
    cells = ee.fingerprint_batch(texts)
    keys = ee.band_keys().func(ee.to_hex(cells))
    near = [(texts[i], texts[j]) for i in range(len(texts)) for j in range(i) if ee.likeness(cells[i : i + 1], cells[j : j + 1])[0] >= 0.8 and (keys[i] == keys[j]).any()]
    want = {}
    for own in _groups(texts, near):
        ids = [i for i, t in rows if (t or "") in own and i is not None]
        want |= {(i, len(t or "")): min(ids, default=None) for i, t in rows if (t or "") in own}
    assert got == want and len(near) >= 4


def _groups(nodes, links):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        root[top(a)] = top(b)
    out = {}
    for n in nodes:
        out.setdefault(top(n), set()).add(n)
    return sorted(map(sorted, out.values()))
