"""The near_dedup stage against brute force on five-word shingles."""

import random
import re

from test_op6 import brute_fp

import corpus_pipeline as p
from vitalair.llm import near_copies as nc
from vitalair.llm.near_copies import near_copies


def grams(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split(" ")
    words = [w for x in words for w in re.split(r"[\t-\r]+", x) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def likeness(a, b):
    a, b = grams(a), grams(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_pairs_of_likeness_above_the_limit_go(spark, tmp_path):
    rng = random.Random(4)
    texts = []
    for k in range(40):
        words = [f"w{rng.randrange(9999)}" for _ in range(200)]
        texts.append(" ".join(words))
        for at in rng.sample(range(10, 190), 2 + k % 8):  # 2 to 9 words differ: likeness about 0.9 to 0.6
            words[at] = f"x{rng.randrange(9999)}"
        texts.append(" ".join(words))
    texts += [None, "", " \n", "one two", "one two", "one two three", "one two three four five six"]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if likeness(texts[i], texts[j]) >= 0.8]
    root = list(range(len(texts)))
    for i, j in sorted(pairs, key=lambda x: x[::-1]):
        a, b = root[i], root[j]
        root = [min(a, b) if r in (a, b) else r for r in root]
    assert sum((brute_fp(texts[i]) ^ brute_fp(texts[j])).bit_count() > 4 for i, j in pairs if texts[i]) > 10
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_copies(docs).collect()} == dict(enumerate(root))
    assert {r.doc_id for r in p.near_dedup(spark, docs, "").collect()} == set(root)


def test_crowded_keys_lose_no_link(spark):
    """Hundreds of near copies of one text, some only like each other: in blocks of few members the components stay those of all pairs."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(9999)}" for _ in range(120)]
    texts = []
    for k in range(300):
        words = list(base)
        for at in rng.sample(range(120), rng.choice((1, 2, 3, 4, 9))):
            words[at] = f"x{rng.randrange(99)}"
        texts.append(" ".join(words))
    sets = [grams(t) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    assert 2 < len(set(root)) < 290
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for room in (10**6, 1500):
        assert {r.doc_id: r.component_id for r in near_copies(docs, room=room).collect()} == dict(enumerate(root))


def bits(a, b):
    return ((a ^ b) & (2**64 - 1)).bit_count()


def _roots(n, pairs):
    root = list(range(n))
    for i, j in pairs:
        a, b = root[i], root[j]
        root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def test_fingerprints_near_each_other_meet_on_golay_keys(spark):
    """The pairs of the stage's SimHash connect just what all pairs at four bits or fewer connect, equal fingerprints too."""
    rng = random.Random(12)
    texts = []
    for k in range(60):
        words = [f"w{rng.randrange(9999)}" for _ in range(rng.choice((3, 40, 400)))]
        for _ in range(3):
            texts.append(" ".join(words))
            words[rng.randrange(len(words))] = f"x{rng.randrange(9999)}"
    sets = list({nc.set_id(s): s for s in map(nc.shingles, [*texts, ""])}.values())
    sims = [nc.majority(s) for s in sets]
    assert sims[-1] == 0 and not len(sets[-1])
    sims += sims[:5]  # other texts of the same fingerprint
    rows = [(i, 1 if i >= len(sets) else len(sets[i]), s) for i, s in enumerate(sims)]
    got = nc.fingerprint_pairs(spark.createDataFrame(rows, "fp long, size long, sim long")).collect()
    near = [(i, j) for i, _, a in rows for j, _, b in rows[:i] if rows[i][1] and rows[j][1] and bits(a, b) <= 4]
    assert all(bits(sims[r.fp], sims[r.pivot]) <= 4 and r.fp != r.pivot for r in got)
    assert len(near) > 30 and _roots(len(rows), [tuple(r) for r in got]) == _roots(len(rows), near)


def test_fingerprints_alone_link_what_the_bands_miss(spark):
    """Without any band the stage still links the pairs whose fingerprints are near, by the exact measure only."""
    rng = random.Random(13)
    texts = []
    for _ in range(30):
        words = [f"w{rng.randrange(9999)}" for _ in range(600)]
        texts.append(" ".join(words))
        words[300] = "other"
        texts.append(" ".join(words))
    sims = [nc.majority(nc.shingles(t)) for t in texts]
    want = _roots(len(texts), [(i + 1, i) for i in range(0, len(texts), 2) if bits(sims[i], sims[i + 1]) <= 4])
    assert sum(r != i for i, r in enumerate(want)) > 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = [(i, nc.set_id(nc.shingles(t)), len(nc.shingles(t)), i, [], s) for i, (t, s) in enumerate(zip(texts, sims))]
    classes = spark.createDataFrame([r[1:] for r in rows], "fp long, size long, least long, keys array<long>, sim long")
    roots = {r.node: r.root for r in nc.rooted(classes, docs, nc.SHINGLE, nc.SIMILARITY).collect()}
    own = [roots.get(r[1], r[1]) for r in rows]
    assert [own.index(o) for o in own] == want
