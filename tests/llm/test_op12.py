import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from vitalair.llm import q12_resampling as q


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def grams(text, longest=1):
    w = words_of(text)
    return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, longest=1, buckets=10_000, least=20, percent=10, seed=2024):
    b = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = Counter(b(g) for _, x in docs for g in grams(x, longest)), Counter(b(g) for x in target for g in grams(x, longest))
    S, T = sum(s.values()), sum(t.values())
    gain = {k: math.floor(1000 * math.log((t[k] + 1.0) * (S + buckets) / ((s[k] + 1.0) * (T + buckets)))) for k in s}
    out = []
    for i, x in docs:
        f = grams(x, longest)
        weight = sum(gain[b(g)] for g in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words_of(x))])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


@pytest.mark.parametrize("which", ["docs", "odd_docs"])
@pytest.mark.parametrize("setting", [{}, {"longest": 3, "buckets": 500, "percent": 50, "least": 2}])
def test_against_brute_force(spark, sf, which, setting, request):
    df = request.getfixturevalue(which)
    target = spark.read.parquet(f"{sf}/benchmark.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    got = sorted(map(tuple, q.resampled(df, target, **setting).collect()), key=repr)
    assert got == brute(rows, [r.text for r in target.select("text").collect()], **setting)
    assert any(r[4] for r in got)


def test_grams_are_the_plain_ones():
    for text in ("", None, " ,. ", "One two\tTHREE--four", "a b a b a", "é日本 x", "x" * 4000, "w " * 3000):
        want = Counter(zlib.crc32(g.encode()) % 97 for g in grams(text, 3))
        assert Counter(q.features(q.collapsed(text), q.patterns(3), 97).tolist()) == want


def test_the_target_is_drawn_more_often(spark):
    docs = [(i, ("alpha beta gamma " if i % 4 == 0 else "stone water cloud ") * 10) for i in range(2000)]
    target = spark.createDataFrame([("alpha beta gamma delta " * 50,)], "text string")
    drawn = [r.doc_id for r in q.resampled(spark.createDataFrame(docs, "doc_id long, text string"), target).where("rank is not null").collect()]
    assert len(drawn) == 200 and sum(i % 4 == 0 for i in drawn) > 150


def test_empty(spark, odd_docs):
    none = odd_docs.limit(0)
    assert q.resampled(none, none).count() == 0
    got = q.resampled(odd_docs, none)
    assert got.count() == odd_docs.count()
