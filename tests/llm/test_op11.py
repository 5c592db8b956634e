import random
import re
import zlib
from collections import Counter

import pytest

from vitalair.llm import q11_variants as q


def brute_vocabulary(rows, least=5):
    out = Counter()
    for i, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            k = h % len(low)
            word = low[:k] + low[k + 1 :] if h % 199 == 0 else low
            if len(word) >= 6:
                out[word] += 1
    return {w: n for w, n in out.items() if n >= least}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, factor=5):
    form = {}
    for w, n in words.items():
        own = [v for v in words if v != w and near(w, v)]
        best = min(own, key=lambda v: (-words[v], v), default=None)
        form[w] = (best if best and words[best] >= factor * n else None, len(own))
    out = []
    for w, n in words.items():
        root = w
        while form[root][0]:
            root = form[root][0]
        f = form[w][0]
        out.append((w, f, root, n, form[w][1], words[f] if f else None))
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("which", ["docs", "odd_docs"])
def test_against_brute_force(which, request):
    df = request.getfixturevalue(which)
    words = brute_vocabulary([tuple(r) for r in df.select("doc_id", "text").collect()])
    if which == "docs":  # all pairs of a large vocabulary are slow in plain Python: the sixth words and what is near them
        words = dict(sorted(words.items())[:700])
        got = rows(q.variants(df.sparkSession.createDataFrame(list(words.items()), "word string, n long")))
        vocabulary = {r.word: r.n for r in q.vocabulary(df).collect()}
        assert vocabulary == brute_vocabulary([tuple(r) for r in df.select("doc_id", "text").collect()])
    else:
        got = rows(q.spelling_variants(df))
    assert got == brute(words)


def test_every_edit_of_every_length_meets(spark):
    rng = random.Random(3)
    words = {}
    for size in range(6, 15):
        for _ in range(12):
            w = "".join(rng.choice("abcdeé") for _ in range(size))
            words[w] = rng.randint(5, 4000)
            for k in range(size):
                for v in (w[:k] + w[k + 1 :], w[:k] + "z" + w[k:], w[:k] + "y" + w[k + 1 :]):
                    if len(v) >= 6 and rng.random() < 0.3:
                        words[v] = rng.randint(5, 400)
            words[w + "ß"] = 9
    assert rows(q.variants(spark.createDataFrame(list(words.items()), "word string, n long"))) == brute(words)


def test_repeated_letters_and_one_hot_prefix(spark):
    words = {"a" * n: 5 * 6 ** (n % 4) for n in range(6, 12)} | {f"commonprefix{i:03d}": 5 + i for i in range(150)}
    assert rows(q.variants(spark.createDataFrame(list(words.items()), "word string, n long"))) == brute(words)


def test_chains_reach_the_last_form_and_ties_take_the_least(spark):
    words = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aabbbb": 3125, "zzzzzz": 5, "zzzzzy": 50, "yzzzzz": 50, "lonely": 7}
    got = {r[0]: r for r in rows(q.variants(spark.createDataFrame(list(words.items()), "word string, n long")))}
    assert got["aaaaaa"][1:3] == ("aaaaab", "aabbbb") and got["zzzzzz"][1] == "yzzzzz" and got["lonely"][1:3] == (None, "lonely")
    assert sorted(got.values()) == brute(words)


def test_empty(spark, odd_docs):
    assert q.spelling_variants(odd_docs.limit(0)).count() == 0
    assert q.spelling_variants(odd_docs.where("text is null")).count() == 0
