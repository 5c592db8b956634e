"""Operators 2, 4, 5 and 9 against brute force."""

import re
import struct

import pytest
import xxhash

from vitalair.llm import q02_licences as q2
from vitalair.llm import q04_line_dedup as q4
from vitalair.llm import q05_chats as q5
from vitalair.llm import q09_urls as q9


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


@pytest.mark.parametrize("which", ["docs", "odd_docs"])
def test_licences(which, request):
    df = request.getfixturevalue(which)
    want = []
    for r in df.collect():
        w, places, own, more, best = words(r.text), [], set(), set(), 0.0
        for p, label in q2.PHRASES.items():
            ps = p.split()
            at = [i for i in range(len(w)) if w[i : i + len(ps)] == ps]
            places += at
            own |= {label} if at else set()
        for label, notice in q2.TEMPLATES:
            t, size = set(words(notice)), len(words(notice))
            if len(t & set(w)) < 0.8 * len(t) - 1e-9:
                continue
            for i in range(len(w)):
                n = len(t & set(w[i : i + size]))
                if n >= 0.8 * len(t) - 1e-9:
                    more.add(label)
                    best = max(best, n / len(t))
        want.append((r.doc_id, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(own)), ",".join(sorted(own | more)), 1.0 if places else best))
    assert sorted(map(tuple, q2.licence_scan(df).collect()), key=repr) == sorted(want, key=repr)
    assert q2.licence_scan(df.limit(0)).count() == 0


def test_wrapped_notices_and_scattered_words(spark):
    long = "word " * 100_000
    texts = [
        "Released under\nthe MIT\nlicense.", "this source code form is subject to the terms of the mozilla public v 2.0", "released under the mit",
        "released " + "a " * 20 + "under the license", long + "\npermission to use, copy, modify, and/or\ndistribute this software for any\npurpose with or without fee is hereby granted\n" + long, None, "",
    ]
    got = {r.doc_id: (r.labels, r.score) for r in q2.licence_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {0: ("mit", 1.0), 1: ("mpl-2.0", 15 / 16), 2: ("mit", 0.8), 3: ("", 0.0), 4: ("isc", 1.0), 5: ("", 0.0), 6: ("", 0.0)}


def h64(data, seed=42):
    return xxhash.xxh64_intdigest(data, seed)


def spans_of(text):
    """(first line, last line, lines) of all chunks and windows of a text; blank lines don't count."""
    full = [(no, x) for no, x in enumerate(text.split("\n")) if re.search(r"[^ \t\n\x0B\f\r]", x)]
    h = [h64(x.encode()) for _, x in full]
    w = [len(re.split(r"[ \t\n\x0B\f\r]+", x.strip(" "))) for _, x in full]
    out, start, n = set(), 0, len(full)
    for i in range(n):
        rolled = i > 0 and h64(struct.pack("<Q", h[i]), h64(struct.pack("<Q", h[i - 1]))) % 2 == 0
        if i == n - 1 or w[i] >= 50 or w[i + 1] >= 50 or rolled:
            if i > start and sum(len(x) for _, x in full[start : i + 1]) >= 40:
                out.add((start, i))
            start = i + 1
    for i in range(n):
        j = next((j for j in range(i, n) if sum(w[i : j + 1]) >= 50), None)
        k = next((k for k in range(i, -1, -1) if sum(w[k : i + 1]) >= 50), None)
        out |= ({(i, j)} if j is not None else set()) | ({(k, i)} if k is not None else set())
    return [(full[i][0], full[j][0], tuple(x for _, x in full[i : j + 1])) for i, j in out]


def brute_dedup(rows):
    """(doc_id, text) of rows after the removal of repeated chunks and windows."""
    home, count, first = {}, {}, {}
    own = [spans_of(r.text) if r.doc_id is not None and r.text is not None else [] for r in rows]
    for r, spans in zip(rows, own):
        for a, b, body in spans:
            home[body] = min(home.get(body, r.doc_id), r.doc_id)
            count[body] = count.get(body, 0) + 1
            key = r.doc_id, r.text, body
            first[key] = min(first.get(key, (a, b)), (a, b))
    want = []
    for r, spans in zip(rows, own):
        gone = set()
        for a, b, body in spans:
            if count[body] > 1 and (home[body] != r.doc_id or first[r.doc_id, r.text, body][1] < a):
                gone |= set(range(a, b + 1))
        want.append((r.doc_id, "\n".join(x for no, x in enumerate(r.text.split("\n")) if no not in gone) if gone else r.text))
    return want


@pytest.mark.parametrize("which", ["docs", "odd_docs"])
def test_line_dedup(which, request):
    df = request.getfixturevalue(which)
    want = brute_dedup(df.collect())
    got = q4.deduplicated(df)
    assert got.columns == [*df.columns, "n_removed"]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(want, key=repr)
    # With hashes of few bits, passages that differ meet under one hash and are told apart by their bytes.
    got = q4.deduplicated(df, bits=12)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert q4.deduplicated(df.limit(0)).count() == 0


def test_line_dedup_of_very_long_texts(spark):
    """Two equal texts of 200,000 lines, in time linear in the lines."""
    text = "\n".join(f"line {i} of a text that is very long, about {i * 7}" for i in range(200_000))
    rows = spark.createDataFrame([(1, text, 5), (2, text, 5), (3, "a short text", 5)], "doc_id long, text string, n_removed int")
    got = {r.doc_id: (r.text, r.n_removed) for r in q4.deduplicated(rows).collect()}
    assert got == {1: (text, 0), 2: ("", 200_000), 3: ("a short text", 0)}


def test_shared_passages_go_and_shifts_do_not_matter(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    block = [f"line {i} of a passage that some documents share" for i in range(40)]
    texts = [f"opening {k} of this text\n{passage}\nclosing {k}\n" + "\n".join([f"inserted {j}" for j in range(k)] + block) for k in range(5)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in q4.deduplicated(df).collect()}
    assert got[0] == texts[0] and all(passage not in got[k] for k in range(1, 5))
    assert all(sum(b in got[k] for b in block) < len(block) - 2 and f"opening {k}" in got[k] for k in range(1, 5))


def test_chats(spark):
    rows = [
        (1, 0, "user", "First point here.\nSecond  point."), (1, 1, "assistant", "> first POINT here.\nMy answer."), (1, 2, "user", ">> First point here.\n> My answer.\nThanks"),
        (1, 3, "user", "no quote"), (1, 4, "assistant", "> nobody said this\nok"), (2, 0, "user", "> Thanks\nfrom elsewhere"), (2, 0, "user", "> Thanks\nfrom elsewhere"),
        (3, 0, "user", None), (3, 1, "assistant", ""), (None, 2, "user", "> Thanks"), (4, None, "user", "x"),
    ]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, level int, h long")
    got = sorted(map(tuple, q5.reply_ordered(df).collect()), key=repr)
    want = [
        (1, 0, "user", "First point here.\nSecond  point.", None, None, 0, 0, 0), (1, 1, "assistant", "My answer.", 1, 0, 0, 1, 1), (1, 2, "user", "Thanks", 1, 1, 0, 2, 2),
        (1, 3, "user", "no quote", None, None, 3, 0, 0), (1, 4, "assistant", "> nobody said this\nok", None, None, 4, 0, 0), (2, 0, "user", "from elsewhere", 1, 2, 0, 0, 1), (2, 0, "user", "from elsewhere", 1, 2, 0, 0, 1),
        (3, 0, "user", "", None, None, 0, 0, 0), (3, 1, "assistant", "", None, None, 1, 0, 0), (None, 2, "user", "> Thanks", None, None, 2, 0, 0), (4, None, "user", "x", None, None, None, 0, 0),
    ]
    places = {(1, 1): 1, (1, 2): 2}  # second and third of the thread that begins at turn 0; the rows of (2, 0) are two places of one thread
    twice = iter((0, 1))
    want = [(*r[:8], next(twice) if r[0] == 2 else places.get(r[:2], 0), r[8]) for r in sorted(want, key=repr)]
    assert got == sorted(want, key=repr)
    assert q5.reply_ordered(df.limit(0)).count() == 0


def test_long_reply_chain(spark):
    rows = [(7, t, "user", (f"> say {t - 1}\n" if t else "") + f"say {t}") for t in range(20)]
    got = {r.turn: (r.root_turn, r.depth) for r in q5.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got == {t: (0, t) for t in range(20)}


def brute_url(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for v, r in q9.RULES:
        h, p = r.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(r) > len(best[1])):
            best = v, r
    return host, path, best


def test_urls(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    odd = [None, "", "nothing", "http://ORG/", "http://a.Example.ORG/es/1", "http://example.org/en/12?x", "http://example.org", "x://y://z/p", "http://b.com/fr", "http://COM/de/#f", "http://xorg/", "http://É.com/fr/\n?q", "//host/path"]
    df = pages.unionByName(spark.createDataFrame([(10_000 + i, u) for i, u in enumerate(odd * 2)], "page_id long, url string"))
    df = df.selectExpr("*", "'clash' AS host", "1 AS label", "'s' AS suffix")
    got = {(r.page_id): r for r in q9.judged(df).collect()}
    assert len(got) == df.count()
    for r in df.collect():
        host, path, best = brute_url(r.url)
        g = got[r.page_id]
        assert (g.host, g.path, g.rule) == (host, path, best and best[1])
        assert g.verdict == best[0] if best else g.verdict in ("allow", "block")
    assert q9.judged(df.limit(0)).count() == 0


def test_url_trees_learn(spark):
    """Held-out accuracy on labels that a rule gives: the trees see no rule, only lexical features."""
    rows = [(i, f"http://site{i}.example.{'com' if i % 2 else 'org'}/{'de' if i % 3 else 'fr'}/{i}?a={i % 7}") for i in range(900)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    rules = [("block", "com/de/1"), ("block", "com/de/2"), ("block", "com/de/3"), ("allow", "com/fr/1"), ("allow", "com/fr/2"), ("allow", "org/fr/1"), ("allow", "org/de/1")]
    free = [r for r in q9.judged(df, rules).collect() if r.rule is None]
    right = sum((r.verdict == "block") == (".com" in r.host and r.path.startswith("/de")) for r in free)
    assert len(free) > 300 and right / len(free) > 0.7
