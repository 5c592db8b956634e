import hashlib
import re

import pytest

from vitalair.llm import q08_decontamination as q


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(rows, items):
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 12) if w else 0):
            wins.setdefault(tuple(w[k : k + 13]), set()).add(str(i))
    sizes = {len(w) for w in wins}
    out = []
    for d, t in rows:
        w = words(t)
        hit, found = [False] * len(w), set()
        for k in range(len(w)):
            for n in sizes:
                own = wins.get(tuple(w[k : k + n])) if k + n <= len(w) else None
                if own:
                    found |= own
                    hit[k : k + n] = [True] * n
        out.append((d, len(w), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def items(spark, sf, docs):
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    some = docs.orderBy("doc_id").limit(9).collect()
    bench += [(1000 + k, " ".join((r.text or "").split()[:40])) for k, r in enumerate(some[:5])]
    bench += [(2000, "the of"), (2001, None), (2002, "..."), (2003, "the"), (2003, "alpha x beta1"), (2004, " ".join((some[7].text or "").split()[3:16]))]
    return [*bench, (3000, " ".join(((some[8].text or "") + " ").split() * 8))]  # more words than a small block


@pytest.mark.parametrize("block_words", [10**6, 500])
@pytest.mark.parametrize("which", ["docs", "odd_docs"])
def test_against_brute_force(which, block_words, items, spark, request):
    df = request.getfixturevalue(which)
    bench = spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, row string")
    want = brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], items)
    assert sorted(map(tuple, q.contamination(df, bench, block_words).collect()), key=repr) == want
    # Rows of docs, each by its own text: brute force on one text at a time.
    kept = sorted(((r.doc_id, r.text) for r in df.collect() if not brute([(r.doc_id, r.text)], items)[0][5]), key=repr)
    got = q.clean_documents(df, bench, block_words)
    assert got.columns == df.columns and sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == kept


def test_empty_tables(docs, spark, items):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.contaminated for r in q.contamination(docs, none).collect()} == {False}
    assert q.contamination(docs.limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0
