"""The corpus pipeline against brute force, stage by stage on what the stage before really kept."""

import pytest
from test_native import brute_dedup
from test_near_copies import grams
from test_op8 import brute

import corpus_pipeline as p
from vitalair.llm import q03_packing as q3
from vitalair.llm import q07_quality as q7

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, sf, docs, odd_docs, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("pipeline"))
    docs.select(*COLUMNS).unionByName(odd_docs.select((odd_docs.doc_id + 10**6).alias("doc_id"), *COLUMNS[1:])).write.parquet(f"{out}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{t}.parquet").write.parquet(f"{out}/{t}.parquet")
    return out


def pairs(rows):
    return sorted(((r.doc_id, r.text) for r in rows), key=repr)


def test_stages(spark, folder, tmp_path):
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in p.STAGES:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs.collect(), spark.read.parquet(f"{tmp_path}/{name}")
        if name != "pack":
            assert sorted(docs.columns) == sorted(COLUMNS)
        kept[name] = (before, docs.collect())
    before, after = kept["quality"]
    model = q7.learn(q7.feature_table(spark.read.parquet(f"{folder}/documents.parquet")), spark.read.parquet(f"{folder}/labels.parquet"))
    vectors = spark.createDataFrame([(i, list(map(float, q7.features(r.text)))) for i, r in enumerate(before)], "i int, x array<double>")
    good = {r.i for r in vectors.where(q7.score_of(vectors.x, model) >= q7.CUT).collect()}
    assert pairs(after) == pairs(r for i, r in enumerate(before) if i in good)
    before, after = kept["line_dedup"]
    assert pairs(after) == sorted(brute_dedup(before), key=repr)
    assert all(r.n_chars == len(r.text or "") for r in after)
    before, after = kept["near_dedup"]
    sets = [grams(r.text) for r in before]
    comp = list(range(len(before)))
    for i in range(len(before)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] == sets[j] or both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                low, high = sorted((comp[i], comp[j]))
                comp = [low if c == high else c for c in comp]
    least = {}
    for c, r in zip(comp, before):
        if r.doc_id is not None:
            least[c] = min(least.get(c, r.doc_id), r.doc_id)
    want = {(r.doc_id, tuple(sorted(s))) for c, r, s in zip(comp, before, sets) if least.get(c) == r.doc_id}
    assert sorted(((r.doc_id, tuple(sorted(grams(r.text)))) for r in after), key=repr) == sorted(want, key=repr)
    assert set(pairs(after)) <= set(pairs(before))
    before, after = kept["decontaminate"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert pairs(after) == pairs(r for r in before if not brute([(r.doc_id, r.text)], items)[0][5])
    before, after = kept["pack"]
    encode, want, got = q3.encoder(), [], []
    for r in before:
        want += [(r.doc_id, k, s, n) for k, (s, n) in enumerate(q3.cut(len(encode(r.text or "")) + 1, 2048))]
    got = [(r.doc_id, r.piece, r.start, r.length) for r in after]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    places = {}
    for r in after:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048


def test_empty_documents(spark, folder, tmp_path):
    none = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in p.STAGES:
        assert stage(spark, none, folder).count() == 0
