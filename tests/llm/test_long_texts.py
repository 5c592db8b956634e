"""Texts of more than a megabyte, handled whole by every operator that has no such test of its own."""

import random

import pytest

from vitalair.llm import q01_fingerprints as q1
from vitalair.llm import q03_packing as q3
from vitalair.llm import q06_simhash as q6
from vitalair.llm import q07_quality as q7
from vitalair.llm import q08_decontamination as q8
from vitalair.llm import q09_urls as q9
from vitalair.llm.near_copies import near_copies


@pytest.fixture(scope="module")
def long_docs(spark):
    rng = random.Random(1)
    text = " ".join(f"word{rng.randrange(50_000)}" for _ in range(150_000))
    tail = text + " " + " ".join(f"tail{k}" for k in range(20))
    return spark.createDataFrame([(1, text), (2, text), (3, tail), (4, "short text")], "doc_id long, text string").cache(), text, tail


def test_long_texts(spark, long_docs, sf):
    df, text, tail = long_docs
    prints = {r.doc_id: r.fingerprint for r in q1.edit_fingerprints(df).collect()}
    assert prints[1] == prints[2] != prints[4]
    pieces = q3.packed_documents(df).where("doc_id = 3").agg({"length": "sum"}).first()[0]
    assert pieces == len(q3.encoder()(tail)) + 1
    assert {r.doc_id: r.component_id for r in q6.near_duplicates(df).collect()}[2] == 1
    assert {r.doc_id: r.component_id for r in near_copies(df).collect()} == {1: 1, 2: 1, 3: 1, 4: 4}
    scores = {r.doc_id: r.score for r in q7.scored(df, spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    assert scores[1] == scores[2]
    items = spark.createDataFrame([("end", " ".join(f"tail{k}" for k in range(20))), ("no", "words that occur nowhere " * 5), ("all", text)], "item_id string, text string")
    got = {r.doc_id: (r.n_items, r.n_hit) for r in q8.contamination(df, items, 60_000).collect()}
    assert got == {1: (1, 150_000), 2: (1, 150_000), 3: (2, 150_020), 4: (0, 0)}


def test_long_urls(spark):
    rows = [(k, f"http://site{k}.example.{'org' if k % 2 else 'com'}/{'de' if k % 3 else 'fr'}/" + "x/" * 200_000 * (k == 0) + f"{k}?a=1") for k in range(40)]
    got = {r.page_id: r for r in q9.judged(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert len(got) == 40 and len(got[0].path) > 400_000 and got[0].rule == "com/fr/"
