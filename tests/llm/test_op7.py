import zlib

import numpy as np

from vitalair.llm import q07_quality as q


def test_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r.doc_id: r for r in q.scored(d, labels).collect()}
    assert len(got) == d.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    known = [(got[r.doc_id], r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    right = np.mean([g.predicted == y for g, y in known])
    good, bad = [g.score for g, y in known if y], [g.score for g, y in known if not y]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    print("held-out accuracy, auc:", right, auc, len(known))
    assert right > 0.9 and auc > 0.93


def test_odd_rows_and_missing_labels(odd_docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = q.scored(odd_docs, none).collect()
    assert len(got) == odd_docs.count() and all(r.predicted == 1 and 0 <= r.score <= 1 for r in got)
    some = spark.createDataFrame([(3, 1, 0), (9, 1, 0), (2, 0, 0), (5, 0, 0), (8, 0, 0), (None, 0, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    got = q.scored(odd_docs, some).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert q.scored(odd_docs.limit(0), some).count() == 0


def test_passing_rows_are_those_of_the_scores(docs, odd_docs, spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    for df in (docs, odd_docs):
        want = sorted((repr(r.doc_id) for r in q.scored(df, labels).where("predicted = 1").collect()))
        got = q.passing(df, labels)
        assert got.columns == df.columns and sorted(repr(r.doc_id) for r in got.collect()) == want
