"""Trees and networks against a majority vote and a brute-force split."""

import random

from vitalair.operators import models


def test_tree_finds_the_best_split(spark):
    rng = random.Random(6)
    rows = [(i, rng.randrange(10), rng.randrange(10), 0) for i in range(800)]
    rows = [(i, a, b, int(a >= 6) if rng.random() > 0.1 else int(a < 6)) for i, a, b, _ in rows]
    df = spark.createDataFrame(rows, "id long, a int, b int, label int")
    got = models.scored(models.fit_tree(df, ["a", "b"], "label"), df).collect()
    name = next(c for c in got[0].asDict() if "predict" in c)
    right = sum(float(r[name]) == float(r["label"]) for r in got) / len(got)
    majority = max(sum(r[3] == k for r in rows) for k in (0, 1)) / len(rows)
    split = max(max(sum((r[f] >= cut) == bool(r[3]) for r in rows), sum((r[f] < cut) == bool(r[3]) for r in rows)) for f in (1, 2) for cut in range(10)) / len(rows)
    assert right >= split - 0.01 and right > majority + 0.2


def test_network_beats_the_majority(spark):
    rng = random.Random(7)
    rows = [(i, x := rng.random(), rng.random(), float(x > 0.6), float(x <= 0.6)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, a double, b double, yes double, no double")
    got = models.scored(models.fit_network(df, ["a", "b"], ["no", "yes"], [4], epochs=60), df).collect()
    name = next(c for c in got[0].asDict() if "predict" in c)
    right = sum(float(r[name]) == r["yes"] for r in got) / len(got)
    assert right > 0.9


def subtrees(tree):
    """Every pruning of a tree."""
    yield models.Node(tree.counts)
    if tree.feature is not None:
        for a in subtrees(tree.left):
            for b in subtrees(tree.right):
                yield tree._replace(left=a, right=b)


def table(spark, n=600, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.randrange(8), rng.choice([None, 0.5, 1.5, 2.5]), rng.random()
        label = (a >= 4) + (b is not None and b > 1)
        rows.append((i, a, b, c, float(label if rng.random() > 0.2 else rng.randrange(3))))
    return rows, spark.createDataFrame(rows, "id long, a int, b double, c double, label double")


def test_pruning_is_the_best_of_all_subtrees(spark):
    rows, df = table(spark)
    tree = models.grown(df.fillna(9.0, ["b"]), ["a", "b", "c"], "label", depth=6)
    every = list(subtrees(tree))
    assert len(every) >= 10 and sum(tree.counts) == len(rows)
    found = models.costs(tree)
    assert found == sorted(found) and len(found) > 2
    for cost in [0.0, *found, *[(x + y) / 2 for x, y in zip(found, found[1:])], found[-1] + 1]:
        least = min(models.leaf_risk(t) + cost * models.leaves(t) for t in every)
        smallest = min(models.leaves(t) for t in every if models.leaf_risk(t) + cost * models.leaves(t) <= least + 1e-6)
        got = models.pruned(tree, cost)
        assert abs(models.leaf_risk(got) + cost * models.leaves(got) - least) < 1e-6 and models.leaves(got) == smallest
    assert models.leaves(models.pruned(tree, found[-1])) == 1


def test_scores_follow_the_tree(spark):
    rows, df = table(spark)
    df = df.fillna(9.0, ["b"])
    tree = models.grown(df, ["a", "b", "c"], "label", depth=4)

    def walk(t, r):
        while t.feature is not None:
            t = t.left if float(r[t.feature]) <= t.threshold else t.right
        return t.counts.index(max(t.counts))

    got = df.withColumn("p", models.tree_class(tree)).collect()
    assert all(r.p == walk(tree, r) for r in got) and sum(r.p != r.label for r in got) == models.leaf_risk(tree)


def test_cross_validation_counts_what_is_held_out(spark):
    from pyspark.sql import functions as F

    rows, df = table(spark)
    df = df.fillna(9.0, ["b"])
    scores = dict(models.cross_validated(df, ["a", "b"], "label", "id", [0.0, 0.01, 10.0], folds=3, depth=3))
    wrong = 0
    for k in range(3):
        fold = F.pmod(F.xxhash64("id"), F.lit(3))
        own, rest = [r.label for r in df.where(fold == k).collect()], [r.label for r in df.where(fold != k).collect()]
        wrong += sum(x != max(sorted(set(rest)), key=rest.count) for x in own)
    assert scores[10.0] == wrong / len(rows)  # pruned to the root: the most frequent class of the other folds
    assert scores[0.01] < scores[10.0] - 0.2
    best = models.fit_pruned(df, ["a", "b", "c"], "label", "id", (0.01, 10.0), depth=4)
    assert 1 < models.leaves(best) < 16


def test_pruned_tree_counts_visits_once(spark, sf, monkeypatch):
    from vitalair.operators import warehouse
    from vitalair.plans import model_queries

    calls, count = [], warehouse.before_and_after
    monkeypatch.setattr(warehouse, "before_and_after", lambda e, *a: calls.append(1) or count(e, *a))
    got = model_queries.ml_pruned_tree(spark, sf)
    want = count(model_queries.views.encounters(spark, sf)).selectExpr("encounter_num", "pre_ed", "cast(least(post_ed, 3) as double) post_bin")
    assert len(calls) == 1 and got.columns == ["encounter_num", "pre_ed", "pm", "PROMO", "SMALL", "post_bin", "predicted"]
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
