"""op4: short multi-line passages of over 50 words in differing contexts."""

import random

from vitalair.llm import q04_line_dedup as q4


def test_whole_short_passages_go(spark):
    rng = random.Random(8)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    rows, want = [], []
    for k in range(60):
        n = 2 + k % 7
        passage = [words(60 // n + 1) for _ in range(n)]
        for side in range(2):
            own = [[words(9) for _ in range(rng.randint(1, 4))] for _ in range(2)]
            rows.append((len(rows), "\n".join(own[0] + passage + own[1])))
            want.append("\n".join(own[0] + ([] if side else passage) + own[1]))
    got = {r.doc_id: r.text for r in q4.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(enumerate(want))


def test_the_first_of_overlapping_repeats_stays(spark):
    line = " ".join(f"w{i}" for i in range(20))
    got = q4.deduplicated(spark.createDataFrame([(1, "\n".join([line] * 30))], "doc_id long, text string")).first().text
    assert 3 <= got.count(line) <= 5
