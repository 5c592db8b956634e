import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalair.llm import minimal_hash as mh
from vitalair.llm import q13_exact_dedup as q


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(low(t), []).append(i)
    out, done = [], set()
    for i, t in sorted(rows, key=repr):
        own = groups[low(t)]
        keep = max((x for x in own if x is not None), default=None)
        kept = i == keep and low(t) not in done
        done |= {low(t)} if kept else set()
        out.append((i, keep, len(own), kept, hashlib.sha256(low(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def weak(text):
    """Texts of one length share this digest."""
    return F.unhex(F.sha2(F.length(text).cast("string"), 256))


@pytest.mark.parametrize("which", ["docs", "odd_docs"])
@pytest.mark.parametrize("old", ["doc_id < 60", "doc_id % 3 = 0", "true", "false"])
def test_against_brute_force(which, old, request):
    df = request.getfixturevalue(which)
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    own = F.coalesce(F.expr(old), F.lit(False))
    assert sorted(map(tuple, q.deduplicated(df.where(own), df.where(~own)).collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("old", ["doc_id < 10", "true", "false"])
def test_texts_that_share_a_digest_are_parted_by_their_bytes(odd_docs, old):
    own = F.coalesce(F.expr(old), F.lit(False))
    got = q.deduplicated(odd_docs.where(own), odd_docs.where(~own), weak).select("doc_id", "keep_id", "group_size", "kept")
    want = brute([tuple(r) for r in odd_docs.select("doc_id", "text").collect()])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((r[:4] for r in want), key=repr)


def test_one_text_in_most_rows(spark):
    rows = [(i, "The Same" if i % 3 else f"text {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = q.deduplicated(df.where("doc_id < 1500"), df.where("doc_id >= 1500"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 99, 1500])
def test_slots_are_a_bijection_in_each_bucket(spark, n):
    digests = spark.createDataFrame([(hashlib.sha256(str(i).encode()).digest(),) for i in range(n)], "digest binary")
    pilots, buckets = mh.build(digests)
    got = mh.with_slots(digests, pilots, buckets).collect()
    own = {}
    for r in got:
        own.setdefault(r.bucket, []).append(r.slot)
    assert len(got) == n and all(sorted(s) == list(range(len(s))) for s in own.values())
    strange = spark.createDataFrame([(hashlib.sha256(f"other {i}".encode()).digest(),) for i in range(200)], "digest binary")
    for r in mh.with_slots(strange, pilots, buckets).collect():
        assert r.slot is None if r.bucket not in own else 0 <= r.slot < len(own[r.bucket])


def test_the_fit_of_a_bucket():
    rng = np.random.default_rng(1)
    for m in (1, 7, 64, 230):
        digests = [rng.bytes(32) for _ in range(m)]
        seed, pilots = mh.fit(digests)
        slots = []
        for d in digests:
            w = [int.from_bytes(d[4 * i : 4 * i + 4]) for i in range(8)]
            slots.append((w[2 + 2 * seed] + pilots[w[1] % len(pilots)] * w[3 + 2 * seed]) % mh.PRIME % m)
        assert sorted(slots) == list(range(m))
    first = digests[0]
    seed, _ = mh.fit([first, first[:16] + rng.bytes(16), rng.bytes(32)])  # the first pair of words doesn't part the first two
    assert seed > 0
    with pytest.raises(ValueError):
        mh.fit([first, first])


def test_extra_columns_and_empty(odd_docs):
    more = odd_docs
    for name in ("part", "k", "top", "size", "digest", "slot", "bucket", "held", "member", "low", "high", "at", "other", "more", "kept", "keep_id", "seed", "pilots"):
        more = more.withColumn(name, F.lit("x"))
    assert q.deduplicated(more.where("doc_id < 9"), more.where("doc_id >= 9 or doc_id is null")).count() == odd_docs.count()
    assert q.deduplicated(more.limit(0), more.limit(0)).count() == 0
