"""A minimal perfect hash over a table of distinct 32-byte digests, built bucket by bucket.

A digest is read as eight 32-bit words.  The first deals it to a bucket of about
BUCKET digests, the second to one of the bucket's groups of about GROUP digests.
Each group has a pilot, the first number that sends all its digests to slots no
other group has taken, so the m digests of a bucket fill the slots 0 to m - 1.
Groups are placed largest first.  A digest that was not there at the fit gets a
slot too: whoever looks up compares the full digest that the slot holds.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalair.llm.common import materialise

BUCKET, GROUP = 100, 3
PRIME = 4_294_967_291  # the largest below 2^32
SEEDS, PILOTS = 3, 1 << 18


def word(digest: Column, i: Column) -> Column:
    """The i-th (from 0) big-endian 32-bit word."""
    return F.conv(F.hex(F.substring(digest, i * 4 + 1, F.lit(4))), 16, 10).cast("long")


def fit(digests: list[bytes]) -> tuple[int, list[int]]:
    """(seed, pilots) of one bucket's distinct digests."""
    w = np.frombuffer(b"".join(digests), dtype=">u4").reshape(-1, 8).astype(np.int64)
    m, groups = len(w), -(-len(w) // GROUP)
    own = w[:, 1] % groups
    order = np.argsort(-np.bincount(own, minlength=groups), kind="stable")
    for seed in range(SEEDS):
        a, b = w[:, 2 + 2 * seed], w[:, 3 + 2 * seed]
        free, pilots = np.ones(m, bool), [0] * groups
        for g in order:
            mine = np.flatnonzero(own == g)
            for lo in range(0, PILOTS, 512):
                at = (a[mine, None] + np.arange(lo, lo + 512) * b[mine, None]) % PRIME % m
                fits = free[at].all(axis=0) & (np.diff(np.sort(at, axis=0), axis=0) > 0).all(axis=0)
                if fits.any():
                    k = int(fits.argmax())
                    pilots[g] = lo + k
                    free[at[:, k]] = False
                    break
            else:
                break  # this pair of words cannot part the group
        if not free.any():
            return seed, pilots
    raise ValueError("digests of a bucket that agree in all their words can't be parted")


def build(digests: DataFrame) -> tuple[DataFrame, int]:
    """Pilots (bucket, size, seed, pilots) of the distinct 32-byte column `digest`, stored, and the number of buckets.

    Buckets are even because digests are; their number grows with the digests, so no
    task holds more than a few hundred of one bucket. An empty table has no buckets.
    """
    n = max(1, digests.count() // BUCKET)

    def run(batches):
        for pdf in batches:
            fitted = [fit(list(d)) for d in pdf["digests"]]
            yield pd.DataFrame({"bucket": pdf["bucket"], "size": pdf["digests"].map(len), "seed": [s for s, _ in fitted], "pilots": [p for _, p in fitted]})

    dealt = digests.groupBy((word(F.col("digest"), F.lit(0)) % n).alias("bucket")).agg(F.collect_list("digest").alias("digests"))
    return materialise(dealt.mapInPandas(run, "bucket long, size long, seed long, pilots array<long>"), "pilots"), n


def with_slots(df: DataFrame, pilots: DataFrame, n: int) -> DataFrame:
    """df (digest and other columns) with bucket and slot; the slot is null where the bucket is empty."""
    d = F.col("row.digest")
    met = df.select(F.struct(*df.columns).alias("row")).withColumn("bucket", word(d, F.lit(0)) % n).join(pilots, "bucket", "left")
    a, b = (word(d, (F.col("seed") * 2 + k).cast("int")) for k in (2, 3))
    pilot = F.get("pilots", (word(d, F.lit(1)) % F.size("pilots")).cast("int"))
    return met.select("bucket", ((a + pilot * b) % PRIME % F.col("size")).alias("slot"), "row.*")
