"""op6: SimHash near-duplicates linked by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits.  Of four
differing bits spread over three segments, two segments have two at most
between them (pigeonhole).  Each segment is decoded to the index of its nearest
Golay codeword and to those of its one-bit neighbours.  For each two segments,
keys pair the plain index of one with every nearby index of the other.  Two
fingerprints that differ in at most two bits of two segments share such a key:
if one bit differs in each, by crossing over; if two in one, by the word
between them.  Fingerprints meet on keys and are verified in full.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from vitalair.llm import golay
from vitalair.llm.common import materialise, partitions, table
from vitalair.llm.components import components

SHINGLE = 4
MAX_BITS = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, width
RUN = 20_000  # fingerprints of one key that are compared directly; longer runs are linked through shared neighbours
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def majority(hashes: np.ndarray) -> int:
    """64 bits, signed, each 1 if set in over half the hashes; of none: 0."""
    ones = np.unpackbits(hashes.view(np.uint8).reshape(len(hashes), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit fingerprint as a signed integer; no words: 0."""
    words = text.encode().translate(LOWER).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    gaps = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
    starts = np.concatenate([[0], gaps + 1])[:n].tolist()
    ends = np.append(gaps, len(joined))[shingle - 1 :].tolist() if len(words) >= shingle else [len(joined)]
    h = xxhash.xxh64_intdigest
    return majority(np.array([h(joined[a:b], 42) for a, b in zip(starts, ends)], dtype=np.uint64))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) per row; null text has no words and fingerprint 0."""

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "fp": np.array([simhash(t) for t in pdf["text"]], dtype=np.int64)})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, fp long")


@F.pandas_udf(LongType())
def _fingerprint(texts: pd.Series) -> pd.Series:
    return texts.map(simhash)


def fingerprint(text: Column) -> Column:
    """The 16 hex digits of a text's fingerprint."""
    return F.lower(F.lpad(F.hex(_fingerprint(text)), 16, "0"))


def fuzzy_keys(fps: np.ndarray) -> np.ndarray:
    """Sorted keys of each fingerprint (int64[n, k]); repeats within a row are -1."""
    u = fps.view(np.uint64)
    near = [golay.near_indices(((u >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.uint32), width).astype(np.int64) for at, width in SEGMENTS]
    parts = []
    for k, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        a, b = near[i], near[j]
        parts += [(k << 24) | (a << 12) | b[:, :1], (k << 24) | (a[:, :1] << 12) | b]
    keys = np.sort(np.concatenate(parts, axis=1), axis=1)
    keys[:, 1:][keys[:, 1:] == keys[:, :-1]] = -1
    return keys


def _keyed(batches):
    for pdf in batches:
        fps = pdf["fp"].to_numpy(dtype=np.int64)
        for lo in range(0, len(fps), 20_000):
            part = fps[lo : lo + 20_000]
            keys = fuzzy_keys(part)
            row, col = np.nonzero(keys >= 0)
            yield pd.DataFrame({"key": keys[row, col], "fp": part[row]})


def _forest(fps: np.ndarray) -> list[tuple[int, int]]:
    """Links that hold together what verified links hold together among the fingerprints of one key."""
    left, links = fps.view(np.uint64), []
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop()
            hit = np.bitwise_count(left ^ x) <= MAX_BITS
            if hit.any():
                found, left = left[hit], left[~hit]
                links += [(int(x.view(np.int64)), int(y)) for y in found.view(np.int64)]
                todo += list(found)
    return links


def _linked(batches):
    """Rows sorted by (key, fp) -> links (a, b), or (a, null) for each member of a run that is too long."""
    key, held, long = None, [], False

    def close():
        if not long and held:
            fps = np.concatenate(held)
            if len(fps) > 1:
                return _forest(fps)
        return []

    for pdf in batches:
        keys, fps = pdf["key"].to_numpy(dtype=np.int64), pdf["fp"].to_numpy(dtype=np.int64)
        if not len(keys):
            continue
        cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        out: list[tuple[int, int | None]] = []
        size = np.diff(cuts)
        # runs of two that lie wholly inside this batch, all at once
        two = np.flatnonzero(size == 2)
        two = two[(two > 0) & (two < len(size) - 1)]
        a, b = fps[cuts[two]], fps[cuts[two] + 1]
        hit = np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= MAX_BITS
        out += list(zip(a[hit].tolist(), b[hit].tolist()))
        edge = {0, len(size) - 1}
        for r in sorted(edge | set(np.flatnonzero(size > 2).tolist())):
            lo, hi = cuts[r], cuts[r + 1]
            if r not in edge and hi - lo <= RUN:
                out += _forest(fps[lo:hi])
                continue
            if keys[lo] != key:
                out += close()
                key, held, long = keys[lo], [], False
            part = fps[lo:hi]
            if not long:
                held.append(part)
                if sum(map(len, held)) > RUN:
                    long, part, held = True, np.concatenate(held), []
            if long:
                out += [(x, None) for x in part.tolist()]
        if out:
            yield pd.DataFrame(out, columns=["a", "b"]).astype({"a": "Int64", "b": "Int64"})
    if out := close():
        yield pd.DataFrame(out, columns=["a", "b"]).astype({"a": "Int64", "b": "Int64"})


def _ball(batches):
    """Each fingerprint with all words within two bits of it."""
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    i, j = np.triu_indices(64, 1)
    flips = np.concatenate([[np.uint64(0)], one, one[i] | one[j]])
    for pdf in batches:
        for lo in range(0, len(pdf), 200):
            fps = pdf["fp"].to_numpy(dtype=np.int64)[lo : lo + 200]
            yield pd.DataFrame({"z": (fps.view(np.uint64)[:, None] ^ flips).view(np.int64).ravel(), "fp": np.repeat(fps, len(flips))})


def links(classes: DataFrame) -> DataFrame:
    """(a, b): verified links between distinct fingerprints, enough to connect all that links connect."""
    n = partitions(classes.sparkSession)
    keyed = classes.select("fp").mapInPandas(_keyed, "key long, fp long")
    met = keyed.repartition(n, "key").sortWithinPartitions("key", "fp").mapInPandas(_linked, "a long, b long")
    met = materialise(met, "met")
    # Members of very long runs: two words link exactly if some word lies within two bits of both,
    # and all within two bits of one word link with each other, so each may hang on the least of them.
    crowd = met.where("b is null").select(F.col("a").alias("fp")).distinct()
    around = crowd.mapInPandas(_ball, "z long, fp long")
    least = around.groupBy("z").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").select("z", "b")
    crowded = around.join(least, "z").select(F.col("fp").alias("a"), "b").where("a != b").distinct()
    direct = met.where("b is not null").distinct()
    return direct.union(crowded) if crowd.limit(1).count() else direct


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable over links) for every row.

    Texts without words have fingerprint 0 and link like any other; rows with
    null doc_id get the component of the others of their fingerprint, null if
    there is none; repeated rows stay repeated; very long texts are hashed whole;
    other columns are ignored; an empty table gives no rows.
    Copies share a fingerprint and are one node of the link graph.
    """
    fps = materialise(fingerprints(docs), "fingerprints")
    classes = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(links(classes), "a", "b").withColumnRenamed("node", "fp")
    rooted = materialise(classes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    ids = materialise(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    named = materialise(rooted.join(ids, "root").select("fp", "component_id"), "named")
    return fps.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
