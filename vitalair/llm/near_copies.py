"""Near copies by the likeness of their word shingles: SimHash under Golay keys, MinHash bands for the rest, then the exact Jaccard measure.

Texts with one set of shingles are one class.  Each class has op6's fingerprint
of its shingles, and fingerprints at four or fewer differing bits meet on op6's
Golay keys.  That finds every pair so near, but at a likeness of 0.8 some ten
bits of 64 differ, so of each class ROWS minima of its hashed shingles make a
band's key, too: at a likeness of 0.8 two classes share one of the BANDS keys in
99.98 % of cases.  Under each key all classes are first compared with one of
them, so a group of copies that are all like it is held together by as many
links as it has members.  Only where a key still holds classes that no link
connects are those compared, in blocks of bounded size.  Comparisons are of
whole sets, so no pair below the likeness is linked by either.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from vitalair.llm.common import materialise, partitions
from vitalair.llm.components import components
from vitalair.llm.q06_simhash import LOWER, links, majority

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 16, 4
ROOM = 2_000_000  # shingles of one block; two blocks meet in a task
_draw = np.random.default_rng(20_240_501).integers(1, 2**63, (2, BANDS * ROWS), dtype=np.int64).view(np.uint64)
MASKS, FACTORS = _draw[0], _draw[1] | np.uint64(1)


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the different runs of `shingle` words; fewer words are one run, no words none."""
    words = text.encode().translate(LOWER).split() if text else []
    h = xxhash.xxh64_intdigest
    runs = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    return np.unique(np.array([h(r, 42) for r in runs], dtype=np.uint64))


def set_id(own: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(own.tobytes())).view(np.int64)) if len(own) else 0


def band_keys(own: np.ndarray) -> list[int]:
    if not len(own):
        return []
    least = np.min([((own[lo : lo + 4096, None] ^ MASKS) * FACTORS).min(axis=0) for lo in range(0, len(own), 4096)], axis=0)
    return [int(np.uint64(xxhash.xxh64_intdigest(least[ROWS * b : ROWS * (b + 1)].tobytes(), b)).view(np.int64)) for b in range(BANDS)]


def set_ids(text: Column, shingle: int = SHINGLE) -> Column:
    """The class of each text."""

    @F.pandas_udf(LongType())
    def ids(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: set_id(shingles(t, shingle)))

    return ids(text)


def forest(ids: list[int], roots: list[int], sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links that hold together what pairs of at least that likeness hold together, beside what has one root already."""
    sizes, roots = np.array([len(s) for s in sets]), np.array(roots)
    left, links = np.arange(len(ids)), []
    while len(left):
        own = roots[left] == roots[left[0]]
        todo, left = list(left[own]), left[~own]
        while todo and len(left):
            x = todo.pop()
            n = sizes[left]
            near = left[(n >= similarity * sizes[x] - 1e-9) & (sizes[x] >= similarity * n - 1e-9)]
            if not len(near):
                continue
            n = sizes[near]
            flat, starts = np.concatenate([sets[i] for i in near]), np.cumsum(np.append(0, n[:-1]))
            at = np.minimum(np.searchsorted(sets[x], flat), sizes[x] - 1)
            both = np.add.reduceat((sets[x][at] == flat).astype(np.int64), starts)
            hit = near[both >= similarity * (sizes[x] + n - both) - 1e-9]
            links += [(ids[x], ids[i]) for i in hit]
            met = np.isin(roots[left], roots[hit])
            todo += list(left[met])
            left = left[~met]
    return links


def _linked(similarity: float):
    """Rows sorted by (key, i, j) -> links within each run of equal (key, i, j), which may go on in the next batch."""

    def run(batches):
        name, ids, roots, sets = None, [], [], []
        for pdf in batches:
            out = []
            for own, fp, root, hashes in zip(zip(pdf["key"], pdf["i"], pdf["j"]), pdf["fp"], pdf["root"], pdf["own"]):
                if own != name:
                    out += forest(ids, roots, sets, similarity)
                    name, ids, roots, sets = own, [], [], []
                ids.append(fp)
                roots.append(root)
                sets.append(hashes.view(np.uint64))
            if out:
                yield pd.DataFrame(out, columns=["a", "b"])
        if out := forest(ids, roots, sets, similarity):
            yield pd.DataFrame(out, columns=["a", "b"])

    return run


def fingerprint_pairs(classes: DataFrame) -> DataFrame:
    """(fp, pivot): classes (fp, size, sim) whose fingerprints differ in at most op6's four bits, enough pairs to connect all such.

    Classes of one fingerprint hang on their least; the least ones of two
    fingerprints meet as op6's Golay keys link these.
    """
    own = classes.where("size > 0").select("fp", "sim")
    least = materialise(own.groupBy("sim").agg(F.min("fp").alias("pivot")), "fingerprints")
    same = own.join(least.hint("merge"), "sim").where("fp != pivot").select("fp", "pivot")
    met = links(least.select(F.col("sim").alias("fp")))
    ends = least.select(F.col("sim").alias("a"), F.col("pivot").alias("fp")), least.select(F.col("sim").alias("b"), "pivot")
    between = met.join(ends[0].hint("merge"), "a").join(ends[1].hint("merge"), "b").select("fp", "pivot")
    return materialise(same.unionByName(between), "fingerprint-pairs")


def _sets(classes: DataFrame, members: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """(fp, own): the sorted shingles of the classes among members, from their texts."""
    wanted = members.select("fp").distinct()
    ids = classes.join(wanted.hint("merge"), "fp").select(F.col("least").alias("_id")).distinct()

    def held(batches):
        for pdf in batches:
            sets = [shingles(t, shingle) for t in pdf["text"]]
            yield pd.DataFrame({"fp": np.array([set_id(s) for s in sets], dtype=np.int64), "own": [s.view(np.int64) for s in sets]})

    few = docs.select("doc_id", "text").join(ids.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    sets = few.select("text").mapInPandas(held, "fp long, own array<long>").join(wanted.hint("merge"), "fp", "left_semi")
    return materialise(sets.groupBy("fp").agg(F.first("own").alias("own")), "sets")


def rooted(classes: DataFrame, docs: DataFrame, shingle: int, similarity: float, room: int = ROOM) -> DataFrame:
    """(node, root) of classes (fp, size, least, keys, sim) that links connect, except of each component's least."""
    n = partitions(docs.sparkSession)
    keyed = classes.select("fp", "size", F.explode("keys").alias("key"))
    met = keyed.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.xxhash64("fp").cast("decimal(38,0)")).alias("s"), F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("n > 1")
    met = materialise(met.groupBy("n", "s", "lo", "hi").agg(F.min("key").alias("key")).select("key"), "met")  # keys with the same members once
    members = materialise(keyed.join(met.hint("merge"), "key"), "members")
    near = fingerprint_pairs(classes)
    sets = _sets(classes, members.select("fp").union(near.select("fp")).union(near.select("pivot")), docs, shingle)

    # Stored, so that a key of very many members is a join's skewed side, which Spark can split.
    pivots = materialise(members.groupBy("key").agg(F.min(F.struct("fp", "size")).alias("p")), "pivots")
    alike = (F.col("size") >= similarity * F.col("p.size") - 1e-9) & (F.col("p.size") >= similarity * F.col("size") - 1e-9)
    pairs = members.join(pivots.hint("merge"), "key").where((F.col("fp") != F.col("p.fp")) & alike).select("fp", F.col("p.fp").alias("pivot"))
    pairs = pairs.unionByName(near).distinct()
    pairs = pairs.join(sets.hint("merge"), "fp").join(sets.select(F.col("fp").alias("pivot"), F.col("own").alias("other")).hint("merge"), "pivot")
    both = F.size(F.array_intersect("own", "other"))
    stars = materialise(pairs.where(both >= similarity * (F.size("own") + F.size("other") - both) - 1e-9).select(F.col("fp").alias("a"), F.col("pivot").alias("b")), "stars")
    roots = components(stars, "a", "b")

    rooted = members.join(roots.withColumnRenamed("node", "fp").hint("merge"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = materialise(rooted.select("key", "fp", "root", "size"), "rooted-members")
    blocks = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.ceil(F.sum("size") / room).alias("blocks")).where("lo != hi").select("key", "blocks")
    blocks = materialise(blocks, "blocks")
    rest = rooted.join(blocks.hint("merge"), "key").withColumn("own_block", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    rest = rest.withColumn("other_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rest = rest.select("key", F.least("own_block", "other_block").alias("i"), F.greatest("own_block", "other_block").alias("j"), "fp", "root")
    run = rest.join(sets.hint("merge"), "fp").repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j", "fp")
    more = materialise(run.mapInPandas(_linked(similarity), "a long, b long").distinct(), "likes")
    return components(stars.unionByName(more), "a", "b") if more.limit(1).count() else roots


def near_copies(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, room: int = ROOM) -> DataFrame:
    """doc_id, set_id (of the text's shingles), component_id (least doc_id reachable over links) for every row.

    Texts without words are one class, linked with no other; rows with null doc_id
    get the component of the others of their class, null if there is none;
    repeated rows stay repeated; very long texts are compared whole; other columns
    are ignored; an empty table gives no rows.
    """

    def run(batches):
        for pdf in batches:
            sets = [shingles(t, shingle) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "fp": np.array([set_id(s) for s in sets], dtype=np.int64), "size": np.array([len(s) for s in sets], dtype=np.int64), "keys": [band_keys(s) for s in sets], "sim": np.array([majority(s) for s in sets], dtype=np.int64)})

    rows = materialise(docs.select("doc_id", "text").mapInPandas(run, "doc_id long, fp long, size long, keys array<long>, sim long"), "shingled")
    classes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.first("size").alias("size"), F.first("keys").alias("keys"), F.first("sim").alias("sim")), "classes")
    roots = rooted(classes, docs, shingle, similarity, room).withColumnRenamed("node", "fp")
    known = materialise(classes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    ids = materialise(known.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    named = materialise(known.join(ids, "root").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select("doc_id", F.col("fp").alias("set_id"), "component_id")
