"""Document fingerprints by a randomised edit embedding.

A pointer walks over the characters of a text.  At step j it writes the
character c it stands on and then moves by one or two places, as a random bit
shared by all texts for (j, c) says.  After an insertion or deletion two walks
drift apart and, by their shared bits, meet again, so a few edits change few
written positions: edit distance becomes Hamming distance.  Walks start afresh
at content-defined anchors, so that long texts are walked piece by piece and
an edit cannot move what lies beyond the next anchor.

The written positions are sampled into a fixed number of one-byte cells: each
position falls in one cell and the one with the smallest shared random rank is
kept, so two fingerprints agree in a cell as often as their embeddings agree.
Bands of sampled fingerprint bits find candidates, which are then verified.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalair.llm.common import materialise, partitions
from vitalair.llm.components import components

CELLS = 128
GRAM = 8  # characters that decide on an anchor
ANCHOR = 256  # one position in so many is an anchor
LONGEST = 1024  # characters of a walk at most
BATCH_CHARS = 2_000_000

_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M[1]
    x = (x ^ (x >> np.uint64(27))) * _M[2]
    return x ^ (x >> np.uint64(31))


def _walk(texts: list[str]) -> np.ndarray:
    """uint8[len(texts), CELLS] for texts of bounded total length (or one long text)."""
    n = len(texts)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.zeros(n, dtype=np.int64)
    np.cumsum((sizes + GRAM)[:-1], out=starts[1:])
    pad = "\0" * GRAM
    codes = np.frombuffer((pad.join(texts) + pad + pad).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    codes = (codes + np.uint64(1)) * _M[0]
    ends = starts + sizes
    total = int(ends[-1]) if n else 0
    gram = np.zeros(total + 1, dtype=np.uint64)
    for k in range(GRAM):
        gram = gram * _M[1] + codes[k : k + total + 1]
    gram = _mix(gram)
    anchor = (gram[:total] % np.uint64(ANCHOR)) == 0
    full = sizes > 0
    anchor[starts[full]] = True
    for a, b in zip(ends[:-1], starts[1:]):  # nothing starts between two texts
        anchor[a:b] = False
    begin = np.flatnonzero(anchor)
    doc = np.searchsorted(starts, begin, side="right") - 1
    doc = doc[sizes[doc] > 0] if len(doc) and not (sizes[doc] > 0).all() else doc
    stop = np.minimum(np.append(begin[1:], total), ends[doc])
    pieces = -(-(stop - begin) // LONGEST)
    if len(begin) and pieces.max() > 1:
        first = np.repeat(np.cumsum(pieces) - pieces, pieces)
        step = np.arange(pieces.sum()) - first
        begin, stop, doc = np.repeat(begin, pieces) + step * LONGEST, np.repeat(stop, pieces), np.repeat(doc, pieces)
        stop = np.minimum(stop, begin + LONGEST)
    seed = gram[begin]
    if len(begin):
        seed[begin == starts[doc]] = _M[0]  # a text's first walk has a seed that all texts share
    best = np.full(n * CELLS, np.iinfo(np.uint64).max, dtype=np.uint64)
    order = np.argsort(begin - stop, kind="stable")  # the longest first, so that those under way are a prefix
    at, stop, base, seed = begin[order], stop[order], doc[order] * CELLS, seed[order]
    j = 0
    while len(at):
        c = codes[at]
        here = c ^ np.uint64((j + 1) * int(_M[2]) & 0xFFFFFFFFFFFFFFFF)
        e = _mix(here + seed)
        np.minimum.at(best, base + (e & np.uint64(CELLS - 1)).astype(np.int64), e >> np.uint64(7))
        at = at + 1 + ((here * _M[1]) >> np.uint64(63)).astype(np.int64)
        on = at < stop
        if not on.all():
            at, stop, base, seed = at[on], stop[on], base[on], seed[on]
        j += 1
    best = best.reshape(n, CELLS)
    none = best == np.iinfo(np.uint64).max
    cells = (_mix(best + _M[0]) & np.uint64(255)).astype(np.uint8)
    for i in np.flatnonzero(none.any(axis=1)):  # short texts: an empty cell takes the next filled one's value, changed by its distance
        filled = np.flatnonzero(~none[i])
        if not len(filled):
            cells[i] = 0
            continue
        gaps = np.flatnonzero(none[i])
        src = filled[np.searchsorted(filled, gaps) % len(filled)]
        cells[i, gaps] = (_mix(best[i, src] + ((src - gaps) % CELLS).astype(np.uint64) * _M[2]) & np.uint64(255)).astype(np.uint8)
    return cells


def fingerprint_batch(texts: list[str]) -> np.ndarray:
    """One row of CELLS bytes per text; equal texts have equal rows, the empty text is all zero."""
    out, lo, size = [], 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > BATCH_CHARS:
            out.append(_walk(texts[lo:i]))
            lo, size = i, 0
        size += len(t) + GRAM
    if lo < len(texts):
        out.append(_walk(texts[lo:]))
    return np.concatenate(out) if out else np.zeros((0, CELLS), dtype=np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated share of embedding positions that two fingerprints have in common (0 to 1), row by row."""
    return _of_share((a == b).mean(axis=1))


def _of_share(equal: np.ndarray) -> np.ndarray:
    agree = np.clip((equal - 1 / 256) / (1 - 1 / 256), 0.0, 1.0)
    return 2 * agree / (1 + agree)


def to_hex(cells: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in cells]


def from_hex(column) -> np.ndarray:
    return np.frombuffer(bytes.fromhex("".join(column)), dtype=np.uint8).reshape(-1, CELLS)


@F.pandas_udf(T.StringType())
def fingerprint(text):
    import pandas as pd

    return pd.Series(to_hex(fingerprint_batch([t or "" for t in text])))


@F.pandas_udf(T.DoubleType())
def hex_likeness(a, b):
    import pandas as pd

    return pd.Series(likeness(from_hex(a), from_hex(b)))


def band_keys(n_bands: int = 24, cells: int = 4):
    """A pandas UDF: fingerprint -> band keys, each of the bits of `cells` (at most 4) cells sampled for all texts alike.

    At a likeness of 0.8 two thirds of the cells agree, so a band of four does in
    a fifth of all cases and at least one of 24 bands in 99.5 %.
    """
    rng = np.random.default_rng(2024)
    places = np.stack([rng.choice(CELLS, cells, replace=False) for _ in range(n_bands)])
    shifts = np.arange(0, 8 * cells, 8, dtype=np.uint64)

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def keys(fp):
        import pandas as pd

        k = (from_hex(fp)[:, places].astype(np.uint64) << shifts).sum(axis=2) | (np.arange(n_bands, dtype=np.uint64) << np.uint64(8 * cells))
        return pd.Series(list(k.astype(np.int64)))

    return keys


def _forest(fps: list[str], least: int) -> list[tuple[str, str]]:
    """Links that hold together what all pairs with `least` equal cells or more would hold together."""
    cells, left, out = from_hex(fps), np.arange(len(fps)), []
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            i = todo.pop()
            hit = (cells[left] == cells[i]).sum(axis=1) >= least
            found, left = left[hit], left[~hit]
            out += [(fps[i], fps[j]) if fps[i] < fps[j] else (fps[j], fps[i]) for j in found]
            todo += list(found)
    return out


def _linked(least: int):
    """Rows sorted by (key, i, j) -> links within each run of equal (key, i, j), which may go on in the next batch."""

    def run(batches):
        import pandas as pd

        held, name = [], None
        for pdf in batches:
            out = []
            for own, part in pdf.groupby(["key", "i", "j"], sort=False)["fp"]:
                if own != name:
                    out += _forest(held, least)
                    held, name = [], own
                held += list(part)
            yield pd.DataFrame(out, columns=["fingerprint_a", "fingerprint_b"])
        yield pd.DataFrame(_forest(held, least), columns=["fingerprint_a", "fingerprint_b"])

    return run


RUN = 2000  # members of a bucket in one block


def near_links(prints: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Verified links between the different values of `fingerprint`: (fingerprint_a, fingerprint_b, likeness).

    The links hold together all fingerprints that pairs of a shared band and a
    likeness at the threshold or above hold together, without being all such
    pairs. Bands are counted on short ids, and fingerprints follow to those alone
    that several share; bands with the same members are taken once. A bucket of
    more than RUN members is cut into blocks and every two of its blocks meet in a
    task of their own, so a crowded bucket loses no link and no task holds more
    than two blocks.
    """
    n = partitions(prints.sparkSession)
    least = int(np.searchsorted(_of_share(np.arange(CELLS + 1) / CELLS), threshold))
    fps = materialise(prints.select(F.col("fingerprint").alias("fp")).distinct().withColumn("id", F.xxhash64("fp")), "different")
    keyed = materialise(fps.select("id", F.explode(band_keys()("fp")).alias("key")), "bands")
    held = keyed.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("s"), F.min("id").alias("lo"), F.max("id").alias("hi")).where("n > 1")
    sizes = held.groupBy("n", "s", "lo", "hi").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("n") / RUN).alias("blocks"))
    met = keyed.join(materialise(sizes, "shared-bands").hint("merge"), "key").join(fps.hint("merge"), "id").withColumn("own", F.pmod("id", F.col("blocks")))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    met = met.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    met = met.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j", "fp")
    pairs = met.mapInPandas(_linked(least), "fingerprint_a string, fingerprint_b string").distinct()
    return pairs.withColumn("likeness", hex_likeness("fingerprint_a", "fingerprint_b"))


def near_pairs(df: DataFrame, text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """`near_links` of the texts' fingerprints.

    Copies are one fingerprint; join back on it for membership. Null texts count as
    empty; very long texts are walked whole; an empty table gives no rows; other
    columns are ignored.
    """
    return near_links(df.select(fingerprint(F.coalesce(F.col(text_col), F.lit(""))).alias("fingerprint")), threshold)


def with_groups(prints: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Add near_group to a stored table of (doc_id, fingerprint, ...): the least doc_id that near links reach; null where all have no doc_id."""
    links = near_links(prints, threshold).select(F.xxhash64("fingerprint_a").alias("a"), F.xxhash64("fingerprint_b").alias("b"))
    roots = components(links, "a", "b")
    ids = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")).withColumn("node", F.xxhash64("fingerprint"))
    known = materialise(ids.join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    least = materialise(known.groupBy("root").agg(F.min("least").alias("near_group")), "groups")
    named = materialise(known.join(least.hint("merge"), "root").select("fingerprint", "near_group"), "named")
    return prints.join(named.hint("merge"), "fingerprint").select(*prints.columns, "near_group")
