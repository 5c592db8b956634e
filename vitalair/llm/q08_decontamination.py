"""op8: benchmark decontamination by a prefix-filtered containment join.

An item's windows of 13 words are sets to be contained whole in a document's
window of the same length, so the prefix that any match must share is one
token: the rarest of the window, by its count over all documents.  Document
positions of such tokens give candidate places; length and position bound
them, and every word of the window is then compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalair.llm.common import ascii_lower, ascii_words, materialise, table

WINDOW = 13
BLOCK_WORDS = 1_000_000  # benchmark words that the driver holds and the tasks get at once; more are taken in blocks
BATCH_CHARS = 2_000_000
RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
HITS = "doc_id long, row string, times long, n_words long, starts array<int>, ends array<int>, items array<string>"


@dataclass
class Index:
    """Windows of one block of the benchmark, ready to be met by documents."""

    vocabulary: dict[bytes, int]  # word -> number from 1; 0 is any other word
    windows: np.ndarray  # int32[w, WINDOW], padded with -1
    lengths: np.ndarray
    owners: list[list[str]]  # item ids of each window
    offset: np.ndarray  # place of the rarest word in its window
    first: np.ndarray  # by word number: the first and last of its windows in `by_token`
    last: np.ndarray
    by_token: np.ndarray


def windows_of(words: list, size: int = WINDOW) -> list[tuple]:
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


def build_index(items: list[tuple[str, str | None]], vocabulary: dict[bytes, int], counts: np.ndarray) -> Index:
    owners: dict[tuple, set[str]] = {}
    for item_id, text in items:
        for w in windows_of([vocabulary[x] for x in ascii_words(text)]):
            owners.setdefault(w, set()).add(item_id)
    found = sorted(owners)
    table_ = np.full((len(found), WINDOW), -1, dtype=np.int32)
    for i, w in enumerate(found):
        table_[i, : len(w)] = w
    lengths = np.array([len(w) for w in found], dtype=np.int64)
    rarity = np.where(table_ >= 0, counts[table_], np.iinfo(np.int64).max)
    offset = rarity.argmin(axis=1) if len(found) else np.zeros(0, dtype=np.int64)
    token = table_[np.arange(len(found)), offset] if len(found) else np.zeros(0, dtype=np.int32)
    by_token = np.argsort(token, kind="stable")
    numbers = np.arange(len(counts))
    return Index(vocabulary, table_, lengths, [sorted(owners[w]) for w in found], offset, np.searchsorted(token[by_token], numbers), np.searchsorted(token[by_token], numbers, side="right"), by_token)


def _batches(texts):
    """Slices of bounded text size."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > lo and size + n > BATCH_CHARS:
            yield slice(lo, i)
            lo, size = i, 0
        size += n
    if lo < len(texts):
        yield slice(lo, len(texts))


def _numbered(texts, vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts, each followed by WINDOW times -2, and where each text starts (one more at the end)."""
    get, gap = vocabulary.get, [-2] * WINDOW
    parts, starts, at = [], [0], 0
    for t in texts:
        words = ascii_words(t)
        parts += [np.fromiter((get(w, 0) for w in words), dtype=np.int32, count=len(words)), gap]
        at += len(words) + WINDOW
        starts.append(at)
    return np.concatenate(parts).astype(np.int32), np.array(starts)


def find(texts: list, index: Index):
    """Per text: number of words, bool array of all words (with the gaps), its bounds, and (text, window, start) of every occurrence."""
    ids, starts = _numbered(texts, index.vocabulary)
    at = np.flatnonzero(ids > 0)
    n = index.last[ids[at]] - index.first[ids[at]]
    at, n = at[n > 0], n[n > 0]
    where = np.repeat(at, n)
    window = index.by_token[np.repeat(index.first[ids[at]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    start = where - index.offset[window]
    fits = start >= 0
    start, window = start[fits], window[fits]
    for k in range(WINDOW):  # candidates fall away word by word; the gaps between texts match nothing
        want = index.windows[window, k]
        same = (want < 0) | (ids[np.minimum(start + k, len(ids) - 1)] == want)
        start, window = start[same], window[same]
    doc = np.searchsorted(starts, start, side="right") - 1
    return np.diff(starts) - WINDOW, starts, len(ids), doc, window, start


def _owned(doc, window, index: Index, n: int) -> list[set[str]]:
    items: list[set[str]] = [set() for _ in range(n)]
    for d, w in set(zip(doc.tolist(), window.tolist())):
        items[d].update(index.owners[w])
    return items


def _verdict(n_words: int, n_hit: int, items) -> tuple:
    ids = ",".join(sorted(items))
    return n_words, n_hit, len(items), hashlib.sha256(ids.encode()).hexdigest(), n_hit > 0 and 20 * n_hit >= n_words


def _judge(index: Index):
    def run(batches):
        for pdf in batches:
            texts, rows = list(pdf["text"]), []
            for part in _batches(texts):
                n_words, starts, size, doc, window, start = find(texts[part], index)
                steps = np.zeros(size + 1, dtype=np.int64)
                np.add.at(steps, start, 1)
                np.add.at(steps, start + index.lengths[window], -1)
                hit = np.concatenate([[0], np.cumsum(np.cumsum(steps[:-1]) > 0)])
                n_hit = hit[starts[1:]] - hit[starts[:-1]]
                rows += [_verdict(int(w), int(h), i) for w, h, i in zip(n_words, n_hit, _owned(doc, window, index, len(n_words)))]
            out = pd.DataFrame(rows, columns=["n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
            yield out.assign(doc_id=pdf["doc_id"].astype("Int64").to_numpy())[["doc_id", *out.columns]].astype({"doc_id": "Int64"})

    return run


def _spans(index: Index):
    def run(batches):
        for pdf in batches:
            texts, rows = list(pdf["text"]), []
            for part in _batches(texts):
                n_words, starts, _, doc, window, start = find(texts[part], index)
                items = _owned(doc, window, index, len(n_words))
                for d, n in enumerate(n_words.tolist()):
                    own = doc == d if items[d] else None
                    a = (start[own] - starts[d]).tolist() if items[d] else []
                    b = (start[own] - starts[d] + index.lengths[window[own]]).tolist() if items[d] else []
                    rows.append((n, a, b, sorted(items[d])))
            out = pd.DataFrame(rows, columns=["n_words", "starts", "ends", "items"])
            out = out.assign(doc_id=pdf["doc_id"].astype("Int64").to_numpy(), row=pdf["row"].to_numpy(), times=pdf["times"].to_numpy())
            yield out[["doc_id", "row", "times", "n_words", "starts", "ends", "items"]].astype({"doc_id": "Int64"})

    return run


def _merge(with_row: bool):
    def run(batches):
        for pdf in batches:
            rows, hashes = [], []
            for doc_id, row, times, n, starts, ends, items in zip(*(pdf[c] for c in ("doc_id", "row", "times", "n_words", "starts", "ends", "items"))):
                hit = np.zeros(n, dtype=bool)
                for a, b in zip(np.concatenate([*starts, []]).astype(int), np.concatenate([*ends, []]).astype(int)):
                    hit[a:b] = True
                rows += [(doc_id, *_verdict(int(n), int(hit.sum()), {x for part in items for x in part}))] * int(times)
                hashes += [row] * int(times)
            out = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
            yield (out.assign(row=hashes) if with_row else out).astype({"doc_id": "Int64"})

    return run


def _counted(vocabulary):
    def run(batches):
        total = np.zeros(len(vocabulary) + 1, dtype=np.int64)
        for pdf in batches:
            texts = list(pdf["text"])
            for part in _batches(texts):
                ids, _ = _numbered(texts[part], vocabulary)
                total += np.bincount(ids[ids > 0], minlength=len(total))
        some = np.flatnonzero(total)
        yield pd.DataFrame({"word": some.astype(np.int64), "n": total[some]})

    return run


def word_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> np.ndarray:
    """How often each word of the vocabulary (one block's, so bounded) occurs in all documents."""
    counts = np.zeros(len(vocabulary) + 1, dtype=np.int64)
    summed = docs.select("text").mapInPandas(_counted(vocabulary), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    for r in summed.toLocalIterator():
        counts[r["word"]] = r["n"]
    return counts


def pieces(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(item_id, text, n): items in pieces of at most `block_words` words (WINDOW at least) that hold all their windows between them."""
    size = max(block_words, 2 * WINDOW)
    ws = F.array_remove(F.split(ascii_lower(F.coalesce("text", F.lit(""))), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), "")
    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("string"), ws.alias("ws")).where(F.size("ws") > 0)
    # A piece begins where the last one has its last windows but for one; one of less than a window would be a window that is none.
    starts = F.filter(F.sequence(F.lit(0), F.size("ws") - 1, F.lit(size - WINDOW + 1)), lambda s: (s == 0) | (s + WINDOW <= F.size("ws")))
    cut = F.transform(starts, lambda s: F.slice("ws", s + 1, size))
    return items.select("item_id", F.explode(cut).alias("p")).select("item_id", F.array_join("p", " ").alias("text"), F.size("p").alias("n"))


def indices(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[tuple[int, Index]]:
    """(number of blocks, index) of one block of the benchmark after the other, each of about `block_words` words, by the rarity of its words in docs.

    The driver holds one block at a time, if the caller does.
    """
    stored = materialise(pieces(benchmark, block_words), "items")
    total = stored.agg(F.sum("n")).first()[0] or 0
    n_blocks = max(1, -(-total // block_words))
    for k in range(n_blocks):
        own = stored.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k) if n_blocks > 1 else stored
        items = [(r["item_id"], r["text"]) for r in own.select("item_id", "text").collect()]
        vocabulary = {w: i + 1 for i, w in enumerate(sorted({w for _, t in items for w in ascii_words(t)}))}
        yield n_blocks, build_index(items, vocabulary, word_counts(docs, vocabulary))


def contamination(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """RESULT for every document row.

    Null or wordless texts have no words and are clean; null or wordless items
    have no windows; items without an id are left out; items with equal ids count
    as one; repeated rows stay repeated; very long texts are judged whole; other
    columns are ignored; empty tables are fine. The benchmark is taken in blocks
    of about `block_words` words, one after the other, each of which is sent to
    all tasks; an item of more words is taken in pieces.
    """
    blocks = indices(docs, benchmark, block_words)
    n, first = next(blocks)
    if n == 1:
        return docs.select("doc_id", "text").mapInPandas(_judge(first), RESULT)
    return _in_blocks(docs, chain([(n, first)], blocks))


def clean_documents(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Rows of docs, with all their columns, that are not contaminated by their own text; nulls and the like as in `contamination`.

    With one block of the benchmark it is one pass that shuffles no text; with more,
    verdicts are joined to the rows by doc_id and a hash of the text.
    """
    blocks = indices(docs, benchmark, block_words)
    n, first = next(blocks)
    if n == 1:
        judge = _judge(first)

        @F.pandas_udf("boolean")
        def contaminated(texts: pd.Series) -> pd.Series:
            (out,) = judge([pd.DataFrame({"doc_id": np.zeros(len(texts), dtype=np.int64), "text": texts})])
            return out["contaminated"].astype(bool)

        return docs.where(~contaminated(F.col("text")))
    bad = _in_blocks(docs, chain([(n, first)], blocks), with_row=True).where("contaminated").select("doc_id", "row").distinct()
    same = F.col("d.doc_id").eqNullSafe(F.col("bad.doc_id")) & (row_hash("d.text") == F.col("bad.row"))
    return docs.alias("d").join(bad.hint("merge").alias("bad"), same, "left_anti")


def row_hash(text: str = "text") -> Column:
    return F.coalesce(F.sha2(text, 256), F.lit(""))


def _in_blocks(docs: DataFrame, blocks: Iterator[tuple[int, Index]], with_row: bool = False) -> DataFrame:
    rows = docs.select("doc_id", "text")
    # A row is known by its id and text here; a repeated one is judged once and given as often as it occurs.
    once = rows.groupBy("doc_id", row_hash().alias("row")).agg(F.first("text").alias("text"), F.count("*").alias("times"))
    merged = None
    for k, (_, block) in enumerate(blocks):  # each block's hits are stored before the next one is built
        hits = once.mapInPandas(_spans(block), HITS)
        hits = materialise(hits if k == 0 else hits.where(F.size("items") > 0), "hits")  # every row once, for its number of words
        merged = hits if merged is None else merged.union(hits)
    merged = merged.groupBy("doc_id", "row").agg(F.first("n_words").alias("n_words"), F.first("times").alias("times"), *(F.collect_list(c).alias(c) for c in ("starts", "ends", "items")))
    return merged.mapInPandas(_merge(with_row), RESULT + (", row string" if with_row else ""))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
