"""op3: best-fit packing of tokenised documents into sequences of bounded length.

Large-item matching: pieces above one third of the capacity go at most two to a
sequence, matched greedily from the longest down to the tightest partner that
fits; smaller pieces then best-fit the gaps that remain.  The matching needs
only how many pieces there are of each length - at most `capacity` numbers at
any input size - so the driver plans on that histogram and Spark places the
pieces: each gets its rank within its length, and a rank its place.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalair.llm.common import materialise, table

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
RECORDS_TO_BROADCAST = 200_000  # rows of 48 bytes; a longer plan is joined by a shuffle
RANKS = 50_000  # ranks of one length in a block, where places are not sent to all tasks


def encoder(name: str = "byte_bpe_50k"):
    """Text -> ids of the public vocabulary `name`, with its one special token recognised in texts.

    The rank file of the same vocabulary gives the same ids several times faster
    than the JSON file; tests hold the two against each other.
    """
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    e = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})
    return lambda text: e.encode(text, allowed_special="all", disallowed_special=())


def cut(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full but perhaps the first."""
    first = n_ids % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n_ids, capacity)]


def tokenised_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = "byte_bpe_50k", keep_ids: bool = False) -> DataFrame:
    """One row per piece of each document (its ids, then id 0); with keep_ids also the ids themselves.

    Null text is empty: one piece holding id 0.
    """

    def pieces(batches):
        encode = encoder(tokenizer)
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                ids = np.array([*(encode(text) if text else ()), 0], dtype="<u4")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    part = ids[start : start + length]
                    rows.append((doc_id, k, start, length, zlib.crc32(part.tobytes()), *([part.astype("int32")] if keep_ids else [])))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])])
            yield out.astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(pieces, PIECES + (", ids array<int>" if keep_ids else ""))


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of each length go: (length, first_rank, last_rank, per_sequence, first_sequence, offset).

    Ranks first_rank..last_rank of that length fill consecutive sequences from
    first_sequence on, per_sequence each, from `offset` on in every one.
    Sequences in the same state are kept as one run of ids, so the work depends
    on the number of lengths, not of pieces.
    """
    gaps: list[int] = []  # sorted gaps of open sequences
    runs: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, how many)
    records, opened = [], 0

    def put(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in runs:
                runs[gap] = []
                insort(gaps, gap)
            runs[gap].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            i = bisect_left(gaps, length)
            if i == len(gaps):  # nothing fits: open what is needed (two at most for lengths over a third of the capacity)
                need = -(-left // (capacity // length))
                put(capacity, opened, need)
                opened += need
                continue
            gap = gaps[i]
            first, n = runs[gap].pop()
            if not runs[gap]:
                del runs[gap], gaps[i]
            per = gap // length
            used = min(n, left // per)
            if not used:
                per, used = left, 1
            records.append((length, rank, rank + used * per - 1, per, first, capacity - gap))
            put(gap, first + used, n - used)
            put(gap - per * length, first, used)
            rank, left = rank + used * per, left - used * per
    return records


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to the rows of a stored table of pieces."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    records = plan(histogram, capacity)
    shards = max(64, max(histogram.values(), default=0) // 50_000)  # a length that many pieces share is ranked in parts
    keyed = pieces.withColumn("_shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)))
    sizes = keyed.groupBy("length", "_shard").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_shard").orderBy("doc_id", "piece", "ids_crc32")
    ranked = keyed.withColumn("_within", F.row_number().over(within) - 1).join(sizes, ["length", "_shard"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_within"))
    places = spark.createDataFrame(records, "_length long, _first long, _last long, _per long, _sequence long, _offset long")
    held = (F.col("length") == F.col("_length")) & F.col("_rank").between(F.col("_first"), F.col("_last"))
    step = F.col("_rank") - F.col("_first")
    if len(records) <= RECORDS_TO_BROADCAST:
        placed = ranked.join(F.broadcast(places), held)
    else:  # pieces of one length meet their places by blocks of ranks
        block = lambda c: F.floor(F.col(c) / RANKS)
        places = places.withColumn("_block", F.explode(F.sequence(block("_first"), block("_last"))))
        placed = ranked.withColumn("_of", block("_rank")).join(places.hint("merge"), held & (F.col("_of") == F.col("_block")))
    return placed.select(
        *pieces.columns,
        (F.col("_sequence") + F.floor(step / F.col("_per"))).alias("sequence_id"),
        (F.col("_offset") + F.pmod(step, F.col("_per")) * F.col("length")).alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves from pieces packed with their ids: sequence_id, ids, and the spans of documents in it."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids"))).alias("p"))
    return parts.select("sequence_id", F.flatten("p.ids").alias("ids"), F.transform("p", lambda x: F.struct(x["doc_id"], x["piece"], x["offset"], x["length"])).alias("spans"))


def packed_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = "byte_bpe_50k", keep_ids: bool = False) -> DataFrame:
    """Tokenise and pack all documents.

    Repeated rows are packed as often as they occur; an empty table gives no
    rows; other columns are ignored; null text is one piece of id 0; texts of any
    length are tokenised whole.
    """
    return pack(materialise(tokenised_pieces(docs, capacity, tokenizer, keep_ids), "pieces"), capacity)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))
