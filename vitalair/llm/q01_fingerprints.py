"""op1: fingerprints of every document and of its text edited with its follower's."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalair.llm import edit_embedding as ee
from vitalair.llm.common import materialise, table
from vitalair.llm.succession import dealt_in_order

SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _with_follower(batches):
    import numpy as np
    import pandas as pd

    held = None  # the last row so far: its follower is yet to come
    for pdf in batches:
        texts = [t or "" for t in pdf["text"]]
        ids, ghost = list(pdf["doc_id"]), list(pdf["ghost"])
        prints = ee.fingerprint_batch(texts)
        if held is not None:
            ids, ghost, texts = [held[0], *ids], [held[1], *ghost], [held[2], *texts]
            prints = np.concatenate([held[3], prints])
        n = len(ids) - 1
        if len(ids):
            held = ids[-1], ghost[-1], texts[-1], prints[-1:]
        keep = [i for i in range(n) if not ghost[i]]
        if not keep:
            continue
        edited = []
        for i in keep:
            k = len(texts[i]) // 2
            edited.append(texts[i][: len(texts[i]) - k] + texts[i + 1][:k])
        eprints, at = ee.fingerprint_batch(edited), np.array(keep)
        yield pd.DataFrame({
            "doc_id": pd.array([None if ids[i] is None or ids[i] != ids[i] else int(ids[i]) for i in keep], dtype="Int64"),
            "n_chars": [len(texts[i]) for i in keep],
            "edited_sha256": [hashlib.sha256(e.encode()).hexdigest() for e in edited],
            "fingerprint": ee.to_hex(prints[at]),
            "edited_fingerprint": ee.to_hex(eprints),
            "near_edited": ee.likeness(prints[at], eprints),
            "near_next": ee.likeness(prints[at], prints[at + 1]),
        })


def edit_fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document row; see SCHEMA.

    Null text is empty (fingerprint all zero). Rows with equal doc_id follow each
    other in the order of their texts; a single row is followed by itself; an
    empty table gives no rows; very long texts are walked whole; other columns are
    ignored.
    """
    dealt = dealt_in_order(docs.select("doc_id", "text"), "doc_id", "text")
    return dealt.mapInPandas(_with_follower, SCHEMA)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, and near_group: which documents bands of the fingerprint's bits and their verification hold together."""
    return ee.with_groups(materialise(edit_fingerprints(table(spark, sf_dir, "documents")), "prints"))
