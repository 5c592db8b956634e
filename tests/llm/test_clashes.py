"""Other columns stay whatever they are called: each name that the code uses inside, in turn and all at once."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as p
from vitalair.llm import q04_line_dedup

ROOT = Path(__file__).parents[2]
NAMES = sorted({n for f in ("corpus_pipeline.py", "vitalair/llm/q04_line_dedup.py", "vitalair/llm/near_copies.py", "vitalair/llm/common.py", "vitalair/llm/q07_quality.py", "vitalair/llm/q08_decontamination.py") for n in re.findall(r'"([a-z_]\w{0,14})"', (ROOT / f).read_text())} - {"doc_id", "text", "n_chars", "n_removed"})


@pytest.fixture(scope="module")
def small(odd_docs):
    own = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    return own.where("doc_id is null or doc_id < 24")


def with_names(df):
    return df.select(*df.columns, *[F.concat(F.lit(n), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(n) for n in NAMES if n not in df.columns])


def rows(df, columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_line_dedup_keeps_columns_of_any_name(small):
    assert {"_id", "_lines", "_keep"} <= set(NAMES)
    wide = with_names(small)
    got = q04_line_dedup.deduplicated(wide)
    assert got.columns == [*wide.columns, "n_removed"]
    assert rows(got, ["doc_id", "text", "n_removed"]) == rows(q04_line_dedup.deduplicated(small), ["doc_id", "text", "n_removed"])
    assert all(r["_id"] == f"_id{'-' if r.doc_id is None else r.doc_id}" for r in got.collect())


@pytest.mark.parametrize("stage", [name for name, _ in p.STAGES[:4]])
def test_stages_keep_columns_of_any_name(spark, sf, small, stage):
    run, wide = dict(p.STAGES)[stage], with_names(small)
    got = run(spark, wide, sf)
    assert sorted(got.columns) == sorted(wide.columns)
    assert rows(got, small.columns) == rows(run(spark, small, sf), small.columns)
    assert all(r["_kept_id"] == f"_kept_id{'-' if r.doc_id is None else r.doc_id}" for r in got.collect())
