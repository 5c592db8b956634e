"""op12: target-distribution importance resampling on hashed n-grams.

Separators are collapsed to single spaces; a regular expression with lookarounds
at word boundaries, matched with overlapped=True, gives the n-grams as spans,
which go straight to CRC-32.  Buckets of all documents and of the target (the
benchmark) are counted; a bucket's gain is the logarithm of the ratio of its
shares.  A document's weight is the mean of its gains, Gumbel noise from its id
makes the highest scores a draw without replacement.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from vitalair.llm.common import WORD_TABLE, materialise, table
from vitalair.operators.binning import ranked

SEED, BUCKETS, LONGEST = 2024, 10_000, 1
LEAST_WORDS, PERCENT = 20, 10


def patterns(longest: int = LONGEST) -> list[regex.Pattern]:
    """One pattern for each number of words: whole words between single spaces."""
    return [regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % n) for n in range(longest)]


def collapsed(text: str | None) -> bytes:
    """Lower-cased (A-Z only) words as UTF-8 with one space between them."""
    return b" ".join(text.encode().translate(WORD_TABLE).split()) if text else b""


def features(words: bytes, grams: list[regex.Pattern], buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of every n-gram, repeats included."""
    crc = zlib.crc32
    return np.concatenate([np.fromiter((crc(m[0]) for m in g.finditer(words, overlapped=True)), dtype=np.uint32) for g in grams]) % buckets


def featured(docs: DataFrame, keys: list[str], longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """keys, n_words and the buckets of each text's n-grams, stored."""

    def run(batches):
        grams = patterns(longest)
        for pdf in batches:
            words = [collapsed(t) for t in pdf["text"]]
            own = pdf[keys].astype("Int64") if keys else pdf[[]].copy()
            yield own.assign(n_words=[w.count(b" ") + 1 if w else 0 for w in words], buckets=[features(w, grams, buckets).astype(np.int32) for w in words])

    schema = ", ".join([*(f"{k} long" for k in keys), "n_words long", "buckets array<int>"])
    return materialise(docs.select(*keys, "text").mapInPandas(run, schema), "features")


def counts(featured: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket; the driver gets one row a bucket at most."""
    out = np.zeros(buckets, dtype=np.int64)
    for r in featured.select(F.explode("buckets").alias("b")).groupBy("b").count().collect():
        out[r["b"]] = r["count"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets)))) of each bucket."""
    k = float(len(source))
    return np.floor(1000 * np.log((target + 1.0) * (source.sum() + k) / ((source + 1.0) * (target.sum() + k)))).astype(np.int64)


def resampled(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED, least: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null where not drawn) of every row.

    Null and empty texts have no features and weight 0; a null doc_id has the noise
    of an empty id and comes last among ties; repeated rows count and are drawn each
    for itself; texts of any length are scanned whole; an empty target leaves the
    gains to the documents' own counts; no documents give no rows; other columns
    are ignored.
    """
    found = featured(docs, ["doc_id"], longest, buckets)
    gain = gains(counts(found, buckets), counts(featured(target, [], longest, buckets), buckets))

    @F.pandas_udf(LongType())
    def weight(own: pd.Series) -> pd.Series:
        return own.map(lambda b: int(gain[b].sum()) // len(b) if len(b) else 0)

    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    scored = found.select("doc_id", "n_words", F.size("buckets").cast("long").alias("n_features"), weight("buckets").alias("weight"))
    scored = materialise(scored.withColumn("score", F.col("weight") + noise), "scores")
    drawn = scored.where(F.col("n_words") >= least).count() * percent // 100
    order = ranked(scored.where(F.col("n_words") >= least), [F.desc("score"), F.asc_nulls_last("doc_id")], "rank").withColumn("rank", F.col("rank") + 1)
    rest = scored.where(F.col("n_words") < least).withColumn("rank", F.lit(None).cast("long"))
    every = order.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long")).unionByName(rest)
    return every.select("doc_id", "n_features", "weight", "score", "rank")


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: CRC-32 of a text in SQL: the usual table of 256 entries in one row, then a fold over the bytes.
CRC_TABLE = "crc AS (SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) r(i)))"


def crc_sql(text: str) -> str:
    digits = f"hex(encode({text}))"
    byte = f"list_transform(range(1, length({digits}), 2), lambda p: ('0x' || substr({digits}, p, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {byte}), lambda c, b: xor(c // 256, tab[xor(c % 256, b) + 1])), 4294967295)"


def _words_sql(column: str) -> str:
    return rf"regexp_extract_all(translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


SQL = f"""WITH {CRC_TABLE}, w AS (SELECT doc_id, unnest({_words_sql('text')}) AS word FROM documents), x AS (SELECT unnest({_words_sql('text')}) AS word FROM benchmark),
v AS (SELECT word, {crc_sql('word')} % 10000 AS b FROM (SELECT word FROM w UNION SELECT word FROM x), crc),
s AS (SELECT b, count(*) AS s FROM w JOIN v USING (word) GROUP BY 1), t AS (SELECT b, count(*) AS t FROM x JOIN v USING (word) GROUP BY 1),
g AS (SELECT b, floor(1000*ln((coalesce(t,0)+1)::DOUBLE*((SELECT count(*) FROM w)+10000)/((coalesce(s,0)+1)::DOUBLE*((SELECT count(*) FROM x)+10000))))::BIGINT AS gain FROM s FULL JOIN t USING (b)),
d AS (SELECT doc_id, count(*) AS n, floor(sum(gain)/count(*))::BIGINT AS weight FROM w JOIN v USING (word) JOIN g USING (b) GROUP BY 1),
e AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000*ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)/4294967296::DOUBLE)))::BIGINT AS score FROM documents LEFT JOIN d USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS many FROM e WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10*many//100 THEN rank END AS rank FROM e LEFT JOIN r USING (doc_id)"""
