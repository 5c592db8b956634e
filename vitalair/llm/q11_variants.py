"""op11: spelling variants of words by asymmetric q-chunks.

A word of length L contributes two disjoint chunks of q = L div 2 letters, at
places 0 and q.  The other word, as long or one letter longer, contributes its
positional q-grams for either length.  One edit leaves one of the chunks whole
and moves it by one place at most, so two near words meet on (length, chunk,
gram) within a shift of one.  What meets is verified by the edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalair.llm.common import materialise, table
from vitalair.llm.q12_resampling import CRC_TABLE, crc_sql

RUN = re.compile("[a-zÀ-ÿ]+")
SPARED, LEAST_CHARS, LEAST_COUNT, FACTOR = 199, 6, 5, 5


def words_of(doc_id: int | None, text: str | None) -> Counter:
    """Counts of a text's words of at least LEAST_CHARS letters, after the letter that h % length names is taken out where 199 divides h."""
    out: Counter = Counter()
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall(text.encode().lower().decode()) if text else ()).items():  # bytes.lower() changes A-Z only
        if len(run) >= LEAST_CHARS:
            h = zlib.crc32(run.encode(), start)
            if h % SPARED == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
                if len(run) < LEAST_CHARS:
                    continue
            out[run] += n
    return out


def vocabulary(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of words with at least that many occurrences over all texts, stored; counts are summed up in each task first."""

    def run(batches):
        for pdf in batches:
            seen: Counter = Counter()
            for i, t in zip(pdf["doc_id"].astype("Int64"), pdf["text"]):
                seen.update(words_of(None if i is pd.NA else int(i), t))
            if seen:
                yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})

    counted = docs.select("doc_id", "text").mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return materialise(counted.where(F.col("n") >= least), "words")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b): words that differ by exactly one inserted, deleted or replaced letter, each pair once with a not longer than b."""
    w, size = F.col("word"), F.length("word")
    at = lambda q, k: (q * k).cast("int")
    q = F.floor(size / 2)
    chunks = F.array(*[F.struct(size.cast("int").alias("size"), F.lit(k).alias("k"), F.substring(w, at(q, k) + 1, q.cast("int")).alias("gram")) for k in (0, 1)])
    chunked = words.select(w.alias("a"), F.explode(chunks).alias("c")).select("a", "c.*")
    grams = []
    for less in (0, 1):  # b is as long as a, or one letter longer
        q = F.floor((size - less) / 2)
        for k in (0, 1):
            for shift in ((0, 1) if less else (0,)) if k else (0,):  # nothing moves to the left, and nothing at all between equal lengths
                grams.append(F.struct((size - less).cast("int").alias("size"), F.lit(k).alias("k"), F.substring(w, at(q, k) + shift + 1, q.cast("int")).alias("gram")))
    gramed = words.select(w.alias("b"), F.explode(F.array_distinct(F.array(*grams))).alias("c")).select("b", "c.*")
    met = chunked.join(gramed, ["size", "k", "gram"]).where((F.length("b") > F.col("size")) | (F.col("a") < F.col("b")))
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "b").distinct()


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """word, n, form, form_n, n_near, root of a vocabulary (word, n).

    The form is the near word of largest n (ties: the least in code-point order) if
    that is at least factor times the word's n. Each step to a form multiplies n by
    the factor, so following forms by doubling ends after a few joins.
    """
    pairs = materialise(near_pairs(words.select("word")), "near-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).unionAll(pairs.select("b", "a"))
    ranked = both.join(words.withColumnsRenamed({"word": "other", "n": "other_n"}), "other")
    best = ranked.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    own = words.join(best, "word", "left").withColumn("more", -F.col("best.less"))
    formed = own.withColumn("form", F.when(F.col("more") >= factor * F.col("n"), F.col("best.other")))
    formed = materialise(formed.select("word", "n", "form", F.when(F.col("form").isNotNull(), F.col("more")).alias("form_n"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")), "forms")
    steps = materialise(formed.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialise(steps.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if not moved.where("moved").limit(1).count():
            return formed.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))
        steps = moved.drop("moved")


def spelling_variants(docs: DataFrame, least: int = LEAST_COUNT, factor: int = FACTOR) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words of all texts.

    Null and empty texts have no words; a null doc_id counts as an empty one;
    repeated rows count each; texts of any length are read whole; no documents give
    no rows; other columns are ignored.
    """
    return variants(vocabulary(docs, least), factor).select("word", "form", "root", "n", "n_near", "form_n")


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


SQL = f"""WITH RECURSIVE {CRC_TABLE}, t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
c AS (SELECT doc_id, run, count(*) AS n FROM t WHERE length(run) >= 6 GROUP BY ALL),
h AS (SELECT run, n, {crc_sql("doc_id || ':' || run")} AS h FROM c, crc),
o AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM h),
v AS (SELECT word, sum(n)::BIGINT AS n FROM o WHERE length(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
x AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (SELECT a.word AS a, b.word AS b FROM x a JOIN x b ON a.i = b.i AND a.rest = b.rest AND a.word != b.word UNION SELECT x.word, v.word FROM x JOIN v ON x.rest = v.word UNION SELECT v.word, x.word FROM x JOIN v ON x.rest = v.word),
f AS (SELECT a AS word, count(*) AS n_near, arg_min(b, (-n, encode(b))) AS best, max(n) AS m FROM p JOIN v ON v.word = b GROUP BY 1),
g AS (SELECT word, n, CASE WHEN m >= 5 * n THEN best END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n, coalesce(n_near, 0) AS n_near FROM v LEFT JOIN f USING (word)),
r AS (SELECT word, word AS root FROM g WHERE form IS NULL UNION ALL SELECT g.word, r.root FROM g JOIN r ON g.form = r.word)
SELECT word, form, root, n, n_near, form_n FROM g JOIN r USING (word)"""
