"""op7: quality scores learnt from preference pairs (Bradley-Terry).

Each text becomes a short vector of surface features.  Of a bounded sample of
labelled rows, every pair of a better and a worse text says that the better
one's score is higher; a linear score is fitted by logistic loss on feature
differences.  The cut is a quantile of the sample's scores, the one with the
fewest wrong decisions, and scores are moved so that the cut lies at 0.3.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from vitalair.llm.common import materialise, table

SAMPLE_ROWS = 20_000  # labelled rows that are fitted on, at most (expected number)
PAIRS = 100_000
CUT = 0.3
NAMES = [
    "log_words", "mean_word", "upper", "symbols", "digits", "distinct", "repeats", "same_lines", "line_words", "stops", "packed",
    "ends", "marked", "bars", "longest", "top_word", "links", "short_lines", "empty",
]
SYMBOLS = re.compile(r"[#$%&*!|<>{}\[\]@^~=+\\_]")


def features(text: str | None) -> list[float]:
    """NAMES of one whole text; null counts as empty."""
    t = text or ""
    words = t.split()
    n, size = len(words), max(len(t), 1)
    if not n:
        return [0.0] * (len(NAMES) - 1) + [1.0]
    letters = sum(map(str.isalpha, t)) or 1
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in t.split("\n") if x.strip()] or [t]
    data = t.encode()
    return [
        math.log(n), min(size / n, 30), sum(map(str.isupper, t)) / letters, len(SYMBOLS.findall(t)) / size, sum(map(str.isdigit, t)) / size,
        len(counts) / n ** 0.8, sum(a == b for a, b in zip(words, words[1:])) / n, 1 - len(set(lines)) / len(lines), math.log(n / len(lines)),
        sum(w[-1] in ".!?" for w in words) / n, len(zlib.compress(data, 1)) / (len(data) + 50) ** 0.95,
        float(t.rstrip()[-1:] in ".!?\"'"), sum(not w[-1].isalnum() and w[-1] not in ".,;:!?" for w in words) / n, t.count("|") / n,
        math.log(max(map(len, words))), max(counts.values()) / n, (t.count("http") + t.count("www.")) / n, sum(len(x) < 20 for x in lines) / len(lines), 0.0,
    ]


def feature_table(docs: DataFrame) -> DataFrame:
    """(doc_id, x array<double>) per row."""

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "x": [features(t) for t in pdf["text"]]})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, x array<double>")


def held_out(doc_id: Column) -> Column:
    """Rows that take no part in learning: crc32 of the id as text leaves no rest by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """Weights, their centres and scales, and the quantile cut; without both labels every text passes."""
    if not len(x) or len(set(y.tolist())) < 2:
        k = len(NAMES)
        return {"centre": np.zeros(k), "scale": np.ones(k), "w": np.zeros(3 * k), "cut": -1.0, "steep": 1.0}
    centre, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    expand = lambda z: np.concatenate([z, z * z, np.maximum(z - 1, 0)], axis=1)
    z = expand(np.clip((x - centre) / scale, -5, 5))
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    rng = np.random.default_rng(11)
    n = min(PAIRS, len(good) * len(bad))
    d = z[rng.choice(good, n)] - z[rng.choice(bad, n)]
    w = np.zeros(d.shape[1])
    for _ in range(25):  # Newton steps on the pairs' logistic loss
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        grad = -d.T @ p / n + 1e-3 * w
        hess = (d * (p * (1 - p))[:, None]).T @ d / n + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    s = z @ w
    cuts = np.quantile(s, np.linspace(0.0, 0.6, 241))
    order = np.sort(s[bad])
    wrong = np.searchsorted(np.sort(s[good]), cuts) + len(bad) - np.searchsorted(order, cuts)
    cut = float(cuts[int(np.argmin(wrong))])
    return {"centre": centre, "scale": scale, "w": w, "cut": cut, "steep": 1.0 / max(float(s.std()) / 2, 1e-9)}


def sample_of(labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(_id, quality) of labelled rows that aren't held out: all, or about `sample_rows` of them by a hash of doc_id."""
    known = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("_id"), "quality").distinct()
    chance = min(1.0, sample_rows / max(known.count(), 1))
    return known.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(chance * 1_000_000))


def learn(x: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict:
    """Fit on the sample of labelled rows, one row an id: the driver gets about `sample_rows` vectors at most."""
    known = sample_of(labels, sample_rows)
    # One row an id (the least), so that an id which very many rows share is one row on the driver too.
    least = x.join(known, x.doc_id == F.col("_id")).groupBy("_id").agg(F.min(F.struct("quality", "x")).alias("r")).select("_id", "r.*")
    rows = sorted(least.collect(), key=lambda r: r["_id"])
    return fit(np.array([r["x"] for r in rows]).reshape(-1, len(NAMES)), np.array([r["quality"] for r in rows]))


def score_of(x: Column, model: dict) -> Column:
    """The score of a feature vector as an expression, 0 to 1."""
    k = len(NAMES)
    w = model["w"]
    z = [F.greatest(F.least((x[i] - float(model["centre"][i])) / float(model["scale"][i]), F.lit(5.0)), F.lit(-5.0)) for i in range(k)]
    total = F.lit(0.0)
    for i in range(k):
        total = total + z[i] * (float(w[i]) + z[i] * float(w[k + i])) + F.greatest(z[i] - 1.0, F.lit(0.0)) * float(w[2 * k + i])
    shift = math.log(CUT / (1 - CUT))
    return 1.0 / (1.0 + F.exp(-((total - model["cut"]) * model["steep"] + shift + 1e-12)))


def scored(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row.

    Null and empty texts are scored by the same features; rows without doc_id are
    scored and not held out; repeated rows stay repeated; without labels of both
    kinds every text passes; very long texts are measured whole; an empty table
    gives no rows; other columns are ignored.
    """
    x = materialise(feature_table(docs), "features")
    model = learn(x, labels, sample_rows)
    out = x.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_of(F.col("x"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


@F.pandas_udf(ArrayType(DoubleType()))
def _vector(texts: pd.Series) -> pd.Series:
    return texts.map(features)


def passing(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Rows of docs, with all their columns, whose own score reaches the cut: one pass that shuffles no text.

    The scores are those of `scored`; so is what holds for nulls, empty texts,
    repeated rows, missing labels and empty tables.
    """
    # About `sample_rows` ids at most are sent to all tasks.
    ids = F.broadcast(sample_of(labels, sample_rows).select("_id").distinct())
    own = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("_id"), "left_semi")
    model = learn(feature_table(own), labels, sample_rows)
    return docs.where(score_of(_vector(F.col("text")), model) >= CUT)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
