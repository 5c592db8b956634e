"""op9: URL filters: explicit rules first, then gradient-boosted trees on lexical features.

The URLs that a rule decides are the labelled ones; trees learnt from a bounded
sample of them judge the rest.  Everything is DataFrame expressions and
pyspark.ml, so scoring runs in the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalair.llm.common import ascii_lower, materialise, table

#: Fixed values of the contract: (verdict, rule).
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]

SAMPLE_ROWS = 20_000  # labelled URLs that the trees are fitted on, at most (expected number)
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0123456789-._~/?=&%#:+"
FEATURES = ["length", "host_length", "depth", "digits", "entropy", "parameters", "labels", "hyphens", "suffix_rate", "suffix_share"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first `://` (A-Z lower-cased) and the path after it; empty where there is none."""
    host = ascii_lower(F.regexp_extract(url, "://([^/?#]*)", 1))
    path = F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, else null."""
    rule = verdict = None
    for v, r in sorted(rules, key=lambda x: -len(x[1])):
        h, p = r.split("/", 1)
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(f"/{p}")
        rule = F.when(fits, r) if rule is None else rule.when(fits, r)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return rule, verdict


def lexical(urls: DataFrame) -> DataFrame:
    """Add the lexical features of `url`, `host` and `path`, and the host's suffix."""
    u = F.lower(F.coalesce("url", F.lit("")))
    n = F.greatest(F.length(u), F.lit(1))
    count = lambda c: F.length(u) - F.length(F.replace(u, F.lit(c)))
    share = lambda c: count(c) / n
    entropy = reduce(lambda a, b: a + b, [F.when(share(c) > 0, -share(c) * F.log2(share(c))).otherwise(0.0) for c in SYMBOLS])
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    return urls.select(
        "*",
        F.length(u).cast("double").alias("length"),
        F.length("host").cast("double").alias("host_length"),
        (F.size(F.split("path", "/")) - 1).cast("double").alias("depth"),
        (F.length(u) - F.length(F.regexp_replace(u, "[0-9]", ""))).cast("double").__truediv__(n).alias("digits"),
        entropy.alias("entropy"),
        F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")).alias("parameters"),
        F.size(F.split("host", r"\.")).cast("double").alias("labels"),
        count("-").cast("double").alias("hyphens"),
        F.substring_index("host", ".", -1).alias("suffix"),
    )


def judged(pages: DataFrame, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """page_id, host, path, rule, verdict, block_score for every row.

    block_score is the trees' probability of a block (null where a rule decides).
    Where labelled URLs are missing or all alike there is nothing to learn and the
    method allows. Null URLs and URLs without `://` have empty host and path and
    are judged by the method; very long URLs are judged whole; repeated rows stay
    repeated; other columns are ignored, whatever their names; an empty table gives
    no rows.
    """
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    urls = urls.select("*", rule.alias("rule"), verdict.alias("given"))
    n = urls.where("rule is not null").count()
    chance = min(1.0, sample_rows / max(n, 1))
    taken = urls.where("rule is not null").where(F.pmod(F.xxhash64("url"), F.lit(1_000_000)) < int(chance * 1_000_000))
    taken = materialise(lexical(taken.select("url", "host", "path", (F.col("given") == "block").cast("double").alias("label"))), "labelled-urls")
    rates = taken.groupBy("suffix").agg(((F.sum("label") + 1) / (F.count("*") + 2)).alias("suffix_rate"), F.count("*").alias("_n"))
    total, classes = taken.agg(F.count("*"), F.count_distinct("label")).first()
    if classes < 2:
        return urls.select("page_id", "host", "path", "rule", F.coalesce("given", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("block_score"))
    rates = rates.select("suffix", "suffix_rate", (F.col("_n") / total).alias("suffix_share"))  # no more suffixes than the sample has rows

    def vectors(df: DataFrame) -> DataFrame:
        df = df.join(F.broadcast(rates), "suffix", "left").fillna({"suffix_rate": 0.5, "suffix_share": 0.0})
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)

    model = GBTClassifier(maxIter=12, maxDepth=4, stepSize=0.2, seed=7, maxBins=32).fit(vectors(taken).select("features", "label"))
    # One pass over all rows; where a rule fits, it wins.
    out = model.transform(vectors(lexical(urls)))
    free = F.col("rule").isNull()
    verdict = F.when(~free, F.col("given")).when(F.col("prediction") == 1.0, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.when(free, vector_to_array("probability")[1]).alias("block_score"))


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")
