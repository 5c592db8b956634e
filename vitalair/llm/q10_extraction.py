"""op10: main text of web pages by wrapper induction.

The trees of all pages of a host are aligned by simple tree matching into a
wrapper that knows which texts are constant in which slot.  Slots are counted
over all pages by Spark: a frame of the slots in whose texts many pages agree,
then what each page's alignment with the frame holds.  A text is constant by the
share of its slot's pages, if three of the pages that have it are no copies of
each other.  Every page is then aligned with the wrapper: constant texts are
template, inside an article element too, and what varies is the content, without
navigation, notices and other noise in it.
"""

from __future__ import annotations

import json
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalair.llm import wrapper as wr
from vitalair.llm.common import materialise, table
from vitalair.llm.q09_urls import host_and_path

WITNESSES = 12  # pages of a set that are compared first; only where these are copies, all others are, too
TO_BROADCAST = 32_000_000  # characters of all wrappers that are sent to every task; more are joined by host
SALTS = 64  # parts of a host's pages in that join
TREE = "above array<int>, keys array<string>, paths array<long>, at array<int>, texts array<long>"


@lru_cache(maxsize=512)
def _loaded(text: str | None) -> tuple:
    return wr.loaded(text)


def _met(rows: DataFrame, known: DataFrame, by: str, to_broadcast: int) -> DataFrame:
    """Rows with what is known of their host, if anything: text in one column, sent to all tasks or, if it is more, joined in parts of a host."""
    column = next(c for c in known.columns if c != "host")
    if (known.agg(F.sum(F.length(column) + F.length("host"))).first()[0] or 0) <= to_broadcast:
        return rows.join(F.broadcast(known), "host", "left")
    salted = known.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).join(salted.hint("merge"), ["host", "_salt"], "left")


def _outlines(own: DataFrame) -> DataFrame:
    """(host, page, h, tree): the different pages of each host by their slots and texts, each with the least hash of its html."""

    @F.pandas_udf("page long, " + TREE)
    def outline(html):
        return pd.DataFrame([wr.outline(x) for x in html], columns=["page", "above", "keys", "paths", "at", "texts"])

    every = materialise(own.select("host", "h", outline("html").alias("o")).select("host", "h", "o.page", F.struct("o.above", "o.keys", "o.paths", "o.at", "o.texts").alias("tree")), "outlines")
    return materialise(every.groupBy("host", "page").agg(F.min("h").alias("h"), F.any_value("tree").alias("tree")), "pages")


def _frames(pages: DataFrame, to_broadcast: int) -> DataFrame:
    """(host, frame): the slots in whose texts pages of a host agree, with those texts and in the order of the pages.

    LEAST_PAGES must agree, and half of CONSTANT of the pages with the slot, aligned or
    not, so a slot has no more texts than a few pages hold.
    """
    texts = F.arrays_zip(F.transform("tree.at", lambda i: F.get("tree.paths", i)).alias("path"), F.col("tree.texts").alias("text"))
    slots = F.transform("tree.paths", lambda p: F.struct(p.alias("path"), F.lit(None).cast("long").alias("text")))
    counts = pages.select("host", F.explode(F.concat(texts, slots)).alias("t")).groupBy("host", "t.path", "t.text").agg(F.count("*").alias("n"))
    counts = materialise(counts.where(F.col("n") >= wr.LEAST_PAGES), "counts")
    slots = counts.where("text is null").select("host", "path", F.col("n").alias("of"))
    shared = counts.where("text is not null").join(slots, ["host", "path"]).where(F.col("n") >= wr.CONSTANT / 2 * F.col("of"))
    shared = materialise(shared.groupBy("host", "path").agg(F.sort_array(F.collect_list("text")).alias("texts")), "shared")
    wanted = shared.groupBy("host").agg(F.to_json(F.sort_array(F.collect_list("path"))).alias("wanted"))

    @F.pandas_udf("array<struct<path long, up long, key string, before long>>")
    def steps(tree, wanted):
        return pd.Series([wr.steps(a, k, p, _wanted(w)) for a, k, p, w in zip(tree["above"], tree["keys"], tree["paths"], wanted)])

    taken = _met(pages, materialise(wanted, "wanted"), "page", to_broadcast).select("host", F.explode(steps("tree", "wanted")).alias("s"))
    taken = taken.groupBy("host", "s.path", "s.up", "s.key", "s.before").count().groupBy("host").agg(F.collect_list(F.struct("path", "up", "key", "before", "count")).alias("steps"))
    texts = shared.groupBy("host").agg(F.collect_list(F.struct("path", "texts")).alias("own"))

    @F.pandas_udf("string")
    def frame(steps, texts):
        rows = [[(s["path"], s["up"], s["key"], s["before"], s["count"]) for s in own] for own in steps]
        known = [{} if own is None else {t["path"]: [int(x) for x in t["texts"]] for t in own} for own in texts]
        return pd.Series([wr.frame(r, k) for r, k in zip(rows, known)])

    return materialise(taken.join(texts, "host", "left").select("host", frame("steps", "own").alias("frame")), "frames")


@lru_cache(maxsize=512)
def _wanted(text: str | None) -> frozenset:
    return frozenset(json.loads(text)) if text else frozenset()


def _various(sets: DataFrame, members: DataFrame, own: DataFrame) -> DataFrame:
    """(set, n): how many pages of each set (3 at most) are no copies of each other, found by comparing all members with those found before.

    sets: set, n (members); members: set, host, page, h; own: host, h, html.
    """

    def with_html(rows):
        html = own.join(rows.select("host", "h").distinct(), ["host", "h"], "left_semi").groupBy("host", "h").agg(F.min("html").alias("html"))
        return rows.join(html, ["host", "h"])

    @F.pandas_udf("array<string>")
    def different(lists):
        return pd.Series([wr.different(list(x), wr.LEAST_PAGES) for x in lists])

    @F.pandas_udf("boolean")
    def is_copy(html, leaders):
        return pd.Series([wr.is_copy(h, list(x)) for h, x in zip(html, leaders)])

    few = members.groupBy("set", F.pmod("page", F.lit(WITNESSES)).alias("_class")).agg(F.min(F.struct("page", "host", "h")).alias("p")).select("set", "p.*")
    few = with_html(materialise(few, "witnesses")).groupBy("set").agg(F.collect_list("html").alias("html"), F.count("*").alias("seen"))
    found = materialise(few.join(sets, "set").select("set", different("html").alias("leaders"), (F.col("seen") < F.col("n")).alias("more")), "leaders")
    for _ in range(wr.LEAST_PAGES - 1):
        open_ = found.where((F.size("leaders") < wr.LEAST_PAGES) & F.col("more")).select("set", "leaders")
        if not open_.limit(1).count():
            break
        others = with_html(members.join(open_.select("set"), "set")).join(open_, "set").where(~is_copy("html", "leaders"))
        others = others.groupBy("set").agg(F.min_by("html", F.struct("page", "h")).alias("other"))
        found = found.join(others, "set", "left")
        found = materialise(found.select("set", F.when(F.col("other").isNull(), F.col("leaders")).otherwise(F.array_append("leaders", F.col("other"))).alias("leaders"), (F.col("more") & F.col("other").isNotNull()).alias("more")), "leaders")
    return found.select("set", F.size("leaders").alias("different"))


def wrappers(pages: DataFrame, to_broadcast: int = TO_BROADCAST) -> DataFrame:
    """(host, wrapper) of all hosts, counted over all their pages; pages of the same slots and texts count once.

    A text is constant if it is on CONSTANT of the pages whose slot aligns, and
    on LEAST_PAGES pages that are no copies of each other.
    """
    own = pages.where("html is not null and html != '' and host != ''").select("host", F.xxhash64("html").alias("h"), "html")
    outlines = _outlines(own)
    frames = _frames(outlines, to_broadcast)

    @F.pandas_udf("array<struct<path long, text long>>")
    def aligned(tree, frame):
        rows = zip(tree["above"], tree["keys"], tree["paths"], tree["at"], tree["texts"], frame)
        return pd.Series([wr.aligned(a, k, p, i, t, _loaded(f)[1]) for a, k, p, i, t, f in rows])

    met = materialise(_met(outlines, frames, "page", to_broadcast).select("host", "page", "h", aligned("tree", "frame").alias("met")), "aligned")
    met = met.select("host", "page", "h", F.explode("met").alias("m")).select("host", "page", "h", "m.path", "m.text")
    sums = met.groupBy("host", "path", "text").agg(F.count("*").alias("n"), F.sum(F.xxhash64("page").cast("decimal(38,0)")).alias("s"), F.min("page").alias("lo"), F.max("page").alias("hi"))
    sums = materialise(sums.withColumn("set", F.xxhash64("host", "n", "s", "lo", "hi")).select("host", "path", "text", "n", "set"), "sums")
    slots = sums.where("text is null").select("host", "path", F.col("n").alias("of"))
    constant = sums.where(F.col("n") >= wr.LEAST_PAGES).join(slots, ["host", "path"]).where(F.col("n") >= wr.CONSTANT * F.col("of"))
    root = wr.path(None, wr.Node("html").key)
    asked = materialise(constant.where("text is not null").select("host", "path", "text", "n", "set").unionByName(sums.where((F.col("path") == root) & F.col("text").isNull())), "asked")
    # Texts on the same pages are one set; each is followed by one of its texts.
    sets = materialise(asked.groupBy("set").agg(F.min("n").alias("n"), F.min(F.struct("host", "path", "text")).alias("one")), "sets")
    one = sets.select("set", "one.*").withColumnsRenamed({"host": "_host", "path": "_path", "text": "_text"})
    same = (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")) & F.col("text").eqNullSafe(F.col("_text"))
    members = met.join(one, same).select("set", "host", "page", "h")
    judged = asked.join(_various(sets.select("set", "n"), members, own), "set")
    own_n = judged.where("text is null").select("host", F.col("different").alias("n"))
    texts = judged.where(F.col("text").isNotNull() & (F.col("different") >= wr.LEAST_PAGES))
    texts = texts.groupBy("host").agg(F.collect_list(F.struct("path", "text")).alias("constant"))

    @F.pandas_udf("string")
    def wrapper(frame, n, constant):
        out = []
        for f, k, rows in zip(frame, n, constant):
            known: dict[int, set[int]] = {}
            for r in () if rows is None else rows:
                known.setdefault(r["path"], set()).add(r["text"])
            out.append(wr.pruned(f, int(k), known))
        return pd.Series(out)

    return materialise(frames.join(own_n, "host").join(texts, "host", "left").select("host", wrapper("frame", "n", "constant").alias("wrapper")), "wrappers")


def main_texts(pages: DataFrame, to_broadcast: int = TO_BROADCAST) -> DataFrame:
    """page_id, url, text, n_chars for every row.

    Null or empty html gives the empty text. Pages without a host have no
    wrapper; a host with fewer than three different pages (copies are one) has no
    constant texts. Pages nest and reach as far as they do. Repeated rows stay
    repeated; an empty table gives no rows; other columns are ignored.
    """

    @F.pandas_udf("string")
    def text_of(html, wrapper):
        return pd.Series([wr.extract(h, _loaded(w)) for h, w in zip(html, wrapper)])

    host, _ = host_and_path(F.col("url"))
    hosted = pages.select("page_id", "url", "html", host.alias("host"))
    met = _met(hosted, wrappers(hosted, to_broadcast), "html", to_broadcast).select("page_id", "url", text_of("html", "wrapper").alias("text"))
    return met.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))
