"""op4: line dedup on content-defined chunks and word windows of lines, in DataFrame expressions only.

A chunk ends after a line where a rolling hash over it and the line before
takes one of a set of values, so an inserted line moves no boundary beyond its
neighbours.  A line of LONG_WORDS words or more is a passage by itself: a chunk
begins before and ends after it.  A chunk's ends depend on its neighbours, so
windows are taken too: from each line with words the fewest lines after it, and
before it, that hold LONG_WORDS words.  Windows lie over each other and cover
every line of a passage of that many words, whatever its context.  Chunks of
two lines or more, long lines and windows are counted over all documents by
hash; of those that repeat, every occurrence but the first (least doc_id) is
removed, once the bytes of all occurrences have been compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalair.llm.common import materialise, set_apart, table

DIVISOR = 2  # one line in so many ends a chunk
LONG_WORDS = 50
LEAST_CHARS = 40  # shorter chunks stay
TOGETHER = 64  # spans of a text that are cut out of one run of its lines
ROW = ["_id", "_t"]  # a row is known by its doc_id and a hash of its text


def _lines(text: str = "text") -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _let(value: Column, use) -> Column:
    """use(value), with value computed once a row: inside a lambda Spark would compute a column's expression for every element."""
    return F.get(F.transform(F.array(value), use), 0)


def chunk_text(lines: Column, first: Column, last: Column) -> Column:
    """The lines of a span that are not blank; blank ones between them don't count."""
    return F.array_join(F.filter(F.slice(lines, first + 1, last - first + 1), lambda x: x.rlike(r"\S")), "\n")


def _numbered(rows: DataFrame) -> DataFrame:
    """(_id, _t, k, no, h, w, c, begins, ends): lines that are not blank, with their hash, words, characters, and whether a chunk begins or ends there."""
    df = rows.withColumn("_lines", F.transform(_lines(), lambda x, no: F.struct(no.alias("no"), x.alias("x"))))
    df = df.withColumn("_full", F.filter("_lines", lambda x: x["x"].rlike(r"\S")))
    n_words = lambda x: F.size(F.split(F.trim(x), r"\s+"))
    df = df.withColumn("_full", F.transform("_full", lambda x: F.struct(x["no"].alias("no"), F.xxhash64(x["x"]).alias("h"), n_words(x["x"]).alias("w"), F.length(x["x"]).alias("c"))))
    one = lambda k: F.get("_full", k)
    rolled = lambda x, k: F.coalesce(F.pmod(F.xxhash64(one(k - 1)["h"], x["h"]), F.lit(DIVISOR)) == 0, F.lit(False))
    ends = lambda x, k: (k == F.size("_full") - 1) | (x["w"] >= LONG_WORDS) | F.coalesce(one(k + 1)["w"] >= LONG_WORDS, F.lit(False)) | ((k > 0) & rolled(x, k))
    df = df.withColumn("_ends", F.transform("_full", ends))
    out = F.transform("_full", lambda x, k: F.struct(k.alias("k"), x["no"].alias("no"), x["h"].alias("h"), x["w"].alias("w"), x["c"].alias("c"), ((k == 0) | F.get("_ends", k - 1)).alias("begins"), F.get("_ends", k).alias("ends")))
    # The outer form, as for the plain one Spark first filters on the size of an array that it would compute anew for it.
    return df.select(*ROW, F.explode_outer(out).alias("x")).select(*ROW, "x.*").where("h is not null")


def spans(rows: DataFrame) -> DataFrame:
    """(_id, _t, first, last, h): chunks and windows that may go, of rows (_id, _t, text), by first and last line.

    A passage that repeats is made of lines that repeat, so only those are cut
    into spans, stretch by stretch: first each line's hash is counted. Each text
    takes time linear in its lines.
    """
    lines = materialise(_numbered(rows), "lines")
    again = materialise(lines.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "again")
    some = lines.join(again.hint("merge"), "h")
    # Lines that follow each other in the text are one stretch.
    in_order = Window.partitionBy(*ROW).orderBy("k")
    some = some.withColumn("_stretch", F.col("k") - F.row_number().over(in_order))
    some = some.withColumn("to_w", F.sum("w").over(in_order)).withColumn("to_c", F.sum("c").over(in_order))
    line = F.struct("k", "no", "h", "w", "c", "begins", "ends", "to_w", "to_c")
    # A text has no more of them than lines; a stretch that can hold no chunk and no window is left out.
    df = some.groupBy(*ROW, "_stretch").agg(F.array_sort(F.collect_list(line)).alias("_s")).where((F.size("_s") > 1) | (F.get("_s", 0)["w"] >= LONG_WORDS))
    df = df.withColumn("_n", F.size("_s"))
    at = lambda i: F.get("_s", i)
    span = lambda first, last: F.shiftleft(first.cast("long"), 32) + last.cast("long")

    def reach(x: Column, i: Column, n: int) -> Column:  # the next of n lines where the words are enough
        near = F.sequence(i, F.least(i + (n - 1), F.col("_n") - 1))
        return F.get(F.filter(near, lambda j: at(j)["to_w"] - x["to_w"] + x["w"] >= LONG_WORDS), 0)

    def back(x: Column, i: Column, n: int) -> Column:
        near = F.sequence(i, F.greatest(i - (n - 1), F.lit(0)))
        return F.get(F.filter(near, lambda j: x["to_w"] - at(j)["to_w"] + at(j)["w"] >= LONG_WORDS), 0)

    # Few lines are enough nearly always.
    after = F.transform("_s", lambda x, i: span(i, F.coalesce(reach(x, i, 3), reach(x, i, LONG_WORDS))))
    before = F.transform("_s", lambda x, i: span(F.coalesce(back(x, i, 3), back(x, i, LONG_WORDS)), i))
    df = df.withColumn("_heads", F.filter(F.sequence(F.lit(0), F.col("_n") - 1), lambda i: at(i)["begins"]))
    following = lambda q: F.coalesce(F.get("_heads", q + 1), F.col("_n"))
    # A chunk goes from one head to the line before the next one, or to the stretch's last line if it ends there.
    chunks = F.transform("_heads", lambda i, q: F.when((following(q) - 1 > i) & at(following(q) - 1)["ends"] & (at(following(q) - 1)["to_c"] - at(i)["to_c"] + at(i)["c"] >= LEAST_CHARS), span(i, following(q) - 1)))
    every = F.filter(F.concat(chunks, after, before), lambda s: s.isNotNull())
    df = df.withColumn("_spans", F.array_distinct(every))

    def hashed(s: Column, hashes: Column) -> Column:
        first, last = F.shiftright(s, 32).cast("int"), s.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
        return F.struct(at(first)["no"].alias("first"), at(last)["no"].alias("last"), F.xxhash64(F.slice(hashes, first + 1, last - first + 1)).alias("h"))

    found = _let(F.col("_s.h"), lambda hashes: F.transform("_spans", lambda s: hashed(s, hashes)))
    return df.select(*ROW, F.explode_outer(found).alias("s")).select(*ROW, "s.first", "s.last", "s.h").where("h is not null")


def _bodies(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """asked (_id, _t, first, last, h) with the text of each span.

    Spans of a text are taken by runs of TOGETHER, each with only the lines that
    it lies on, so no row carries more of a long text than it needs.
    """
    asks = asked.groupBy(*ROW).agg(F.array_sort(F.collect_set(F.struct("first", "last", "h"))).alias("_asks"))
    met = rows.join(asks.hint("merge"), ROW)

    def run(g: Column, lines: Column) -> Column:
        own = F.slice("_asks", g * TOGETHER + 1, TOGETHER)
        base = own[0]["first"]
        return F.struct(own.alias("own"), base.alias("base"), F.slice(lines, base + 1, F.array_max(F.transform(own, lambda a: a["last"])) - base + 1).alias("lines"))

    runs = _let(_lines(), lambda lines: F.transform(F.sequence(F.lit(0), F.ceil(F.size("_asks") / TOGETHER).cast("int") - 1), lambda g: run(g, lines)))
    runs = met.select(*ROW, F.explode_outer(runs).alias("r")).select(*ROW, "r.base", "r.lines", F.explode_outer("r.own").alias("a"))
    return runs.select(*ROW, "a.first", "a.last", "a.h", chunk_text(F.col("lines"), F.col("a.first") - F.col("base"), F.col("a.last") - F.col("base")).alias("body"))


def _repeats(found: DataFrame) -> DataFrame:
    """Spans whose hash occurs more than once, with the least document that has it."""
    found = materialise(found, "spans")
    homes = found.groupBy("h").agg(F.count("*").alias("n"), F.min("_id").alias("home")).where("n > 1").select("h", "home")
    return materialise(found.join(materialise(homes, "homes"), "h"), "repeats")


def repeated_spans(rows: DataFrame, bits: int = 64) -> DataFrame:
    """(_id, _t, first, last, h, home): spans that occur more than once byte by byte, and the least _id that has each.

    The bytes of all spans of one hash are compared by their least and greatest,
    which tasks sum up before they shuffle, so a passage of very many documents
    is no hot key. Spans of one hash that differ get another hash and are
    compared anew. `bits` of a hash count (fewer in tests).
    """
    cut = lambda h: h.bitwiseAND(F.lit((1 << bits) - 1)) if bits < 64 else h
    asked, sure, again = _repeats(spans(rows).withColumn("h", cut(F.col("h")))), None, 0
    while True:
        bodies = _bodies(rows, asked.select(*ROW, "first", "last", "h"))
        both = bodies.groupBy("h").agg(F.min("body").alias("lo"), F.max("body").alias("hi"))
        same = materialise(both.select("h", (F.col("lo") == F.col("hi")).alias("same")), "same")
        good = asked.join(same.where("same").select("h"), "h", "left_semi").select(*ROW, "first", "last", "h", "home")
        sure = good if sure is None else sure.unionByName(good)
        if not same.where("not same").limit(1).count():
            return sure
        again += 1
        bits = 64
        differ = asked.join(same.where("not same").select("h"), "h", "left_semi").select(*ROW, "first", "last", "h")
        asked = _repeats(_bodies(rows, differ).select(*ROW, "first", "last", F.xxhash64(F.lit(again), "h", "body").alias("h")))


def lost_lines(rows: DataFrame, bits: int = 64) -> DataFrame:
    """(_id, _t, first, last): the lines that go, as runs that do not lie over each other."""
    found = repeated_spans(rows, bits).distinct()
    place = F.struct("first", "last")
    own = found.withColumn("_own", F.min(place).over(Window.partitionBy(*ROW, "h")))
    out = own.where((F.col("_id") != F.col("home")) | (F.col("_own.last") < F.col("first"))).select(*ROW, "first", "last")
    # Runs that lie over each other or inside others become one set of lines.
    past = Window.partitionBy(*ROW).orderBy("first", F.col("last").desc()).rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumn("_to", F.coalesce(F.max("last").over(past), F.lit(-1)))
    return out.where("last > _to").select(*ROW, F.greatest("first", F.col("_to") + 1).alias("first"), "last")


def deduplicated(docs: DataFrame, bits: int = 64) -> DataFrame:
    """All rows and columns of docs, with the lines of repeated chunks and windows taken out of `text`, and n_removed (lines).

    Rows of one doc_id count as one document: a chunk of the least doc_id stays in
    each of them, but only once in a text; what overlaps it there is no repeat of
    it. Rows without doc_id and null texts stay as they are; a text whose every
    chunk repeats becomes empty; repeated rows stay repeated; an empty table gives
    no rows; a column n_removed of docs is replaced, other columns stay. Texts of
    any length are handled in time linear in their lines.
    """
    docs, names = set_apart(docs.drop("n_removed"), "doc_id", "text")
    columns = docs.columns
    known = docs.where("doc_id is not null").select(*columns, F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_t"))
    gone = lost_lines(known.select(*ROW, "text").where("text is not null"), bits)
    gone = materialise(gone.groupBy(*ROW).agg(F.collect_list(F.struct("first", "last")).alias("_gone")), "gone")
    met = known.join(gone.hint("merge"), ROW, "left").withColumn("_lines", F.when(F.col("_gone").isNotNull(), _lines()))
    every = F.sequence(F.lit(0), F.size("_lines") - 1)
    lost = F.flatten(F.transform("_gone", lambda g: F.sequence(g["first"], g["last"])))
    met = met.withColumn("_keep", F.when(F.col("_gone").isNotNull(), F.array_except(every, lost)))
    body = F.array_join(F.transform("_keep", lambda i: F.get("_lines", i)), "\n")
    n_removed = F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_lines") - F.size("_keep")).alias("n_removed")
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(body).alias("text")
    out = met.select(*[text if c == "text" else F.col(c) for c in columns], n_removed)
    rest = docs.where("doc_id is null").select(*columns, F.lit(0).alias("n_removed"))
    return out.unionByName(rest).withColumnsRenamed(names)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.col("n_removed").cast("long"), "text")
