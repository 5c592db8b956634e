"""op5: chat formatting by quotation linking, in DataFrame expressions only.

A line that begins with one or more `>` is quoted at that level; a run of lines
of one level is a passage, and so is each of its lines.  Passages are normalised
and hashed by their first one, two, four or eight lines, and joined to the
places where messages hold such lines unquoted; there the whole passage is then
compared, byte by byte.  Its source is the latest earlier turn of the same
conversation that holds it, else the first message of another conversation.  A
message replies to the source of its shallowest, then longest quote.  Replies
give each message a root, a depth and a place in its thread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalair.llm.common import materialise, table

MARK = r"^((?:[ \t]*>)+)"
NEWLINE = "\r?\n"
WINDOWS = (1, 2, 4, 8)  # lines that a passage is first found by: as many of them as it has
MESSAGE = ["conv_id", "turn", "_t"]  # a message is known by its place and a hash of its text


def _line(x: Column) -> Column:
    """struct(level, body) of one line: how deep it is quoted, and what it says, normalised."""
    mark = F.regexp_extract(x, MARK, 1)
    body = F.lower(F.trim(F.regexp_replace(F.regexp_replace(x, MARK, ""), r"\s+", " ")))
    return F.struct((F.length(mark) - F.length(F.replace(mark, F.lit(">")))).alias("level"), body.alias("body"))


def _parsed(messages: DataFrame) -> DataFrame:
    """Add `_lines`: array<struct<level, body>> of the lines that aren't blank, normalised."""

    known = messages.where("conv_id is not null and turn is not null and text is not null").select("conv_id", "turn", F.xxhash64("text").alias("_t"), "text")
    return known.withColumn("_lines", F.filter(F.transform(F.split("text", NEWLINE), _line), lambda x: x["body"] != ""))


def _let(value: Column, use) -> Column:
    """use(value), with value computed once a row."""
    return F.get(F.transform(F.array(value), use), 0)


def _key(hashes: Column, at: Column, n: int) -> Column:
    return F.xxhash64(F.lit(n), F.slice(hashes, at + 1, n))


def passages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, n_lines, window, key, body) of all quoted passages."""
    df = _parsed(messages.where(F.col("text").rlike("(?m)" + MARK)))
    at = lambda i: F.get("_lines", i)
    bounds = F.filter(F.sequence(F.lit(0), F.size("_lines")), lambda i: (i == 0) | (i == F.size("_lines")) | (at(i)["level"] != at(i - 1)["level"]))
    df = df.where(F.size("_lines") > 0).withColumn("_bounds", bounds)
    runs = _let(F.col("_bounds"), lambda b: F.transform(F.sequence(F.lit(0), F.size(b) - 2), lambda q: F.struct(b[q].alias("first"), (b[q + 1] - b[q]).alias("n"))))
    runs = F.filter(runs, lambda r: at(r["first"])["level"] > 0)
    lines = F.transform(F.filter(F.sequence(F.lit(0), F.size("_lines") - 1), lambda i: at(i)["level"] > 0), lambda i: F.struct(i.alias("first"), F.lit(1).alias("n")))
    df = df.withColumn("_spans", F.concat(F.filter(runs, lambda r: r["n"] > 1), lines))

    def passage(r: Column, bodies: Column) -> Column:
        own = F.slice(bodies, r["first"] + 1, r["n"])
        return F.struct(at(r["first"])["level"].alias("level"), r["n"].alias("n_lines"), own.alias("own"))

    found = _let(F.col("_lines.body"), lambda bodies: F.transform("_spans", lambda r: passage(r, bodies)))
    df = df.select("conv_id", "turn", F.explode_outer(found).alias("p")).where("p is not null").select("conv_id", "turn", "p.*")
    hashes = F.transform("own", lambda x: F.xxhash64(x))
    key, window = F.lit(None).cast("long"), F.lit(None).cast("int")
    for n in WINDOWS:
        key, window = F.when(F.col("n_lines") >= n, _key(hashes, F.lit(0), n)).otherwise(key), F.when(F.col("n_lines") >= n, n).otherwise(window)
    return df.select("conv_id", "turn", "level", "n_lines", window.alias("window"), key.alias("key"), F.array_join("own", "\n").alias("body"))


def _sources(messages: DataFrame, wanted: DataFrame) -> DataFrame:
    """(conv_id, turn, h, body): messages that hold a wanted passage (key, window, n_lines, h, body) unquoted."""
    used = {r["window"] for r in wanted.select("window").distinct().collect()}  # some of WINDOWS
    if not used:
        return messages.sparkSession.createDataFrame([], messages.select("conv_id", "turn").schema).select("conv_id", "turn", F.lit(0).cast("long").alias("h"), F.lit("").alias("body")).limit(0)
    df = _parsed(messages).withColumn("_own", F.transform(F.filter("_lines", lambda x: x["level"] == 0), lambda x: x["body"])).drop("_lines", "text")
    ends = lambda n: F.filter(F.sequence(F.lit(0), F.size("_own") - 1), lambda i: i + n <= F.size("_own"))
    of = lambda hashes, n: F.transform(ends(n), lambda i: F.struct(i.alias("at"), _key(hashes, i, n).alias("key")))
    keys = lambda hashes: F.concat(*[of(hashes, n) for n in WINDOWS if n in used])
    places = df.where(F.size("_own") > 0).select(*MESSAGE, F.explode_outer(_let(F.transform("_own", lambda x: F.xxhash64(x)), keys)).alias("k")).select(*MESSAGE, "k.at", "k.key")
    lengths = wanted.select("key", "n_lines").distinct()
    met = places.join(lengths.hint("merge"), "key")
    # No more entries than the text has places, times the lengths of passages that begin alike.
    asks = materialise(met.groupBy(*MESSAGE).agg(F.collect_set(F.struct("at", "n_lines", "key")).alias("_asks")), "asks")
    held = df.join(asks.hint("merge"), MESSAGE)
    cut = _let(F.col("_own"), lambda own: F.transform("_asks", lambda a: F.struct(a["key"].alias("key"), F.array_join(F.slice(own, a["at"] + 1, a["n_lines"]), "\n").alias("body"))))
    bodies = held.select("conv_id", "turn", F.explode_outer(cut).alias("b")).select("conv_id", "turn", "b.key", "b.body").withColumn("h", F.xxhash64("body")).distinct()
    same = wanted.select("key", "h", "body").hint("merge")
    return bodies.join(same, ["key", "h", "body"]).select("conv_id", "turn", "h", "body")


def links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, n_lines, h, body, from_conv, from_turn): the quoted passages that have a source, stored."""
    quoted = materialise(passages(messages).withColumn("h", F.xxhash64("body")).distinct(), "quoted")
    wanted = materialise(quoted.select("key", "window", "n_lines", "h", "body").distinct(), "wanted")
    held = materialise(_sources(messages, wanted).distinct(), "sources")
    # In the same conversation: the last one before, as rows of one passage stand in the order of their turns.
    asks = quoted.select("conv_id", "turn", "h", "body", "level", "n_lines", F.lit(None).cast("long").alias("said"), F.lit(0).alias("_source"))
    said = held.select("conv_id", "turn", "h", "body", F.lit(None).cast("int").alias("level"), F.lit(None).cast("int").alias("n_lines"), F.col("turn").cast("long").alias("said"), F.lit(1).alias("_source"))
    before = Window.partitionBy("conv_id", "h", "body").orderBy("turn", "_source").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = asks.unionByName(said).withColumn("near_turn", F.last("said", ignorenulls=True).over(before)).where("_source = 0").drop("said", "_source")
    # Elsewhere: the first message of the two least conversations, so that one is not the quoting one.
    one = materialise(held.groupBy("h", "body").agg(F.min(F.struct("conv_id", "turn")).alias("a")), "least")
    two = held.join(one.hint("merge"), ["h", "body"]).where("conv_id != a.conv_id").groupBy("h", "body").agg(F.min(F.struct("conv_id", "turn")).alias("b"))
    far = materialise(one.join(two.hint("merge"), ["h", "body"], "left"), "far")
    found = near.join(far.hint("merge"), ["h", "body"], "left")
    other = F.when(F.col("a.conv_id") != F.col("conv_id"), F.col("a")).otherwise(F.col("b"))
    is_near = F.col("near_turn").isNotNull()
    from_conv = F.when(is_near, F.col("conv_id")).otherwise(other["conv_id"])
    found = found.select("conv_id", "turn", "level", "n_lines", "h", "body", from_conv.alias("from_conv"), F.when(is_near, F.col("near_turn")).otherwise(other["turn"]).alias("from_turn")).where("from_turn is not null")
    return materialise(found, "links")


def parents(found: DataFrame) -> DataFrame:
    """(conv_id, turn, from_conv, from_turn, n_quotes) of each message with links; n_quotes counts different quoted lines with a source."""
    best = F.struct(F.when(F.col("from_conv") == F.col("conv_id"), 0).otherwise(1), "level", (-F.col("n_lines")).alias("size"), (-F.col("from_turn")).alias("late"), "from_conv")
    first = found.groupBy("conv_id", "turn").agg(F.min(best).alias("b"), F.count_if(F.col("n_lines") == 1).alias("n_quotes"))
    return first.select("conv_id", "turn", F.col("b.from_conv").alias("from_conv"), (-F.col("b.late")).alias("from_turn"), "n_quotes")


def threads(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, root_turn, depth) of messages that reply within their conversation, by doubling the steps to the root."""
    step = materialise(replies.where("from_conv = conv_id").select("conv_id", "turn", F.col("from_turn").alias("root_turn"), F.lit(1).alias("depth")), "steps")
    while step.limit(1).count():
        up = step.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("next"), F.col("depth").alias("more"))
        joined = step.join(up, ["conv_id", "root_turn"], "left")
        moved = materialise(joined.select("conv_id", "turn", F.coalesce("next", "root_turn").alias("root_turn"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("next").isNotNull().alias("moved")), "steps")
        step = moved.drop("moved")
        if not moved.where("moved").limit(1).count():
            break
    return step


def without_quotes(messages: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, turn, _t, clean): texts of messages with links, without the quoted lines that have a source and without empty quoted lines; other quotes stay."""
    gone = found.where("n_lines = 1").select("conv_id", "turn", "body", F.lit(True).alias("_gone")).distinct()
    texts = messages.where(F.col("text").rlike("(?m)" + MARK)).select("conv_id", "turn", F.xxhash64("text").alias("_t"), "text").distinct()
    texts = texts.join(gone.select("conv_id", "turn").distinct().hint("merge"), ["conv_id", "turn"], "left_semi")
    lines = texts.select(*MESSAGE, F.posexplode(F.split("text", NEWLINE)).alias("at", "line")).withColumn("l", _line(F.col("line"))).select(*MESSAGE, "at", "line", "l.*")
    quoted = lines.where("level > 0 and body != ''").join(gone.hint("merge"), ["conv_id", "turn", "body"], "left").where("_gone is null")
    kept = lines.where("level = 0").select(*MESSAGE, "at", "line").unionByName(quoted.select(*MESSAGE, "at", "line"))
    joined = kept.groupBy(*MESSAGE).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n").alias("clean"))
    return texts.select(*MESSAGE).join(joined.hint("merge"), MESSAGE, "left").select(*MESSAGE, F.trim(F.coalesce("clean", F.lit(""))).alias("clean"))


def reply_ordered(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text without linked quotes, reply_conv, reply_turn, root_turn, depth, place, n_quotes for every row.

    Quoted lines go only where they have a source; others, in a message with links
    or without, are part of the text. A message without a linked quote is its own
    root at depth 0. place counts the
    messages of a thread (conv_id, root_turn) from 0, replies after what they reply
    to: order by conv_id, root_turn, place to read a conversation. Rows with equal
    conv_id and turn share their links; null texts become empty; rows without
    conv_id or turn have no links and place 0; quotes of any length and messages of
    any number of lines are handled whole; an empty table gives no rows; other
    columns are ignored.
    """
    found = links(messages)
    replies = materialise(parents(found), "replies")
    known = materialise(replies.join(threads(replies), ["conv_id", "turn"], "left"), "threads")
    clean = materialise(without_quotes(messages, found), "texts")
    said = messages.select("conv_id", "turn", "role", "text", F.xxhash64("text").alias("_t")).join(clean.hint("merge"), MESSAGE, "left")
    said = said.select("conv_id", "turn", "role", F.coalesce("clean", "text", F.lit("")).alias("text")).join(known, ["conv_id", "turn"], "left")
    said = said.withColumn("root_turn", F.coalesce("root_turn", "turn"))
    loose = F.when(F.col("conv_id").isNull() | F.col("turn").isNull(), F.monotonically_increasing_id())  # no thread holds them all
    in_thread = Window.partitionBy("conv_id", "root_turn", "_loose").orderBy("turn", "role", "text")
    return said.withColumn("_loose", loose).select(
        "conv_id", "turn", "role", "text",
        F.col("from_conv").alias("reply_conv"), F.col("from_turn").alias("reply_turn"), "root_turn",
        F.coalesce("depth", F.lit(0)).alias("depth"), (F.row_number().over(in_thread) - 1).cast("long").alias("place"),
        F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"),
    )


def op5_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_ordered(table(spark, sf_dir, "conversations"))
