"""op2: licence scans by an exact set-similarity join, in DataFrame expressions only.

Blocks are runs of as many words as a template has, over line ends and at every
place of a text.  A block matches a template if it holds at least THRESHOLD of
the template's distinct words.  Words are put in one global order, rarest in the
corpus first.  Of a template of n words of which k must match, some match has
its first common word among the n - k + 1 rarest (its prefix), so places of
those words are joined with the templates; places with too few words around
them (length), or with fewer than k of the template's words among those that
any block over the place can hold (position), fall away before blocks are
counted exactly.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalair.llm.common import table

SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.8

#: Fixed values of the contract: phrase -> label.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Templates of the method (fixed values): label, opening words or whole paragraphs of public licence notices. Labels may have several notices.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4.0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4.0"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0 if a copy of the mpl was not distributed with this file you can obtain one at"),
]


def words(text: Column) -> Column:
    """Lower-cased words. Lower-casing beyond A-Z changes no word boundary, no count and no word that is looked for."""
    return F.array_remove(F.split(F.lower(text), SPLIT), "")


def _sequence(notice: str) -> list[str]:
    return notice.replace(".", " ").split()


def _template_words(notice: str) -> list[str]:
    return list(dict.fromkeys(_sequence(notice)))


def _need(n: int, threshold: float) -> int:
    return math.ceil(threshold * n - 1e-9)


def word_order(docs: DataFrame, vocabulary: list[str]) -> list[str]:
    """The templates' words by the number of documents that hold them, rarest first."""
    held = F.array_intersect(words(F.coalesce("text", F.lit(""))), F.array(*map(F.lit, vocabulary)))
    counts = docs.select(F.explode_outer(held).alias("w")).where("w is not null").groupBy("w").count().collect()  # at most one row a word of the templates
    n = {r["w"]: r["count"] for r in counts}
    return sorted(vocabulary, key=lambda w: (n.get(w, 0), w))


def matching_blocks(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text_hash, block, label, n, containment): blocks, by their first word, that meet the threshold, the best one around each place of a prefix word.

    `templates` is a list of (label, notice), as long as the caller's memory
    allows: it is sent to all tasks as one row for each word of the prefixes.
    """
    sets = [(label, _sequence(notice), _template_words(notice)) for label, notice in templates]
    order = word_order(docs, sorted({w for *_, ws in sets for w in ws}))
    rank = {w: i for i, w in enumerate(order)}
    prefixes, longest = [], max(len(sequence) for _, sequence, _ in sets)
    for label, sequence, ws in sets:
        ws, need = sorted(ws, key=rank.__getitem__), _need(len(ws), threshold)
        prefixes += [F.struct(F.lit(w).alias("word"), F.lit(label).alias("label"), F.lit(len(sequence)).alias("size"), F.lit(need).alias("need"), F.array(*map(F.lit, ws)).alias("ws")) for w in ws[: len(ws) - need + 1]]
    rare = sorted({w for label, _, ws in sets for w in sorted(ws, key=rank.__getitem__)[: len(ws) - _need(len(ws), threshold) + 1]})
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.coalesce("text", F.lit(""))).alias("all"))
    # Spark keeps each text's words beside every one of them only until the place is tested and its surroundings are cut out.
    places = rows.select("doc_id", "text_hash", "all", F.posexplode("all").alias("at", "word")).where(F.col("word").isin(rare))
    before = F.least(F.col("at"), F.lit(longest - 1))
    met = places.select("doc_id", "text_hash", "at", "word", before.alias("c"), F.slice("all", F.col("at") - before + 1, before + longest).alias("around"))
    table_ = docs.sparkSession.range(1).select(F.inline(F.array(*prefixes)))  # one row a prefix word: bounded by the templates
    met = met.join(F.broadcast(table_), "word").where(F.size("around") >= F.col("need"))
    low = F.greatest(F.col("c") - F.col("size") + 1, F.lit(0))
    met = met.where(F.size(F.array_intersect(F.slice("around", low + 1, F.col("c") - low + F.col("size")), "ws")) >= F.col("need"))
    count = lambda s: F.struct(F.size(F.array_intersect(F.slice("around", s + 1, F.col("size")), "ws")).alias("n"), (-s).alias("s"))
    met = met.withColumn("best", F.array_max(F.transform(F.sequence(low, F.col("c")), count))).where("best.n >= need")
    block = (F.col("at") - F.col("c") - F.col("best.s")).alias("block")
    return met.select("doc_id", "text_hash", block, "label", F.col("best.n").alias("n"), (F.col("best.n") / F.size("ws")).alias("containment")).distinct()


def _places(ws: Column, joined: Column, phrase: str) -> Column:
    parts = phrase.split()
    at = lambda i: reduce(lambda a, b: a & b, [F.get(ws, i + k) == w for k, w in enumerate(parts)])
    none = F.array().cast("array<int>")
    return F.when(joined.contains(f" {phrase} "), F.filter(F.sequence(F.lit(0), F.size(ws) - len(parts)), at)).otherwise(none)


def licence_scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row.

    score is 1 with a base phrase, else the largest containment that met the
    threshold, else 0. Texts of any length are scanned whole. Null texts have no words and no labels; repeated rows stay
    repeated; an empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(text).alias("ws"))
    base = base.select("doc_id", "text_hash", "ws", F.concat(F.lit(" "), F.array_join("ws", " "), F.lit(" ")).alias("joined"))
    found = [_places(F.col("ws"), F.col("joined"), p).alias(f"p{k}") for k, p in enumerate(PHRASES)]
    base = base.select("doc_id", "text_hash", F.size("ws").cast("long").alias("n_words"), *found)
    every = F.concat(*[f"p{k}" for k in range(len(PHRASES))])
    labels = F.filter(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(v)) for k, v in enumerate(PHRASES.values())]), lambda x: x.isNotNull())
    base = base.select("doc_id", "text_hash", "n_words", F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"), labels.alias("own"))
    more = matching_blocks(docs, templates, threshold).groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.collect_set("label").alias("more"), F.max("containment").alias("containment"))
    both = base.join(more, base.doc_id.eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    none = F.array().cast("array<string>")
    return both.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("own"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("own", F.coalesce("more", none)))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    sets = [(k, label, len(_sequence(notice)), _template_words(notice)) for k, (label, notice) in enumerate(TEMPLATES)]
    values = ", ".join(f"({k}, '{label}', {size}, {_need(len(ws), THRESHOLD)}, {ws!r})" for k, label, size, ws in sets)
    ws = "list_filter(string_split_regex(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
    places = " || ".join(
        "list_filter(range(len(ws)), lambda i: " + " AND ".join(f"ws[i + {k + 1}] = '{w}'" for k, w in enumerate(p.split())) + ")" for p in PHRASES
    )
    own = " || ".join(f"(CASE WHEN contains(joined, ' {p} ') THEN ['{v}'] ELSE [] END)" for p, v in PHRASES.items())
    return f"""
WITH t(k, label, size, need, tw) AS (VALUES {values}),
tw AS (SELECT k, size, need, unnest(tw) AS w FROM t),
d AS (SELECT doc_id, {ws.format("text")} AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM d),
h AS (SELECT doc_id, k, size, need, pos, w FROM w JOIN tw USING (w)),
near AS (SELECT doc_id, k FROM h GROUP BY doc_id, k, need HAVING count(DISTINCT w) >= need),
g AS (SELECT h.* FROM h JOIN near USING (doc_id, k)),
b AS (SELECT x.doc_id, x.k, x.need, count(DISTINCT y.w) AS c FROM g x JOIN g y ON x.doc_id = y.doc_id AND x.k = y.k AND y.pos BETWEEN x.pos AND x.pos + x.size - 1
      GROUP BY x.doc_id, x.k, x.need, x.pos),
m AS (SELECT doc_id, list_distinct(list(label)) AS more, max(c / len(tw)) AS c FROM b JOIN t USING (k) WHERE c >= b.need GROUP BY doc_id),
e AS (SELECT doc_id, ws, ' ' || array_to_string(ws, ' ') || ' ' AS joined, {places} AS pl FROM d)
SELECT e.doc_id, len(ws)::BIGINT AS n_words, len(pl)::BIGINT AS n_base, list_min(pl)::BIGINT AS first_word, list_max(pl)::BIGINT AS last_word,
       array_to_string(list_sort({own}), ',') AS base_labels,
       array_to_string(list_sort(list_distinct({own} || coalesce(more, []))), ',') AS labels,
       CASE WHEN len(pl) > 0 THEN 1.0::DOUBLE ELSE coalesce(c, 0)::DOUBLE END AS score
FROM e LEFT JOIN m USING (doc_id)"""


SQL = _sql()
