"""An index of code patterns: patterns are a table, and a coding meets only those whose literal start it begins with.

A pattern is a regular expression for the whole text (flag true), the text as it
stands (false), or a text where `*` stands for anything (flag absent).  Its
literal starts are texts one of which begins whatever it matches.  Codings
are keyed by themselves and by their beginnings of the lengths that occur, and
meet the patterns by an equi-join; regular expressions are tried on what meets.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalair.operators.mapping import anchored

LONGEST, MOST = 32, 64  # letters of a literal start, starts of a pattern
SHORT = 2  # starts under this length are met by very many codings and are spread
SCHEMA = "feature string, system string, system_is_regex boolean, code string, code_is_regex boolean"


def literal_starts(regex: str) -> list[str]:
    """Texts one of which begins every whole match, none the start of another; [""] where nothing is known."""
    try:
        found, at = _alternatives(regex, 0)
    except (IndexError, ValueError):
        return [""]
    if at != len(regex) or len(found) > MOST:
        return [""]
    texts = sorted({t[:LONGEST] for t, _ in found})
    return [t for i, t in enumerate(texts) if not any(t.startswith(u) for u in texts[:i])]


def _alternatives(regex: str, at: int) -> tuple[list[tuple[str, bool]], int]:
    """(start, whether more may be appended) of each alternative, up to the closing bracket or the end."""
    found: list[tuple[str, bool]] = []
    while True:
        own, at = _sequence(regex, at)
        found += own
        if at >= len(regex) or regex[at] != "|":
            return found, at
        at += 1


def _sequence(regex: str, at: int) -> tuple[list[tuple[str, bool]], int]:
    found = [("", True)]
    while at < len(regex) and regex[at] not in "|)":
        atom, at = _atom(regex, at)
        optional, repeated = False, False
        if at < len(regex) and regex[at] in "*+?{":
            if regex[at] == "{":
                end = regex.index("}", at)
                least, repeated = int(regex[at + 1 : end].split(",")[0]), True
                optional, at = least == 0, end + 1
            else:
                optional, repeated, at = regex[at] in "*?", True, at + 1
            if at < len(regex) and regex[at] in "?+":
                at += 1
        atom = [("", False)] if optional else [(t, more and not repeated) for t, more in atom]
        found = [y for t, more in found for y in ([(t + u, go) for u, go in atom] if more else [(t, False)])]
        if len(found) > MOST:
            raise ValueError("too many starts")
    return found, at


def _atom(regex: str, at: int) -> tuple[list[tuple[str, bool]], int]:
    c = regex[at]
    if c == "(":
        if regex[at + 1 : at + 3] == "?:":
            at += 2
        elif regex[at + 1] == "?":
            raise ValueError("flags and lookarounds are not read")
        found, at = _alternatives(regex, at + 1)
        if regex[at] != ")":
            raise ValueError("bracket left open")
        return found, at + 1
    if c == "[":
        end = at + 1 + (regex[at + 1] == "^")
        end += regex[end] == "]"
        while regex[end] != "]":
            if regex[end] == "[":
                raise ValueError("nested classes are not read")
            end += 2 if regex[end] == "\\" else 1
        return [("", False)], end + 1
    if c == "\\":
        if regex[at + 1] in "QE":
            raise ValueError("quoted runs are not read")
        return ([("", False)] if regex[at + 1].isalnum() else [(regex[at + 1], True)]), at + 2
    if c in ".^$":
        return ([("", c == "^")]), at + 1
    if c in "*+?{":
        raise ValueError("nothing to repeat")
    return [(c, True)], at + 1


def _whole(pattern: str, is_regex: bool | None) -> str | None:
    """The regular expression of a pattern; null where it is plain text."""
    return anchored(pattern, is_regex).replace("^", r"\A", 1)[:-1] + r"\z" if is_regex or (is_regex is None and "*" in pattern) else None


def _starts(pattern: str, is_regex: bool | None) -> list[str]:
    return literal_starts(pattern) if is_regex else [pattern.split("*")[0][:LONGEST]]


def indexed(patterns: DataFrame) -> DataFrame:
    """Index rows of patterns (SCHEMA): keys of system and code, the expressions to try (null: the key says all), and the length of the code's start (null: whole)."""

    def flag(x):
        return None if x is None or x != x else bool(x)

    def run(batches):
        for pdf in batches:
            out = []
            for p in pdf.itertuples(index=False):
                if p.code is None or p.system is None:
                    continue
                system, code = _whole(p.system, flag(p.system_is_regex)), _whole(p.code, flag(p.code_is_regex))
                system_key = "~" if system else "=" + p.system
                for start in [None] if code is None else _starts(p.code, flag(p.code_is_regex)):
                    out.append((p.feature, system_key, system, "=" + p.code if start is None else "<" + start, code, None if start is None else len(start)))
            yield pd.DataFrame(out, columns=["feature", "system_key", "system_regex", "code_key", "code_regex", "size"]).astype({"size": "Int64"})

    return patterns.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in SCHEMA.split(", ")]).mapInPandas(run, "feature string, system_key string, system_regex string, code_key string, code_regex string, size long")


def matched(codings: DataFrame, system: Column, code: Column, index: DataFrame) -> DataFrame:
    """codings' columns and feature: one row for each coding and pattern that fit; codings without system or code fit none.

    index is `indexed`, stored if it is used again. Short starts, which very many codings share, are copied to
    as many places as there are partitions and the codings dealt over them. Both sides are shuffled and sorted:
    neither is broadcast, as their files' sizes say little of their rows.
    """
    spark = codings.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = sorted(r["size"] for r in index.select("size").where("size is not null").distinct().collect())  # LONGEST + 1 numbers at most
    short = F.col("size") < SHORT
    place = F.when(short, F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0)))
    spread = index.withColumn("place", F.explode(place)).drop("size")
    deal = F.pmod(F.xxhash64(system, code), F.lit(n)).cast("int")
    key = lambda text, place: F.named_struct(F.lit("code_key"), text, F.lit("place"), place)
    keys = [key(F.concat(F.lit("="), code), F.lit(0))]
    keys += [key(F.when(F.length(code) >= s, F.concat(F.lit("<"), F.substring(code, 1, s))), deal if s < SHORT else F.lit(0)) for s in sizes]
    systems = F.array(F.concat(F.lit("="), system), F.lit("~"))
    row = F.struct(*codings.columns).alias("row")
    keyed = codings.where(system.isNotNull() & code.isNotNull()).select(row, system.alias("system"), code.alias("code"), F.explode(systems).alias("system_key"), F.array(*keys).alias("keys"))
    keyed = keyed.select("row", "system", "code", "system_key", F.explode(F.filter("keys", lambda k: k["code_key"].isNotNull())).alias("k")).select("row", "system", "code", "system_key", "k.*")
    fits = lambda c: F.col(f"{c}_regex").isNull() | F.rlike(F.col(c), F.col(f"{c}_regex"))
    return keyed.join(spread.hint("merge"), ["system_key", "code_key", "place"]).where(fits("code") & fits("system")).select("row.*", "feature")
