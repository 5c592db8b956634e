"""Codes and values: patterns, units, body-mass index, lab panels, code lists."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Codes of body-mass index, weight and height, and units with their size in pounds and inches.
BMI, WEIGHT, HEIGHT = "39156-5", "29463-7", "8302-2"
POUNDS = {"lbs": 1.0, "[lb_av]": 1.0, "kg": 1 / 0.45359237, "g": 1 / 453.59237}
INCHES = {"in": 1.0, "[in_i]": 1.0, "cm": 1 / 2.54}
ETHNICITIES = {"2135-2": "Hispanic", "2186-5": "Not Hispanic"}


def anchored(pattern: str, is_regex: bool | None = None) -> str:
    """Any pattern as a regular expression for a whole code: a regex as it stands, `*` as a wildcard if no flag is given, else literal text."""
    if is_regex:
        return f"^(?:{pattern})$"
    if is_regex is None and "*" in pattern:
        return "^" + ".*".join(map(re.escape, pattern.split("*"))) + "$"
    return f"^{re.escape(pattern)}$"


def ethnicity(code: Column) -> Column:
    out = F.when(F.lit(False), "")
    for k, v in ETHNICITIES.items():
        out = out.when(code == k, v)
    return out.otherwise("Unknown")


def value_text(value: Column, unit: Column, text: Column) -> Column:
    """`5 mg`, `5`, or the text where there is no number."""
    return F.when(value.isNotNull(), F.concat_ws(" ", value.cast("string"), unit)).otherwise(text)


def in_unit(value: Column, unit: Column, wanted: Column) -> Column:
    """The value if its unit is the wanted one (both may be absent), else null: such rows are rejects."""
    return F.when(unit.eqNullSafe(wanted), value)


def _scaled(value: Column, unit: Column, sizes: dict[str, float]) -> Column:
    out = F.when(F.lit(False), F.lit(0.0))
    for k, v in sizes.items():
        out = out.when(unit == k, value * v)
    return out


def body_mass_index(measures: DataFrame, keys: list[str], code: str, value: str, unit: str, order: list[str]) -> DataFrame:
    """First direct index, else weight / height^2 * 703 of the first of each; -1 where neither can be told."""
    first = lambda c, v: F.min_by(v, F.when(F.col(code) == c, F.struct(*order)))
    v, u = F.col(value), F.col(unit)
    found = measures.groupBy(*keys).agg(
        first(BMI, v).alias("_b"), first(WEIGHT, _scaled(v, u, POUNDS)).alias("_w"), first(HEIGHT, _scaled(v, u, INCHES)).alias("_h"),
    )
    return found.select(*keys, F.coalesce("_b", F.col("_w") / (F.col("_h") * F.col("_h")) * 703, F.lit(-1.0)).alias("bmi"))


def lab_panel(labs: DataFrame, keys: list[str], code: str, value: str, order: list[str], panel: dict[str, str]) -> DataFrame:
    """Per key and panel name: number of values, first and last value by order. Flags, and values of one time that differ: visit_vectors.value_features."""
    out = []
    for c, name in panel.items():
        own = F.col(code) == c
        at = F.when(own, F.struct(*order))
        out += [F.count_if(own).alias(f"{name}_n"), F.min_by(value, at).alias(f"{name}_first"), F.max_by(value, at).alias(f"{name}_last")]
    return labs.where(F.col(code).isin(*panel)).groupBy(*keys).agg(*out)


def code_list(lines: DataFrame, line: str) -> DataFrame:
    """(code, name) rows of `name<TAB>c1,c2,` lines."""
    parts = F.split(line, "\t")
    return lines.select(F.explode(F.split(F.get(parts, F.lit(1)), ",")).alias("code"), F.get(parts, F.lit(0)).alias("name")).where("code != ''")


def codes_with_prefix(facts: DataFrame, keys: list[str], code: str, prefixes: list[str], but: list[str]) -> DataFrame:
    """Distinct keys and codes cut at the first dot, of codes with one of the prefixes that aren't excluded."""
    chosen = facts.where(F.col(code).rlike("^(?:" + "|".join(map(re.escape, prefixes)) + ")") & ~F.col(code).isin(*but))
    return chosen.select(*keys, F.substring_index(code, ".", 1).alias(code)).distinct()


def plain_key(key: Column) -> Column:
    """Column name to code: instance suffix off, medication cut at `_`, diagnosis at `.`, bare digits get `rxnorm:`, blanks become `_`."""
    k = F.regexp_replace(key, r"_\d+$", "")
    k = F.when(k.startswith("MDCTN:"), F.substring_index(F.regexp_replace(k, "^MDCTN:", ""), "_", 1)).when(k.rlike("^ICD"), F.substring_index(k, ".", 1)).otherwise(k)
    return F.regexp_replace(F.when(k.rlike(r"^\d+$"), F.concat(F.lit("rxnorm:"), k)).otherwise(k), " ", "_")


def codes_in_list(facts: DataFrame, keys: list[str], code: str, codes: list[str]) -> DataFrame:
    """Distinct keys and codes without their instance suffix (`_n`), of codes in the list."""
    plain = F.regexp_replace(code, r"_\d+$", "")
    return facts.where(plain.isin(codes)).select(*keys, plain.alias(code)).distinct()
