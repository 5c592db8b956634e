"""The pattern index against a loop over all patterns."""

import random
import re

import pytest
from pyspark.sql import functions as F

from vitalair.operators import patterns as p


@pytest.mark.parametrize("regex, starts", [
    ("J45.*", ["J45"]), ("J45\\.[0-9]", ["J45."]), ("(ICD9|ICD10):49[35]", ["ICD10:49", "ICD9:49"]), ("ab?c", ["a"]), ("ab+c", ["ab"]), ("ab*", ["a"]), ("(?:ab)+c", ["ab"]),
    ("a|b(c|d)e", ["a", "bce", "bde"]), (".*", [""]), ("(?i)abc", [""]), ("a{2,3}b", ["a"]), ("a{0,2}b", [""]), ("\\d+", [""]), ("a|ab", ["a"]), ("x(a|)y", ["xay", "xy"]), ("[ab]c", [""]),
    ("a[]b]c", ["a"]), ("(unclosed", [""]), ("\\Qa.b\\E", [""]), ("^abc$", ["abc"]), ("a\\+b", ["a+b"]), ("", [""]), ("ab??c", ["a"]), ("(a|b)(c|d)?e", ["a", "b"]),
])
def test_literal_starts(regex, starts):
    assert p.literal_starts(regex) == starts


def loop(codings, patterns):
    """Each pattern on each coding."""
    out = []
    def lines(pattern, flag, texts):
        regex = pattern if flag else ".*".join(map(re.escape, pattern.split("*"))) if flag is None else re.escape(pattern)
        fits = re.compile(regex).fullmatch
        return {i for i, t in enumerate(texts) if fits(t)}

    every = {}
    for feature, system, sflag, code, cflag in patterns:
        key = (system, sflag)
        if key not in every:
            every[key] = lines(system, sflag, [s for s, _ in codings])
        out += [(*codings[i], feature) for i in lines(code, cflag, [c for _, c in codings]) & every[key]]
    return sorted(out)


def drawn(n_codes, n_patterns, seed):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("ABCXYZ019") for _ in range(k))
    codings = sorted({(rng.choice(["icd9", "icd10", "rxnorm"]), f"{word(rng.randint(1, 4))}.{word(rng.randint(1, 3))}") for _ in range(n_codes)})
    kinds = [
        lambda c: (c, False), lambda c: (c, None), lambda c: (c[: rng.randint(1, 4)] + "*", None), lambda c: (re.escape(c[:3]) + ".*", True),
        lambda c: (f"({re.escape(c[:2])}|{word(2)})[A-Z0-9]*\\.{rng.choice('ABC019')}.*", True), lambda c: (re.escape(c.split(".")[0]) + r"\.[0-9]{1,3}", True),
    ]
    rows = []
    for i in range(n_patterns):
        code, cflag = rng.choice(kinds)(rng.choice(codings)[1])
        system, sflag = rng.choice([("icd9", False), ("icd10", None), ("icd(9|10)", True), ("*", None), ("rx.*", True)])
        rows.append((f"f{i}", system, sflag, code, cflag))
    rows += [("any", "*", None, ".*0", True), ("all", "icd9", False, "*", None), ("dot", "icd9", False, "A.*", False)]
    return codings, rows


def test_against_a_loop_over_patterns(spark):
    codings, rows = drawn(400, 90, 1)
    rows += rows[:10]  # patterns of one feature count each
    df = spark.createDataFrame(codings, "system string, code string")
    got = p.matched(df, F.col("system"), F.col("code"), p_index(spark, rows))
    assert sorted(map(tuple, got.collect())) == loop(codings, rows)


def test_five_thousand_patterns(spark, tmp_path):
    codings, rows = drawn(150_000, 5_000, 2)
    assert len(codings) > 100_000
    spark.createDataFrame(codings, "system string, code string").write.parquet(f"{tmp_path}/c")
    got = p.matched(spark.read.parquet(f"{tmp_path}/c"), F.col("system"), F.col("code"), p_index(spark, rows))
    got.write.parquet(f"{tmp_path}/got")
    got = spark.read.parquet(f"{tmp_path}/got")
    some = rows[:5000:50] + rows[-3:]
    assert sorted(map(tuple, got.where(F.col("feature").isin([r[0] for r in some])).collect())) == loop(codings, some)
    assert got.select("feature").distinct().count() > 4_000


def p_index(spark, rows):
    index = p.indexed(spark.createDataFrame(rows, p.SCHEMA)).collect()
    return spark.createDataFrame(index, "feature string, system_key string, system_regex string, code_key string, code_regex string, size long")


def test_no_pattern_is_in_the_plan(spark, tmp_path):
    spark.createDataFrame(drawn(50, 40, 1)[1], p.SCHEMA).write.parquet(f"{tmp_path}/p")
    p.indexed(spark.read.parquet(f"{tmp_path}/p")).write.parquet(f"{tmp_path}/i")
    df = spark.createDataFrame([("icd9", "A.1"), (None, "A.1"), ("icd9", None), ("", "")], "system string, code string").withColumn("place", F.lit("x")).withColumn("row", F.lit(1))
    got = p.matched(df, F.col("system"), F.col("code"), spark.read.parquet(f"{tmp_path}/i"))
    plan = got._jdf.queryExecution().toString()
    assert "rlike" in plan.lower() and "icd(9|10)" not in plan
    assert {r.code for r in got.collect()} <= {"A.1"} and got.columns == ["system", "code", "place", "row", "feature"]


def test_empty(spark):
    none = spark.createDataFrame([], p.SCHEMA)
    df = spark.createDataFrame([("a", "b")], "system string, code string")
    assert p.matched(df, F.col("system"), F.col("code"), p.indexed(none)).count() == 0
    assert p.matched(df.limit(0), F.col("system"), F.col("code"), p.indexed(spark.createDataFrame([("f", "*", None, "*", None)], p.SCHEMA))).count() == 0


def test_a_table_of_code_patterns_is_the_list(spark):
    from vitalair.operators.visits import feature_map

    listed = [("A.*", True, "a"), ("B\\.[01]", True, "b"), ("C.1", False, "c"), (".*1", True, "one")]
    codes = spark.createDataFrame([(x,) for x in ("A", "A.1", "B.1", "B.2", "C.1", "CX1", "Cx", None)], "code string")
    table = spark.createDataFrame(listed, "code string, code_is_regex boolean, feature string")
    want = sorted(map(tuple, feature_map(codes, "code", listed).collect()))
    assert sorted(map(tuple, feature_map(codes, "code", table).collect())) == want and len(want) == 8


def test_small_files_are_not_broadcast(spark):
    """A file's size says little of its rows: neither side may go through the driver."""
    codings = spark.createDataFrame([("S", "A1")], "system string, code string")
    patterns = spark.createDataFrame([("f", "S", False, "A*", None)], p.SCHEMA)
    met = p.matched(codings, F.col("system"), F.col("code"), p.indexed(patterns))
    assert [tuple(r) for r in met.collect()] == [("S", "A1", "f")]
    assert "Broadcast" not in met._jdf.queryExecution().executedPlan().toString()
