"""Exact quantiles in two narrow passes: a sketch brackets each of them, counts within the brackets decide."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalair.sources.tables import stored

ACCURACY = 10_000  # the sketch's ranks are off by n / ACCURACY at most
FEW_KEYS = 50_000  # brackets of so many keys are sent to every task; those of more are joined
SALTS = 16  # parts of a key's rows in that join


def _with_brackets(rows: DataFrame, brackets: DataFrame, own: list[str], few: int) -> DataFrame:
    if brackets.count() <= few:
        return rows.join(F.broadcast(brackets), own)
    salted = brackets.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64("_v"), F.lit(SALTS)).cast("int")).join(salted.hint("merge"), [*own, "_salt"]).drop("_salt")


def exact_quantiles(df: DataFrame, keys: list[str], value: str, shares: list[float]) -> DataFrame:
    """(keys, n, quantiles): exact linearly interpolated quantiles of each key's values that aren't null.

    The first pass sketches each key's values and takes, around each share, a bracket
    three times as wide as the sketch can be off; a key of few values has one bracket
    from its least to its greatest. The second pass counts values within brackets
    one by one and all others by the gap they fall in, summed up before the shuffle,
    so some thousandths of the values are ranked. A bracket that should miss its
    quantile, which the sketch's bound rules out, is an error. Rows meet the
    brackets where they are, or, with very many keys, in SALTS parts a key, so a key
    of very many rows isn't held by one task.
    """
    own = keys or ["_all"]
    rows = (df if keys else df.withColumn("_all", F.lit(0))).where(F.col(value).isNotNull()).select(*own, F.col(value).alias("_v"))
    order = sorted(set(shares))
    ends = [(max(0.0, s - 3 / ACCURACY), min(1.0, s + 3 / ACCURACY)) for s in order]
    points = sorted({p for e in ends for p in e})
    sketch = rows.groupBy(*own).agg(F.count("*").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"), F.percentile_approx("_v", points, ACCURACY).alias("_q"))
    few = F.col("_n") <= 3 * ACCURACY
    low = [F.when(few | F.lit(a == 0), F.col("_least")).otherwise(F.col("_q")[points.index(a)]) for a, _ in ends]
    high = [F.when(few | F.lit(b == 1), F.col("_most")).otherwise(F.col("_q")[points.index(b)]) for _, b in ends]
    brackets = sketch.select(*own, F.array(*low).alias("_low"), F.array(*high).alias("_high"))
    lows, highs = ([F.col(c)[i] for i in range(len(order))] for c in ("_low", "_high"))
    if keys:
        brackets = stored(brackets, "brackets")
        met = _with_brackets(rows, brackets, own, FEW_KEYS)
    else:  # the brackets are one row
        met, one = rows, brackets.first()
        lows, highs = ([F.lit(v) for v in (one[c] if one else [None] * len(order))] for c in ("_low", "_high"))
    gap = sum((F.when(F.col("_v") >= x, 1).otherwise(0) for x in lows), F.lit(0))
    within = F.lit(False)
    for x, y in zip(lows, highs):
        within = within | ((F.col("_v") >= x) & (F.col("_v") <= y))
    counts = met.select(*own, gap.alias("_gap"), (~within).alias("_out"), F.when(within, F.col("_v")).alias("_v")).groupBy(*own, "_gap", "_out", "_v").agg(F.count("*").alias("_n"))
    # In a gap, values within brackets come before those beyond them.
    so_far = Window.partitionBy(*own).orderBy("_gap", "_out", "_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("_to", F.sum("_n").over(so_far)).withColumn("_total", F.sum("_n").over(Window.partitionBy(*own))).withColumn("_from", F.col("_to") - F.col("_n"))
    out = []
    for i, s in enumerate(shares):
        at = F.lit(float(s)) * (F.col("_total") - 1)
        holds = lambda r: F.max(F.when((F.col("_from") <= r) & (r < F.col("_to")), F.col("_v")))
        out += [holds(F.floor(at)).alias(f"_lo{i}"), holds(F.ceil(at)).alias(f"_hi{i}"), F.max(at - F.floor(at)).alias(f"_f{i}")]
    picked = ranked.groupBy(*own).agg(F.max("_total").alias("n"), *out)
    whole = F.lit(True)
    for i in range(len(shares)):
        whole = whole & F.col(f"_lo{i}").isNotNull() & F.col(f"_hi{i}").isNotNull()
    q = F.array(*[(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).cast("double") for i in range(len(shares))])
    return picked.select(*keys, "n", F.when(whole, q).otherwise(F.raise_error(F.lit("a bracket missed its quantile")).cast("array<double>")).alias("quantiles"))
