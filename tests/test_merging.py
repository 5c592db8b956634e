"""Extracts merged year by year, and the index of a survey over several runs."""

import random

from pyspark.sql import functions as F

from vitalair.operators import binning, bundles

SCHEMA = "id string, birth_date string, gender string, race array<string>, ethnicity array<string>, address array<string>"


def extracts(seed):
    rng = random.Random(seed)
    pick = lambda xs: rng.choice(xs)
    some = lambda: [pick("abc") for _ in range(rng.randint(0, 3))] if rng.random() < 0.8 else None
    return {y: [(str(i), pick([None, "1990", "1990", "1991"]), pick([None, "male", "female"]), some(), some(), some()) for i in range(40) if rng.random() < 0.7 for _ in range(pick([1, 1, 2]))] for y in (2010, 2011, 2013)}


def brute(years):
    """Patients and conflicts of all extracts at once."""
    kept, lists, conflicts = {}, {}, set()
    for y in sorted(years):
        for i in {r[0] for r in years[y]}:
            rows = [r for r in years[y] if r[0] == i]
            for f, at in (("birth_date", 1), ("gender", 2)):
                for v in sorted({r[at] for r in rows if r[at] is not None}):
                    first = kept.setdefault((i, f), (v, y))
                    if first[0] != v:
                        conflicts.add((i, f, first[0], v, first[1], y))
            for at in (3, 4, 5):
                own = lists.setdefault((i, at), [])
                for x in (v for a in sorted(r[at] for r in rows if r[at] is not None) for v in a):
                    if x not in own:
                        own.append(x)
    ids = {r[0] for rows in years.values() for r in rows}
    return sorted((i, *kept.get((i, "birth_date"), (None, None)), *kept.get((i, "gender"), (None, None)), *(tuple(lists[i, at]) for at in (3, 4, 5))) for i in ids), sorted(conflicts)


def test_year_by_year_is_all_at_once(spark, tmp_path):
    years = extracts(4)
    for y, rows in years.items():
        bundles.merge_into(spark, str(tmp_path), spark.createDataFrame(rows, SCHEMA), y, parts=5)
    got = spark.read.parquet(f"{tmp_path}/patients").select("id", "birth_date", "birth_date_year", "gender", "gender_year", "race", "ethnicity", "address").collect()
    want, conflicts = brute(years)
    assert sorted(((*r[:5], *map(tuple, r[5:])) for r in got), key=repr) == sorted(want, key=repr)
    report = spark.read.parquet(f"{tmp_path}/conflicts").select("id", "field", "kept", "other", "kept_year", "year").collect()
    assert sorted(map(tuple, report)) == conflicts and len(conflicts) > 10


def test_only_touched_folders_are_replaced_and_a_year_may_be_repeated(spark, tmp_path):
    years = extracts(5)
    for y, rows in years.items():
        bundles.merge_into(spark, str(tmp_path), spark.createDataFrame(rows, SCHEMA), y, parts=4)
    files = lambda: {str(p) for p in tmp_path.rglob("*.parquet")}
    before, whole = files(), sorted(map(repr, spark.read.parquet(f"{tmp_path}/patients").collect()))
    one = [r for r in years[2013] if r[0] == years[2013][0][0]]
    bundles.merge_into(spark, str(tmp_path), spark.createDataFrame(one, SCHEMA), 2013, parts=4)
    gone = {p for p in before - files() if "/patients/" in p}
    assert len({p.split("part=")[1].split("/")[0] for p in gone}) == 1
    assert sorted(map(repr, spark.read.parquet(f"{tmp_path}/patients").collect())) == whole


def test_an_index_keeps_what_it_gave(spark):
    rng = random.Random(1)
    keys = rng.sample(range(1000), 300)
    table = lambda ks: spark.createDataFrame([(f"k{k}", k) for k in ks], "key string, o long")
    index, seen = None, []
    for ks in (keys[:100], keys[50:200], keys[:10], keys):
        index = binning.appended_index(index, table(ks), "key", [F.col("o")])
        index = spark.createDataFrame(index.collect(), index.schema)
        seen += sorted(k for k in ks if k not in seen)
        assert {r.key: r["index"] for r in index.collect()} == {f"k{k}": i for i, k in enumerate(seen)}
    assert binning.appended_index(index, table([]), "key", [F.col("o")]).count() == 300


def test_survey_rows_without_a_patient_stay_alone(spark):
    survey = spark.createDataFrame([("h1", 5), ("h2", 6), ("h3", 7)], "hk string, q long")
    walk = spark.createDataFrame([("h1", 1)], "hk string, p long")
    rows = spark.createDataFrame([(1, 1996, "v1"), (1, 1996, "v2"), (2, 1996, "v3")], "p long, year int, visit string")
    index = binning.appended_index(None, binning.persons(survey, walk, rows, "hk", "p"), "person", [F.asc_nulls_last("hk"), F.asc("p")])
    named, bare = binning.survey_tables(survey, walk, rows, index, "hk", "p", "year", 1996)
    got = sorted((tuple(r[c] for c in ("hk", "p", "visit", "q", "IN_EPR", "IN_ICEES", "year", "index")) for r in named.collect()), key=repr)
    want = [("h1", 1, "v1", 5, 1, 1, 1996, 0), ("h1", 1, "v2", 5, 1, 1, 1996, 0), ("h2", None, None, 6, 1, 0, 1996, 1), ("h3", None, None, 7, 1, 0, 1996, 2), (None, 2, "v3", None, 0, 1, 1996, 3)]
    assert got == sorted(want, key=repr) and not {"hk", "p"} & set(bare.columns)


def test_an_extract_is_read_once(spark, tmp_path):
    from vitalair.operators import bundles

    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(len(b))
            yield b

    schema = "id string, birth_date string, gender string, race array<string>, ethnicity array<string>, address array<string>"
    for year, gender in ((2010, "male"), (2011, "other")):
        rows = spark.createDataFrame([(str(i), "2000-01-01", gender, ["a"], [], []) for i in range(50)], schema)
        bundles.merge_into(spark, str(tmp_path / "m"), rows.mapInPandas(counted, schema), year)
    assert read.value == 100
    assert spark.read.parquet(f"{tmp_path}/m/patients").where("gender = 'male' and gender_year = 2010").count() == spark.read.parquet(f"{tmp_path}/m/conflicts").count() == 50
