"""Sources, years of a window, visit vectors and patient tables on rows written by hand."""

from datetime import date, datetime

from pyspark.sql import functions as F

from vitalair.operators import exposure, patient_tables, visit_vectors, warehouse
from vitalair.sources import tables


def test_columns_and_empty_tables(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(1, 2)], "y int, z int")
    assert tables.missing_columns(a, b) == {"only_first": ["x"], "only_second": ["z"]}
    assert tables.not_empty(a) is a and tables.not_empty(a.limit(0)) is None


def test_concatenated_files(spark, tmp_path):
    for name, df in (("a", spark.createDataFrame([("1", "p", "s"), ("1", "p", "t")], "k string, pm string, secret string")), ("b", spark.createDataFrame([("1", "s"), ("2", "s")], "k string, secret string"))):
        tables.write_csv(df, f"{tmp_path}/{name}", one_file=True)
    paths = [f"{tmp_path}/a", f"{tmp_path}/b"]
    out = tables.concatenated(spark, paths, "k|pm", "-", file_column="file")
    assert sorted((r.k, r.pm, "/a/" in r.file) for r in out.collect()) == [("1", "-", False), ("1", "p", True), ("1", "p", True), ("2", "-", False)]
    once = tables.concatenated(spark, paths, "k|pm", "-", distinct=True)
    assert sorted(map(tuple, once.collect())) == [("1", "-"), ("1", "p"), ("2", "-")]


def test_documents_and_whole_files(spark, tmp_path):
    df = spark.createDataFrame([("a", [1, 2], None), ("b", [], "x")], "id string, n array<int>, note string")
    tables.write_documents(df, f"{tmp_path}/d")
    assert sorted(map(tuple, tables.read_documents(spark, f"{tmp_path}/d", df.schema).collect())) == [("a", [1, 2], None), ("b", [], "x")]
    (tmp_path / "one.json").write_text('{"x":\n1}')
    assert [tuple(r) for r in tables.read_text(spark, str(tmp_path / "one.json"), whole=True).collect()] == [('{"x":\n1}', "one.json")]


def test_years_of_a_window():
    assert exposure.study_years("2010-01-01T05:00:00", "2011-01-01T05:00:00", -5) == [2010]
    assert exposure.study_years("2010-01-01T00:00:00", "2011-01-01T06:00:00", -5) == [2009, 2010, 2011]


def test_visit_vectors_by_hand(spark):
    """A visit without start takes its first medication's; an item of no visit is a visit; days are local; codings count once a pattern."""
    t = lambda d, h=12: datetime(2010, 1, d, h)
    visits = spark.createDataFrame([("e1", "p", None, "AMB"), ("e2", "p", t(3), "EMER"), ("e3", "p", t(3), "IMP"), ("e4", "p", None, "AMB")], "visit string, patient string, start timestamp, kind string")
    items = spark.createDataFrame(
        [("p", "e1", "condition", t(1), "icd9", "493.9", 1.0, "H"), ("p", "e1", "medication", t(2, 3), "rx", "77", None, None), ("p", "e2", "condition", t(9), "icd9", "493.1", 2.0, "L"), ("p", "e3", "condition", t(9), "icd10", "493.1", 3.0, None), ("p", None, "condition", t(5, 2), "icd9", "493.0", 4.0, None)],
        "patient string, visit string, kind string, instant timestamp, system string, code string, value double, flag string",
    )
    patterns = [{"feature": "asthma", "system": "icd9", "code": "493*"}, {"feature": "asthma", "system": "icd9", "code": r"493\.9", "code_is_regex": True}, {"feature": "drug", "system": "rx", "code": "77", "code_is_regex": False}]
    started = visit_vectors.effective_starts(visits, items, "visit", "start", ["medication", "condition"])
    assert {r.visit: r.start for r in started.collect()} == {"e1": t(2, 3), "e2": t(3), "e3": t(3)}
    at = visit_vectors.visit_items(started, items, "patient", "visit", "start")
    counts = visit_vectors.coded_counts(at, ["patient", "start"], "system", "code", patterns, ["asthma", "drug"])
    got = {r.start: (r.visit, r.kind, r.asthma, r.drug, r.day) for r in visit_vectors.visit_vectors(started, at, counts, "patient", "visit", "start", "kind", -5).collect()}
    assert got == {t(2, 3): ("e1", "AMB", 2, 1, date(2010, 1, 1)), t(3): ("e2|e3", "EMER|IMP", 1, 0, date(2010, 1, 3)), t(5, 2): ("", "", 1, 0, date(2010, 1, 4))}
    labs = spark.createDataFrame([("p", "wbc", t(2), 2, 5.0, "H"), ("p", "wbc", t(1), 1, 4.0, None), ("p", "wbc", t(1), 3, 4.5, "N"), ("q", "hct", t(1), 1, 9.0, "L")], "patient string, feature string, at timestamp, id int, value double, flag string")
    got = {r.patient: r for r in visit_vectors.value_features(labs, ["patient"], "value", "flag", ["at", "id"], ["wbc", "hct"]).collect()}
    assert (got["p"].wbc_n, got["p"].wbc_value_first, got["p"].wbc_flag_first, got["p"].wbc_value_last, got["p"].wbc_flag_last, got["p"].wbc_differ) == (3, 4.0, None, 5.0, "H", True)
    assert (got["p"].hct_n, got["p"].hct_value_first, got["p"].hct_differ, got["q"].hct_n, got["q"].hct_flag_last) == (0, None, False, 1, "L")


def test_patient_table_by_hand(spark):
    rows = [("p", 2010, 1, "AMB|IMP", 1, 1, 0, 1.0, None), ("p", 2010, 2, "EMER", 0, 0, 1, 2.0, 7.0), ("p", 2010, 3, "IMP", 1, 2, 0, 3.0, 8.0), ("old", 2010, 1, "AMB", 1, 1, 1, 1.0, 1.0)]
    v = spark.createDataFrame(rows, "patient string, period int, n int, VisitType string, Asthma int, Cough int, ObesityBMIVisit int, pm double, lab_first double")
    v = v.withColumn("birth_date", F.when(F.col("patient") == "old", F.lit("1900-01-01")).otherwise("1980-06-01").cast("date"))
    got = patient_tables.patient_table(v, "patient", "period", ["n"], ["pm"], ["Asthma", "Croup"], ["lab_first", "lab_last"], ["Asthma", "Cough"], "2010-01-01").collect()
    assert len(got) == 1
    r = got[0]
    assert (r.pm, r.Asthma, r.Croup, r.lab_first, r.ObesityBMI, r.RespiratoryDx, r.AgeStudyStart) == (1.0, 2, 0, 7.0, 1, 1, 29)
    assert (r.TotalEDVisits, r.TotalInpatientVisits, r.TotalEDInpatientVisits) == (1, 2, 2)


def test_names_of_wide_facts(spark):
    f = spark.createDataFrame([(1, "b", 2, 5.0), (1, "b", 1, 4.0), (1, "a", 1, 3.0), (2, "c", 1, 2.0)], "k int, name string, instance_num int, v double")
    assert [tuple(r) for r in warehouse.names_table(f, "name").orderBy("place").collect()] == [(1, "a"), (2, "b"), (3, "c")]
    assert {r.k: r.v for r in warehouse.wide_by_name(f, ["k"], "name", ["v"], warehouse.names_table(f, "name")).collect()} == {1: [3.0, 4.0, None], 2: [None, None, 2.0]}


def test_wide_lines_are_the_wide_arrays(spark):
    f = spark.createDataFrame([(1, "a", 2, 5.0), (1, "a", 1, 3.0), (1, "c", 1, None), (2, "d", 1, 2.0), (3, "b", 1, 7.0)], "k long, name string, instance_num long, v double")
    names = warehouse.names_table(f, "name")
    got = {r.k: tuple(r)[1:] for r in warehouse.wide_lines(f, ["k"], "name", "v", names, "-").collect()}
    assert got == {1: (4, 1, "3.0,-,-,-"), 2: (4, 1, "-,-,-,2.0"), 3: (4, 1, "-,7.0,-,-")}
    for r in warehouse.wide_by_name(f, ["k"], "name", ["v"], names).collect():
        assert ",".join("-" if x is None else str(x) for x in r.v) == got[r.k][2]
