import pytest

from vitalair.operators.visits import feature_map as hits
from vitalair.sources.feature_maps import code_patterns, feature_map

TEXT = """
FHIR:
  Asthma:
    Condition:
    - {system: icd10, code: "J45[.].*", code_is_regex: true}
    - {system: icd9, code: "493*"}
    Observation:
    - {system: loinc, code: 1234-5, unit: mg}
  Empty: {Patient: []}
  Cough:
    Condition:
    - {system: icd9, code: "786.2", code_is_regex: false}
Visit: [x]
"""


def test_patterns_of_a_file(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "map.yaml").write_text(TEXT)
    (tmp_path / "none.yaml").write_text("")
    got = feature_map(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == sorted([
        ("Asthma", "Condition", "icd10", "J45[.].*", None, True, None), ("Asthma", "Condition", "icd9", "493*", None, None, None),
        ("Asthma", "Observation", "loinc", "1234-5", None, None, "mg"), ("Cough", "Condition", "icd9", "786.2", None, False, None),
    ])
    codes = spark.createDataFrame([("J45.1",), ("J451",), ("493.90",), ("786.2",), ("78612",), (None,)], "code string")
    found = hits(codes, "code", code_patterns(got, "Condition")).collect()
    assert sorted(map(tuple, found)) == [("493.90", "Asthma"), ("786.2", "Cough"), ("J45.1", "Asthma")]
