"""Feature maps: files that say which codes make up which feature."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "feature string, resource string, system string, code string, system_is_regex boolean, code_is_regex boolean, unit string"
RESOURCES = ("Condition", "MedicationRequest", "Observation", "Procedure")


def _entries(batches):
    import pandas as pd
    import yaml  # needed for these files only

    for pdf in batches:
        rows = []
        for text in pdf["value"]:
            held = (yaml.safe_load(text) or {}).get("FHIR") or {}
            for feature, by_resource in held.items():
                for resource in RESOURCES:
                    for c in (by_resource or {}).get(resource) or []:
                        flags = [c.get("system_is_regex"), c.get("code_is_regex")]
                        rows.append((feature, resource, str(c["system"]), str(c["code"]), *flags, c.get("unit")))
        yield pd.DataFrame(rows, columns=[x.split()[0] for x in SCHEMA.split(", ")])


def feature_map(spark: SparkSession, path: str) -> DataFrame:
    """One row a pattern of each YAML file under path (`FHIR: feature: resource: [{system, code, ...}]`); absent flags and units are null.

    Sections of other resources and features without patterns give no rows.
    """
    return spark.read.text(path, wholetext=True).mapInPandas(_entries, SCHEMA)


def code_patterns(features: DataFrame, resource: str) -> list[tuple[str, bool, str]]:
    """(pattern, True, feature) of one resource, anchored, for operators.visits.feature_map: a map is a short file that the driver may hold."""
    from vitalair.operators.mapping import anchored

    rows = features.where(features.resource == resource).orderBy("feature", "system", "code").collect()
    return [(anchored(r.code, r.code_is_regex), True, r.feature) for r in rows]
