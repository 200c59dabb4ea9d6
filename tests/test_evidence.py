"""Evidence bundles: each rule on its own."""

import pytest
from pyspark.sql import functions as F

from hexloom.operators import evidence as e

DAY = "1700-06-01"


@pytest.fixture
def tables(spark):
    features = spark.createDataFrame([("f", "s", "POLITY_EXTERNAL_BOUNDARY", "1690-01-01", "1710-01-01", 5.0)], "feature_id string, subject_id string, feature_role string, valid_from string, valid_to string, uncertainty_km double")
    links = spark.createDataFrame([("f", "g", "GEOMETRY_SHAPE"), ("f", "p", "POLITICAL_STATUS")], "feature_id string, evidence_id string, evidence_role string")
    facts = [("g", "s", "src", "BOUNDARY_POSITION", "1700-01-01", "1700-12-31", "p. 3", "HIGH", "YES", "NO"), ("p", "s", "src", "POLITICAL_CONTROL", "1699-01-01", "1701-01-01", "p. 4", "MEDIUM", "NO", "YES")]
    assertions = spark.createDataFrame(facts, "evidence_id string, subject_id string, source_id string, assertion_type string, valid_from string, valid_to string, locator string, confidence string, geometry_authority string, political_authority string")
    return dict(features=features, links=links, assertions=assertions, registry=spark.createDataFrame([("src", "ATLAS")], "source_id string, authority_level string"), subjects=spark.createDataFrame([("s", "pol")], "subject_id string, polity_id string"))


def run(t, **options):
    authorised, rejected = e.compile_snapshot(t["features"], t["links"], t["assertions"], t["registry"], t["subjects"], DAY, **options)
    return [tuple(r) for r in authorised.select("feature_id", "polity_id", "confidence", "evidence_ids", "roles").collect()], [r.reasons for r in rejected.collect()]


def test_a_whole_bundle(tables):
    assert run(tables) == ([("f", "pol", "MEDIUM", "g|p", "GEOMETRY_SHAPE|POLITICAL_STATUS")], [])


RULES = {
    "MISSING_POLITICAL_STATUS": lambda t: t.update(links=t["links"].where("evidence_id = 'g'")),
    "NO_EVIDENCE_LINKED": lambda t: t.update(links=t["links"].where("evidence_id = 'x'")),
    "SOURCE_NOT_REGISTERED": lambda t: t.update(registry=t["registry"].where("source_id = 'x'")),
    "SUBJECT_NOT_MAPPED": lambda t: t.update(subjects=t["subjects"].where("subject_id = 'x'")),
    "NO_EXACT_LOCATOR": lambda t: t.update(assertions=t["assertions"].withColumn("locator", F.lit("UNKNOWN page"))),
    "OTHER_SUBJECT": lambda t: t.update(assertions=t["assertions"].withColumn("subject_id", F.lit("other"))),
    "NO_POLITICAL_AUTHORITY": lambda t: t.update(assertions=t["assertions"].withColumn("political_authority", F.lit("NO"))),
    "NO_GEOMETRY_AUTHORITY": lambda t: t.update(assertions=t["assertions"].withColumn("geometry_authority", F.lit(None).cast("string"))),
    "TYPE_NOT_ALLOWED": lambda t: t.update(assertions=t["assertions"].withColumn("assertion_type", F.lit("DE_JURE_CLAIM"))),
    "ROLE_NOT_CONVERTIBLE": lambda t: t.update(features=t["features"].withColumn("feature_role", F.lit("UNCERTAIN_BOUNDARY"))),
    "NO_UNCERTAINTY": lambda t: t.update(features=t["features"].withColumn("uncertainty_km", F.lit(None).cast("double"))),
}


def test_each_rule(spark, tables):
    """One feature for each rule, all in one run."""
    whole = {k: [] for k in tables}
    for rule, change in RULES.items():
        own = dict(tables)
        change(own)
        for k, df in own.items():
            keys = [c for c in df.columns if c in ("feature_id", "subject_id", "evidence_id", "source_id")]
            whole[k] += [{**r.asDict(), **{c: f"{rule}:{r[c]}" for c in keys}} for r in df.collect()]
    many = {k: spark.createDataFrame([tuple(r[c] for c in tables[k].columns) for r in rows], tables[k].schema) for k, rows in whole.items()}
    authorised, rejected = e.compile_snapshot(many["features"], many["links"], many["assertions"], many["registry"], many["subjects"], DAY)
    reasons = {r.feature_id.split(":")[0]: r.reasons.split("; ") for r in rejected.collect()}
    assert authorised.count() == 0 and set(reasons) == set(RULES) and all(rule in found for rule, found in reasons.items())


def test_forbidden_authority_and_other_days(tables):
    assert run(tables, forbidden=("ATLAS",))[1][0].startswith("AUTHORITY_FORBIDDEN")
    tables["features"] = tables["features"].withColumn("valid_to", F.lit("UNKNOWN"))
    assert run(tables) == ([], [])


def test_shape_from_another_time_needs_a_bridge(spark, tables):
    old = F.when(F.col("evidence_id") == "g", "1650-01-01")
    tables["assertions"] = tables["assertions"].withColumns({"valid_from": F.coalesce(old, "valid_from"), "valid_to": F.coalesce(F.when(F.col("evidence_id") == "g", "1660-01-01"), "valid_to")})
    assert run(tables) == ([], ["SHAPE_NOT_CARRIED_TO_DAY"])
    tables["links"] = tables["links"].unionByName(spark.createDataFrame([("f", "c1", "TEMPORAL_CONTINUITY"), ("f", "c2", "TEMPORAL_CONTINUITY")], tables["links"].schema))
    bridge = lambda a, b, c: [("c1", "s", "src", "TERRITORIAL_CONTINUITY", "1655-01-01", a, "p. 9", "LOW", "NO", "YES"), ("c2", "s", "src", "TERRITORIAL_CONTINUITY", b, c, "p. 9", "LOW", "NO", "YES")]
    base = tables["assertions"]
    tables["assertions"] = base.unionByName(spark.createDataFrame(bridge("1680-01-01", "1681-01-01", "1710-01-01"), base.schema))
    assert run(tables) == ([], ["SHAPE_NOT_CARRIED_TO_DAY"])
    tables["assertions"] = base.unionByName(spark.createDataFrame(bridge("1680-01-01", "1680-01-01", "1710-01-01"), base.schema))
    authorised, rejected = run(tables)
    assert rejected == [] and authorised[0][2:] == ("LOW", "c1|c2|g|p", "GEOMETRY_SHAPE|POLITICAL_STATUS|TEMPORAL_CONTINUITY")


def test_unknown_roles_and_unfit_bridges(spark, tables):
    """Each fault names the evidence that breaks the rule; a bridge matters only where a shape needs one."""
    base = tables["assertions"]
    more = [("c1", "s", "src", "POLITICAL_CONTROL", "1600-01-01", "1710-01-01", "p. 9", "LOW", "NO", "YES"), ("c2", "s", "src", "TERRITORIAL_CONTINUITY", "1600-01-01", "1710-01-01", "p. 9", "LOW", "NO", "NO")]
    tables["assertions"] = base.unionByName(spark.createDataFrame(more, base.schema))
    tables["links"] = tables["links"].unionByName(spark.createDataFrame([("f", "c1", "TEMPORAL_CONTINUITY"), ("f", "c2", "TEMPORAL_CONTINUITY")], tables["links"].schema))
    found = lambda: {(r.violation, r.evidence_id) for r in e.evaluate(tables["features"], tables["links"], tables["assertions"], tables["registry"], DAY)[0].collect()}
    assert found() == set()
    tables["assertions"] = tables["assertions"].withColumn("valid_to", F.when(F.col("evidence_id") == "g", "1700-02-01").otherwise(F.col("valid_to")))
    assert found() == {("CONTINUITY_TYPE_NOT_ALLOWED", "c1"), ("CONTINUITY_WITHOUT_AUTHORITY", "c2"), ("SHAPE_NOT_CARRIED_TO_DAY", "g")}
    tables["links"] = tables["links"].where("evidence_role <> 'TEMPORAL_CONTINUITY'").unionByName(spark.createDataFrame([("f", "c1", "RUMOUR"), ("f", "c2", None)], tables["links"].schema))
    assert found() == {("UNKNOWN_EVIDENCE_ROLE", "c1"), ("UNKNOWN_EVIDENCE_ROLE", "c2"), ("SHAPE_NOT_CARRIED_TO_DAY", "g")}


def test_production_faults(spark, tables):
    """One feature without fault; one that breaks each rule of its own row; one whose fields are null."""
    schema = "feature_id string, subject_id string, feature_role string, valid_from string, valid_to string, geometry_source_id string, source_locator string"
    role = "POLITY_EXTERNAL_BOUNDARY"
    rows = [("f", "s", role, "1690-01-01", "1710-01-01", "src", "sheet 1"), ("g", "lost", role, "1690-01-01", "1695-01-01", "other", "UNKNOWN"), ("g", "lost", role, "1690-01-01", "1695-01-01", "other", "UNKNOWN"), ("h", None, None, None, None, None, None)]
    features = spark.createDataFrame(rows, schema)
    rings = spark.createDataFrame([("f", False, [0.0, 1.0, 1.0], [0.0, 0.0, 1.0]), ("g", False, [0.0, 1.0, 1.0, 0.0], [0.0, 1.0, 0.0, 1.0]), ("x", False, [0.0, 1.0], [0.0, 1.0])], "feature_id string, is_hole boolean, xs array<double>, ys array<double>")
    run_on = lambda f: {tuple(r) for r in e.production_faults(f, rings, tables["links"], tables["assertions"], tables["registry"], tables["subjects"], DAY).collect()}
    own = {("GEOMETRY_SOURCE_NOT_REGISTERED", "other"), ("NO_FEATURE_LOCATOR", "UNKNOWN"), ("FEATURE_NOT_VALID_ON_DAY", "1690-01-01..1695-01-01"), ("SUBJECT_NOT_MAPPED", "lost"), ("GEOMETRY_NOT_VALID", "CROSSES_ITSELF"), ("FEATURE_TWICE", "2"), ("NO_EVIDENCE_LINKED", "")}
    nulls = {("GEOMETRY_SOURCE_NOT_REGISTERED", ""), ("NO_FEATURE_LOCATOR", ""), ("FEATURE_NOT_VALID_ON_DAY", ".."), ("SUBJECT_NOT_MAPPED", ""), ("NO_GEOMETRY", ""), ("ROLE_NOT_CONVERTIBLE", "")}
    assert run_on(features) == {("g", *v) for v in own} | {("h", *v) for v in nulls}
    assert run_on(features.limit(0)) == set()
