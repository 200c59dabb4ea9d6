"""Which boundary features the evidence authorises on a day: joins, one row for each broken rule, no loops over features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexloom.functions.ids import joined_ids
from hexloom.functions.predicates import UNKNOWN, truthy, valid_on, worst_confidence
from hexloom.operators.control import covers_without_gap, orphans, violations
from hexloom.operators.spatial import ring_faults
from hexloom.tables import written

#: For each role of a feature the roles of evidence it needs, and the assertion types each of them must have.
REQUIRED = {
    "POLITY_EXTERNAL_BOUNDARY": {"GEOMETRY_SHAPE": ["BOUNDARY_POSITION", "GEOMETRIC_SUBSTRATE_ONLY"], "POLITICAL_STATUS": ["POLITICAL_CONTROL"]},
    "DE_FACTO_CONTROL_BOUNDARY": {"GEOMETRY_SHAPE": ["BOUNDARY_POSITION", "GEOMETRIC_SUBSTRATE_ONLY"], "POLITICAL_STATUS": ["POLITICAL_CONTROL"]},
    "DE_JURE_CLAIM_BOUNDARY": {"GEOMETRY_SHAPE": ["BOUNDARY_POSITION", "GEOMETRIC_SUBSTRATE_ONLY"], "CLAIM_STATUS": ["DE_JURE_CLAIM"]},
    "DISPUTED_BOUNDARY": {"GEOMETRY_SHAPE": ["BOUNDARY_POSITION", "GEOMETRIC_SUBSTRATE_ONLY"], "CONTESTED_STATUS": ["POLITICAL_CONTROL", "DE_JURE_CLAIM"]},
    "CONSTITUENT_INTERNAL_BOUNDARY": {"GEOMETRY_SHAPE": ["BOUNDARY_POSITION", "GEOMETRIC_SUBSTRATE_ONLY"], "POLITICAL_STATUS": ["POLITICAL_CONTROL", "DE_JURE_CLAIM"]},
}
CONTINUITY = "TEMPORAL_CONTINUITY"
#: Roles that evidence may have, and those that authorise nothing.
EVIDENCE_ROLES = ["GEOMETRY_SHAPE", "POLITICAL_STATUS", "CLAIM_STATUS", "CONTESTED_STATUS", "TEMPORAL_CONTINUITY", "SUPPORTING", "QA_ONLY"]
NO_AUTHORITY_ROLES = ("SUPPORTING", "QA_ONLY")


def requirements(spark) -> DataFrame:
    """The table of required evidence: feature_role, evidence_role, types."""
    rows = [(f, e, types) for f, needs in REQUIRED.items() for e, types in needs.items()]
    return spark.createDataFrame(rows, "feature_role string, evidence_role string, types array<string>")


def _texts(*rules: tuple[Column, str]) -> Column:
    return F.filter(F.array(*[F.when(F.coalesce(broken, F.lit(True)), name) for broken, name in rules]), lambda x: x.isNotNull())


def evaluate(features: DataFrame, links: DataFrame, assertions: DataFrame, registry: DataFrame, day: str, forbidden: tuple[str, ...] = (), free_roles: tuple[str, ...] = NO_AUTHORITY_ROLES) -> tuple[DataFrame, DataFrame]:
    """Broken rules (feature_id, violation, and the evidence_id that breaks it, null where none does) and bundles (feature_id, confidence, evidence_ids, source_ids, roles) of all features.

    A feature needs, for each evidence role that its own role asks for, an assertion on its subject with a locator, from a
    registered source whose level is not forbidden, of an allowed type, with the authority of its kind; other
    evidence than of shape must hold on the day. Shape from another time needs continuity evidence, of political or of continuity authority (a column that may lack), that reaches the day without a gap;
    continuity evidence that can't do so by its type or authority is a fault of its own. Roles of evidence that are not known are faults too.
    """
    spark = features.sparkSession
    no_evidence = F.lit(None).cast(links.schema["evidence_id"].dataType).alias("evidence_id")
    needs = F.broadcast(requirements(spark))
    known = features.join(F.broadcast(needs.select("feature_role").distinct().withColumn("convertible", F.lit(True))), "feature_role", "left")
    role_broken = known.where("convertible is null").select("feature_id", F.lit("ROLE_NOT_CONVERTIBLE").alias("violation"), no_evidence)
    usable = known.where("convertible").select("feature_id", F.col("subject_id").alias("subject"), "feature_role")
    linked = usable.join(links, "feature_id", "left")
    none = linked.where("evidence_id is null").select("feature_id", F.lit("NO_EVIDENCE_LINKED").alias("violation"), no_evidence)
    odd = linked.where(F.col("evidence_id").isNotNull() & ~F.coalesce(F.col("evidence_role").isin(EVIDENCE_ROLES), F.lit(False))).select("feature_id", F.lit("UNKNOWN_EVIDENCE_ROLE").alias("violation"), "evidence_id")
    continuity = F.col("continuity_authority") if "continuity_authority" in assertions.columns else F.lit("NO")
    facts = assertions.select("evidence_id", "subject_id", "source_id", "assertion_type", "valid_from", "valid_to", "locator", "confidence", "geometry_authority", "political_authority", continuity.alias("continuity_authority"), F.lit(True).alias("registered"))
    sources = registry.select("source_id", "authority_level", F.lit(True).alias("source_known"))
    rows = linked.where("evidence_id is not null").join(facts, "evidence_id", "left").join(sources, "source_id", "left")
    # The rules of one piece of evidence, the first broken one counts.
    locator = F.coalesce(F.col("locator"), F.lit(""))
    first = (
        F.when(F.col("registered").isNull(), "EVIDENCE_NOT_REGISTERED")
        .when(~F.coalesce(F.col("subject_id") == F.col("subject"), F.lit(False)), "OTHER_SUBJECT")
        .when((locator == "") | locator.startswith("UNKNOWN"), "NO_EXACT_LOCATOR")
        .when(F.col("source_known").isNull(), "SOURCE_NOT_REGISTERED")
        .when(F.col("authority_level").isin(list(forbidden)) & ~F.col("evidence_role").isin(list(free_roles)), "AUTHORITY_FORBIDDEN")
    )
    rows = written(rows.withColumn("broken", first), "evidence-rows")  # read by every rule below
    bad = rows.where("broken is not null").select("feature_id", F.col("broken").alias("violation"), "evidence_id")
    good = rows.where("broken is null")
    # Of a feature without any evidence that alone is said.
    required = usable.join(rows.select("feature_id"), "feature_id", "left_semi").join(needs, "feature_role").join(good.drop("subject", "feature_role"), ["feature_id", "evidence_role"], "left")
    required = written(required, "evidence-required")
    missing = required.where("evidence_id is null").select("feature_id", F.concat(F.lit("MISSING_"), "evidence_role").alias("violation"), no_evidence)
    shape = F.col("evidence_role") == "GEOMETRY_SHAPE"
    holds = valid_on(F.col("valid_from"), F.col("valid_to"), day)
    fault = (
        F.when(~F.array_contains("types", F.col("assertion_type")), "TYPE_NOT_ALLOWED")
        .when(shape & ~truthy(F.col("geometry_authority")), "NO_GEOMETRY_AUTHORITY")
        .when(~shape & ~truthy(F.col("political_authority")), "NO_POLITICAL_AUTHORITY")
        .when(~shape & ~holds, "NOT_VALID_ON_DAY")
    )
    found = required.where("evidence_id is not null").withColumn("fault", fault)
    faults = found.where("fault is not null").select("feature_id", F.col("fault").alias("violation"), "evidence_id")
    used = found.where("fault is null")
    # Shape from another time: continuity evidence from the shape's end (or begin) to the day.
    off = used.where(shape & ~holds).select("feature_id", F.col("evidence_id").alias("shape_id"), F.when((F.col("valid_to") != UNKNOWN) & (F.col("valid_to") < day), F.col("valid_to")).otherwise(F.col("valid_from")).alias("anchor"))
    unfit = F.when(~F.coalesce(F.col("assertion_type") == "TERRITORIAL_CONTINUITY", F.lit(False)), "CONTINUITY_TYPE_NOT_ALLOWED").when(~(truthy(F.col("political_authority")) | truthy(F.col("continuity_authority"))), "CONTINUITY_WITHOUT_AUTHORITY")
    spans = good.where(F.col("evidence_role") == CONTINUITY).withColumn("unfit", unfit)
    bridge = spans.where("unfit is null")
    # Only where a shape needs to be carried.
    weak = spans.where("unfit is not null").join(off.select("feature_id").distinct(), "feature_id").select("feature_id", F.col("unfit").alias("violation"), "evidence_id")
    pairs = off.join(bridge.select("feature_id", "valid_from", "valid_to"), "feature_id", "left")
    covered = covers_without_gap(pairs, ["feature_id", "shape_id", "anchor"], F.col("anchor"), F.lit(day))
    gaps = covered.where("not covered").select("feature_id", F.lit("SHAPE_NOT_CARRIED_TO_DAY").alias("violation"), F.col("shape_id").alias("evidence_id"))
    broken = role_broken
    for some in (none, odd, bad, missing, faults, weak, gaps):
        broken = broken.unionByName(some)
    broken = broken.distinct()
    carried = covered.where("covered").select("feature_id").distinct().join(bridge, "feature_id")
    columns = ["feature_id", "evidence_id", "source_id", "confidence", "evidence_role"]
    bundle = used.select(*columns).unionByName(carried.select(*columns)).groupBy("feature_id").agg(
        worst_confidence(F.col("confidence")).alias("confidence"), joined_ids(F.col("evidence_id")).alias("evidence_ids"), joined_ids(F.col("source_id")).alias("source_ids"), joined_ids(F.col("evidence_role")).alias("roles")
    )
    return broken, bundle


def compile_snapshot(features: DataFrame, links: DataFrame, assertions: DataFrame, registry: DataFrame, subjects: DataFrame, day: str, **options) -> tuple[DataFrame, DataFrame]:
    """Authorised features of a day with their polity and bundle, and rejected ones with all reasons joined.

    A subject without a polity is a reason; names are never matched.
    """
    chosen = features.where(valid_on(F.col("valid_from"), F.col("valid_to"), day)).join(subjects, "subject_id", "left")
    broken, bundle = evaluate(chosen, links, assertions, registry, day, **options)
    extra = chosen.select("feature_id", F.explode(_texts((F.col("polity_id").isNull(), "SUBJECT_NOT_MAPPED"), (~(F.col("uncertainty_km") >= 0), "NO_UNCERTAINTY"))).alias("violation"))
    reasons = broken.select("feature_id", "violation").unionByName(extra).groupBy("feature_id").agg(F.array_join(F.array_sort(F.collect_set("violation")), "; ").alias("reasons"))
    authorised = chosen.join(reasons, "feature_id", "left_anti").join(bundle, "feature_id")
    return authorised, chosen.join(reasons, "feature_id")


def production_faults(features: DataFrame, rings: DataFrame, links: DataFrame, assertions: DataFrame, registry: DataFrame, subjects: DataFrame, day: str, **options) -> DataFrame:
    """Every fault that keeps a feature from production: feature_id, gate, and the evidence of the fault (an id or a value, empty where something lacks).

    The rules of its bundle (``evaluate``), and of its own row: a registered geometry_source_id, an exact source_locator, dates that hold the day,
    a shape that is there and whole, a subject with a polity, and an id that no other row has. Null fields break their rule; a feature without id has faults under null.
    """
    # An id that two rows have is judged by what either row breaks.
    broken, _ = evaluate(features, links, assertions, registry, day, **options)
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    bundle = broken.select("feature_id", F.col("violation").alias("gate"), text(F.col("evidence_id")).alias("evidence"))
    known = registry.select(F.col("source_id").alias("geometry_source_id")).distinct().withColumn("source_known", F.lit(True))
    mapped = subjects.where("polity_id is not null").select("subject_id").distinct().withColumn("mapped", F.lit(True))
    drawn = rings.select("feature_id").distinct().withColumn("drawn", F.lit(True))
    rows = features.join(known, "geometry_source_id", "left").join(mapped, "subject_id", "left").join(drawn, "feature_id", "left")
    locator = F.trim(text(F.col("source_locator")))
    rules = [
        (F.col("source_known").isNull(), "GEOMETRY_SOURCE_NOT_REGISTERED", text(F.col("geometry_source_id"))), ((locator == "") | (locator == UNKNOWN), "NO_FEATURE_LOCATOR", locator),
        (~valid_on(F.col("valid_from"), F.col("valid_to"), day), "FEATURE_NOT_VALID_ON_DAY", F.concat(text(F.col("valid_from")), F.lit(".."), text(F.col("valid_to")))),
        (F.col("mapped").isNull(), "SUBJECT_NOT_MAPPED", text(F.col("subject_id"))), (F.col("drawn").isNull(), "NO_GEOMETRY", F.lit("")),
    ]
    found = F.filter(F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.struct(F.lit(gate).alias("gate"), value.alias("evidence"))) for bad, gate, value in rules]), lambda x: x.isNotNull())
    own = rows.select("feature_id", F.explode(found).alias("f")).select("feature_id", "f.*")
    shapes = ring_faults(rings).join(features.select("feature_id").distinct(), "feature_id", "left_semi").select("feature_id", F.lit("GEOMETRY_NOT_VALID").alias("gate"), F.col("fault").alias("evidence"))
    twice = features.groupBy("feature_id").agg(F.count("*").alias("n")).where("n > 1").select("feature_id", F.lit("FEATURE_TWICE").alias("gate"), F.col("n").cast("string").alias("evidence"))
    return bundle.unionByName(own).unionByName(shapes).unionByName(twice).distinct()


def assertion_faults(assertions: DataFrame, registry: DataFrame, types: list[str]) -> DataFrame:
    """Broken rules of the assertion table: enums, YES or NO, order of dates, unknown sources, and statements made twice."""
    yes_no = lambda c: F.upper(F.col(c)).isin("YES", "NO")
    unknown = lambda c: F.col(c) == UNKNOWN
    rules = {"TYPE": F.col("assertion_type").isin(types), "GEOMETRY_AUTHORITY": yes_no("geometry_authority"), "POLITICAL_AUTHORITY": yes_no("political_authority"), "DATES": unknown("valid_from") | unknown("valid_to") | (F.col("valid_from") <= F.col("valid_to"))}
    rows = violations(assertions, "evidence_id", rules)
    lost = orphans(assertions, "source_id", registry, "source_id", "SOURCE").select(F.col("value").alias("evidence_id"), F.lit("SOURCE").alias("rule"))
    same = ["subject_id", "source_id", "assertion_type", "valid_from", "valid_to"]
    twice = assertions.groupBy(*same).agg(F.min("evidence_id").alias("evidence_id"), F.count("*").alias("n")).where("n > 1").select("evidence_id", F.lit("SAID_TWICE").alias("rule"))
    return rows.unionByName(lost).unionByName(twice)
