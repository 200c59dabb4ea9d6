"""Who holds which cell: dominance, temporal selection, promotion, revision and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexloom.functions.ids import frame_hash, hashed_id
from hexloom.functions.predicates import UNKNOWN, valid_on

KEY = ["scenario_id", "target_type", "target_id"]


def dominant(shares: DataFrame, by: str, holder: str, value: str) -> DataFrame:
    """For each group the holder with the most, its value, the runner-up's, the margin, the number of holders and whether there are several; of ties the smaller holder."""
    sums = shares.groupBy(by, holder).agg(F.sum(value).alias(value))
    counts = sums.groupBy(by).agg(F.count("*").alias("holders"))
    place = F.row_number().over(Window.partitionBy(by).orderBy(F.desc(value), holder))
    first = sums.withColumn("place", place).where("place <= 2").groupBy(by).agg(
        F.max(F.when(F.col("place") == 1, F.col(holder))).alias(holder), F.max(F.when(F.col("place") == 1, F.col(value))).alias(value), F.coalesce(F.max(F.when(F.col("place") == 2, F.col(value))), F.lit(0.0)).alias("runner_up"),
    )
    return first.join(counts, by).select(by, holder, value, "runner_up", (F.col(value) - F.col("runner_up")).alias("margin"), "holders", (F.col("holders") > 1).alias("is_border"))


def ranked_shares(parts: DataFrame, by: str, key: str, value: str) -> DataFrame:
    """Each part with its rank in its group (largest first, then the smaller key) and its share of the group."""
    return parts.withColumns({
        "rank": F.row_number().over(Window.partitionBy(by).orderBy(F.desc(value), key)),
        "share": F.try_divide(F.col(value), F.sum(value).over(Window.partitionBy(by))),
    })


def covers_without_gap(intervals: DataFrame, by: list[str], start: Column, end: Column) -> DataFrame:
    """For each group whether its intervals (valid_from, valid_to) together cover start to end; null or unknown ends count for nothing.

    An interval may begin where an earlier one ends, not later. start and end are columns of the group.
    """
    low, high = F.least(start, end), F.greatest(start, end)
    known = intervals.withColumns({"_a": low, "_b": high}).where(
        F.coalesce((F.col("valid_from") != UNKNOWN) & (F.col("valid_to") != UNKNOWN) & (F.col("valid_from") != "") & (F.col("valid_to") != ""), F.lit(False))
    )
    w = Window.partitionBy(*by).orderBy("valid_from", "valid_to").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest(F.col("_a"), F.coalesce(F.max("valid_to").over(w), F.col("_a")))
    gap = (F.col("valid_from") > reached) & (reached < F.col("_b"))
    # A gap before the end spoils the cover; rows after it don't mend it.
    each = known.withColumn("gap", gap)
    found = each.groupBy(*by).agg((~F.bool_or("gap") & (F.max("valid_to") >= F.max("_b"))).alias("covered"))
    all_groups = intervals.select(*by).distinct()
    return all_groups.join(found, by, "left").withColumn("covered", F.coalesce("covered", F.lit(False)))


def snapshot(features: DataFrame, day: str) -> DataFrame:
    """Features that hold on a day."""
    return features.where(valid_on(F.col("valid_from"), F.col("valid_to"), day))


def resolve_status(targets: DataFrame, control: DataFrame, coverage: DataFrame, strict: bool = False) -> DataFrame:
    """Each target (target_id, unit) with its status: a control row's, UNCONTROLLED under complete coverage, else unknown; strict raises for those."""
    out = targets.join(control.select("target_id", "status"), "target_id", "left").join(coverage.select("unit", "coverage"), "unit", "left")
    missing = F.raise_error(F.concat(F.lit("no control row under incomplete coverage: "), F.col("target_id").cast("string"))).cast("string") if strict else F.lit("UNKNOWN_COVERAGE_INCOMPLETE")
    return out.withColumn("status", F.when(F.col("status").isNotNull(), F.col("status")).when(F.coalesce(F.col("coverage") == "COMPLETE", F.lit(False)), "UNCONTROLLED").otherwise(missing)).drop("coverage")


def border_confidence(distance_km: Column, uncertainty_km: Column, holders: Column) -> Column:
    """How sure a cell's holder is: within the source's uncertainty, at a border, or inside."""
    return F.when(distance_km <= uncertainty_km, "BORDER_UNCERTAIN").when(holders > 1, "BORDER").otherwise("INTERIOR")


def safe_interior(cells: DataFrame, uncertainty_km: float, distance: str = "boundary_km") -> DataFrame:
    """Cells at least as far from the frontier as it is uncertain."""
    return cells.where(F.col(distance) >= uncertainty_km)


def share_status(terrestrial: Column, inside: Column, land: Column, limit: float = 0.02) -> tuple[Column, Column]:
    """Status and reason of a cell from the part of its land inside one safe interior."""
    outside = F.when(land > 0, 1 - inside / land)
    status = F.when(~terrestrial, "NOT_PRODUCED").when(outside <= 0, "CONTROLLED").otherwise("UNRESOLVED")
    reason = F.when(~terrestrial, "NON_TERRESTRIAL").when(outside <= 0, F.lit(None)).when(outside > limit, "MIXED_COMPONENT").otherwise("UNCERTAIN_BAND")
    return status, reason


def control_rows(memberships: DataFrame, provenance: DataFrame, scenario: str) -> DataFrame:
    """Control rows of the dominant memberships (target_id, holder, is_dominant); a holder without provenance is an error."""
    held = memberships.where("is_dominant").join(provenance, "holder", "left")
    checked = F.when(F.coalesce(F.col("provenance_id"), F.lit("")) == "", F.raise_error(F.concat(F.lit("no provenance for "), F.col("holder").cast("string"))).cast("string")).otherwise(F.col("provenance_id"))
    return held.select(F.lit(scenario).alias("scenario_id"), F.lit("TERRESTRIAL_HEX").alias("target_type"), "target_id", F.col("holder").alias("controller"), F.lit("CONTROLLED").alias("status"), checked.alias("source_id"))


def promotion_id(candidate: DataFrame, scenario: str, stage: str) -> str:
    """The id that the same candidate from the same stage always gets, whatever the order of its rows."""
    digest = frame_hash(candidate).first()
    content = digest["content_sha256"] if digest else "empty"
    return candidate.sparkSession.range(1).select(hashed_id("promo_", F.lit(scenario), F.lit(stage), F.lit(content))).first()[0]


def promote(canonical: DataFrame, provenance: DataFrame, log: DataFrame, candidate: DataFrame, scenario: str, stage: str, source_id: str, promoted: str, review_status: str = "REVIEWED"):
    """Insert a reviewed candidate (target_type, target_id, controller, status, confidence) into canonical control.

    Returns the new canonical, provenance and log tables and a one-row report. A second promotion of the same
    candidate changes nothing. A target that carries a row of another promotion, a target given twice
    and a candidate that is not reviewed are errors.
    """
    if review_status not in ("REVIEWED", "PROMOTED"):
        raise ValueError(f"only reviewed candidates are promoted, not {review_status}")
    pid = promotion_id(candidate, scenario, stage)
    new = candidate.withColumn("scenario_id", F.lit(scenario))
    if not new.groupBy(*KEY).count().where("count > 1").isEmpty():
        raise ValueError("a target has several rows in the candidate")
    owned = provenance.where(F.col("promotion_id") == pid).select(*KEY, F.lit(True).alias("mine"))
    met = new.join(canonical.select(*KEY), KEY, "left_semi").join(owned, KEY, "left")
    counts = met.agg(F.count_if("mine").alias("already_present"), F.count_if(F.col("mine").isNull()).alias("collisions"), F.min(F.when(F.col("mine").isNull(), F.col("target_id"))).alias("first")).first()
    if counts["collisions"]:
        raise ValueError(f"{counts['collisions']} targets carry a row of another promotion, the first is {counts['first']}")
    rows = new.join(canonical.select(*KEY), KEY, "left_anti")
    kept = canonical.unionByName(rows.withColumn("source_id", F.lit(source_id)).select(*canonical.columns))
    origin = provenance.unionByName(rows.select(*KEY, F.lit(pid).alias("promotion_id"), F.lit(stage).alias("stage"), F.lit(source_id).alias("source_id")).select(*provenance.columns))
    entry = candidate.agg(F.count("*").alias("promoted_rows"), F.count_if(F.col("status") == "CONTROLLED").alias("controlled"), F.count_if(F.col("status") == "UNRESOLVED").alias("unresolved"))
    entry = entry.select(F.lit(pid).alias("promotion_id"), F.lit(scenario).alias("scenario_id"), F.lit(stage).alias("stage"), F.lit("PROMOTED").alias("promotion_status"), F.lit(promoted).alias("promoted"), "promoted_rows", "controlled", "unresolved", F.lit(None).cast("string").alias("supersedes"))
    logged = log.where(F.col("promotion_id") != pid).unionByName(entry.select(*log.columns))
    report = rows.agg(F.count("*").alias("inserted")).select(F.lit(pid).alias("promotion_id"), "inserted", F.lit(counts["already_present"]).cast("bigint").alias("already_present"))
    return kept, origin, logged, report


def revise(canonical: DataFrame, provenance: DataFrame, log: DataFrame, revisions: DataFrame, candidate: DataFrame, scenario: str, stage: str, source_id: str, reason: str, promoted: str):
    """Replace rows that a re-measured candidate changes; new targets are inserted, unchanged ones keep row and provenance.

    Every change goes to the revision log with the state before and after; promotions whose rows were replaced
    are marked SUPERSEDED and stay in the log. Returns canonical, provenance, log, revisions and a one-row report.
    """
    pid = promotion_id(candidate, scenario, stage)
    new = candidate.withColumn("scenario_id", F.lit(scenario))
    old = canonical.select(*KEY, F.col("status").alias("old_status"), F.col("controller").alias("old_controller"), F.lit(True).alias("known"))
    origin = provenance.groupBy(*KEY).agg(F.max("promotion_id").alias("old_promotion"))
    each = new.join(old, KEY, "left").join(origin, KEY, "left").withColumn(
        "change",
        F.when(F.col("known").isNull(), "INSERTED")
        .when(F.col("status").eqNullSafe(F.col("old_status")) & F.col("controller").eqNullSafe(F.col("old_controller")), "UNCHANGED")
        .otherwise("REVISED"),
    )
    touched = each.where("change <> 'UNCHANGED'")
    rows = touched.withColumn("source_id", F.lit(source_id))
    kept = canonical.join(touched.select(*KEY), KEY, "left_anti").unionByName(rows.select(*canonical.columns)) if canonical.columns else rows
    sources = provenance.join(touched.select(*KEY), KEY, "left_anti").unionByName(rows.select(*KEY, F.lit(pid).alias("promotion_id"), F.lit(stage).alias("stage"), "source_id").select(*provenance.columns))
    revised = touched.where("change = 'REVISED'").select(
        hashed_id("rev_", F.lit(scenario), F.lit(pid), F.col("target_id")).alias("revision_id"), *KEY, F.col("old_promotion").alias("old_promotion_id"), F.lit(pid).alias("new_promotion_id"),
        "old_status", F.col("status").alias("new_status"), "old_controller", F.col("controller").alias("new_controller"), F.lit(reason).alias("reason"),
    )
    replaced = revised.where("old_promotion_id is not null").select(F.col("old_promotion_id").alias("promotion_id")).distinct().withColumn("gone", F.lit(True))
    marked = log.join(replaced, "promotion_id", "left").withColumn("promotion_status", F.when(F.col("gone"), "SUPERSEDED").otherwise(F.col("promotion_status"))).select(*log.columns)
    entry = candidate.agg(F.count("*").alias("promoted_rows"), F.count_if(F.col("status") == "CONTROLLED").alias("controlled"), F.count_if(F.col("status") == "UNRESOLVED").alias("unresolved"))
    names = replaced.agg(F.nullif(F.array_join(F.array_sort(F.collect_set("promotion_id")), "|"), F.lit("")).alias("supersedes"))
    entry = entry.crossJoin(names).select(F.lit(pid).alias("promotion_id"), F.lit(scenario).alias("scenario_id"), F.lit(stage).alias("stage"), F.lit("PROMOTED").alias("promotion_status"), F.lit(promoted).alias("promoted"), "promoted_rows", "controlled", "unresolved", "supersedes")
    logged = marked.where(F.col("promotion_id") != pid).unionByName(entry.select(*log.columns))
    history = revisions.join(revised.select("revision_id"), "revision_id", "left_anti").unionByName(revised.select(*revisions.columns))
    report = each.agg(F.count_if(F.col("change") == "INSERTED").alias("inserted"), F.count_if(F.col("change") == "REVISED").alias("revised"), F.count_if(F.col("change") == "UNCHANGED").alias("unchanged"))
    return kept, sources, logged, history, report


def would_change(current: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Promoted targets with their status and controller now and as recomputed, and whether they would change."""
    new = recomputed.select("target_id", F.col("status").alias("new_status"), F.col("controller").alias("new_controller"))
    same = F.col("status").eqNullSafe(F.col("new_status")) & F.col("controller").eqNullSafe(F.col("new_controller"))
    return current.select("target_id", "status", "controller").join(new, "target_id").withColumn("would_change", ~same)


def delta(canonical: DataFrame, provenance: DataFrame, revisions: DataFrame, promotion: str) -> DataFrame:
    """Rows that a promotion touched: revised ones with their state before, the others as inserted."""
    mine = provenance.where(F.col("promotion_id") == promotion).select(*KEY)
    before = revisions.where(F.col("new_promotion_id") == promotion).select(*KEY, "old_status", "old_controller", F.lit("REVISED").alias("change"))
    return canonical.join(mine, KEY, "left_semi").join(before, KEY, "left").withColumn("change", F.coalesce("change", F.lit("INSERTED")))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with several rows, and how many."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def orphans(df: DataFrame, key: str, parents: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Values of a foreign key without a parent, with the number of rows: one table of violations for any key."""
    lost = df.where(F.col(key).isNotNull()).join(parents.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")
    return lost.groupBy(F.col(key).cast("string").alias("value")).agg(F.count("*").alias("rows")).select(F.lit(name).alias("reference"), "value", "rows")


def unknown_targets(df: DataFrame, registries: dict[str, DataFrame]) -> DataFrame:
    """Rows whose (target_type, target_id) is in no registry of its type."""
    known = None
    for kind, ids in registries.items():
        part = ids.select(F.lit(kind).alias("target_type"), F.col(ids.columns[0]).alias("target_id"))
        known = part if known is None else known.unionByName(part)
    return df.join(known, ["target_type", "target_id"], "left_anti")


def validate_control(canonical: DataFrame, provenance: DataFrame, polities: DataFrame, sources: DataFrame, registries: dict[str, DataFrame], structural: DataFrame) -> DataFrame:
    """Violations of the canonical table's rules: check, value, rows. An empty result is a valid table."""
    shape = lambda df, check, value: df.groupBy(F.lit(check).alias("check"), value.cast("string").alias("value")).agg(F.count("*").alias("rows"))
    found = shape(duplicate_keys(canonical, KEY), "duplicate_target", F.col("target_id"))
    for key, parents, name in (("controller", polities, "orphan_controller"), ("source_id", sources, "orphan_source")):
        found = found.unionByName(orphans(canonical, key, parents, parents.columns[0], name).withColumnRenamed("reference", "check"))
    holders = canonical.join(structural.select(F.col(structural.columns[0]).alias("controller")).distinct(), "controller", "left_semi")
    found = found.unionByName(shape(holders, "structural_holder", F.col("controller")))
    found = found.unionByName(shape(unknown_targets(canonical, registries), "unknown_target", F.col("target_id")))
    return found.unionByName(shape(provenance.join(canonical.select(*KEY), KEY, "left_anti"), "provenance_without_row", F.col("target_id")))


def same_tables(a: DataFrame, b: DataFrame, ignored: tuple[str, ...] = ("run_id",)) -> DataFrame:
    """How many rows each of two tables has that the other has not, leaving some columns out: both zero if they are equal."""
    columns = [c for c in a.columns if c not in ignored]
    a, b = a.select(*columns), b.select(*columns)
    only = lambda x, y, side: x.exceptAll(y).agg(F.count("*").alias("rows")).select(F.lit(side).alias("side"), "rows")
    return only(a, b, "only_first").unionByName(only(b, a, "only_second"))


def supersession(rows: DataFrame, key: str, status: str, successors: str) -> DataFrame:
    """Violations of the rules of superseded rows: an active row has no successor, a superseded one has, and each is an active row."""
    listed = F.coalesce(F.col(successors), F.lit("")) != ""
    own = rows.where((F.col(status) == "ACTIVE") & listed).select(F.lit("active_with_successor").alias("check"), F.col(key).cast("string").alias("value"))
    none = rows.where((F.col(status) == "SUPERSEDED") & ~listed).select(F.lit("superseded_without_successor").alias("check"), F.col(key).cast("string").alias("value"))
    named = rows.where(listed).select(F.explode(F.split(successors, r"\|")).alias("value"))
    active = rows.where(F.col(status) == "ACTIVE").select(F.col(key).cast("string").alias("value"))
    return own.unionByName(none).unionByName(named.join(active, "value", "left_anti").distinct().select(F.lit("successor_not_active").alias("check"), "value"))


def held_twice(rows: DataFrame, target: str = "target_id", holder: str = "controller") -> DataFrame:
    """Targets held by several, with their number."""
    return rows.where(F.col(holder).isNotNull()).groupBy(target).agg(F.countDistinct(holder).alias("holders")).where("holders > 1")


def violations(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """One row for each rule that a row breaks: key and rule. A rule that is null for a row is broken."""
    broken = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules.items()]), lambda x: x.isNotNull())
    return df.select(key, F.explode(broken).alias("rule"))
