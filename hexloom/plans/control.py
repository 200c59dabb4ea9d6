"""Queries on control, evidence and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from hexloom.functions import ids
from hexloom.functions.predicates import worst_confidence
from hexloom.operators import control as c

from .registry import register
from .standins import cte, stand_in

HOLD, EV, CO = cte("holdings"), cte("evidence"), cte("control")
hold = lambda s, d: stand_in(s, d, "holdings")
evidence = lambda s, d: stand_in(s, d, "evidence")
LEVELS = "['UNKNOWN', 'LOW', 'MEDIUM', 'HIGH']"
level = lambda: F.element_at(F.array(*map(F.lit, ("UNKNOWN", "LOW", "MEDIUM", "HIGH"))), F.col("level") + 1)
SUMS = HOLD + ", s as (select hex_id, polity_id, sum(km2) as km2 from holdings group by all), k as (select *, row_number() over (partition by hex_id order by km2 desc, polity_id) as rn, lead(km2) over (partition by hex_id order by km2 desc, polity_id) as nx, count(*) over (partition by hex_id) as n from s)"
register("w01_dominant", lambda s, d: c.dominant(hold(s, d), "hex_id", "polity_id", "km2"), SUMS + " select hex_id, polity_id, km2, coalesce(nx, 0e0) as runner_up, km2 - coalesce(nx, 0e0) as margin, n as holders, n > 1 as is_border from k where rn = 1")
register(
    "w05_ranked_shares",
    lambda s, d: c.ranked_shares(hold(s, d).groupBy("hex_id", "polity_id").agg(F.sum("km2").alias("km2")), "hex_id", "polity_id", "km2").select("hex_id", "polity_id", F.col("rank").cast("bigint"), F.round("share", 9).alias("share")),
    SUMS + " select hex_id, polity_id, rn as rank, round(km2 / sum(km2) over (partition by hex_id), 9) as share from k",
)
register("p11_snapshot", lambda s, d: c.snapshot(evidence(s, d), "2024-01-15").select("evidence_id", "subject", "valid_from", "valid_to"), EV + " select evidence_id, subject, valid_from, valid_to from evidence where valid_from <= '2024-01-15' and valid_to >= '2024-01-15'")
register("a27_worst_confidence", lambda s, d: evidence(s, d).groupBy("subject").agg(worst_confidence(level()).alias("confidence")), EV + f" select subject, list_extract({LEVELS}, cast(min(level) as int) + 1) as confidence from evidence group by subject")
register(
    "w07_continuous_cover",
    lambda s, d: c.covers_without_gap(evidence(s, d), ["subject"], F.lit("2024-01-05"), F.lit("2024-01-25")),
    EV + """, m as (select *, greatest('2024-01-05', coalesce(max(valid_to) over (partition by subject order by valid_from, valid_to rows between unbounded preceding and 1 preceding), '2024-01-05')) as reached from evidence)
select subject, not bool_or(valid_from > reached and reached < '2024-01-25') and max(valid_to) >= '2024-01-25' as covered from m group by subject""",
)
register("f38_violations", lambda s, d: c.violations(evidence(s, d), "evidence_id", {"level_known": F.col("level") > 0, "type_allowed": F.col("assertion_type").isin("click", "view", "purchase"), "dates_ordered": F.col("valid_from") < F.col("valid_to")}).select("evidence_id", "rule"), EV + " select evidence_id, 'level_known' as rule from evidence where not level > 0 union all select evidence_id, 'type_allowed' from evidence where assertion_type not in ('click', 'view', 'purchase') union all select evidence_id, 'dates_ordered' from evidence where not valid_from < valid_to")
register("q06_duplicate_assertions", lambda s, d: c.duplicate_keys(evidence(s, d), ["subject", "assertion_type", "valid_from"]), EV + " select subject, assertion_type, valid_from, count(*) as rows from evidence group by all having count(*) > 1")
register("f12_ids", lambda s, d: evidence(s, d).select("evidence_id", ids.hashed_id("hev_", F.col("subject"), F.col("assertion_type"), F.col("valid_from"), F.col("valid_to")).alias("hev_id"), ids.relationship_id("rel_", F.lit("s1"), F.col("assertion_type"), F.col("valid_to"), F.col("valid_from"), F.col("level") > 1).alias("rel_id")), EV + " select evidence_id, 'hev_' || substr(sha1(concat_ws('|', subject, assertion_type, valid_from, valid_to)), 1, 12) as hev_id, 'rel_' || substr(sha1(concat_ws('|', 's1', assertion_type, case when level > 1 then least(valid_from, valid_to) else valid_to end, case when level > 1 then greatest(valid_from, valid_to) else valid_from end)), 1, 12) as rel_id from evidence")
register("f15_provenance_ids", lambda s, d: hold(s, d).groupBy("hex_id").agg(ids.joined_ids(F.col("polity_id").cast("string")).alias("sources")).select("hex_id", ids.hashed_id("prov_", F.col("sources")).alias("provenance_id")), HOLD + " select hex_id, 'prov_' || substr(sha1(string_agg(distinct cast(polity_id as varchar), '|' order by cast(polity_id as varchar))), 1, 12) as provenance_id from holdings group by hex_id")
register("f36_colours", lambda s, d: hold(s, d).select("polity_id").distinct().select("polity_id", ids.colour(F.col("polity_id")).alias("colour")))
register("a23_frame_hash", lambda s, d: ids.frame_hash(hold(s, d), ["polity_id"]))

control = lambda s, d: stand_in(s, d, "control").withColumns({"scenario_id": F.lit("s1"), "target_type": F.lit("TERRESTRIAL_HEX")})
LOG = "promotion_id string, scenario_id string, stage string, promotion_status string, promoted string, promoted_rows bigint, controlled bigint, unresolved bigint, supersedes string"
REV = "revision_id string, scenario_id string, target_type string, target_id bigint, old_promotion_id string, new_promotion_id string, old_status string, new_status string, old_controller string, new_controller string, reason string"


def tables(s, d):
    """Canonical rows of a third of the targets, their provenance, and empty logs."""
    canonical = control(s, d).where("target_id % 3 = 0").select(*c.KEY, "controller", "status", F.lit("src_0").alias("source_id"))
    provenance = canonical.select(*c.KEY, F.lit("promo_0").alias("promotion_id"), F.lit("stage0").alias("stage"), "source_id")
    log = s.createDataFrame([("promo_0", "s1", "stage0", "PROMOTED", "2024-01-01", 1, 1, 0, None)], LOG)
    return canonical, provenance, log, s.createDataFrame([], REV)


def candidate(s, d, keep):
    status = F.when(F.col("price") % 2 < 1, "UNRESOLVED").otherwise(F.col("status"))
    return control(s, d).where(keep).select("target_type", "target_id", "controller", status.alias("status"))


def m05(s, d):
    canonical, provenance, log, _ = tables(s, d)
    kept, *_ = c.promote(canonical, provenance, log, candidate(s, d, "target_id % 3 = 1"), "s1", "stage1", "src_1", "2024-02-01")
    return kept.select("target_id", "controller", "status", "source_id")


NEW = "case when price % 2 < 1 then 'UNRESOLVED' else status end"
register("m05_promote", m05, CO + f" select target_id, controller, status, 'src_0' as source_id from control where target_id % 3 = 0 union all select target_id, controller, {NEW}, 'src_1' from control where target_id % 3 = 1")


def m06(part):
    def run(s, d):
        kept, sources, logged, history, report = c.revise(*tables(s, d), candidate(s, d, "target_id % 2 = 0"), "s1", "stage2", "src_2", "measured again", "2024-03-01")
        return {"rows": kept.select("target_id", "controller", "status", "source_id"), "history": history.select("target_id", "old_promotion_id", "old_status", "new_status", "old_controller", "new_controller"), "report": report, "log": logged.select("stage", "promotion_status", "promoted_rows", "controlled", "unresolved", "supersedes")}[part]

    return run


REVISED = f"target_id % 3 = 0 and target_id % 2 = 0 and {NEW} <> status"
register("m06_revise", m06("rows"), CO + f" select target_id, controller, case when {REVISED} then {NEW} else status end as status, case when {REVISED} then 'src_2' else 'src_0' end as source_id from control where target_id % 3 = 0 union all select target_id, controller, {NEW}, 'src_2' from control where target_id % 2 = 0 and target_id % 3 <> 0")
register("m06_revision_log", m06("history"), CO + f" select target_id, 'promo_0' as old_promotion_id, status as old_status, {NEW} as new_status, controller as old_controller, controller as new_controller from control where {REVISED}")
register("m06_report", m06("report"), CO + f" select count(*) filter (target_id % 3 <> 0) as inserted, count(*) filter ({REVISED}) as revised, count(*) filter (target_id % 3 = 0 and not ({REVISED})) as unchanged from control where target_id % 2 = 0")
register("m06_promotion_log", m06("log"), CO + f" select 'stage0' as stage, 'SUPERSEDED' as promotion_status, 1 as promoted_rows, 1 as controlled, 0 as unresolved, null as supersedes union all select 'stage2', 'PROMOTED', count(*), count(*) filter ({NEW} = 'CONTROLLED'), count(*) filter ({NEW} = 'UNRESOLVED'), 'promo_0' from control where target_id % 2 = 0".replace("1 as promoted_rows, 1 as controlled, 0 as unresolved", "cast(1 as bigint) as promoted_rows, cast(1 as bigint) as controlled, cast(0 as bigint) as unresolved"))


def m07(s, d):
    canonical, provenance, *_ = tables(s, d)
    extra = canonical.where("target_id % 30 = 0")
    polities = canonical.where("target_id % 9 = 0").select("controller").distinct()
    few = s.range(0, 1500, 3).select(F.col("id").alias("target_id"))
    return c.validate_control(canonical.unionByName(extra), provenance, polities, s.createDataFrame([("src_0",)], "source_id string"), {"TERRESTRIAL_HEX": few}, s.createDataFrame([("Brand#12",)], "polity string"))


register("m07_validate", m07, CO + """, c as (select * from control where target_id % 3 = 0), x as (select * from c union all select * from c where target_id % 30 = 0)
select 'duplicate_target' as "check", cast(target_id as varchar) as value, cast(1 as bigint) as rows from x group by target_id having count(*) > 1
union all select 'orphan_controller', controller, count(*) from x where controller not in (select controller from c where target_id % 9 = 0) group by controller
union all select 'structural_holder', controller, count(*) from x where controller = 'Brand#12' group by controller
union all select 'unknown_target', cast(target_id as varchar), count(*) from x where target_id >= 1500 group by target_id""")
register("m09_would_change", lambda s, d: c.would_change(tables(s, d)[0], candidate(s, d, "target_id % 2 = 0")).select("target_id", "status", "new_status", "would_change"), CO + f" select target_id, status, {NEW} as new_status, {NEW} <> status as would_change from control where target_id % 6 = 0")
register("u04_keys_subset", lambda s, d: control(s, d).where("target_id % 3 = 0").join(control(s, d).where("target_id % 2 = 0").select("target_id"), "target_id", "left_anti").agg(F.count("*").alias("missing")), CO + " select count(*) as missing from control where target_id % 3 = 0 and target_id % 2 <> 0")
register("u06_new_and_conflicts", lambda s, d: control(s, d).where("target_id % 2 = 0").join(control(s, d).where("target_id % 3 = 0").select("target_id", F.lit(True).alias("there")), "target_id", "left").select("target_id", F.when(F.col("there"), "CONFLICT").otherwise("NEW").alias("kind")), CO + " select target_id, case when target_id % 3 = 0 then 'CONFLICT' else 'NEW' end as kind from control where target_id % 2 = 0")
register("u08_duplicate_keys", lambda s, d: c.duplicate_keys(hold(s, d), ["hex_id", "polity_id"]), HOLD + " select hex_id, polity_id, count(*) as rows from holdings group by all having count(*) > 1")
register("u10_delta", lambda s, d: (lambda t: (lambda out: c.delta(out[0], out[1], out[3], out[2].where("stage = 'stage2'").first()["promotion_id"]).select("target_id", "status", "old_status", "change"))(c.revise(*t, candidate(s, d, "target_id % 2 = 0"), "s1", "stage2", "src_2", "measured again", "2024-03-01")))(tables(s, d)), CO + f" select target_id, {NEW} as status, status as old_status, 'REVISED' as change from control where {REVISED} union all select target_id, {NEW}, null, 'INSERTED' from control where target_id % 2 = 0 and target_id % 3 <> 0")
register("u11_same_tables", lambda s, d: c.same_tables(control(s, d).withColumn("run_id", F.lit(1)), control(s, d).where("target_id <> 7").withColumn("run_id", F.lit(2))), CO + " select 'only_first' as side, count(*) as rows from control where target_id = 7 union all select 'only_second', cast(0 as bigint)")
register("j40_orphans", lambda s, d: c.orphans(hold(s, d), "polity_id", s.range(0, 50).withColumnRenamed("id", "polity"), "polity", "polity_id"), HOLD + " select 'polity_id' as reference, cast(polity_id as varchar) as value, count(*) as rows from holdings where polity_id >= 50 group by polity_id")
register("j41_unknown_targets", lambda s, d: c.unknown_targets(control(s, d).withColumn("target_type", F.when(F.col("target_id") % 2 == 0, "HEX").otherwise("COMPONENT")), {"HEX": s.range(0, 1000), "COMPONENT": s.range(500, 2000)}).select("target_type", "target_id"), CO + " select case when target_id % 2 = 0 then 'HEX' else 'COMPONENT' end as target_type, target_id from control where (target_id % 2 = 0 and target_id >= 1000) or (target_id % 2 = 1 and (target_id < 500 or target_id >= 2000))")
register("q17_supersession", lambda s, d: c.supersession(control(s, d).select("target_id", F.when(F.col("size") % 4 == 0, "SUPERSEDED").otherwise("ACTIVE").alias("st"), F.when(F.col("size") % 4 != 1, F.lit(None)).otherwise(F.concat_ws("|", (F.col("target_id") + 1).cast("string"), (F.col("target_id") + 2).cast("string"))).alias("succ")), "target_id", "st", "succ"), CO + """, r as (select target_id, case when size % 4 = 0 then 'SUPERSEDED' else 'ACTIVE' end as st, size % 4 = 1 as listed from control), n as (select target_id + v.k as t from r cross join (values (1), (2)) v(k) where listed)
select 'active_with_successor' as "check", cast(target_id as varchar) as value from r where st = 'ACTIVE' and listed union all select 'superseded_without_successor', cast(target_id as varchar) from r where st = 'SUPERSEDED' and not listed union all select distinct 'successor_not_active', cast(t as varchar) from n where t not in (select target_id from r where st = 'ACTIVE')""")
register("q19_held_twice", lambda s, d: c.held_twice(hold(s, d), "hex_id", "polity_id"), HOLD + " select hex_id, count(distinct polity_id) as holders from holdings group by hex_id having count(distinct polity_id) > 1")
register("p12_resolve_status", lambda s, d: c.resolve_status(control(s, d).select("target_id", (F.col("target_id") % 10).alias("unit")), control(s, d).where("target_id % 4 = 0"), s.range(10).select(F.col("id").alias("unit"), F.when(F.col("id") < 6, "COMPLETE").otherwise("EVIDENCE_PARTIAL").alias("coverage"))).select("target_id", "status"), CO + " select target_id, case when target_id % 4 = 0 then status when target_id % 10 < 6 then 'UNCONTROLLED' else 'UNKNOWN_COVERAGE_INCOMPLETE' end as status from control")
register("p13_border_confidence", lambda s, d: control(s, d).select("target_id", c.border_confidence(F.col("size") * 1.0, F.lit(8.0), F.col("target_id") % 3).alias("confidence")), CO + " select target_id, case when size <= 8 then 'BORDER_UNCERTAIN' when target_id % 3 > 1 then 'BORDER' else 'INTERIOR' end as confidence from control")
register("p32_share_status", lambda s, d: (lambda sr: control(s, d).select("target_id", sr[0].alias("status"), sr[1].alias("reason")))(c.share_status(F.col("target_id") % 7 != 0, F.least(F.col("size") * 1.0, F.lit(40.0)), F.greatest(F.col("size") * 1.0, F.lit(10.0)))), CO + ", f as (select target_id, target_id % 7 <> 0 as t, 1 - least(size, 40e0) / greatest(size, 10e0) as o from control) select target_id, case when not t then 'NOT_PRODUCED' when o <= 0 then 'CONTROLLED' else 'UNRESOLVED' end as status, case when not t then 'NON_TERRESTRIAL' when o <= 0 then null when o > 0.02e0 then 'MIXED_COMPONENT' else 'UNCERTAIN_BAND' end as reason from f")
register("a33_status_counts", lambda s, d: control(s, d).groupBy("status", "controller").agg(F.count("*").alias("rows")), CO + " select status, controller, count(*) as rows from control group by all")
register("m12_safe_interior", lambda s, d: c.safe_interior(control(s, d).withColumn("boundary_km", F.col("size") * 1.0), 12.5).select("target_id"), CO + " select target_id from control where size >= 12.5")
register("m03_control_rows", lambda s, d: c.control_rows(c.dominant(hold(s, d), "hex_id", "polity_id", "km2").select(F.col("hex_id").alias("target_id"), F.col("polity_id").alias("holder"), (~F.col("is_border") | (F.col("margin") > 5)).alias("is_dominant")), hold(s, d).groupBy(F.col("polity_id").alias("holder")).agg(F.concat(F.lit("p"), F.count("*").cast("string")).alias("provenance_id")), "s1").select("target_id", "controller", "source_id"), SUMS + ", p as (select polity_id, 'p' || count(*) as provenance_id from holdings group by 1) select k.hex_id as target_id, k.polity_id as controller, p.provenance_id as source_id from k join p on p.polity_id = k.polity_id where rn = 1 and (n = 1 or km2 - coalesce(nx, 0) > 5)")
