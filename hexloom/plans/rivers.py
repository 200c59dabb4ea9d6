"""Queries on river networks, edges and lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from hexloom.operators import rivers as r

from .registry import register
from .standins import cte, stand_in

REACHES = cte("reaches")
RECURSIVE = REACHES.replace("with ", "with recursive ", 1)
CLASS = "case when {0} >= 8000 then 'GREAT' when {0} >= 300 then 'MAJOR' when {0} >= 50 then 'MEDIUM' when {0} >= 10 then 'MINOR' end"
reaches = lambda s, d: stand_in(s, d, "reaches")

register("p14_river_class", lambda s, d: reaches(s, d).select("reach_id", r.river_class(F.col("discharge")).alias("river_class")), REACHES + f" select reach_id, {CLASS.format('discharge')} as river_class from reaches")
register("s06_load_reaches", lambda s, d: r.load_reaches(reaches(s, d)).select("reach_id", "next_down", "river_class"), REACHES + f" select reach_id, next_down, {CLASS.format('discharge')} as river_class from reaches where discharge >= 10")
register("f30_width", lambda s, d: reaches(s, d).select("reach_id", F.round(r.width(F.col("discharge")), 6).alias("width_m")), REACHES + " select reach_id, round(7.2e0 * sqrt(greatest(discharge, 0)), 6) as width_m from reaches")
register(
    "p15_representation",
    lambda s, d: reaches(s, d).select("reach_id", r.representation(r.river_class(F.col("discharge") * 40), r.width(F.col("discharge") * 40), 5.0).alias("representation")),
    REACHES + f" select reach_id, case when coalesce({CLASS.format('(discharge * 40)')} = 'GREAT', false) and 7.2e0 * sqrt(discharge * 40) * 5 >= 2500 then 'WATER_HEX_RIVER' else 'EDGE_RIVER' end as representation from reaches",
)
BRANCHES = RECURSIVE + f""", linked as (select a.reach_id, a.discharge, case when b.reach_id is null then 0 else a.next_down end as next_down from reaches a left join reaches b on b.reach_id = a.next_down),
up as (select next_down as reach_id, count(*) as n from linked where next_down <> 0 group by 1),
heads as (select l.reach_id from linked l left join up u on u.reach_id = l.reach_id where coalesce(u.n, 0) <> 1),
chain(head, reach_id, k) as (select reach_id, reach_id, 0 from heads union all select c.head, l.next_down, k + 1 from chain c join linked l on l.reach_id = c.reach_id join up u on u.reach_id = l.next_down and u.n = 1),
branches as (select 'br_' || head as branch_id, list(c.reach_id order by k) as reach_ids, arg_max(l.discharge, k) as discharge, arg_max(l.next_down, k) as next_down_reach from chain c join linked l on l.reach_id = c.reach_id group by head)"""
branches = lambda s, d: r.branches(reaches(s, d))
register(
    "g02_branches",
    lambda s, d: branches(s, d).select("branch_id", F.array_join(F.transform("reach_ids", lambda x: x.cast("string")), "|").alias("reach_ids"), "river_class", F.round("width_m", 6).alias("width_m"), "next_down_reach"),
    BRANCHES + f" select branch_id, array_to_string(reach_ids, '|') as reach_ids, {CLASS.format('discharge')} as river_class, round(7.2e0 * sqrt(discharge), 6) as width_m, next_down_reach from branches",
)
register("j37_confluences", lambda s, d: r.receivers(branches(s, d)).select("branch_id", "receiver_id"), BRANCHES + ", m as (select branch_id as receiver_id, unnest(reach_ids) as reach_id from branches) select b.branch_id, m.receiver_id from branches b join m on m.reach_id = b.next_down_reach")


def g03(s, d):
    table = branches(s, d)
    number = F.expr("cast(substring(branch_id, 4) as bigint)")
    return r.names_downstream(table, table.where(number % 11 == 0).select("branch_id", F.concat(F.lit("river_"), (number % 5).cast("string")).alias("name"))).select("branch_id", "name", F.col("steps").cast("bigint"))


register("g03_names_downstream", g03, BRANCHES + """, m as (select branch_id as receiver_id, unnest(reach_ids) as reach_id from branches), down as (select b.branch_id, m.receiver_id from branches b join m on m.reach_id = b.next_down_reach),
seeds as (select branch_id, 'river_' || (cast(substr(branch_id, 4) as bigint) % 5) as name from branches where cast(substr(branch_id, 4) as bigint) % 11 = 0),
flow(branch_id, name, steps) as (select branch_id, name, 0 from seeds union all select d.receiver_id, f.name, f.steps + 1 from flow f join down d on d.branch_id = f.branch_id where d.receiver_id not in (select branch_id from seeds)),
best as (select branch_id, name, steps, row_number() over (partition by branch_id order by steps, name) as k from flow) select b.branch_id, f.name, cast(f.steps as bigint) as steps from branches b left join best f on f.branch_id = b.branch_id and f.k = 1""")
register(
    "g11_reaches_water",
    lambda s, d: r.reach_open_water(reaches(s, d), reaches(s, d).where("next_down = 0 and reach_id % 3 = 1").select("reach_id")),
    RECURSIVE + ", walk(reach_id, here, links) as (select reach_id, reach_id, 0 from reaches union all select w.reach_id, r.next_down, links + 1 from walk w join reaches r on r.reach_id = w.here where r.next_down <> 0), e as (select reach_id, arg_max(here, links) as terminal_reach, max(links) as links from walk group by 1) select reach_id, terminal_reach, cast(links as bigint) as links, terminal_reach % 3 = 1 as reaches_water from e",
)
MEMBER = cte("membership")
member = lambda s, d: stand_in(s, d, "membership")
register("a12_edge_importance", lambda s, d: r.edge_rows(member(s, d)).select("edge_id", "branch_id", F.round("importance", 9).alias("importance")), MEMBER + " select edge_id, branch_id, round(log10(greatest(discharge, 0) + 1), 9) as importance from membership")
register(
    "a11_game_edges",
    lambda s, d: r.game_edges(member(s, d)),
    MEMBER + ", t as (select edge_id, arg_max(river_id, (discharge, -river_id, -branch_id)) as dominant_river_id from membership group by edge_id) select m.edge_id, string_agg(distinct cast(river_id as varchar), '|' order by cast(river_id as varchar)) as river_ids, string_agg(distinct cast(branch_id as varchar), '|' order by cast(branch_id as varchar)) as branch_ids, any_value(t.dominant_river_id) as dominant_river_id, max(discharge) as max_discharge, max(width) as crossing_width, count(distinct river_id) as river_count from membership m join t on t.edge_id = m.edge_id group by m.edge_id",
)
register("a28_joined_ids", lambda s, d: member(s, d).groupBy("river_id").agg(r.joined_ids(F.col("edge_id").cast("string")).alias("edge_ids")), MEMBER + " select river_id, string_agg(distinct cast(edge_id as varchar), '|' order by cast(edge_id as varchar)) as edge_ids from membership group by river_id")
register(
    "a13_hex_rivers",
    lambda s, d: r.hex_rivers(member(s, d).select(F.col("edge_id").alias("hex_a"), F.when(F.col("branch_id") % 5 != 0, F.col("branch_id") % 97).alias("hex_b"), r.river_class(F.col("discharge") / 100).alias("river_class"), "discharge", "river_id")),
    MEMBER + f", e as (select edge_id as hex_id, discharge, river_id from membership union all select branch_id % 97, discharge, river_id from membership where branch_id % 5 <> 0) select hex_id, count(*) as river_edge_count, {CLASS.format('max(discharge / 100)')} as max_river_class, max(discharge) as max_discharge, arg_max(river_id, (discharge, -river_id)) as primary_river_id from e group by hex_id",
)
register(
    "p16_edge_penalty",
    lambda s, d: r.edge_penalty(member(s, d).select(F.col("edge_id").alias("hex_a"), F.col("branch_id").alias("hex_b")).distinct(), s.range(0, 5000, 3).select(F.col("id").alias("hex_id"))).select("hex_a", "hex_b", "factor"),
    MEMBER + " select distinct edge_id as hex_a, branch_id as hex_b, case when edge_id % 3 = 0 and edge_id < 5000 and branch_id % 3 = 0 and branch_id < 5000 then 25e0 else 1e0 end as factor from membership",
)
register(
    "a18_offset_statistics",
    lambda s, d: (lambda o: o.select("n", *[F.round(c, 6).alias(c) for c in ("mean", "median", "p95", "most")], "above_100", "above_500"))(r.offset_statistics(reaches(s, d), [100.0, 500.0], "discharge")),
    REACHES + " select count(*) as n, round(avg(discharge), 6) as mean, round(quantile_cont(discharge, 0.5), 6) as median, round(quantile_cont(discharge, 0.95), 6) as p95, round(max(discharge), 6) as most, count(*) filter (discharge > 100) as above_100, count(*) filter (discharge > 500) as above_500 from reaches",
)
register(
    "p26_quality_gates",
    lambda s, d: reaches(s, d).select("reach_id", r.quality(F.when(F.col("reach_id") % 17 != 0, F.col("discharge") / 250), F.col("discharge") * 10, 0.15, 0.3, 3000, 4500).alias("gate")),
    REACHES + " select reach_id, case when reach_id % 17 = 0 then 'N/A' when abs(discharge / 250 - 1) > 0.3e0 or discharge * 10 > 4500 then 'FAIL' when abs(discharge / 250 - 1) > 0.15e0 or discharge * 10 > 3000 then 'WARN' else 'PASS' end as gate from reaches",
)
LINES = cte("reaches").replace("reaches as (select", "lines as (select o_custkey as line, o_orderkey as k, cast(o_totalprice as double) as x, cast((o_orderkey * 7919) % 100003 as double) as y from orders), reaches as (select")


def lines(s, d):
    return s.read.parquet(f"{d}/orders.parquet").selectExpr("o_custkey as line", "o_orderkey as k", "cast(o_totalprice as double) as x", "cast((o_orderkey * 7919) % 100003 as double) as y")


W = "over (partition by line order by k)"
register("w08_turns", lambda s, d: r.turns(lines(s, d), "line", "k").select("line", "k", F.col("turn").cast("bigint"), "same_turn"), LINES + f""", t as (select line, k, (x - lag(x) {W}) * (lead(y) {W} - y) - (y - lag(y) {W}) * (lead(x) {W} - x) as c from lines), u as (select line, k, cast(sign(c) as bigint) as turn from t where c is not null) select line, k, turn, coalesce(lag(turn) {W} = turn and turn <> 0, false) as same_turn from u""")
register("w09_turn_density", lambda s, d: r.turn_density(lines(s, d), "line", "k").select("line", F.round("length_m", 6).alias("length_m"), F.round("turns_per_100km", 6).alias("turns_per_100km")), LINES + f""", l as (select line, k, lead(x) {W} - x as dx, lead(y) {W} - y as dy from lines), m as (select *, atan2(dy, dx) as a from l where dx is not null), c as (select *, abs(a - lag(a) {W}) as ch from m)
select line, round(sum(sqrt(dx * dx + dy * dy)), 6) as length_m, round(case when sum(sqrt(dx * dx + dy * dy)) > 0 then coalesce(degrees(sum(least(ch, 2 * pi() - ch))) / 60, 0) / (sum(sqrt(dx * dx + dy * dy)) / 100000) else 0 end, 6) as turns_per_100km from c group by line""")
register("w14_line_samples", lambda s, d: r.sampled(lines(s, d), "line", "k", 20_000.0).select("line", "sample", F.round("x", 3).alias("x"), F.round("y", 3).alias("y")), LINES + f""", l as (select line, k, x, y, lead(x) {W} as nx, lead(y) {W} as ny from lines), m as (select *, sqrt((nx - x) * (nx - x) + (ny - y) * (ny - y)) as leg from l where nx is not null),
c as (select *, coalesce(sum(leg) over (partition by line order by k rows between unbounded preceding and 1 preceding), 0) as s0 from m), e as (select *, unnest(range(cast(ceil(s0 / 20000) as bigint), cast(ceil((s0 + leg) / 20000) as bigint))) as sample from c where leg > 0)
select line, sample, round(x + (nx - x) * ((sample * 20000 - s0) / leg), 3) as x, round(y + (ny - y) * ((sample * 20000 - s0) / leg), 3) as y from e""")
