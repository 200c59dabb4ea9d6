"""Queries on rivers laid on hex edges.

The lines are the orders of a customer, strung out between the customer's place and that of the
customer an eighth as high, into whose river it flows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from hexloom.functions.hexgrid import GridSpec
from hexloom.operators import snapping as o
from hexloom.operators.points import place_points
from hexloom.operators.simplify import simplified

from .registry import register
from .standins import PLACED_SQL, cte, stand_in

GRID, PLACES = GridSpec(3000.0), GridSpec(6000.0)
#: Lines as both engines read them.
LINES = """select branch, k, mx + (ux - mx) * t + wobble * t * (1 - t) as x, my + (uy - my) * t - wobble * t * (1 - t) as y from (
select o_custkey as branch, o_orderkey as k, (o_custkey * 7919) % 61 * 1500e0 as mx, (o_custkey * 10473) % 59 * 1500e0 as my,
 cast(floor(o_custkey / 8) as bigint) * 7919 % 61 * 1500e0 as ux, cast(floor(o_custkey / 8) as bigint) * 10473 % 59 * 1500e0 as uy, (o_orderkey * 7919) % 4001 * 4e0 - 8000 as wobble,
 (row_number() over (partition by o_custkey order by o_orderkey) - 1) * 1e0 / greatest(count(*) over (partition by o_custkey) - 1, 1) as t from {orders}) as strung"""


def lines(s, d):
    s.read.parquet(f"{d}/orders.parquet").createOrReplaceTempView("_line_orders")
    return s.sql(LINES.format(orders="_line_orders"))


def network(s, d):
    """Branches with their receivers, larger the nearer to a mouth."""
    c = s.read.parquet(f"{d}/orders.parquet").select(F.col("o_custkey").alias("branch")).distinct()
    up = F.floor(F.col("branch") / 8)
    return c.select("branch", F.when(F.col("branch") >= 8, up).alias("receiver"), (1e6 / (F.col("branch") + 1)).alias("discharge"))


def water_cells(s, d):
    """Open water: the cells at the places of suppliers."""
    at = s.read.parquet(f"{d}/supplier.parquet").select(((F.col("s_suppkey") * 7919) % 89 * 1000.0).alias("x"), ((F.col("s_suppkey") * 10473) % 83 * 1000.0).alias("y"))
    q, r = GRID.cell(F.col("x"), F.col("y"))
    return at.select(q.alias("q"), r.alias("r")).distinct()


def paths(s, d):
    """The paths as lists, a row each."""
    water = water_cells(s, d).select(GRID.hex_id(F.col("q"), F.col("r")).alias("hex_id"))
    return o.snap_lists(lines(s, d), network(s, d), water, GRID, reach=6000.0, scale=3000.0)


def node_columns(df):
    return df.select("branch", "step", F.col("node.x").alias("node_x"), F.col("node.y").alias("node_y"), F.round("cost", 3).alias("cost"))


def rounded(df):
    return df.select(*[F.round(c, 3).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


register("g04_river_paths", lambda s, d: node_columns(o.steps_of(paths(s, d))))
register("g05_path_metrics", lambda s, d: rounded(o.path_metrics(paths(s, d), lines(s, d), GRID, 6000.0)))
register("g06_mouth_extensions", lambda s, d: node_columns(o.extend_mouths(paths(s, d), network(s, d), water_cells(s, d), GRID)))
register("j32_wide_rivers", lambda s, d: o.wide_river_hexes(lines(s, d).withColumn("width", F.col("branch") % 7 * 500.0), GRID, "width", 2.0))


def asked(s, d):
    """A third along every leg."""
    return o.legs(lines(s, d)).select("branch", "k", (F.col("s0") + F.col("leg") / 3).alias("s"))


register(
    "f32_tangents",
    lambda s, d: o.tangents(lines(s, d), asked(s, d), ["k"]).select(F.col("branch").cast("bigint").alias("branch"), "k", F.round("tx", 3).alias("tx"), F.round("ty", 3).alias("ty")),
    f"""with lines as ({LINES.format(orders="orders")}), ends as (select branch, k, x as x1, y as y1, lead(x) over w as x2, lead(y) over w as y2 from lines window w as (partition by branch order by k)),
long as (select *, sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) as leg from ends where x2 is not null), legs as (select *, sum(leg) over (partition by branch order by k) - leg as s0, sum(leg) over (partition by branch) as total from long),
asked as (select branch, k, e, least(total, greatest(0, s0 + leg / 3 + e * 400)) as at from legs cross join (values (-1), (1)) v(e)),
spots as (select a.branch, a.k, a.e, l.x1 + (l.x2 - l.x1) * case when leg > 0 then (a.at - s0) / leg else 0 end as x, l.y1 + (l.y2 - l.y1) * case when leg > 0 then (a.at - s0) / leg else 0 end as y from asked a asof join legs l on a.branch = l.branch and a.at >= l.s0)
select branch, k, round(sum(e * x), 3) as tx, round(sum(e * y), 3) as ty from spots group by branch, k""",
)


def corners(s, d):
    """The corners of each point's cell, with the point."""
    at = place_points(stand_in(s, d, "points"), PLACES)
    cx, cy = 2 * F.col("q") + F.col("r"), 3 * F.col("r")
    corner = F.explode(F.array(*[F.struct((cx + u).alias("x"), (cy + v).alias("y")) for u, v in o.RING]))
    return at.select(F.col("id").alias("branch"), F.col("x").alias("to_x"), F.col("y").alias("to_y"), corner.alias("node"))


def nearest(s, d, n):
    found = o.nearest_nodes(corners(s, d), PLACES, n)
    return found.select(F.col("branch").alias("id"), F.col("rank").cast("bigint").alias("rank"), F.col("node.x").alias("node_x"), F.col("node.y").alias("node_y"), F.round("distance_m", 3).alias("distance_m"))


NEAREST = cte("points") + PLACED_SQL + """, corners as (select id, 2 * q + r + u as node_x, 3 * r + v as node_y, x, y from placed cross join (values (1, -1), (1, 1), (0, 2), (-1, 1), (-1, -1), (0, -2)) c(u, v)),
away as (select id, node_x, node_y, sqrt((node_x * 3000 - x) * (node_x * 3000 - x) + (node_y * (3000 / sqrt(3e0)) - y) * (node_y * (3000 / sqrt(3e0)) - y)) as m from corners),
ranked as (select *, row_number() over (partition by id order by m, node_x, node_y) as rank from away) select id, rank, cast(node_x as bigint) as node_x, cast(node_y as bigint) as node_y, round(m, 3) as distance_m from ranked where rank <= """
register("t04_nearest_corners", lambda s, d: nearest(s, d, o.JUNCTIONS), NEAREST + "3")
register("t05_nearest_corner", lambda s, d: nearest(s, d, 1), NEAREST + "1")


def g04_simplified(s, d):
    """The lines that paths are laid by where they are simplified first: how many corners stay and how long the line then is."""
    legs = o.legs(simplified(lines(s, d), 1500.0))
    return legs.groupBy("branch").agg((F.count("*") + 1).alias("corners"), F.round(F.sum("leg"), 2).alias("length_m"))


register("g04_simplified_lines", g04_simplified)
