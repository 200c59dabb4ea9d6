"""Line simplification: the corners that a line needs to stay within a distance of itself, all lines at once.

The rule is that of the farthest corner: of the corners between two that are kept the farthest from the straight
way between them is kept if it is farther than the tolerance, and both sides go on so. A round does this for every open stretch
of every line by one grouped maximum; stretches without such a corner are done and leave the table. There are as many
rounds as the deepest line has splits after one another, about the logarithm of its corners for usual lines; each is a written table. No task holds a line.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexloom.operators.snapping import to_leg
from hexloom.tables import written


def simplified(vertices: DataFrame, tolerance_m: float) -> DataFrame:
    """The vertices (branch, k, x, y) of lines that stay: the first and the last, and those that the rule of the farthest corner needs.

    A corner at the tolerance goes. Of equally far ones that with the smaller k is taken. With a tolerance of zero corners on a straight
    way go, and so do repeated ones. Vertices with a null are left out; of vertices with one branch and k the smallest stays. A line of one vertex keeps it.
    """
    corner = lambda *c: F.struct("k", "x", "y")
    all_ = vertices.select(F.col("branch").cast("string").alias("branch"), "k", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).dropna()
    all_ = written(all_.groupBy("branch", "k").agg(F.min(F.struct("x", "y")).alias("p")).select("branch", "k", "p.x", "p.y"), "simplify")
    ends = written(all_.groupBy("branch").agg(F.min(corner()).alias("a"), F.max(corner()).alias("b")), "simplify-ends")
    kept = [ends.select("branch", "a.*"), ends.where("a.k < b.k").select("branch", "b.*")]
    open_ = all_.join(ends, "branch").where("k > a.k and k < b.k")
    while True:
        open_ = written(open_.withColumn("d", to_leg(F.col("x"), F.col("y"), F.col("a.x"), F.col("a.y"), F.col("b.x"), F.col("b.y"))[0]), "simplify-open")
        farthest = open_.groupBy("branch", F.col("a.k").alias("from")).agg(F.max_by(corner(), F.struct("d", (-F.col("k")).alias("o"))).alias("m"), F.max("d").alias("most"))
        farthest = written(farthest.where(F.col("most") > tolerance_m).select("branch", "from", "m"), "simplify-kept")
        if farthest.isEmpty():
            break
        kept.append(farthest.select("branch", "m.*"))
        before = F.col("k") < F.col("m.k")
        split = open_.withColumn("from", F.col("a.k")).join(farthest, ["branch", "from"]).where("k <> m.k")
        open_ = split.select("branch", "k", "x", "y", F.when(before, F.col("a")).otherwise(F.col("m")).alias("a"), F.when(before, F.col("m")).otherwise(F.col("b")).alias("b"))
    return reduce(DataFrame.unionByName, kept)
