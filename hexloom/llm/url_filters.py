"""URL filters as a sort-merge range join on reversed-host keys.

A rule is a host and a path prefix. Its key is the host's labels in reverse
order, a separator and the path, as bytes: everything below the rule sorts into
the interval from the key up to the key followed by 0xFF, a byte that UTF-8
never holds. Intervals of prefixes are nested or disjoint. A url gets one key
for each number of host labels that some rule has, so that a rule also meets
the subdomains of its host.

Rule starts, rule ends and url keys are sorted together into range blocks. A
running sum of starts and ends is the number of nested rules at a place; the
latest start on that level is the innermost one still open, which is the top
of the sweep's stack. The stack a block begins with comes from two small tables:
the number of open rules and the latest start of each level before the block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

ALLOW, BLOCK = "allow", "block"
START, POINT, END = 0, 1, 2
_A_TO_Z = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path, both empty where the url is null or has no ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), *_A_TO_Z)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def _key(labels: Column, depth: Column, path: Column) -> Column:
    """The last ``depth`` labels in reverse order, a zero byte after each, then the path."""
    host = F.concat_ws("\0", F.slice(F.reverse(labels), F.lit(1), depth))
    return F.concat(host, F.lit("\0\0"), path).cast("binary")


def match_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = ALLOW) -> DataFrame:
    """Every row of ``pages`` with the rule that decides on its url.

    ``rules`` has columns host, path and verdict. A rule fits its host and all
    subdomains where the url's path starts with the rule's path; the rule with
    the longest host plus path wins, then the longest host; of the same rule
    given twice, a block goes before an allow. Adds columns host, path, rule
    (host plus path, null where none fits) and verdict (``default`` where none
    fits); a column of ``pages`` with one of these names is replaced.

    Null urls and urls without ``://`` have an empty host and path and meet no
    rule, unless a rule has an empty host. Rows with a null host or verdict are
    no rules; a null path is empty. Repeated rows are kept, each with its verdict.
    Without rules every row gets the default; without pages the result is empty.
    """
    own = [c for c in pages.columns if c not in {"host", "path", "rule", "verdict"}]
    host, path = host_and_path(F.col(url))
    rules = (
        rules.where("host is not null and verdict is not null")
        .select(F.translate("host", *_A_TO_Z).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))  # "block" sorts after "allow"
    )
    labels = F.split("host", r"\.", -1)
    rule = F.struct(
        F.length(F.concat("host", "path")).alias("size"), F.length("host").alias("host_size"),
        F.concat("host", "path").alias("rule"), "verdict",
    )
    key = _key(labels, F.size(labels), F.col("path"))
    row = F.struct(*[F.col(c) for c in own]) if own else F.struct(F.lit(None).cast("int").alias("none"))
    starts = rules.select(key.alias("key"), F.lit(START).alias("kind"), F.lit(1).alias("step"), rule.alias("rule"))
    ends = rules.select(F.concat(key, F.unhex(F.lit("FF"))).alias("key"), F.lit(END).alias("kind"), F.lit(-1).alias("step"))

    # Numbers of labels that rules have: a host has 127 at most, so this is a short list.
    depths = sorted(r[0] for r in rules.select(F.size(labels)).distinct().collect())
    points = (
        pages.select(row.alias("row"), host.alias("host"), path.alias("path"))
        .withColumn("id", F.monotonically_increasing_id())
        .withColumn("depth", F.explode_outer(F.filter(F.array(*map(F.lit, depths)).cast("array<int>"), lambda d: d <= F.size(labels))))
        .select(
            F.coalesce(_key(labels, F.coalesce("depth", F.lit(0)), F.col("path")), F.lit(b"")).alias("key"),
            F.lit(POINT).alias("kind"), F.lit(0).alias("step"), "id", "row", "host", "path",
        )
    )
    events = starts.unionByName(ends, allowMissingColumns=True).unionByName(points, allowMissingColumns=True)
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    events = events.repartitionByRange(n, "key", "kind", F.coalesce("id", F.lit(-1))).withColumn("block", F.spark_partition_id())
    events = written(events, "url-events")  # the blocks are fixed from here on

    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row a block
    opened = events.groupBy("block").agg(F.sum("step").alias("step")).select("block", F.coalesce(F.sum("step").over(before), F.lit(0)).alias("opened"))
    place = Window.partitionBy("block").orderBy("key", "kind", "id")
    level = events.withColumn("level", F.sum("step").over(place.rowsBetween(Window.unboundedPreceding, 0)))
    level = level.join(F.broadcast(opened), "block").withColumn("level", F.col("level") + F.col("opened")).where(F.col("kind") != END)
    slot = Window.partitionBy("block", "level").orderBy("key", "kind", "id").rowsBetween(Window.unboundedPreceding, 0)
    top = level.withColumn("top", F.last("rule", ignorenulls=True).over(slot))

    # The latest start of each level in each block; on a level some earlier block may hold the start.
    ends_with = top.groupBy("block", "level").agg(F.max_by("rule", F.when(F.col("rule").isNotNull(), F.struct("key", "kind"))).alias("rule"))
    earlier = Window.partitionBy("level").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends_with.select("block", "level", F.last("rule", ignorenulls=True).over(earlier).alias("carried"))
    found = (
        top.where(F.col("kind") == POINT)
        .join(carried, ["block", "level"], "left")
        .withColumn("top", F.when(F.col("level") > 0, F.coalesce("top", "carried")))
        .groupBy("id")
        .agg(F.max("top").alias("top"), F.first("row").alias("row"), F.first("host").alias("host"), F.first("path").alias("path"))
    )
    return found.select(
        *[F.col("row")[c].alias(c) for c in own], "host", "path",
        F.col("top.rule").alias("rule"), F.coalesce("top.verdict", F.lit(default)).alias("verdict"),
    )
