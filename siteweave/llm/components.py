"""Groups of records from pairwise ties.

The component of the vertex of highest degree is found by breadth-first joins
from a frontier and taken out of the graph by an anti-join. What is left, many
small components, is labelled by propagating minima: in every round each vertex
takes the least vertex around it, in an order that is drawn anew by round, and
vertices with the same least one become one vertex. A round leaves a fraction of
the vertices, whatever the shape, so long chains take few rounds too.

The frontier goes on as long as it adds more than one in THIN of what it has
reached. What then still hangs on to it, such as the rest of a chain, is tied to
the start instead, and gets its label with the small components.

Vertices are 64-bit numbers, digests of their keys; keys whose digests agree in
all but the last SLOT_BITS bits are told apart by these bits.

Defined results for odd input: null ends and self-ties say nothing; repeated
ties and both directions count once; vertices are compared as plain bytes; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteweave.storage import Scratch

THIN = 16
SLOT_BITS = 4


def _number(key: Column) -> Column:
    return F.shiftleft(F.shiftrightunsigned(F.xxhash64(key), SLOT_BITS), SLOT_BITS)


def _numbered(ties: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(v, id) of every vertex, and the ties as distinct (x, y), x < y."""
    pairs = ties.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"))
    pairs = scratch.cut(pairs)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("v")).distinct()
    # Keys with one digest are very few: a list of more than 1 << SLOT_BITS has no chance.
    slots = ends.groupBy(_number(F.col("v")).alias("h")).agg(F.array_sort(F.collect_list("v")).alias("vs"))
    slot = F.when(F.col("slot") < 1 << SLOT_BITS, F.col("slot")).otherwise(F.raise_error(F.lit("digests of vertices collide")).cast("int"))
    vertices = scratch.cut(slots.select("h", F.posexplode("vs").alias("slot", "v")).select("v", (F.col("h") + slot).alias("id")))
    moved = scratch.cut(vertices.where(F.col("id") != _number(F.col("v"))))
    for end in ("a", "b"):
        pairs = pairs.join(moved.withColumnRenamed("v", end), end, "left").withColumn(end, F.coalesce("id", _number(F.col(end)))).drop("id")
    return vertices, scratch.cut(pairs.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct())


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))


def _peel(edges: DataFrame, scratch: Scratch) -> tuple[DataFrame | None, DataFrame, int | None]:
    """(reached vertices, ties left, the start); ties that still leave the reached part start at the start."""
    around = _both(edges)
    top = around.groupBy("x").count().orderBy(F.desc("count"), "x").first()
    if top is None:
        return None, edges, None
    start = top["x"]
    parts = [scratch.cut(edges.sparkSession.createDataFrame([(start,)], "v bigint"))]
    reached = added = 1
    # Neighbours of a level lie in it, in the one before or in the one after.
    while added * THIN > reached:
        step = around.join(parts[-1].withColumnRenamed("v", "x"), "x").select(F.col("y").alias("v")).distinct()
        for known in parts[-2:]:
            step = step.join(known, "v", "left_anti")
        parts.append(scratch.cut(step))
        added = parts[-1].count()
        reached += added
    inside = parts[0]
    for part in parts[1:]:
        inside = inside.unionByName(part)
    inside = scratch.cut(inside)
    left = edges
    for end in ("x", "y"):
        left = left.join(inside.withColumnRenamed("v", end), end, "left_anti")
    if added:
        hanging = around.join(parts[-1].withColumnRenamed("v", "x"), "x").select(F.col("y").alias("v")).distinct()
        for known in parts[-2:]:
            hanging = hanging.join(known, "v", "left_anti")
        left = left.select("x", "y").unionByName(hanging.select(F.least(F.lit(start), "v").alias("x"), F.greatest(F.lit(start), "v").alias("y")))
    left = scratch.cut(left.select("x", "y"))
    scratch.drop(*parts)
    return inside, left, start


def _minima(edges: DataFrame, scratch: Scratch) -> DataFrame | None:
    """(v, root): one of its vertices for all vertices of a component; None without ties."""
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        order = lambda c, n=len(steps): F.xxhash64(F.lit(n), c)
        least = _both(edges).groupBy("x").agg(F.min_by("y", order("y")).alias("m"))
        least = scratch.cut(least.select(F.col("x").alias("v"), F.when(order("m") < order("x"), F.col("m")).otherwise(F.col("x")).alias("m")))
        steps.append(least)
        ends = edges.join(least.select(F.col("v").alias("x"), F.col("m").alias("p")), "x").join(least.select(F.col("v").alias("y"), F.col("m").alias("q")), "y")
        after = scratch.cut(ends.where(F.col("p") != F.col("q")).select(F.least("p", "q").alias("x"), F.greatest("p", "q").alias("y")).distinct())
        scratch.drop(edges)
        edges = after
    if not steps:
        return None
    labels = steps[-1].withColumnRenamed("m", "root")
    for step in reversed(steps[:-1]):
        above = labels.select(F.col("v").alias("m"), "root")
        labels = step.join(above, "m", "left").select("v", F.coalesce("root", "m").alias("root"))
    return labels


def groups(ties: DataFrame) -> DataFrame:
    """(v, root): every vertex that occurs in a tie (a, b) with another, and the least vertex of its component."""
    spark = ties.sparkSession
    scratch = Scratch(spark, "groups")
    vertices, edges = _numbered(ties, scratch)
    reached, left, start = _peel(edges, scratch)
    if reached is None:
        return spark.createDataFrame([], "v string, root string")
    rest = _minima(left, scratch)
    big, members = start, reached
    if rest is not None:
        rest = scratch.cut(rest)
        tied = rest.where(F.col("v") == start).first()
        big = tied["root"] if tied else start
        members = rest.unionByName(reached.where(F.col("v") != start).select("v", F.lit(big).alias("root")))
        if not tied:
            members = members.unionByName(spark.createDataFrame([(start, start)], "v bigint, root bigint"))
    else:
        members = reached.select("v", F.lit(start).alias("root"))
    labelled = scratch.cut(vertices.join(members.withColumnRenamed("v", "id"), "id").select("v", "root"))
    # The peeled component may hold a great part of all rows; its least key is one value.
    least = labelled.where(F.col("root") == big).agg(F.min("v")).first()[0]
    mine = labelled.where(F.col("root") == big).select("v", F.lit(least).alias("root"))
    others = labelled.where(F.col("root") != big)
    roots = others.groupBy("root").agg(F.min("v").alias("least"))
    return mine.unionByName(others.join(roots, "root").select("v", F.col("least").alias("root")))
