"""Records of one site in several sources to one facility: blocking, scoring, constrained merging, consolidation.

Blocking joins records on one-kilometre cells of their projected position; full cells are
salted. Merging is best-first under cannot-link pairs: in order, a task to a group tied by
edges, up to a stated size; beyond it in rounds of joins. There an edge that is
the best of both clusters at its ends is decided now, since no better edge can still change
either of them; such edges are independent, and deciding them all at once gives the result
of the sequential order without the group in one task.

Defined results for odd input: records without a position or a key take no part;
ties in score follow record order; repeated keys count once; an empty table gives
empty results; columns beyond the record shape are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteweave.functions import similarity as sim
from siteweave.functions.projection import projected
from siteweave.storage import Scratch, ship
from siteweave.vocabulary import OTHER_PRIORITY, SOURCE_PRIORITY, SQM_PER_SQFT

REACH_M = 1000.0
MERGE, REVIEW = 0.72, 0.50
#: Records of one cell that one join task takes; fuller cells are salted.
CELL_RECORDS = 1_000
#: Edges and cannot-link pairs of a group that one task merges.
GROUP_PAIRS = 1_000_000
#: Rounds of merges before they are made one table.
MERGES_KEPT = 8
UNION_ORDER = ("osm", "peeringdb", "epa_nei")


def _rank(source: Column, order: dict[str, int], other: int) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in order.items() for x in pair]), source), F.lit(other))


def prepare(records: DataFrame) -> DataFrame:
    """Records with a position, an order and the parts that scoring compares."""
    ship(records.sparkSession)
    rows = records.where(F.col("lat").isNotNull() & F.col("lon").isNotNull() & ~F.isnan("lat") & ~F.isnan("lon") & F.col("source").isNotNull() & F.col("source_id").isNotNull())
    union = _rank(F.col("source"), {s: k for k, s in enumerate(UNION_ORDER)}, len(UNION_ORDER))
    rows = rows.dropDuplicates(["source", "source_id"]).withColumn("ord", F.concat(F.lpad(union.cast("string"), 2, "0"), F.lit("|"), "source", F.lit("|"), "source_id"))
    return rows.withColumns({"m": projected("lon", "lat", F.coalesce("state", F.lit(""))), "codes": sim.code_tokens(F.col("name")), "tokens": sim.name_tokens(F.col("name")), "addr": sim.short_address(F.col("address"))}).withColumn("number", sim.street_number(F.col("addr")))


def candidate_pairs(rows: DataFrame, reach: float = REACH_M) -> DataFrame:
    """(i, j, metres) of records of one jurisdiction at most ``reach`` apart, i before j."""
    cell = lambda axis: F.floor(F.col(f"m.{axis}") / reach)
    base = rows.select("ord", F.coalesce("state", F.lit("")).alias("zone"), F.col("m.x").alias("x"), F.col("m.y").alias("y"), cell("x").alias("cx"), cell("y").alias("cy"))
    around = F.explode(F.array(*[F.struct((F.col("cx") + dx).alias("cx"), (F.col("cy") + dy).alias("cy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]))
    left = base.select(F.col("ord").alias("i"), "zone", F.col("x").alias("x1"), F.col("y").alias("y1"), around.alias("c")).select("i", "zone", "x1", "y1", "c.cx", "c.cy")
    right = base.select(F.col("ord").alias("j"), "zone", F.col("x").alias("x2"), F.col("y").alias("y2"), "cx", "cy")
    keys = ["zone", "cx", "cy"]
    full = right.groupBy(*keys).count().where(F.col("count") > CELL_RECORDS).select(*keys, F.ceil(F.col("count") / CELL_RECORDS).cast("int").alias("salts"))
    salts = F.coalesce("salts", F.lit(1))
    left = left.join(full, keys, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    right = right.join(full, keys, "left").withColumn("salt", F.pmod(F.hash("j"), salts)).drop("salts")
    metres = F.hypot(F.col("x1") - F.col("x2"), F.col("y1") - F.col("y2"))
    return left.join(right, [*keys, "salt"]).where((F.col("i") < F.col("j")) & (metres <= reach)).select("i", "j", metres.alias("metres"))


def score_pairs(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Components, score and what forbids each pair."""
    side = lambda p, key: rows.select(F.col("ord").alias(key), *[F.col(c).alias(f"{p}_{c}") for c in ("source", "source_id", "name", "address", "operator", "codes", "tokens", "addr", "number")])
    both = pairs.join(side("l", "i"), "i").join(side("r", "j"), "j")
    ratio = sim.block_ratio(F.col("l_addr"), F.col("r_addr"))
    both = both.withColumn("addr_ratio", ratio).withColumn("op_ratio", sim.block_ratio(F.lower(F.coalesce("l_operator", F.lit(""))), F.lower(F.coalesce("r_operator", F.lit("")))))
    operators = F.col("l_operator").isNotNull() & F.col("r_operator").isNotNull()
    address = F.when((F.col("l_number") == F.col("r_number")) & (F.col("addr_ratio") > 0.55), 1.0).otherwise(F.col("addr_ratio"))
    operator = F.when(~operators, 0.0).when(F.col("l_operator") == F.col("r_operator"), 1.0).otherwise(F.col("op_ratio"))
    both = both.withColumns({"distance": sim.distance_credit(F.col("metres")), "name_score": sim.jaccard(F.col("l_tokens"), F.col("r_tokens")), "address_score": address, "operator_score": operator, "shared": F.arrays_overlap("l_codes", "r_codes"), "operators": operators})
    score = sim.pair_score(F.col("distance"), F.col("name_score"), F.col("address_score"), F.col("operator_score"), F.col("shared"), F.col("operators"), F.col("metres"))
    return both.withColumn("score", score).withColumn("forbidden", sim.cannot_link(F.col("l_codes"), F.col("r_codes"), F.col("l_number"), F.col("r_number"))).drop("addr_ratio", "op_ratio", "shared", "operators")


def constrained_clusters(edges: DataFrame, forbidden: DataFrame, scratch: Scratch) -> DataFrame:
    """(v, cluster) of every vertex of an edge; cluster is the least vertex merged with it. ``edges`` (i, j, score), ``forbidden`` (i, j).

    Groups tied by edges are independent, and cannot-link pairs between them forbid nothing. A group of at most GROUP_PAIRS
    edges and cannot-link pairs is merged in order in one task; larger ones are merged in rounds.
    """
    edges = scratch.cut(edges.select("i", "j", F.col("score").cast("double").alias("score")))
    groups = tied_groups(edges, scratch)
    at = lambda c: groups.select(F.col("v").alias(c), F.col("g").alias(f"g{c}"))
    inside = forbidden.join(at("i"), "i").join(at("j"), "j").where(F.col("gi") == F.col("gj")).select(F.col("gi").alias("g"), "i", "j", F.lit(None).cast("double").alias("score"))
    pairs = scratch.cut(edges.join(at("i"), "i").select(F.col("gi").alias("g"), "i", "j", "score").unionByName(inside))
    large = scratch.cut(pairs.groupBy("g").count().where(F.col("count") > GROUP_PAIRS).select("g"))
    kind = edges.schema["i"].dataType.simpleString()
    in_tasks = lambda df: df.repartition("g").sortWithinPartitions("g").mapInPandas(_merged, f"v {kind}, cluster {kind}")
    if large.isEmpty():
        return in_tasks(pairs)
    rest = scratch.cut(pairs.join(large, "g", "left_semi"))
    tied = rest.where(F.col("score").isNotNull())
    merged = scratch.cut(clusters_in_rounds(tied, rest.where(F.col("score").isNull()), scratch))
    alone = tied.select(F.explode(F.array("i", "j")).alias("v")).distinct().join(merged, "v", "left_anti")
    return in_tasks(pairs.join(large, "g", "left_anti")).unionByName(merged).unionByName(alone.select("v", F.col("v").alias("cluster")))


def tied_groups(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(v, g) of every vertex of an edge: the least vertex that edges tie it to.

    A round takes the least label among the neighbours and then that vertex's own label, so a chain costs a logarithm of its length.
    """
    both = scratch.cut(edges.select(F.col("i").alias("v"), F.col("j").alias("o")).unionByName(edges.select(F.col("j").alias("v"), F.col("i").alias("o"))).distinct())
    labels = scratch.cut(both.groupBy("v").agg(F.least("v", F.min("o")).alias("g"), F.lit(True).alias("moved")))
    while not labels.where("moved").isEmpty():
        near = both.join(labels.select(F.col("v").alias("o"), "g"), "o").groupBy("v").agg(F.min("g").alias("near"))
        low = labels.select("v", "g").join(near, "v").withColumn("low", F.least("g", "near"))
        onward = low.join(labels.select(F.col("v").alias("low"), F.col("g").alias("onward")), "low")
        found = scratch.cut(onward.select("v", F.col("onward").alias("g"), (F.col("onward") != F.col("g")).alias("moved")))
        scratch.drop(labels)
        labels = found
    return labels.select("v", "g")


def _merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Clusters of groups whose rows (g, i, j, score) follow one another; no score marks a cannot-link pair."""
    rows = (row for batch in batches for row in zip(batch["g"], batch["i"], batch["j"], batch["score"]))
    found: list[tuple] = []
    for _, group in groupby(rows, key=lambda row: row[0]):
        found += _in_order([row[1:] for row in group])
        if len(found) > 10_000:
            yield pd.DataFrame(found, columns=["v", "cluster"])
            found = []
    yield pd.DataFrame(found, columns=["v", "cluster"])


def _in_order(pairs: list[tuple]) -> list[tuple]:
    """(vertex, cluster) of one group: best edges first, among equals the least pair; an edge between clusters with a cannot-link pair is left out."""
    edges = sorted((-score, i, j) for i, j, score in pairs if score == score)
    owner = {v: v for _, i, j in edges for v in (i, j)}
    least, members, bans = dict(owner), {v: [v] for v in owner}, {v: set() for v in owner}
    for i, j, score in pairs:
        if score != score and i != j:
            bans[i].add(j)
            bans[j].add(i)
    for _, i, j in edges:
        a, b = owner[i], owner[j]
        if a == b or b in bans[a]:
            continue
        if len(members[a]) + len(bans[a]) < len(members[b]) + len(bans[b]):
            a, b = b, a
        least[a] = min(least[a], least[b])
        for v in members[b]:
            owner[v] = a
        members[a] += members.pop(b)
        for v in bans.pop(b):
            bans[v].discard(b)
            bans[v].add(a)
            bans[a].add(v)
    return [(v, least[a]) for v, a in owner.items()]


def clusters_in_rounds(edges: DataFrame, forbidden: DataFrame, scratch: Scratch) -> DataFrame:
    """(v, cluster) of every vertex that merged into another, by deciding locally best edges together."""
    live = scratch.cut(edges.select("i", "j", F.struct(F.col("score").alias("s"), F.col("i").alias("a"), F.col("j").alias("b")).alias("w")))
    bans = scratch.cut(forbidden.select(F.least("i", "j").alias("p"), F.greatest("i", "j").alias("q")).distinct())
    merges: list[DataFrame] = []
    while not live.isEmpty():
        ends = live.select(F.col("i").alias("v"), "w").unionByName(live.select(F.col("j").alias("v"), "w"))
        # Highest score first, among equals the least pair: the score is negated to take one minimum.
        order = F.struct((-F.col("w.s")).alias("s"), F.col("w.a").alias("a"), F.col("w.b").alias("b"))
        best = ends.groupBy("v").agg(F.min(order).alias("best"))
        mine = live.withColumn("order", order)
        decided = mine.join(best.select(F.col("v").alias("i"), F.col("best").alias("bi")), "i").join(best.select(F.col("v").alias("j"), F.col("best").alias("bj")), "j").where((F.col("order") == F.col("bi")) & (F.col("order") == F.col("bj")))
        pairs = decided.select(F.least("i", "j").alias("p"), F.greatest("i", "j").alias("q")).distinct()
        banned = bans.withColumn("ban", F.lit(True))
        judged = scratch.cut(pairs.join(banned, ["p", "q"], "left"))
        merge = judged.where(F.col("ban").isNull()).select(F.col("q").alias("v"), F.col("p").alias("to"))
        merges.append(merge)
        if len(merges) == MERGES_KEPT:
            merges = [scratch.cut(reduce(DataFrame.unionByName, merges))]
        refused = judged.where(F.col("ban")).select("p", "q")

        def moved(df: DataFrame, a: str, b: str, merge: DataFrame = merge) -> DataFrame:
            for c in (a, b):
                df = df.join(merge.select(F.col("v").alias(c), F.col("to").alias("_to")), c, "left").withColumn(c, F.coalesce("_to", c)).drop("_to")
            return df.where(F.col(a) != F.col(b))

        next_bans = scratch.cut(moved(bans, "p", "q").select(F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q")).distinct())
        kept = live.withColumns({"p": F.least("i", "j"), "q": F.greatest("i", "j")}).join(refused, ["p", "q"], "left_anti").drop("p", "q")
        next_live = scratch.cut(moved(kept, "i", "j"))
        scratch.drop(live, bans)
        live, bans = next_live, next_bans
    return _followed(merges, scratch).withColumnRenamed("to", "cluster") if merges else edges.select(F.col("i").alias("v"), F.col("i").alias("cluster")).limit(0)


def _followed(merges: list[DataFrame], scratch: Scratch) -> DataFrame:
    """(v, to) with the last cluster of each vertex. A vertex moves in one round only, so the merges are a forest, whose paths a pass halves."""
    forest = scratch.cut(reduce(DataFrame.unionByName, merges).where(F.col("v") != F.col("to")).withColumn("moved", F.lit(True)))
    while not forest.where("moved").isEmpty():
        onward = forest.select(F.col("v").alias("to"), F.col("to").alias("_to"))
        forest = scratch.cut(forest.drop("moved").join(onward, "to", "left").select("v", F.coalesce("_to", "to").alias("to"), F.col("_to").isNotNull().alias("moved")))
    return forest.drop("moved")


def _best(column: str, rank: str = "prio") -> Column:
    """The value of the most trusted record that has one."""
    return F.expr(f"min_by({column}, struct({rank}, ord)) FILTER (WHERE {column} IS NOT NULL)").alias(column)


def consolidate(members: DataFrame) -> DataFrame:
    """One facility per cluster; ``members`` are prepared records with cluster and footprint_sqm."""
    rows = members.withColumn("prio", _rank(F.col("source"), SOURCE_PRIORITY, OTHER_PRIORITY)).withColumn("footprint_sqft", F.nanvl(F.col("footprint_sqm"), F.lit(None).cast("double")) / SQM_PER_SQFT)
    largest = "max_by(struct(lat, lon, geometry_wkt), struct(footprint_sqft, ord)) FILTER (WHERE footprint_sqft IS NOT NULL)"
    kind = "min_by(facility_class, ord) FILTER (WHERE facility_class <> 'unknown')"
    out = rows.groupBy("cluster").agg(
        F.expr(largest).alias("anchor"), F.avg("lat").alias("mean_lat"), F.avg("lon").alias("mean_lon"), _best("name"), F.expr(kind).alias("facility_class"),
        *[_best(c) for c in ("operator", "operator_confidence", "address", "city", "state", "postcode", "year_built", "building_levels", "clli", "website", "geometry_wkt")],
        *[F.max(c).alias(c) for c in ("footprint_sqft", "pdb_net_count", "pdb_ix_count", "pdb_carrier_count")],
        F.array_join(F.array_sort(F.collect_set("source")), ",").alias("source_list"), F.count_distinct("source").cast("int").alias("n_sources"), F.min("ord").alias("ord"),
    )
    out = out.withColumns({"lat": F.coalesce("anchor.lat", "mean_lat"), "lon": F.coalesce("anchor.lon", "mean_lon"), "geometry_wkt": F.coalesce("anchor.geometry_wkt", "geometry_wkt"), "name": F.coalesce("name", F.lit("Unnamed data center")), "facility_class": F.coalesce("facility_class", F.lit("unknown"))})
    out = out.withColumn("facility_id", sim.facility_id(F.col("name"), F.col("lat"), F.col("lon")))
    same = Window.partitionBy("facility_id")
    nth = F.row_number().over(same.orderBy("ord")) - 1
    # Equal ids get their number in record order; the crosswalk carries the same id, since both come from this table.
    unique = F.when(F.count("*").over(same) > 1, F.concat("facility_id", F.lit("-"), nth.cast("string"))).otherwise(F.col("facility_id"))
    return out.withColumn("facility_id", unique).drop("anchor", "mean_lat", "mean_lon", "ord")


def resolve(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(facilities, crosswalk, review queue) of records in scope, with operator, operator_confidence and facility_class."""
    scratch = Scratch(records.sparkSession, "resolve")
    rows = scratch.cut(prepare(records))
    scored = scratch.cut(score_pairs(rows, candidate_pairs(rows)))
    mergeable = scored.where(F.col("forbidden").isNull() & (F.col("score") >= MERGE)).select("i", "j", "score")
    bans = scored.where(F.col("forbidden").isNotNull()).select("i", "j")
    clusters = constrained_clusters(mergeable, bans, scratch)
    members = scratch.cut(rows.join(clusters.withColumnRenamed("v", "ord"), "ord", "left").withColumn("cluster", F.coalesce("cluster", "ord")))
    facilities = scratch.cut(consolidate(members))
    crosswalk = members.join(facilities.select("cluster", "facility_id"), "cluster").select("facility_id", "source", "source_id", "source_url", F.col("name").alias("source_name"))
    at = members.select(F.col("ord").alias("i"), F.col("cluster").alias("ci")), members.select(F.col("ord").alias("j"), F.col("cluster").alias("cj"))
    queue = scored.where(F.col("forbidden").isNull() & (F.col("score") >= REVIEW)).join(at[0], "i").join(at[1], "j")
    blocked = (F.col("score") >= MERGE) & (F.col("ci") != F.col("cj"))
    queue = queue.where(blocked | (F.col("score") < MERGE)).select(
        F.col("l_source").alias("left_source"), F.col("l_source_id").alias("left_source_id"), F.col("l_name").alias("left_name"), F.col("l_address").alias("left_address"),
        F.col("r_source").alias("right_source"), F.col("r_source_id").alias("right_source_id"), F.col("r_name").alias("right_name"), F.col("r_address").alias("right_address"),
        F.bround("score", 3).alias("score"), F.when(blocked, F.lit("blocked_by_constraint")).alias("note"), F.bround("metres", 1).alias("distance_m"), F.bround("distance", 3).alias("distance"),
        F.bround("name_score", 3).alias("name"), F.bround("address_score", 3).alias("address"), F.bround("operator_score", 3).alias("operator"),
        F.concat(F.array_join(F.array_sort("l_codes"), ","), F.lit("|"), F.array_join(F.array_sort("r_codes"), ",")).alias("codes"),
    )
    return facilities.drop("cluster"), crosswalk, queue
