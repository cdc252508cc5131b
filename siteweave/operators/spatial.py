"""Points near other points, and the regions that contain a point.

``near_pairs`` joins points on a grid of latitude bands whose cells are as wide
as the distance; ``containing_regions`` cuts polygons into triangles by ear
clipping, lays a bounding-volume hierarchy over the triangles, tests the
triangles that a point may be in exactly and drops repeated assignments.

Defined results for odd input: a null id, a null or non-finite coordinate and
0/0 are no location; repeated rows count once; points at exactly the distance
and on an outer or inner edge count; null, empty or unreadable shapes contain
nothing; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteweave.functions.wkt import Point, orientation, parse_polygons, triangulate
from siteweave.storage import Scratch

EARTH_RADIUS_M = 6_371_008.8
#: Points of one cell that one join task takes; fuller cells are salted.
CELL_POINTS = 2_000
#: Triangles that one hierarchy holds, and points that one task looks up in it.
BLOCK_TRIANGLES, TASK_POINTS = 200_000, 20_000
LEAF_TRIANGLES = 8


def located(lat: Column, lon: Column) -> Column:
    """True where the pair is a location."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 1e9)
    return F.coalesce(finite(lat) & finite(lon) & ~((lat == 0) & (lon == 0)), F.lit(False))


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_RADIUS_M * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def on_globe(lat: Column, lon: Column) -> tuple[Column, Column]:
    """The same place with a latitude in -90..90 and a longitude in 0..360, for cells only."""
    turned = F.cos(F.radians(lat)) < 0
    return F.degrees(F.asin(F.sin(F.radians(lat)))), F.pmod(F.when(turned, lon + 180).otherwise(lon), F.lit(360.0))


def _cells_in_band(band: Column, height: float) -> Column:
    """Cells of a band: as many as are at least ``height`` wide, measured where the band is narrowest."""
    edge = F.greatest(F.abs(band * height), F.abs((band + 1) * height))
    return F.when(edge >= 90, F.lit(1)).otherwise(F.greatest(F.lit(1), F.floor(360 * F.cos(F.radians(edge)) / height))).cast("bigint")


def near_pairs(points: DataFrame, distance_m: float) -> DataFrame:
    """(left_id, right_id, distance_m), left smaller, for points (id, lat, lon) at most ``distance_m`` apart on the sphere."""
    found = near_points(points, points, distance_m, F.col("id") < F.col("other_id"))
    return found.groupBy(F.col("id").alias("left_id"), F.col("other_id").alias("right_id")).agg(F.min("distance_m").alias("distance_m"))


def _points(points: DataFrame) -> DataFrame:
    base = points.select(F.col("id").cast("string").alias("id"), F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))
    base = base.where(F.col("id").isNotNull() & located(F.col("lat"), F.col("lon"))).distinct()
    y, x = on_globe(F.col("lat"), F.col("lon"))
    return base.withColumn("y", y).withColumn("x", x)


def near_points(asking: DataFrame, points: DataFrame, distance_m: float, wanted: Column | None = None) -> DataFrame:
    """(id, other_id, distance_m) of every asking point (id, lat, lon) and the others at most ``distance_m`` away; ``wanted`` is tested on the ids first."""
    angle = math.degrees(distance_m / EARTH_RADIUS_M)
    height = angle * (1 + 1e-6)
    own_band = F.floor(F.col("y") / height)
    n_own = _cells_in_band(own_band, height)
    own = _points(points).withColumn("band", own_band).withColumn("cell", F.least(F.floor(F.col("x") / 360 * n_own), n_own - 1))
    reach = F.when(F.abs(F.col("y")) + height >= 90, F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.radians(F.lit(height))) / F.cos(F.radians("y"))))) * (1 + 1e-6))

    def reached(step: int) -> Column:
        band = own_band + step
        n = _cells_in_band(band, height)
        low, high = F.floor((F.col("x") - reach) / 360 * n), F.floor((F.col("x") + reach) / 360 * n)
        cells = F.array_distinct(F.transform(F.sequence(low, F.least(high, low + n - 1)), lambda c: F.pmod(c, n)))
        return F.transform(cells, lambda c: F.struct(band.alias("band"), c.alias("cell")))

    asks = _points(asking).withColumn("at", F.explode(F.concat(reached(-1), reached(0), reached(1)))).select("id", "lat", "lon", "at.band", "at.cell")
    full = own.groupBy("band", "cell").count().where(F.col("count") > CELL_POINTS).select("band", "cell", F.ceil(F.col("count") / CELL_POINTS).alias("salts"))
    if full.isEmpty():
        own, asks = own.withColumn("salt", F.lit(0)), asks.withColumn("salt", F.lit(0))
    else:
        own = own.join(full, ["band", "cell"], "left").withColumn("salt", F.pmod(F.hash("id"), F.coalesce("salts", F.lit(1))).cast("int"))
        asks = asks.join(full, ["band", "cell"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), (F.coalesce("salts", F.lit(1)) - 1).cast("int"))))
    own = own.select("band", "cell", "salt", F.col("id").alias("other_id"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    metres = haversine_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))
    pairs = asks.join(own, ["band", "cell", "salt"]).where(wanted if wanted is not None else F.col("id") != F.col("other_id"))
    return pairs.withColumn("distance_m", metres).where(F.col("distance_m") <= distance_m).select("id", "other_id", "distance_m")


def _triangle_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for region, text in zip(batch["region"], batch["shape"]):
            for rings in parse_polygons(text):
                try:
                    rows += [(region, "", *a, *b, *c) for a, b, c in triangulate(rings)]
                except ValueError:
                    # A ring that crosses itself has no ears; its box is a candidate and the crossing count decides.
                    xs, ys = [p[0] for p in rings[0]], [p[1] for p in rings[0]]
                    rows.append((region, text, min(xs), min(ys), max(xs), min(ys), max(xs), max(ys)))
        yield pd.DataFrame(rows, columns=["region", "odd", "ax", "ay", "bx", "by", "cx", "cy"])


def _even_odd(text: str, p: Point) -> bool:
    """By crossing count over all rings; a point on an edge is inside."""
    for rings in parse_polygons(text):
        inside = False
        for ring in rings:
            for a, b in zip(ring, ring[1:] + ring[:1]):
                turn = orientation(a, b, p)
                if turn == 0 and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1]):
                    return True
                if (a[1] > p[1]) != (b[1] > p[1]) and (turn > 0) == (b[1] > a[1]):
                    inside = not inside
        if inside:
            return True
    return False


class TriangleHierarchy:
    """Bounding boxes over triangles, halved at the median of the wider side down to small leaves."""

    def __init__(self, corners: np.ndarray, regions: np.ndarray, odd: np.ndarray) -> None:
        self.corners, self.regions, self.odd = corners, regions, odd
        xs, ys = corners[:, 0::2], corners[:, 1::2]
        self.boxes = np.column_stack([xs.min(1), ys.min(1), xs.max(1), ys.max(1)]) if len(corners) else np.empty((0, 4))
        centre = (self.boxes[:, :2] + self.boxes[:, 2:]) / 2
        self.nodes: list[tuple[np.ndarray, int, int, np.ndarray | None]] = []

        def build(members: np.ndarray) -> int:
            box = np.concatenate([self.boxes[members, :2].min(0), self.boxes[members, 2:].max(0)])
            at = len(self.nodes)
            self.nodes.append((box, -1, -1, members))
            if len(members) > LEAF_TRIANGLES:
                side = int(np.argmax(np.ptp(centre[members], axis=0)))
                order = members[np.argsort(centre[members, side], kind="stable")]
                left, right = build(order[: len(order) // 2]), build(order[len(order) // 2 :])
                self.nodes[at] = (box, left, right, None)
            return at

        if len(corners):
            build(np.arange(len(corners)))

    def find(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of points and the regions that contain them, each pair once."""
        points, found = [], []
        stack = [(0, np.arange(len(x)))] if self.nodes else []
        while stack:
            at, who = stack.pop()
            box, left, right, members = self.nodes[at]
            who = who[(x[who] >= box[0]) & (x[who] <= box[2]) & (y[who] >= box[1]) & (y[who] <= box[3])]
            if not len(who):
                continue
            if members is None:
                stack += [(left, who), (right, who)]
                continue
            for t in members:
                hit = who[self._inside(t, x[who], y[who])]
                points.append(hit)
                found.append(np.full(len(hit), self.regions[t], dtype=object))
        if not points:
            return np.empty(0, dtype=int), np.empty(0, dtype=object)
        pairs = pd.DataFrame({"p": np.concatenate(points), "r": np.concatenate(found)}).drop_duplicates()
        return pairs["p"].to_numpy(), pairs["r"].to_numpy()

    def _inside(self, t: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        if self.odd[t]:
            return np.array([_even_odd(self.odd[t], (float(px), float(py))) for px, py in zip(x, y)], dtype=bool)
        corners = self.corners[t].reshape(3, 2)
        inside, unsure = np.ones(len(x), dtype=bool), np.zeros(len(x), dtype=bool)
        for a, b in zip(corners, np.roll(corners, -1, axis=0)):
            left, right = (a[0] - x) * (b[1] - y), (a[1] - y) * (b[0] - x)
            det, bound = left - right, 4e-16 * (np.abs(left) + np.abs(right))
            inside &= det >= -bound
            unsure |= np.abs(det) <= bound
        for k in np.flatnonzero(inside & unsure):
            p = (float(x[k]), float(y[k]))
            a, b, c = (tuple(map(float, q)) for q in corners)
            inside[k] = min(orientation(a, b, p), orientation(b, c, p), orientation(c, a, p)) >= 0
        return inside


def containing_regions(points: DataFrame, regions: DataFrame, block_triangles: int = BLOCK_TRIANGLES, task_points: int = TASK_POINTS) -> DataFrame:
    """(id, region) for every region (region, shape as WKT) that contains a point (id, lat, lon).

    Triangles are made on the executors, ordered along a space-filling curve and cut into
    blocks of ``block_triangles``. Points go to the blocks whose box holds them, over the
    whole degrees that boxes touch; each task builds the hierarchy of one block and looks
    up to about ``task_points`` of its points up in it.
    """
    spark = points.sparkSession
    scratch = Scratch(spark, "regions")
    shapes = regions.select(F.col("region").cast("string").alias("region"), F.col("shape").cast("string").alias("shape"))
    shapes = shapes.where(F.col("region").isNotNull() & F.col("shape").isNotNull()).distinct()
    triangles = scratch.cut(shapes.mapInPandas(_triangle_rows, "region string, odd string, ax double, ay double, bx double, by double, cx double, cy double"))
    bits = [F.shiftleft(F.floor((c + 360) * 100).cast("long").bitwiseAND(F.lit(1 << k)), k + s) for k in range(17) for c, s in ((F.col("ax"), 0), (F.col("ay"), 1))]
    curve = sum(bits[1:], bits[0])
    blocks = max(1, -(-triangles.count() // block_triangles))
    triangles = scratch.cut(triangles.repartitionByRange(blocks, curve).withColumn("block", F.spark_partition_id()))
    corners = lambda axis: [f"{corner}{axis}" for corner in "abc"]
    bounds = [f(g(*corners(axis))).alias(f"{axis}{end}") for axis in "xy" for f, g, end in ((F.min, F.least, 0), (F.max, F.greatest, 1))]
    boxes = triangles.groupBy("block").agg(*bounds)
    degree = lambda c, most: F.greatest(F.lit(-most), F.least(F.lit(most), F.floor(c)))
    columns = boxes.withColumn("i", F.explode(F.sequence(degree(F.col("x0"), 361), degree(F.col("x1"), 361))))
    cells = columns.withColumn("j", F.explode(F.sequence(degree(F.col("y0"), 91), degree(F.col("y1"), 91))))
    base = points.select(F.col("id").cast("string").alias("id"), F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))
    base = base.where(F.col("id").isNotNull() & located(F.col("lat"), F.col("lon"))).withColumns({"i": degree(F.col("lon"), 361), "j": degree(F.col("lat"), 91)})
    placed = base.join(cells, ["i", "j"]).where(F.col("lon").between(F.col("x0"), F.col("x1")) & F.col("lat").between(F.col("y0"), F.col("y1"))).select("id", "lat", "lon", F.col("block").alias("part"))
    salts = scratch.cut(placed.groupBy("part").agg(F.ceil(F.count("*") / task_points).cast("int").alias("salts")))
    placed = placed.join(salts, "part").withColumn("salt", F.pmod(F.hash("id", "lat", "lon"), "salts")).drop("salts")
    triangles = triangles.join(salts.withColumnRenamed("part", "block"), "block").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    return placed.groupBy("part", "salt").cogroup(triangles.groupBy("block", "salt")).applyInPandas(_locate, "id string, region string").distinct()


def _locate(points: pd.DataFrame, triangles: pd.DataFrame) -> pd.DataFrame:
    tree = TriangleHierarchy(triangles[["ax", "ay", "bx", "by", "cx", "cy"]].to_numpy(float), triangles["region"].to_numpy(object), triangles["odd"].to_numpy(object))
    who, where = tree.find(points["lon"].to_numpy(float), points["lat"].to_numpy(float))
    return pd.DataFrame({"id": points["id"].to_numpy(object)[who], "region": where}, columns=["id", "region"])
