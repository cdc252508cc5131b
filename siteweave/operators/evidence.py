"""Joins that attach cited evidence, layers and neighbours to facilities."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siteweave import dims
from siteweave.operators.lookups import BROADCAST_ROWS
from siteweave.operators.spatial import EARTH_RADIUS_M, containing_regions, haversine_m, located, on_globe
from siteweave.storage import Scratch

# A name of so many long words has 255 sets of them.
SUBSET_WORDS = 8
# Places of features that a point shares its cell with on average, and the least size of cells, of about a metre.
CELL_PLACES, LEAST_DEG = 32, 1e-5
# The widest cells of the tree are at least so wide, some 80 on the globe; of cells so wide there are some 17,000, which every task gets.
ROOT_DEG, BROADCAST_DEG = 32, 2


def by_phrase(facilities: DataFrame, overrides: DataFrame) -> DataFrame:
    """All facilities whose name (and operator, where one is given) contains an override's text in any case.

    A literal substring has no key to join on, so each facility is read against all overrides, BROADCAST_ROWS of them at a time.
    """
    texts = overrides.select(F.lower("name_contains").alias("_n"), F.lower("operator_contains").alias("_o"), *[c for c in overrides.columns if c not in ("name_contains", "operator_contains")])
    blocks = [texts]
    if (n := overrides.count()) > BROADCAST_ROWS:
        numbered = Scratch(overrides.sparkSession, "overrides").cut(texts.withColumn("_block", F.floor((F.row_number().over(Window.orderBy("_n")) - 1) / BROADCAST_ROWS)))
        blocks = [numbered.where(F.col("_block") == k).drop("_block") for k in range(-(-n // BROADCAST_ROWS))]
    hit = F.lower("name").contains(F.col("_n")) & (F.col("_o").isNull() | F.coalesce(F.lower("operator").contains(F.col("_o")), F.lit(False)))
    found = [facilities.join(F.broadcast(block), hit).drop("_n", "_o") for block in blocks]
    return reduce(DataFrame.unionByName, found)


def by_title(facilities: DataFrame, filings: DataFrame) -> DataFrame:
    """(filing_id, facility_id, overlap): for each filing title the facility sharing most words of over four letters; the smaller id on a tie.

    Sets of words that names hold are indexed with the smallest facility id of each. A title grows the sets it holds word by word,
    and the largest it reaches decide, so a word of many names costs a title one row and not one for every name.
    Names of more than SUBSET_WORDS such words have too many sets; they are joined word by word.
    """
    scratch = Scratch(filings.sparkSession, "titles")
    words = lambda c: F.array_sort(F.array_distinct(F.filter(F.split(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "), " "), lambda w: F.length(w) > 4)))
    names = scratch.cut(facilities.select(words(F.col("name")).alias("words"), "facility_id").where(F.size("words") > 0).groupBy("words").agg(F.min("facility_id").alias("facility_id")))
    subsets = F.expr("filter(aggregate(words, array(''), (sets, w) -> concat(sets, transform(sets, s -> ltrim(concat(s, ' ', w))))), s -> s != '')")
    index = scratch.cut(names.where(F.size("words") <= SUBSET_WORDS).select(F.explode(subsets).alias("held"), "facility_id").groupBy("held").agg(F.min("facility_id").alias("facility_id")))
    titles = scratch.cut(filings.select("filing_id", F.explode(words(F.col("title"))).alias("word")))
    level, held = 1, scratch.cut(titles.withColumnRenamed("word", "held").join(index, "held"))
    known = scratch.cut(held.select("filing_id", F.col("held").alias("word")))
    long = names.where(F.size("words") > SUBSET_WORDS).select("facility_id", F.explode("words").alias("word"))
    counts = titles.join(long, "word").groupBy("filing_id", "facility_id").agg(F.count("*").alias("overlap"))
    while not held.isEmpty():
        counts = counts.unionByName(held.groupBy("filing_id").agg(F.min("facility_id").alias("facility_id"), F.lit(level).cast("bigint").alias("overlap")))
        longer = held.select("filing_id", "held").join(known, "filing_id").where(F.col("word") > F.substring_index("held", " ", -1))
        level, held = level + 1, scratch.cut(longer.select("filing_id", F.concat_ws(" ", "held", "word").alias("held")).join(index, "held"))
    best = F.min_by(F.struct("facility_id", "overlap"), F.struct((-F.col("overlap")).alias("o"), "facility_id"))
    return counts.groupBy("filing_id").agg(best.alias("b")).select("filing_id", "b.facility_id", "b.overlap")


def in_states_of(facilities: DataFrame, layer: DataFrame) -> DataFrame:
    """Facilities of the layer's states, or in their boxes where the state is unknown; all if the layer names no state."""
    if "state" not in layer.columns:
        return facilities
    boxes = dims.boxes(layer.sparkSession).join(layer.select("state").distinct(), "state", "left_semi").withColumnRenamed("state", "_state")
    inside = F.col("lon").between(F.col("min_lon"), F.col("max_lon")) & F.col("lat").between(F.col("min_lat"), F.col("max_lat"))
    return facilities.join(F.broadcast(boxes), (F.col("state") == F.col("_state")) | (F.col("state").isNull() & inside), "left_semi")  # a few boxes


def cited_figures(facilities: DataFrame, overrides: DataFrame | None, filings: DataFrame | None) -> DataFrame | None:
    """(facility_id, stated_value_mw, basis, source_url, retrieved_at, quote, cited_order): hand-entered figures in their order, then those of filings; none without a value or a citation.

    Filings with a state go to facilities of that state only.
    """
    basis = F.coalesce("basis", F.lit("total_facility")).alias("basis")
    kept = [F.col("value_mw").alias("stated_value_mw"), basis, "source_url", "retrieved_at", "quote"]
    parts = []
    if overrides is not None:
        usable = overrides.where(F.col("value_mw").isNotNull() & ~F.isnan("value_mw") & F.col("source_url").isNotNull()).withColumnsRenamed({"match_name": "name_contains", "match_operator": "operator_contains"})
        parts.append(by_phrase(facilities.select("facility_id", "name", "operator"), usable).select("facility_id", *kept, F.lit(0).alias("_from"), F.lit("").alias("_key"), F.col("line").cast("bigint").alias("_place")))
    if filings is not None:
        titles = filings.select(F.col("sch_number").alias("filing_id"), "title").distinct()
        placed = by_title(in_states_of(facilities, filings), titles).select(F.col("filing_id").alias("sch_number"), "facility_id")
        parts.append(filings.join(placed, "sch_number").select("facility_id", *kept, F.lit(1).alias("_from"), F.col("sch_number").alias("_key"), F.col("place").cast("bigint").alias("_place")))
    if not parts:
        return None
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.withColumn("cited_order", F.row_number().over(Window.partitionBy("facility_id").orderBy("_from", "_key", "_place"))).drop("_from", "_key", "_place")


def serving_territories(facilities: DataFrame, territories: DataFrame, overlays: DataFrame) -> DataFrame:
    """(facility_id, utility, utility_candidates): territories of the point without overlays; the smallest serves."""
    from siteweave.functions.projection import area_m2

    kept = territories.join(overlays, F.trim(territories["utility_name"]) == overlays["utility_name"], "left_anti")
    points = facilities.select(F.col("facility_id").alias("id"), "lat", "lon")
    hits = containing_regions(points, kept.select(F.col("utility").alias("region"), F.col("geometry").alias("shape")))
    areas = kept.groupBy(F.col("utility").alias("region")).agg(F.min(area_m2("geometry", F.lit(""))).alias("area"))
    by = hits.join(areas, "region").groupBy("id").agg(F.min_by("region", F.struct("area", "region")).alias("utility"), F.array_join(F.array_sort(F.collect_set("region")), ",").alias("utility_candidates"))
    return facilities.select("facility_id").join(by.withColumnRenamed("id", "facility_id"), "facility_id", "left")


def nearest_km(points: DataFrame, features: DataFrame, first_deg: float = 0.5) -> DataFrame:
    """(id, feature, km): the nearest feature of every point (id, lat, lon), the least one on a tie.

    Places of features are looked up in the nine cells around a point; a hit nearer than what lies outside them is final.
    Cells are quartered from ``first_deg`` until a point shares its own with CELL_PLACES places on average. Other points go down a
    tree of these cells, four by four in one: of a cell's parts only those go on that may hold a place as near as the nearest part surely has.
    """
    scratch = Scratch(points.sparkSession, "nearest")
    globe = lambda df: df.withColumns(dict(zip("yx", on_globe(F.col("lat"), F.col("lon")))))
    asking = scratch.cut(globe(points.select("id", "lat", "lon").where(located(F.col("lat"), F.col("lon"))).withColumn("p", F.monotonically_increasing_id())))
    places = features.where(located(F.col("lat"), F.col("lon"))).groupBy("lat", "lon").agg(F.min("id").alias("feature"))
    places = scratch.cut(globe(places).select("feature", F.col("lat").alias("flat"), F.col("lon").alias("flon"), "y", "x"))
    size = _cell_size(asking, places, first_deg)
    cell = lambda c: F.floor(F.col(c) / size)
    km = haversine_m(F.col("lat"), F.col("lon"), F.col("flat"), F.col("flon")) / 1000
    nearest = F.min(F.struct(km.alias("km"), F.col("feature"))).alias("b")

    n_lon = max(1, round(360 / size))
    column = lambda: F.floor(F.col("x") / (360 / n_lon))
    steps = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy in (-1, 0, 1) for dx in ((-1, 0, 1) if n_lon > 2 else range(n_lon))])
    around = places.withColumn("s", F.explode(steps)).select("feature", "flat", "flon", (cell("y") + F.col("s.dy")).alias("cy"), F.pmod(column() + F.col("s.dx"), F.lit(n_lon)).alias("cx"))
    asks = asking.select("p", "lat", "lon", cell("y").alias("cy"), F.pmod(column(), F.lit(n_lon)).alias("cx"))
    best = asks.join(around, ["cy", "cx"]).groupBy("p").agg(nearest).select("p", "b.km", "b.feature")
    # What lies outside the nine cells is at least one cell away in latitude, or one cell of the narrowest longitude.
    width = min(size, 360 / n_lon)
    sure = F.lit(width) * F.cos(F.radians(F.least(F.lit(90.0), F.abs("y") + size))) * 111.0 if n_lon > 2 else F.lit(-1.0)
    found = scratch.cut(asking.join(best, "p", "left").withColumn("final", F.col("km").isNotNull() & (F.col("km") <= sure)))
    near = found.where("final").select("id", "km", "feature")
    open_points = found.where("NOT final")
    if open_points.isEmpty():
        return near.groupBy("id").agg(F.min(F.struct("km", "feature")).alias("b")).select("id", "b.feature", "b.km")

    # Squares of straight distances on a globe of radius 1; they order places as kilometres do.
    solid = lambda lat, lon: (F.cos(F.radians(lat)) * F.cos(F.radians(lon)), F.cos(F.radians(lat)) * F.sin(F.radians(lon)), F.sin(F.radians(lat)))
    axes = "uvw"
    leaves = scratch.cut(places.withColumns({"cy": cell("y"), "cx": cell("x")} | dict(zip(axes, solid(F.col("flat"), F.col("flon"))))))
    sizes = [size]
    while sizes[-1] < ROOT_DEG:
        sizes.append(sizes[-1] * 4)
    ends = [f(a).alias(f"{a}{end}") for a in axes for f, end in ((F.min, 0), (F.max, 1))]
    boxes = scratch.cut(leaves.groupBy("cy", "cx").agg(*ends))
    wider = [f(f"{a}{end}").alias(f"{a}{end}") for a in axes for f, end in ((F.min, 0), (F.max, 1))]
    levels = [boxes, *[boxes.groupBy(F.floor(F.col("cy") / 4**k).alias("cy"), F.floor(F.col("cx") / 4**k).alias("cx")).agg(*wider) for k in range(1, len(sizes))]]
    gap = lambda a: F.greatest(F.lit(0.0), F.col(f"{a}0") - F.col(a), F.col(a) - F.col(f"{a}1"))
    span = lambda a: F.greatest(F.abs(F.col(a) - F.col(f"{a}0")), F.abs(F.col(a) - F.col(f"{a}1")))
    square = lambda f: f("u") * f("u") + f("v") * f("v") + f("w") * f("w")
    reached = F.pow(2 * F.sin(F.least(F.col("km") * 1000 / (2 * EARTH_RADIUS_M), F.lit(math.pi / 2))), 2)
    kept = open_points.withColumns(dict(zip(axes, solid(F.col("lat"), F.col("lon"))))).select("p", *axes, F.coalesce(reached, F.lit(8.0)).alias("most"))
    for k in reversed(range(len(sizes))):
        parts = levels[k].withColumns({"py": F.floor(F.col("cy") / 4), "px": F.floor(F.col("cx") / 4)})
        parts = F.broadcast(parts) if sizes[k] >= BROADCAST_DEG else parts
        asks = kept.join(parts.drop("py", "px")) if k == len(sizes) - 1 else kept.withColumnsRenamed({"cy": "py", "cx": "px"}).join(parts, ["py", "px"])
        bounds = asks.select("p", *axes, "most", "cy", "cx", square(gap).alias("low"), square(span).alias("high"))
        bounds = bounds.withColumn("most", F.least("most", F.min("high").over(Window.partitionBy("p"))))
        kept = bounds.where(F.col("low") <= F.col("most") * (1 + 1e-9) + 1e-13).select("p", *axes, "most", "cy", "cx")
    last = kept.select("p", "cy", "cx").join(leaves.select("feature", "flat", "flon", "cy", "cx"), ["cy", "cx"]).join(open_points.select("p", "id", "lat", "lon"), "p")
    far = last.groupBy("id").agg(nearest).select("id", "b.km", "b.feature")
    return near.unionByName(far).groupBy("id").agg(F.min(F.struct("km", "feature")).alias("b")).select("id", "b.feature", "b.km")


def _cell_size(asking: DataFrame, places: DataFrame, size: float) -> float:
    """The size of cells, quartered while points share theirs with more than CELL_PLACES places on average."""
    most = CELL_PLACES * asking.count()
    while size > LEAST_DEG:
        per_cell = lambda df, n, s=size: df.groupBy(F.floor(F.col("y") / s).alias("cy"), F.floor(F.col("x") / s).alias("cx")).agg(F.count("*").alias(n))
        pairs = per_cell(asking, "n").join(per_cell(places, "m"), ["cy", "cx"]).agg(F.sum(F.col("n") * F.col("m"))).first()[0]
        if (pairs or 0) <= most:
            break
        size /= 4
    return size
