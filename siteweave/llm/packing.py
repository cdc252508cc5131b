"""Items of varying length into containers of fixed capacity, by minimum bin slack.

Only lengths matter for the fill, so the corpus is first counted: how many items
there are of each length from 1 to the capacity, a table no longer than the
capacity at any number of items. On these counts, bin after bin, a bitset
dynamic programme over the lengths still available finds the fullest feasible
combination that holds the longest item left; the combination is repeated as
often as the counts allow and its items are removed. The list of combinations is
bounded by the capacity as well. Then every item gets its rank among the items
of its length, and with it a place: an equi-join on length and block of ranks, with blocks
so wide that one holds the start of one run of places on average.

An item longer than the capacity is cut into full containers and a rest, which is
packed as an item. Items without length (null, zero or below) go into none.

Defined results for odd input: ranks of equal lengths follow the item's key, then
the piece; repeated rows are separate items; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siteweave.storage import Scratch

CAPACITY = 2_048
#: Parts into which the items of one length are ranked, at least; as many as shuffle partitions where these are more.
RANK_PARTS = 64


def fullest_combination(counts: dict[int, int], capacity: int) -> Counter:
    """The combination of available lengths with the largest sum within the capacity that holds the longest length.

    Bitset subset sums, lengths from long to short with counts in binary steps; the
    first of several equal fills in that order is taken.
    """
    first = max(counts)
    room = capacity - first
    limit = (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []
    reach = 1
    for length in sorted(counts, reverse=True):
        have = min(counts[length] - (length == first), room // length)
        times = 1
        while have > 0:
            take = min(times, have)
            grown = (reach | reach << (length * take)) & limit
            if grown != reach:
                steps.append((length, take, reach))
                reach = grown
            have -= take
            times *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen = Counter({first: 1})
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] += take
            total -= length * take
    return chosen


def combinations(counts: dict[int, int], capacity: int) -> list[tuple[int, Counter]]:
    """(repetitions, combination) until every item of the counts is placed."""
    left = {length: n for length, n in counts.items() if n > 0}
    found = []
    while left:
        chosen = fullest_combination(left, capacity)
        times = min(left[length] // n for length, n in chosen.items())
        for length, n in chosen.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
        found.append((times, chosen))
    return found


def pack(items: DataFrame, key: str, size: str, capacity: int = CAPACITY) -> DataFrame:
    """(container, key, piece, first, length): each item's place; ``first`` is its offset within the whole item."""
    spark = items.sparkSession
    scratch = Scratch(spark, "packing")
    rows = items.select(F.col(f"`{key}`").alias("k"), F.col(f"`{size}`").cast("bigint").alias("n")).where(F.col("n") > 0)
    pieces = F.transform(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / capacity).cast("int")), lambda i: F.struct(i.alias("piece"), (i * F.lit(capacity)).cast("bigint").alias("first"), F.least(F.lit(capacity).cast("bigint"), F.col("n") - i * F.lit(capacity)).alias("length")))
    cut = rows.withColumn("p", F.explode(pieces)).select("k", "p.piece", "p.first", "p.length")
    # Rank within (length, part), then the parts' offsets: no length, however common, is ranked in one task.
    parts = max(RANK_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    parted = cut.withColumn("part", F.pmod(F.xxhash64("k", "piece"), F.lit(parts)).cast("int"))
    ranked = scratch.cut(parted.withColumn("r", F.row_number().over(Window.partitionBy("length", "part").orderBy("k", "piece")) - 1))
    sizes = ranked.groupBy("length", "part").agg(F.count("*").alias("c"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("offset", F.coalesce(F.sum("c").over(before), F.lit(0))).drop("c")
    counts = {row["length"]: row["c"] for row in sizes.groupBy("length").agg(F.sum("c").alias("c")).collect()}
    runs: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    used: Counter = Counter()
    containers = 0
    for times, chosen in combinations(counts, capacity):
        for length, n in chosen.items():
            runs[length].append((used[length], used[length] + n * times, n, containers))
            used[length] += n * times
        containers += times
    widths = {length: max(1, -(-counts[length] // len(found))) for length, found in runs.items()}
    places = [(length, block, *run) for length, found in runs.items() for run in found for block in range(run[0] // widths[length], (run[1] - 1) // widths[length] + 1)]
    # Runs are bounded by the capacity, whatever the number of items; blocks at most double them.
    table = spark.createDataFrame(places, "length bigint, block bigint, low bigint, high bigint, each bigint, base bigint")
    wide = spark.createDataFrame(list(widths.items()), "length bigint, width bigint")
    offsets = offsets.join(F.broadcast(wide), "length")
    rank = F.col("r") + F.col("offset")
    placed = ranked.join(offsets, ["length", "part"]).withColumn("rank", rank).withColumn("block", F.floor(F.col("rank") / F.col("width")))
    placed = placed.join(F.broadcast(table), ["length", "block"]).where((F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    container = F.col("base") + F.floor((F.col("rank") - F.col("low")) / F.col("each"))
    return placed.select(container.cast("bigint").alias("container"), F.col("k").alias(key), "piece", "first", "length")
