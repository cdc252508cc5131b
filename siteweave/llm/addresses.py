"""Address records that denote the same place, though written differently.

An address is read into house number, direction, street, street type, city,
state and postcode; places are the distinct readings. The street is a weighted
bag of character 1-grams and 2-grams: letters stay together where two are swapped.

Places meet in blocks of one house number and one region, and of those only where
some block-mate can agree: places with postcodes under the postcode, a place without
one under its state, one without a state with those that lack a postcode, one without
both with all. Inside the blocks candidates come from an inverted index of grams,
prefix-filtered: of each street only the rarest grams are indexed, as many as any
other street with a cosine of MIN_COSINE or more must share one of. Only numbers go
through these joins; the readings are fetched for the candidates found.

Candidates are verified by that cosine and by the house number, which leaves few wrong
ones; an exact check follows: at most one slip on either side in the street, none in a
numbered street, and no direction, type, city, state or postcode against another.

Defined results for odd input: an address that is null, a stand-in or without
a house number denotes no place; parts that one side leaves out agree with
anything; rooms, floors and buildings within the place are left out; equal
readings are one place, however many records have it; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteweave.functions.text import FOLD_FROM, FOLD_TO
from siteweave.llm.names import slips
from siteweave.storage import Scratch

# Weights of grams lie between 1 and this, however many streets there are.
MAX_WEIGHT = 1.3
# No pair of streets of three letters or more that the exact check allows has a lower cosine, even where all that differs has the largest weight and all else the least.
MIN_COSINE = 0.32

TYPES = {
    "street": "st", "st": "st", "str": "st", "avenue": "ave", "ave": "ave", "av": "ave", "boulevard": "blvd", "blvd": "blvd", "boul": "blvd", "drive": "dr", "dr": "dr", "drv": "dr",
    "road": "rd", "rd": "rd", "lane": "ln", "ln": "ln", "court": "ct", "ct": "ct", "crt": "ct", "place": "pl", "pl": "pl", "circle": "cir", "cir": "cir", "circ": "cir",
    "terrace": "ter", "ter": "ter", "terr": "ter", "parkway": "pkwy", "pkwy": "pkwy", "pky": "pkwy", "highway": "hwy", "hwy": "hwy", "way": "way", "trail": "trl", "trl": "trl",
    "square": "sq", "sq": "sq", "loop": "loop", "expressway": "expy", "expy": "expy", "freeway": "fwy", "fwy": "fwy", "alley": "aly", "aly": "aly", "plaza": "plz", "plz": "plz",
}
DIRECTIONS = {"n": "n", "north": "n", "s": "s", "south": "s", "e": "e", "east": "e", "w": "w", "west": "w", "ne": "ne", "northeast": "ne", "nw": "nw", "northwest": "nw", "se": "se", "southeast": "se", "sw": "sw", "southwest": "sw"}
ORDINALS = {w: f"{n}{'st' if n == 1 else 'nd' if n == 2 else 'rd' if n == 3 else 'th'}" for n, w in enumerate(("first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth", "eleventh", "twelfth", "thirteenth", "fourteenth", "fifteenth", "sixteenth", "seventeenth", "eighteenth", "nineteenth", "twentieth"), 1)}
TITLES = {"st": "saint", "saint": "saint", "mt": "mount", "mount": "mount", "ft": "fort", "fort": "fort"}
STATE_CODES = {
    "alabama": "al", "alaska": "ak", "arizona": "az", "arkansas": "ar", "california": "ca", "colorado": "co", "connecticut": "ct", "delaware": "de",
    "district of columbia": "dc", "florida": "fl", "georgia": "ga", "hawaii": "hi", "idaho": "id", "illinois": "il", "indiana": "in", "iowa": "ia",
    "kansas": "ks", "kentucky": "ky", "louisiana": "la", "maine": "me", "maryland": "md", "massachusetts": "ma", "michigan": "mi", "minnesota": "mn",
    "mississippi": "ms", "missouri": "mo", "montana": "mt", "nebraska": "ne", "nevada": "nv", "new hampshire": "nh", "new jersey": "nj", "new mexico": "nm",
    "new york": "ny", "north carolina": "nc", "north dakota": "nd", "ohio": "oh", "oklahoma": "ok", "oregon": "or", "pennsylvania": "pa", "rhode island": "ri",
    "south carolina": "sc", "south dakota": "sd", "tennessee": "tn", "texas": "tx", "utah": "ut", "vermont": "vt", "virginia": "va", "washington": "wa",
    "west virginia": "wv", "wisconsin": "wi", "wyoming": "wy",
}
PLACE = ("num", "dir", "street", "type", "city", "state", "zip")

_FOLD = str.maketrans(FOLD_FROM, FOLD_TO)
_STATE_ZIP = re.compile(r"[\s,]+(" + "|".join([*STATE_CODES, *STATE_CODES.values()]) + r")?\.?[\s,]+(\d{5})(?:-\d{4})?\s*(?:,?\s*(?:usa?|united states))?\s*$")
_INSIDE = re.compile(r"\b(?:suite|ste|floor|flr|fl|unit|room|rm|bldg|building|apt|apartment|dept|level|lvl|hall|wing)\b\.?\s*(?:#|no\.?)?\s*(?:[a-z]?\d{1,4}[a-z]?|[a-z])\b|#\s*\d+\b|\b\d{1,3}(?:st|nd|rd|th)\s+(?:floor|fl|flr)\b")
_NUMBER_SIGN = re.compile(r"\b(?:no|nr|num|number)\b\.?\s*(?=\d)")
_NUMBERED = re.compile(r"\d+(?:st|nd|rd|th)")


def _plain(text: str | None) -> str:
    return text.translate(_FOLD).lower().strip() if isinstance(text, str) else ""


def _letters(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", "", text)


def read_address(address: str | None, city: str | None, state: str | None, postcode: str | None) -> tuple[str, ...] | None:
    """(num, dir, street, type, city, state, zip), parts left out as empty; None without a house number and a street."""
    text = _plain(address)
    found = _STATE_ZIP.search(text)
    if found:
        read = _read_street(text[: found.start()], found[1] or "", found[2], city, state, postcode)
        if read:
            return read
    # What looked like a postcode was the house number behind the street, as in "Elm Ct 11469".
    return _read_street(text, "", "", city, state, postcode)


def _read_street(text: str, inner_state: str, inner_zip: str, city: str | None, state: str | None, postcode: str | None) -> tuple[str, ...] | None:
    text = _NUMBER_SIGN.sub(" ", _INSIDE.sub(" , ", text))
    segments = [words for part in text.split(",") if (words := re.sub(r"[^a-z0-9]+", " ", re.sub(r"['’]", "", part)).split())]
    number, at = "", -1
    for i, words in enumerate(segments):
        if words[0].isdigit():
            number, at = words.pop(0), i
        elif len(words) > 1 and words[-1].isdigit():
            number, at = words.pop(), i
        if number:
            break
    if not number:
        return None
    if not segments[at]:
        # The number stands alone: its street comes next, or just before it.
        segments.pop(at)
        if at >= len(segments):
            at -= 1
        if at < 0:
            return None
    words, rest = list(segments[at]), [s for i, s in enumerate(segments) if i != at]
    direction = kind = ""
    if len(words) > 1 and words[0] in DIRECTIONS:
        direction = DIRECTIONS[words.pop(0)]
    if len(words) > 1 and words[-1] in DIRECTIONS:
        direction = DIRECTIONS[words.pop()] if not direction else direction
    if len(words) > 1 and words[-1] in TYPES:
        kind = TYPES[words.pop()]
        if len(words) > 1 and words[-1] in DIRECTIONS and not direction:
            direction = DIRECTIONS[words.pop()]
    if len(words) > 1 and words[0] in TITLES:
        words[0] = TITLES[words[0]]
    words = [ORDINALS.get(w, w) for w in words]
    street = "".join(words)
    if not street:
        return None
    town = _letters(_plain(city)) or _letters("".join(rest[-1]) if rest else "")
    region = re.sub(r"[^a-z ]+", "", _plain(state)) or inner_state
    digits = re.match(r"\s*(\d{5})", postcode or "")
    return number.lstrip("0") or "0", direction, street, kind, town, STATE_CODES.get(region, region), digits[1] if digits else inner_zip


def grams(street: str) -> list[str]:
    padded = f"^{street}$"
    return sorted({*street, *(padded[i : i + 2] for i in range(len(padded) - 1))})


def gram_weight(count: int, most: int) -> float:
    """Rarer is heavier, but mildly so: the grams of a slip are the rarest of all."""
    return min(MAX_WEIGHT, 1.0 + 0.05 * math.log((most + 1) / count))


class Streets:
    """Weighted bags of streets, kept for the streets met last."""

    def __init__(self, rarity: dict[str, float]) -> None:
        self.rarity = rarity
        self.bag = lru_cache(maxsize=100_000)(self._bag)

    def _bag(self, street: str) -> dict[str, float]:
        weights = {g: self.rarity.get(g, MAX_WEIGHT) for g in grams(street)}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        return {g: w / norm for g, w in weights.items()}

    def prefix(self, street: str) -> list[str]:
        """The rarest grams, in one order for all streets, until what is left is too light to reach MIN_COSINE."""
        bag = self.bag(street)
        left, out = 1.0, []
        for gram in sorted(bag, key=lambda g: (-self.rarity.get(g, MAX_WEIGHT), g)):
            if left < MIN_COSINE**2:
                break
            out.append(gram)
            left -= bag[gram] ** 2
        return out

    def cosine(self, a: str, b: str) -> float:
        x, y = self.bag(a), self.bag(b)
        return sum(w * y[g] for g, w in x.items() if g in y)


def _agree(a: str, b: str) -> bool:
    return not a or not b or a == b


def same_place(a: tuple, b: tuple) -> bool:
    """The exact check on two readings with one house number."""
    if a[0] != b[0] or not all(_agree(a[i], b[i]) for i in (1, 3, 5, 6)):
        return False
    if a[4] and b[4] and slips(a[4], b[4]) > (2 if min(len(a[4]), len(b[4])) >= 7 else 1):
        return False
    if a[2] == b[2]:
        return True
    return not _NUMBERED.match(a[2]) and not _NUMBERED.match(b[2]) and slips(a[2], b[2]) <= (2 if min(len(a[2]), len(b[2])) >= 7 else 1)


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for key, *parts in zip(batch["key"], batch["address"], batch["city"], batch["state"], batch["postcode"]):
            place = read_address(*parts)
            if place:
                rows.append((key, *place))
        yield pd.DataFrame(rows, columns=["key", *PLACE])


def _blocks() -> Column:
    """(block, ask): the blocks of a place, and whether it looks for others there."""
    zipped, stated, none = F.col("zip") != "", F.col("state") != "", F.lit(None)
    block = lambda sign, ask, *region: F.struct(F.xxhash64(F.lit(sign), "num", *region).alias("block"), ask.alias("ask"))
    found = F.array(
        F.when(zipped, block("zip", F.lit(True), "zip")).otherwise(none),
        F.when(stated, block("state", ~zipped, "state")).otherwise(none),
        F.when(~zipped | ~stated, block("no zip", ~stated)).otherwise(none),
        block("any", ~zipped & ~stated),
    )
    return F.filter(found, lambda x: x.isNotNull())


def same_addresses(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((key, place), (left, right)): the place of every record (key, address, city, state, postcode), and pairs of places that are the same.

    Places are numbered by a digest of their reading. Records of one place are not expanded into pairs here.
    """
    spark = records.sparkSession
    scratch = Scratch(spark, "addresses")
    parts = records.select(F.col("key").cast("string").alias("key"), *[F.col(c).cast("string").alias(c) for c in ("address", "city", "state", "postcode")])
    readings = parts.where(F.col("key").isNotNull() & F.col("address").rlike(r"\d")).mapInPandas(_read, "key string, " + ", ".join(f"{c} string" for c in PLACE))
    readings = scratch.cut(readings.withColumn("place", F.xxhash64(*PLACE)))
    places = scratch.cut(readings.select("place", *PLACE).distinct())
    # Counted over all streets; a gram is one or two of 38 signs, so this table has a bound of 1,482 rows.
    counted = places.select("street").distinct()
    padded = F.concat(F.lit("^"), "street", F.lit("$"))
    pairs_of = F.transform(F.sequence(F.lit(1), F.length(padded) - 1), lambda i: F.substring(padded, i, F.lit(2)))
    split = F.array_distinct(F.concat(pairs_of, F.split("street", "")))
    seen = counted.select(F.explode(split).alias("gram")).where(F.col("gram") != "").groupBy("gram").count().collect()
    most = max((r["count"] for r in seen), default=1)
    shared = spark.sparkContext.broadcast({r["gram"]: gram_weight(r["count"], most) for r in seen})

    blocks = places.select("place", "street", F.explode(_blocks()).alias("b")).select("place", "street", "b.block", "b.ask")
    # Blocks where nobody asks, or nobody else is.
    live = blocks.groupBy("block").agg(F.bool_or("ask").alias("asked"), F.count("*").alias("n")).where(F.col("asked") & (F.col("n") > 1)).select("block")
    blocks = blocks.join(live, "block", "left_semi")

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        streets = Streets(shared.value)
        for batch in batches:
            yield batch.assign(gram=[streets.prefix(s) for s in batch["street"]]).explode("gram")[["place", "block", "ask", "gram"]]

    indexed = blocks.mapInPandas(index, "place bigint, block bigint, ask boolean, gram string")
    indexed = scratch.cut(indexed.select("place", "ask", F.xxhash64("block", "gram").alias("key")))
    asking = indexed.where("ask").select("key", F.col("place").alias("one"))
    met = asking.join(indexed.select("key", F.col("place").alias("two")), "key").where(F.col("one") != F.col("two"))
    candidates = met.select(F.least("one", "two").alias("left"), F.greatest("one", "two").alias("right")).distinct()
    for side, name in (("left", "a"), ("right", "b")):
        candidates = candidates.join(places.select(F.col("place").alias(side), *[F.col(c).alias(f"{name}_{c}") for c in PLACE]), side)

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        streets = Streets(shared.value)
        for batch in batches:
            one, two = (zip(*[batch[f"{side}_{c}"] for c in PLACE]) for side in "ab")
            good = [streets.cosine(a[2], b[2]) >= MIN_COSINE and same_place(a, b) for a, b in zip(one, two)]
            yield batch.loc[good, ["left", "right"]]

    return readings.select("key", "place"), candidates.mapInPandas(verify, "left bigint, right bigint")


def record_pairs(places: DataFrame, pairs: DataFrame) -> DataFrame:
    """(left_key, right_key), smaller first: records of one place and of places that are the same."""
    a, b = places.select(F.col("key").alias("x"), F.col("place").alias("left")), places.select(F.col("key").alias("y"), F.col("place").alias("right"))
    within = a.join(b, F.col("left") == F.col("right")).where(F.col("x") < F.col("y")).select("x", "y")
    across = a.join(pairs, "left").join(b, "right").select("x", "y")
    return within.unionByName(across).select(F.least("x", "y").alias("left_key"), F.greatest("x", "y").alias("right_key"))
