"""Records of the same site in several sources that share no identifier.

A cascade of deterministic rules, from strong to weak. Each pass joins exactly on
a weaker combination of attributes and checks what it found:

1. site code and house number, same operator;
2. site code, same operator;
3. house number with postcode, town or either end of the street, the address denotes the same place, same operator, no other site code;
4. a third record in common, or the grid cells within 150 m, and what the two sites know together agrees: a code or a house number;
5. the grid cells within 60 m, same operator, nothing known against it;
6. the grid cells within 150 m, likewise.

A record is open towards another source until a pass matches it there. Open records ask;
those that are resolved are anti-joined from the asking side of the next passes, and a pair
whose two ends are both resolved towards each other's source is looked at no more. Resolved
records stay to be found, since a site may have several records in one source: with
both ends anti-joined one pair in forty of the test tables would be lost.

After the passes on codes and addresses a record carries the codes and house
numbers of the records it was resolved with; a pair that is near or has a third in common that these put on two sites
is out, one that they put on one site is in. Of the sites of one operator around
a record without code and address the nearest is the one it can be matched to.

Every rule's confidence is its precision on labelled pairs, smoothed as if one match
and one other had been added; rules below MIN_CONFIDENCE match nothing.

Defined results for odd input: records without a key, and keys of the two sides in
one source, are never matched; missing names, addresses and positions leave the
rules that need them out; repeated rows count once; empty tables give no rows;
other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteweave.functions.text import FOLD_FROM, FOLD_TO
from siteweave.llm.addresses import PLACE, read_address, same_place
from siteweave.llm.names import LEGAL, slips
from siteweave.operators.spatial import near_points
from siteweave.storage import Scratch, ship

NEAR_M, MID_M = 60.0, 150.0
MIN_CONFIDENCE = 0.5
RULES = ("code_and_number", "code", "address", "near", "mid")

_FOLD = str.maketrans(FOLD_FROM, FOLD_TO)
_CODE = re.compile(r"\b([a-z]{2,4})[\s-]?(\d{1,3})([a-z]?)\b")
_NO_CODE = {"dh", "hall", "bldg", "room", "rm", "no", "unit", "ste", "fl"}
_GENERIC = {
    *LEGAL, "data", "center", "centers", "centre", "centres", "datacenter", "datacenters", "datacentre", "datacentres", "ctrs", "dc", "dcs", "campus", "bldg", "building", "hall", "north", "south",
    "east", "west", "of", "svcs", "svc", "services", "service", "cloud", "digital", "infrastructure", "infra", "dig", "works", "wks", "compute", "dh", "annex", "expansion", "phase", "former",
    "formerly", "leased", "site", "facility", "property", "unnamed", "unknown", "none", "null", "tbd", "not", "available", "telecom", "telecommunications",
    "telecoms", "telecomm", "telco", "tel", "hosting", "hstg", "colocation", "colo", "networks", "network", "netwks", "ntwks", "ntwk", "nets", "net", "computeworks", "computewks", "compworks", "interconnect",
    "interconnection", "interconn", "intercon", "ix", "datactrs", "datactr", "digitalinfrastructure", "diginfrastructure", "digitalinfra", "diginfra", "cloudservices", "cloudservice", "cloudsvcs", "cloudsvc",
}


def _plain(text: str | None) -> str:
    text = text.translate(_FOLD).lower() if isinstance(text, str) else ""
    return re.sub(r"(?<=[a-z])-(?=[a-z])", "", re.sub(r"['’]s\b", "", text))


def site_codes(name: str | None) -> list[str]:
    """Codes such as ABCD123 in a name, letters and digits joined."""
    return sorted({m[1] + m[2] + m[3] for m in _CODE.finditer(_plain(name).replace("_", "-")) if m[1] not in _NO_CODE})


def coined_words(text: str | None, town: str | None = None) -> list[str]:
    """The words of a name that are no code, town, trade or legal form."""
    drop = _GENERIC | set(_plain(town).split())
    words = re.sub(r"[^a-z0-9]+", " ", _CODE.sub(" ", _plain(text))).split()
    return sorted({w for w in words if len(w) > 2 and not w.isdigit() and w not in drop})


def _akin(a: str, b: str) -> bool:
    short = min(len(a), len(b))
    if a == b or short >= 4 and (a.startswith(b) or b.startswith(a)):
        return True
    return short >= 5 and slips(a, b) <= (2 if short >= 7 else 1)


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for r in batch.itertuples(index=False):
            place = read_address(r.address, r.city, r.state, r.postcode)
            words = sorted({*coined_words(r.name, r.city), *coined_words(r.operator)})
            rows.append((r.key, r.src, r.lat, r.lon, site_codes(r.name), words, *(place or ("",) * len(PLACE))))
        yield pd.DataFrame(rows, columns=["key", "src", "lat", "lon", "codes", "words", *PLACE])


def profiles(records: DataFrame) -> DataFrame:
    """What is compared of every record (key, src, name, operator, address, city, state, postcode, lat, lon)."""
    text = ("key", "src", "name", "operator", "address", "city", "state", "postcode")
    rows = records.select(*[F.col(c).cast("string").alias(c) for c in text], F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))
    schema = "key string, src string, lat double, lon double, codes array<string>, words array<string>, " + ", ".join(f"{c} string" for c in PLACE)
    return rows.where(F.col("key").isNotNull() & F.col("src").isNotNull()).mapInPandas(_read, schema)


SIDE = ("src", "codes", "words", *PLACE)
JUDGED = "left string, right string, left_src string, right_src string, metres double, place int"


def _judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Keeps pairs of the same operator; place: 1 the same, -1 another, 0 not known."""
    for batch in batches:
        kept, places = [], []
        for r in batch.to_dict("records"):
            # A town that only one side names is no sign of the same operator.
            towns = [t for t in (r["a_city"], r["b_city"]) if t]
            mine, theirs = ([w for w in r[f"{side}_words"] if not any(w in t for t in towns)] for side in "ab")
            akin = any(_akin(x, y) for x in mine for y in theirs)
            kept.append(akin)
            a, b = tuple(r[f"a_{c}"] for c in PLACE), tuple(r[f"b_{c}"] for c in PLACE)
            places.append(0 if not akin or not a[0] or not b[0] else 1 if same_place(a, b) else -1)
        yield batch.assign(place=places, left_src=batch["a_src"], right_src=batch["b_src"]).loc[kept, ["left", "right", "left_src", "right_src", "metres", "place"]]


def _sides(pairs: DataFrame, people: DataFrame) -> DataFrame:
    a = people.select(F.col("key").alias("left"), *[F.col(c).alias(f"a_{c}") for c in SIDE])
    b = people.select(F.col("key").alias("right"), *[F.col(c).alias(f"b_{c}") for c in SIDE])
    return pairs.join(a, "left").join(b, "right").where(F.col("a_src") != F.col("b_src"))


def _shares(a: str, b: str) -> Column:
    return F.arrays_overlap(a, b)


def _apart(a: str, b: str) -> Column:
    """Both sides know something and nothing of it agrees."""
    return (F.size(a) > 0) & (F.size(b) > 0) & ~F.arrays_overlap(a, b)


def _open(people: DataFrame, sources: DataFrame, found: DataFrame | None) -> DataFrame:
    """(key, toward): records and the sources in which nothing is matched to them yet."""
    every = people.select("key", "src").join(sources, F.col("src") != F.col("toward")).select("key", "toward")
    if found is None:
        return every
    done = found.select(F.col("left").alias("key"), F.col("right_src").alias("toward")).unionByName(found.select(F.col("right").alias("key"), F.col("left_src").alias("toward")))
    return every.join(done.distinct(), ["key", "toward"], "left_anti")


def _still_open(pairs: DataFrame, open_: DataFrame) -> DataFrame:
    """Pairs (left, right, left_src, right_src, ..) of which an end is open towards the other's source."""
    mark = lambda end, other: open_.select(F.col("key").alias(end), F.col("toward").alias(other), F.lit(True).alias(f"{end}_open"))
    both = pairs.join(mark("left", "right_src"), ["left", "right_src"], "left").join(mark("right", "left_src"), ["right", "left_src"], "left")
    return both.where(F.col("left_open") | F.col("right_open")).drop("left_open", "right_open")


PAIR = ("left", "right", "left_src", "right_src")


def match_sources(records: DataFrame) -> DataFrame:
    """(left, right, rule): pairs of records of different sources, left key smaller."""
    spark = records.sparkSession
    scratch = Scratch(spark, "matching")
    read = profiles(records)
    rest = [c for c in read.columns if c != "key"]
    people = scratch.cut(read.groupBy("key").agg(F.min(F.struct(*rest)).alias("r")).select("key", "r.*"))
    sources = people.select(F.col("src").alias("toward")).distinct()
    known = people.select("key", "codes", F.when(F.col("num") != "", F.array("num")).otherwise(F.array().cast("array<string>")).alias("nums"))
    found: DataFrame | None = None
    for rule, blocks, holds in _passes():
        keyed = people.select("key", "src", F.explode(blocks).alias("block"))
        ask = keyed.join(_open(people, sources, found), "key")
        other = keyed.select(F.col("key").alias("other"), F.col("src").alias("toward"), "block")
        # Skewed blocks are split by the adaptive join; only keys go through it.
        pairs = ask.join(other, ["block", "toward"]).select(F.least("key", "other").alias("left"), F.greatest("key", "other").alias("right"), F.lit(None).cast("double").alias("metres")).distinct()
        judged = _sides(pairs, people).mapInPandas(_judge, JUDGED)
        hits = _with(judged, known).where(holds).select(*PAIR, F.lit(rule).alias("rule"), "a_codes", "b_codes", "a_nums", "b_nums")
        if found is not None:
            hits = hits.join(found.select("left", "right"), ["left", "right"], "left_anti")
        found = scratch.cut(hits if found is None else found.unionByName(hits))
    strong = found
    open_ = scratch.cut(_open(people, sources, strong))
    asking = open_.select("key").distinct().join(people, "key").select(F.col("key").alias("id"), "lat", "lon")
    close = near_points(asking, people.select(F.col("key").alias("id"), "lat", "lon"), MID_M)
    close = close.select(F.least("id", "other_id").alias("left"), F.greatest("id", "other_id").alias("right"), F.col("distance_m").alias("metres"))
    # Two records that were resolved with the same third are looked at too, wherever they are; of its many partners only those of another source that are still open there.
    ends = strong.select(F.col("left").alias("via"), F.col("right").alias("end"), F.col("right_src").alias("end_src")).unionByName(strong.select(F.col("right").alias("via"), F.col("left").alias("end"), F.col("left_src").alias("end_src")))
    lacking = ends.join(open_.select(F.col("key").alias("end"), "toward"), "end")
    linked = lacking.join(ends.select("via", F.col("end").alias("other"), F.col("end_src").alias("toward")), ["via", "toward"]).select(F.least("end", "other").alias("left"), F.greatest("end", "other").alias("right"), F.lit(None).cast("double").alias("metres"))
    close = close.unionByName(linked).groupBy("left", "right").agg(F.min("metres").alias("metres"))
    judged = _sides(close, people).mapInPandas(_judge, JUDGED).where(F.col("place") >= 0)
    judged = scratch.cut(_still_open(judged, open_))
    # What the resolved records of a site know together. Sites have few records each; sets stay small.
    told = strong.select(F.col("left").alias("key"), F.col("b_codes").alias("codes"), F.col("b_nums").alias("nums")).unionByName(strong.select(F.col("right").alias("key"), F.col("a_codes").alias("codes"), F.col("a_nums").alias("nums")))
    facts = known.unionByName(told).select("key", F.explode(F.concat(F.transform("codes", lambda c: F.concat(F.lit("c"), c)), F.transform("nums", lambda n: F.concat(F.lit("n"), n)))).alias("fact")).distinct()
    gathered = facts.groupBy("key").agg(F.collect_set("fact").alias("facts"))
    starts = lambda sign: F.filter(F.coalesce("facts", F.array().cast("array<string>")), lambda f: f.startswith(sign))
    enriched = people.select("key").join(gathered, "key", "left").select("key", starts("c").alias("codes"), starts("n").alias("nums"))
    one_site = _shares("a_codes", "b_codes") | (_shares("a_nums", "b_nums") & ~_apart("a_codes", "b_codes"))
    two_sites = _apart("a_codes", "b_codes") | (_apart("a_nums", "b_nums") & ~_shares("a_codes", "b_codes"))
    weak = scratch.cut(_with(judged, enriched).withColumn("one", one_site).where(F.col("one") | ~two_sites))
    together = weak.where("one").select(*PAIR, F.when(_shares("a_codes", "b_codes"), RULES[1]).otherwise(RULES[2]).alias("rule"))
    found = scratch.cut(strong.select(*PAIR, "rule").unionByName(together))
    # Around each record: the nearest site that knows its code or number.
    around = weak.select(F.col("left").alias("key"), "metres", F.col("b_codes").alias("codes"), F.col("b_nums").alias("nums")).unionByName(weak.select(F.col("right").alias("key"), "metres", F.col("a_codes").alias("codes"), F.col("a_nums").alias("nums")))
    around = around.where(F.col("metres").isNotNull() & ((F.size("codes") > 0) | (F.size("nums") > 0)))
    nearest = around.groupBy("key").agg(F.min_by(F.struct("codes", "nums"), F.struct("metres", "codes", "nums")).alias("z")).select("key", "z.codes", "z.nums")
    free = weak.where(~F.col("one") & F.col("metres").isNotNull())
    for side, mine in (("left", "b"), ("right", "a")):
        free = free.join(nearest.select(F.col("key").alias(side), F.col("codes").alias("z_codes"), F.col("nums").alias("z_nums")), side, "left")
        rival = _apart(f"{mine}_codes", "z_codes") | (_apart(f"{mine}_nums", "z_nums") & ~_shares(f"{mine}_codes", "z_codes"))
        free = free.where(~F.coalesce(rival, F.lit(False))).drop("z_codes", "z_nums")
    free = scratch.cut(free.select(*PAIR, "metres"))
    for rule, reach in ((RULES[3], NEAR_M), (RULES[4], MID_M)):
        hits = _still_open(free.where(F.col("metres") <= reach), _open(people, sources, found)).select(*PAIR, F.lit(rule).alias("rule"))
        found = scratch.cut(found.unionByName(hits.join(found.select("left", "right"), ["left", "right"], "left_anti")))
    return found.select("left", "right", "rule")


def _with(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    a = facts.select(F.col("key").alias("left"), F.col("codes").alias("a_codes"), F.col("nums").alias("a_nums"))
    b = facts.select(F.col("key").alias("right"), F.col("codes").alias("b_codes"), F.col("nums").alias("b_nums"))
    return pairs.join(a, "left").join(b, "right")


def _passes() -> list[tuple[str, Column, Column]]:
    """(rule, keys of its exact join, what must hold of a pair) of the passes on codes and addresses, from strong to weak."""
    none = F.array().cast("array<string>")
    numbered = F.col("num") != ""
    ends = [("zip", F.col("zip")), ("city", F.col("city")), ("street", F.substring("street", 1, 3)), ("street", F.substring("street", -3, 3))]
    partial = F.filter(F.array(*[F.when(F.col(c) != "", F.concat_ws("|", F.lit(c), "num", part)) for c, part in ends]), lambda x: x.isNotNull())
    code, same = _shares("a_codes", "b_codes"), F.col("place") == 1
    return [
        (RULES[0], F.when(numbered, F.transform("codes", lambda c: F.concat_ws("|", c, "num"))).otherwise(none), code & same),
        (RULES[1], F.col("codes"), code),
        (RULES[2], F.when(numbered, partial).otherwise(none), same & ~_apart("a_codes", "b_codes")),
    ]


def _label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rules = []
        for ln, rn, la, ra, metres in zip(batch["left_name"], batch["right_name"], batch["left_address"], batch["right_address"], batch["metres"]):
            x, y, rule = set(site_codes(ln)), set(site_codes(rn)), None
            if any(_akin(a, b) for a in coined_words(ln) for b in coined_words(rn)):
                p, q = read_address(la, None, None, None), read_address(ra, None, None, None)
                same = bool(p and q) and same_place(p, q)
                against = bool(x and y and not x & y) or bool(p and q and not same and not x & y)
                if x & y:
                    rule = RULES[0] if same else RULES[1]
                elif same and not (x and y):
                    rule = RULES[2]
                elif not against and metres is not None and not math.isnan(metres):
                    rule = RULES[3] if metres <= NEAR_M else RULES[4] if metres <= MID_M else None
            rules.append(rule)
        yield pd.DataFrame({"rule": rules, "hit": batch["hit"]}).dropna()


def rule_confidence(labelled: DataFrame) -> DataFrame:
    """(rule, confidence) from pairs (left_name, right_name, left_address, right_address, metres, hit 0 or 1); a row for every rule."""
    ship(labelled.sparkSession)
    seen = labelled.mapInPandas(_label, "rule string, hit int").groupBy("rule").agg(F.sum("hit").alias("hits"), F.count("*").alias("n"))
    every = labelled.sparkSession.createDataFrame([(r,) for r in RULES], "rule string")
    smoothed = (F.coalesce("hits", F.lit(0)) + 1) / (F.coalesce("n", F.lit(0)) + 2)
    return every.join(seen, "rule", "left").select("rule", F.round(smoothed, 4).alias("confidence"))
