"""Groups, survivors, addresses, cross-source matches and names on small tables and against brute force."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from siteweave.llm import components
from siteweave.llm.addresses import PLACE, read_address, record_pairs, same_addresses, same_place
from siteweave.llm.matching import RULES, coined_words, match_sources, rule_confidence, site_codes
from siteweave.llm.names import closeness, lcs_length, link_names, slips, within_one_slip, words_of
from siteweave.llm.queries import latest_decisions
from siteweave.llm.survivor import survivors
from siteweave.llm.usable import area_usable, text_usable, valid_deliveries


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


# --- groups


def brute_groups(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a and b and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return sorted((v, find(v)) for v in parent)


def ties(spark, pairs):
    return spark.createDataFrame([(a, b, "extra") for a, b in pairs], "a string, b string, root string")


CHAIN = [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)]
STAR = [("hub", f"s{i:03}") for i in range(80)]


@pytest.mark.parametrize("pairs", [STAR + CHAIN + [("x", "y"), ("y", "x"), ("x", "x"), (None, "y"), ("z", None), ("x", "y")], STAR + [("s000", "c000")] + CHAIN])
def test_groups(spark, pairs):
    assert rows(components.groups(ties(spark, pairs))) == brute_groups(pairs)


def test_groups_with_a_tail_and_keys_of_one_digest(spark, monkeypatch):
    # The frontier stops at the chain that hangs on to the hub, and eight digests stand for all keys.
    monkeypatch.setattr(components, "_number", lambda key: F.shiftleft(F.pmod(F.xxhash64(key), F.lit(8)), 4))
    pairs = STAR[:30] + [("s000", "c000")] + CHAIN[:20] + [("x", "y")]
    assert rows(components.groups(ties(spark, pairs))) == brute_groups(pairs)


def test_random_groups(spark):
    rng = random.Random(1)
    pairs = [(f"v{rng.randrange(90):02}", f"v{rng.randrange(90):02}") for _ in range(70)]
    assert rows(components.groups(ties(spark, pairs))) == brute_groups(pairs)


def test_no_ties(spark):
    assert rows(components.groups(ties(spark, []))) == rows(components.groups(ties(spark, [("a", "a"), (None, None)]))) == []


def test_latest_decision(spark):
    at = lambda d: datetime(2031, 1, d)
    data = [("osm", "1", "PDB ", " 2", " Match ", at(1), 1), ("pdb", "2", "OSM", "1", "no_match", at(2), 2), ("osm", "3", "pdb", "4", "MATCH", at(1), 4), ("osm", "3", "pdb", "4", "nomatch", at(1), 3), ("osm", "3", "pdb", "4", None, at(9), 9), ("osm", "5", "pdb", None, "match", at(1), 5), ("osm", "6", "osm", "6", "match", at(1), 6), ("osm", "7", "pdb", "8", "match", None, 7)]
    df = spark.createDataFrame(data, "left_source string, left_source_id string, right_source string, right_source_id string, decision string, reviewed_at timestamp, review_id long")
    assert rows(latest_decisions(df)) == [("osm|1", "pdb|2", "no_match"), ("osm|3", "pdb|4", "match"), ("osm|7", "pdb|8", "match")]


# --- survivors


def test_survivors(spark):
    at = lambda d: datetime(2031, 1, d)
    data = [
        ("g", "n1", None, 1, at(1), "b"), ("g", "n2", "a2", 2, at(9), "a"), ("g", None, "a3", 2, at(10), "c"), ("g", "n4", "a4", None, at(30), "d"), ("g", "n1", None, 1, at(1), "b"),
        ("tie", "n", None, 1, at(1), "z"), ("tie", "m", None, 1, at(1), "y"), ("none", None, None, 1, at(1), "x"), (None, "n", "a", 1, at(1), "w"), ("late", "n", "a", 1, None, "u"), ("late", "n", "a", 1, at(1), "v"),
    ]
    df = spark.createDataFrame([(*r, "extra") for r in data], "grp string, name string, address string, trust int, t timestamp, id string, field string")
    got = survivors(df, "grp", [("name", F.col("name").isNotNull()), ("address", F.col("address").isNotNull())], F.col("trust"), F.col("t"), ("id",))
    assert rows(got, "grp", "field", "id") == sorted([("g", "name", "b"), ("g", "address", "c"), ("tie", "name", "y"), ("late", "name", "v"), ("late", "address", "v")], key=repr)
    # b leads the first layer but has no address; c, with as many fields and later, is in the first layer too.
    assert {(r["grp"], r["field"]): r["layer"] for r in got.where("grp = 'g'").collect()} == {("g", "name"): 1, ("g", "address"): 1}
    assert rows(survivors(df.limit(0), "grp", [("name", F.col("name").isNotNull())], F.col("trust"), F.col("t"), ("id",))) == []


def test_layers_fill_what_the_first_lacks(spark):
    at = lambda d: datetime(2031, 1, d)
    # (name, address, area), trust, time: the first dominates the second, which dominates the third.
    data = [("g", 1, 0, 1, 1, at(9), "a"), ("g", 0, 1, 0, 2, at(8), "b"), ("g", 0, 1, 0, 3, at(7), "c"), ("h", 1, 0, 0, 1, at(9), "a"), ("h", 1, 0, 0, 2, at(9), "b"), ("h", 0, 1, 0, 3, at(9), "c"), ("i", 1, 0, 1, 1, at(9), "a"), ("i", 0, 1, 0, 2, at(8), "b"), ("i", 1, 1, 1, 3, at(7), "c")]
    df = spark.createDataFrame(data, "g string, n int, a int, f int, trust int, t timestamp, id string")
    got = {(r["g"], r["field"]): (r["id"], r["layer"]) for r in survivors(df, "g", [(c, F.col(c) == 1) for c in "naf"], F.col("trust"), F.col("t"), ("id",)).collect()}
    assert got == {("g", "n"): ("a", 1), ("g", "f"): ("a", 1), ("g", "a"): ("b", 2), ("h", "n"): ("a", 1), ("h", "a"): ("c", 3), ("i", "n"): ("a", 1), ("i", "f"): ("a", 1), ("i", "a"): ("b", 2)}


def test_survivors_against_brute_force(spark):
    rng = random.Random(2)
    data = [(f"g{rng.randrange(12)}", *[rng.random() < 0.5 for _ in range(3)], rng.choice((1, 2, 3, None)), datetime(2031, 1, rng.randrange(1, 6)), f"i{k:03}") for k in range(200)]
    df = spark.createDataFrame(data, "g string, a boolean, b boolean, c boolean, trust int, t timestamp, id string")
    got = set(rows(survivors(df, "g", [(f, F.col(f)) for f in "abc"], F.col("trust"), F.col("t"), ("id",)), "g", "field", "id"))
    want = set()
    for g in {r[0] for r in data}:
        for k, f in enumerate("abc", 1):
            have = [r for r in data if r[0] == g and r[k]]
            if have:
                want.add((g, f, min(have, key=lambda r: (r[4] or 99, -r[5].timestamp(), r[6]))[6]))
    assert got == want


def test_usable_and_valid(spark):
    texts = ["Equinix", " TBD ", "(none)", "?", "-", "", None, "N/A", "unknown", "Unnamed data center", "Address withheld", "A1"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(text_usable(F.col("t"))).collect()] == [True] + [False] * 10 + [True]
    areas = spark.createDataFrame([(0, 0.0), (1, -1.0), (2, 9999999.0), (3, float("nan")), (4, None), (5, 1234.5), (6, 99999.0), (7, 9998.73), (8, 9999.0)], "i int, a double")
    assert [r[0] for r in areas.orderBy("i").select(area_usable(F.col("a"))).collect()] == [False] * 5 + [True, False, True, False]
    delivered = spark.createDataFrame([(1, "OSM ", " 1", datetime(2031, 1, 1)), (2, "osm", "1", datetime(2031, 1, 2)), (3, "osm", "1", datetime(2031, 1, 2)), (4, "osm", None, None), (5, "epa", "1", None)], "row_id long, source string, source_id string, updated_at timestamp")
    assert rows(valid_deliveries(delivered), "src", "sid", "row_id") == [("epa", "1", 5), ("osm", "1", 3)]


# --- addresses


def test_reading():
    same = [
        "13537 Nutniebkand Road", "13537, Nutniebkand Rd.", "NO. 13537 NUTNIEBKAND RD, SUITE 5", "Ste 12, 13537 Nutniebkand Rd", "Nutniebkand Road 13537", "Sefby, 13537 Nutniebkand Rd Bldg 3", "13537 Nutniebkand Rd, Sefby, OH 44300",
        "Floor 2, 13537 Nütniebkand Rd", "13537 Nutniebkand",
    ]
    first = read_address(same[0], "Sefby", "OH", "44300-1234")
    assert first == ("13537", "", "nutniebkand", "rd", "sefby", "oh", "44300")
    assert all(same_place(first, read_address(t, None, None, None)) for t in same)
    other = ["13537 Nutniebkand Ave", "13538 Nutniebkand Rd", "13537 Nutniebkand Rd, Magby, OH 44300", "13537 Nutniebkand Rd, Sefby, TX 44300", "13537 Nutniebkand Rd, Sefby, OH 44301"]
    assert not any(same_place(first, read_address(t, None, None, None)) for t in other)
    north = read_address("12 N 5th Ave", None, None, None)
    assert north[:4] == ("12", "n", "5th", "ave") and same_place(north, read_address("12 Fifth Avenue", None, None, None)) and same_place(north, read_address("12 Fifth Avenue North", None, None, None))
    assert not same_place(north, read_address("12 S 5th Ave", None, None, None)) and not same_place(north, read_address("12 N 6th Ave", None, None, None))
    assert read_address("Elm Ct 11469", None, None, None)[:4] == ("11469", "", "elm", "ct")
    for nothing in (None, "", "TBD", "Fourth Avenue", "suite 5", "12345", "9", ",,,", "x" * 5000):
        assert read_address(nothing, None, None, None) is None


def test_address_pairs_against_all_pairs(spark):
    rng = random.Random(6)
    streets = ["nutniebkand rd", "nutnibekand road", "nutniebkand ave", "N nutniebkand rd", "lanzmar pl", "lanzmar", "lanzmra pl", "5th st", "6th st", "saint tabofoznos blvd", "st. tabofoznos"]
    data = [(f"k{i:02}", f"{rng.choice((11, 12))} {rng.choice(streets)}", rng.choice((None, "Sefby", "Magby", "Sefyb")), rng.choice((None, "OH")), rng.choice((None, "44300"))) for i in range(60)]
    data += [("none", None, None, None, None), ("word", "unknown", "Sefby", None, None), (None, "11 lanzmar pl", None, None, None)]
    df = spark.createDataFrame([(*r, "extra") for r in data], "key string, address string, city string, state string, postcode string, place string")
    read = {k: p for k, *r in data if k and (p := read_address(*r))}
    want = sorted((a, b) for a in read for b in read if a < b and same_place(read[a], read[b]))
    assert rows(record_pairs(*same_addresses(df))) == want and len(want) > 50
    assert rows(record_pairs(*same_addresses(df.limit(0)))) == []
    assert len(PLACE) == 7


# --- sources without keys


def site(key, name=None, operator=None, address=None, lat=None, lon=None, city="Sefby", postcode="44300"):
    return (key, key.split("|")[0], name, operator, address, city, "OH", postcode, lat, lon, "extra")


def test_matching(spark):
    data = [
        site("osm|1", "Fevfald: SEFB123 Sefby", "Fevfald Telecom", "11 Lanzmar Pl", 40.0, -83.0), site("peeringdb|1", "fevfald sefb-123", "FEVFALD TELECOM INC", "12 Other Rd", 40.0001, -83.0), site("epa_nei|1", "Fevfald Sefby Campus", "Fevfld", "11 Lanzmar Place", None, None),
        site("osm|2", "Quillon Sefby", "Quillon Holdings", "11 Lanzmar Pl", 40.0, -83.0), site("peeringdb|3", "Rilafis Sefby", "Rilafis", None, 41.0, -83.0), site("osm|3", "RILAFIS DATA CENTER", None, None, 41.0002, -83.0), site("osm|4", "Rilafis Data Center", None, None, 41.0001, -83.0),
        site("peeringdb|5", "Bofguzam (SEFB7)", None, None, 42.0, -83.0), site("osm|5", "Bofguzam SEFB8", None, None, 42.0, -83.0), site("epa_nei|6", None, None, None, None, None, None, None), site("osm|1", "Fevfald: SEFB123 Sefby", "Fevfald Telecom", "11 Lanzmar Pl", 40.0, -83.0),
    ]
    df = spark.createDataFrame(data, "key string, src string, name string, operator string, address string, city string, state string, postcode string, lat double, lon double, rule string")
    got = {(r["left"], r["right"]): r["rule"] for r in match_sources(df).collect()}
    assert got == {("osm|1", "peeringdb|1"): "code", ("epa_nei|1", "osm|1"): "address", ("osm|3", "peeringdb|3"): "near", ("osm|4", "peeringdb|3"): "near"}
    assert match_sources(df.limit(0)).isEmpty()


def test_codes_words_confidence(spark):
    assert site_codes("Oktatand - Fogezthorpe (FOGE-874b) Hall 3") == ["foge874b"] and site_codes(None) == [] and site_codes("Bldg 12 DH 3") == []
    assert coined_words("Fev-fald Telecom's Data Center, Sefby (SEFB12)", "Sefby") == ["fevfald"] and coined_words(None) == []
    data = [("A12 Fevfald", "Fevfald A12", None, None, 5.0, 1), ("AB12 Fevfald", "Fevfald AB12", None, None, 5.0, 1), ("AB12 Fevfald", "Fevfald AB12", None, None, None, 0), ("Fevfald", "Rilafis", None, None, 1.0, 0), (None, None, None, None, None, 1)]
    df = spark.createDataFrame(data, "left_name string, right_name string, left_address string, right_address string, metres double, hit int")
    got = {r["rule"]: r["confidence"] for r in rule_confidence(df).collect()}
    assert set(got) == set(RULES) and got["code"] == 0.5 and got["near"] == 0.6667 and got["mid"] == 0.5


# --- names


def test_letter_measures():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(9))) for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
        assert lcs_length(a, b) == table[-1][-1] == lcs_length(b, a)
        assert within_one_slip(a, b) == (slips(a, b) <= 1) and slips(a, b) == slips(b, a)


def test_names(spark):
    listed = spark.createDataFrame([(1, "Oktatand Cloud Services"), (2, "Partoveld Data Centers"), (3, "Rifosal Cloud Services"), (4, "Fevfald Telecom"), (5, "Koffefeld Interconnect"), (5, "Koffefeld Interconnect")], "id int, name string")
    good = {
        1: ["OKTATAND CLOUD SERVICES", "Oktaand Cloud Svcs LLC", "kttnd cloud svc.", "Cloud Services, Oktatand", "The Oktatand Cloud Services / Alaska Corp", "Oktat's Cloud Svcs", "Okta Tand Cloud Services", "Oktatand, L.L.C.", "Oktatand CloudServices of New Mexico"],
        2: ["Prtvld DC", "Parto-veld Data Centres Ltd", "DATA CENTERS (PARTOVELD) HOLDINGS", "Partoveld Dat aCenters", "Pärtoveld Datacenters"],
        4: ["FVFLD TELECOMMUNICATIONS HOLDINGS", "Fevfadl Telecom Group"],
        5: ["Koffefeld  Interconnect ", "Koffefeld IX"],
    }
    bad = ["Rifodalwick Data Centers", "Oktadalwick Savings Bank", "Quillon Cloud Services", "Fevfald County Schools", "Cloud Services", "Data Centers Inc", "2166 Oktatand Partners LLC", "", None, "??", "x" * 3000]
    names = [(n,) for group in good.values() for n in group] + [(n,) for n in bad]
    df = spark.createDataFrame(names, "name string").withColumn("text", words_of(F.col("name")))
    got = {r["name"]: r["id"] for r in df.join(link_names(df.where("text != ''"), listed), "text").collect()}
    assert got == {n: k for k, group in good.items() for n in group}
    assert link_names(df.limit(0), listed).isEmpty() and link_names(df.where("text != ''"), listed.limit(0)).isEmpty()
    assert closeness("oktatand", "oktatand", "cloudservices") == 3.0 and closeness("elsulund", "oktatand", "cloudservices") == 0.0
