"""Scalar functions on the cases they are known by."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from siteweave import dims
from siteweave.functions import projection, ratings, similarity as sim
from siteweave.operators import classify, lookups
from siteweave.sources.peeringdb import BOXES


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, x) for i, x in enumerate(values)], f"i int, x {kind}").orderBy("i")


def apply(spark, values, f, kind="string"):
    return [r[0] for r in column(spark, values, kind).select(f(F.col("x"))).collect()]


def test_ratings(spark):
    texts = ["G1 1500 KW EMERGENCY GENERATOR", "947 BHP EMERGENCY IC ENGINE", "2 MW STANDBY GENERATOR", "1,250 kva set", "STANDBY GENERATOR SN-6", "", None, "PERMIT 99999 KW", "10 KW UNIT", "9 KW then 900 KW"]
    got = apply(spark, texts, ratings.rating_kw)
    assert got[:4] == pytest.approx([1500, 706.462, 2000, 1000]) and got[4:] == [None] * 6


def test_years_and_postcodes(spark):
    assert apply(spark, ["2016", "~2020", "1899", "2016-05-01", "C19", None], ratings.year_of) == [2016, None, None, 2016, None, None]
    assert apply(spark, ["82009", "FL 33487", "10001-1234", "135-0061", "1234", "ABCDE", "", None], ratings.postcode_prefix) == [820, 334, 100, None, None, None, None, None]


def test_generator_words(spark):
    df = spark.createDataFrame([("20100102", None, None), ("385", "Gen set 4", ""), (None, "BOILER", "emergency use"), (None, "BOILER", None), ("x", None, None)], "a string, b string, c string")
    assert [r[0] for r in df.select(ratings.is_generator(F.col("a"), F.col("b"), F.col("c"))).collect()] == [True, True, True, False, False]


def test_power_mentions(spark):
    text = "The site has a critical load of 57.6 MW at peak. It sold 12 MW of corn. Total demand: 1,200 megawatts; capacity 9999 MW."
    got = apply(spark, [text, "", None], ratings.power_mentions)
    assert [(m["value_mw"], m["basis"]) for m in got[0]] == [(57.6, "critical_load"), (1200.0, "total_facility")] and got[1:] == [[], None]


def test_addresses_codes_and_links(spark):
    assert apply(spark, ["11 Great Oaks Boulevard", "200 Paul Ave", None], sim.short_address) == ["11 great oaks blvd", "200 paul ave", ""]
    assert apply(spark, ["CoreSite - Santa Clara (SV3)", "Csquare SFO1 data center", None], lambda c: F.array_sort(sim.code_tokens(c))) == [["sv3"], ["sfo1"], []]
    df = spark.createDataFrame([("a SV3", "a SV7", "1 x st", "1 x st"), ("a", "b", "1525 comstock st", "1725 comstock st"), ("a SFO1", "b SFO1", "1 x", "2 x"), (None, None, None, None)], "n string, m string, a string, b string")
    why = sim.cannot_link(sim.code_tokens(F.col("n")), sim.code_tokens(F.col("m")), sim.street_number(F.col("a")), sim.street_number(F.col("b")))
    assert [r[0] for r in df.select(why).collect()] == ["distinct_site_codes", "distinct_street_numbers", "distinct_street_numbers", None]


def test_scores(spark):
    def score(d, n, a, o, code, both, m):
        return spark.range(1).select(sim.pair_score(*map(F.lit, (d, n, a, o)), F.lit(code), F.lit(both), F.lit(m))).first()[0]

    assert score(1.0, 0.2, 0.0, 0.0, True, False, 10.0) == 0.82
    assert score(0.9, 0.0, 0.0, 1.0, False, True, 200.0) == 0.80
    assert score(0.0, 0.0, 0.95, 1.0, False, True, 900.0) == 0.82
    assert score(0.8, 1.0, 1.0, 0.1, True, True, 151.0) == 0.45
    assert score(1.0, 1.0, 1.0, 1.0, True, True, 1.0) == 1.0
    assert apply(spark, [10.0, 60.0, 530.0, 1000.0, 2000.0], sim.distance_credit, "double") == pytest.approx([1, 1, 0.5, 0, 0])


def test_block_ratio_is_not_symmetric(spark):
    df = spark.createDataFrame([("tide", "diet"), ("diet", "tide"), ("", "a"), (None, "a"), ("same", "same")], "a string, b string")
    assert [r[0] for r in df.select(sim.block_ratio("a", "b")).collect()] == [0.25, 0.5, 0.0, 0.0, 1.0]


def test_ids(spark):
    got = apply(spark, ["Equinix San Jose (SV1)", "***", "x" * 60], lambda c: sim.facility_id(c, F.lit(37.4), F.lit(-121.95)))
    assert got[0].startswith("equinix-san-jose-sv1-") and got[1].startswith("facility-") and len(got[2]) == 51 and len(got[0].rsplit("-", 1)[1]) == 6


def test_areas():
    square = "POLYGON ((-121.98 37.38, -121.979 37.38, -121.979 37.381, -121.98 37.381, -121.98 37.38))"
    want = 88.4 * 111.0
    for state in ("CA", None):
        assert 8_000 < projection.polygon_area_m2(square, state) < 12_000
        assert math.isclose(projection.polygon_area_m2(square, state), want * 1000 / 1000, rel_tol=0.02)
    with_hole = "POLYGON ((-120 37, -119.99 37, -119.99 37.01, -120 37.01, -120 37), (-119.996 37.004, -119.994 37.004, -119.994 37.006, -119.996 37.006, -119.996 37.004))"
    whole = "POLYGON ((-120 37, -119.99 37, -119.99 37.01, -120 37.01, -120 37))"
    assert math.isclose(projection.polygon_area_m2(with_hole), projection.polygon_area_m2(whole) * 0.96, rel_tol=1e-3)
    # An equal-area projection gives the same area wherever it is centred.
    for lat, lon in ((64.0, -150.0), (20.5, -157.0)):
        box = f"POLYGON (({lon} {lat}, {lon + 0.01} {lat}, {lon + 0.01} {lat + 0.01}, {lon} {lat + 0.01}, {lon} {lat}))"
        areas = [projection.polygon_area_m2(box, s) for s in ("AK", "HI", "CA")]
        assert max(areas) / min(areas) < 1 + 1e-6
    assert projection.polygon_area_m2(None) is None and projection.polygon_area_m2("POINT (1 2)") is None


def test_ring_centroid(spark):
    df = spark.createDataFrame([([(0.0, 0.0), (0.0, 4.0), (2.0, 4.0), (2.0, 0.0)],), ([(1.0, 1.0), (1.0, 3.0), (1.0, 2.0)],)], "g array<struct<lat: double, lon: double>>")
    got = [tuple(r[0]) for r in df.select(projection.ring_centroid(F.col("g"))).collect()]
    assert got == [(1.0, 2.0), (1.0, 2.0)]


def test_operator_cascade(spark):
    texts = {
        "RAGING WIRE": ("NTT", "alias"), "DRT LAX10": ("Digital Realty", "alias_token"), "CYXTERA COMMUNICATIONS  LLC SC4-5": ("Cyxtera", "alias_token"), "Level(3) Los Angeles": ("Lumen Technologies", "alias_token"),
        "Equinix, Inc.": ("Equinix", "alias"), "QTS Santa Clara 1": ("QTS", "alias_token"), "Totally Unknown Entity Xyz": ("Totally Unknown Entity Xyz", "unresolved"), "XERES VENTURES, LP (SC1)": ("Unattributed (property SPV)", "unattributed"),
        "AT&T Switching Center": ("AT&T", "alias_token"), "Primerica Financial": ("Primerica Financial", "unresolved"), "  ": (None, "unresolved"), None: (None, "unresolved"),
    }
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    got = lookups.resolve_operators(df, "raw", dims.operator_aliases(spark), dims.unattributed(spark))
    assert {r["raw"]: (r["operator"], r["operator_confidence"]) for r in got.collect()} == texts


def test_states(spark):
    data = [(" CA ", None, None, None), ("south carolina", None, None, None), ("", "82009", None, None), ("", "FL 33487", None, None), (None, "135-0061", None, None), ("", None, 26.405641, -80.114041), ("PR", None, None, None), (None, None, 51.5, -0.1), (None, "00601", None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, s string, z string, lat double, lon double")
    got = lookups.assign_state(df, dims.zip3_ranges(spark), BOXES, "s", "z", "lat", "lon").orderBy("i")
    assert [r["assigned_state"] for r in got.collect()] == ["CA", "SC", "WY", "FL", None, "FL", "PR", None, "PR"]


def test_boxes(spark):
    boxes = [b for _, b in BOXES]
    places = [(61.2, -149.9, True), (52.89, 172.97, True), (51.5, -0.13, False), (35.68, 139.69, False), (-33.9, 151.2, False), (45.0, -40.0, False), (None, 1.0, False)]
    df = spark.createDataFrame([(a, b) for a, b, _ in places], "lat double, lon double")
    assert [r[0] for r in df.select(lookups.in_any_box(F.col("lat"), F.col("lon"), boxes)).collect()] == [w for *_, w in places]


def test_rules_and_classes(spark):
    names = ["SDSU Computer Room", "Server room 2", "City Hall annex", "St Mary Hospital", "Cisco lab", "Plain site", None]
    assert apply(spark, names, classify.first_rule) == ["education_facility", "server_room_not_facility", "government_non_commercial", "healthcare_facility", "enterprise_self_operated", None, None]
    df = spark.createDataFrame([("Google", "x"), ("QTS", "x"), ("Equinix", "x"), ("Verizon", "x"), (None, "Main wire center"), (None, None)], "o string, n string")
    assert [r[0] for r in df.select(classify.site_class(F.col("o"), F.col("n"))).collect()] == ["hyperscale", "wholesale", "colocation", "telecom", "telecom", "unknown"]


def test_priors(spark):
    df = spark.createDataFrame([("colocation", 2016), ("colocation", None), ("mystery", 1950), ("telecom", 2200), (None, 2012)], "c string, y int")
    got = [r[0] for r in df.select(lookups.prior_of(F.col("c"), F.col("y"))["w_mid"]).collect()]
    assert got == [240.0, 190.0, 130.0, 70.0, 190.0]


def test_dimensions(spark):
    assert dims.jurisdictions(spark).count() == 51 and dims.boxes(spark).count() == 52 and dims.priors(spark).count() == 12 and dims.overlays(spark).count() == 6
    assert rows(dims.zip3_ranges(spark).where("state = 'GA'"), "low", "high") == [(300, 319), (398, 399)]


def test_five_places_by_the_binary_value(spark):
    import random

    rng = random.Random(1)
    values = [0.0, -0.5, 37.123455, -121.987655, 179.999995, 90.0, 1e-7, -1e-7, *[round(rng.uniform(-180, 180), 6) for _ in range(3000)], *[rng.uniform(-180, 180) for _ in range(1000)], *[round(rng.uniform(-180, 180), 5) + 0.000005 for _ in range(3000)]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x double")
    got = {r["i"]: r["t"] for r in df.select("i", sim.five_places(F.col("x")).alias("t")).collect()}
    assert [got[i] for i in range(len(values))] == [f"{x:.5f}" for x in values]
