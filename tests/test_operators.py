"""Resolution, estimates, totals, figures, contracts, sources, sinks and streams on small tables."""

import io
import json
import random
import urllib.error

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from siteweave import dims
from siteweave.operators import analytics, evidence, power
from siteweave.operators import resolve as R
from siteweave.schemas import RECORD, conform, empty_records, facility_rules, power_rules, publish, violations
from siteweave.sinks import writers
from siteweave.sources import filings, history, http, nei, osm, peeringdb, tables, territories
from siteweave.storage import Scratch


def records(spark, *items):
    full = [{"source": "osm", "is_building": False, "state": "CA", **r} for r in items]
    return spark.createDataFrame([tuple(r.get(f.name) for f in RECORD.fields) for r in full], RECORD).withColumns({"operator": F.col("operator_raw"), "operator_confidence": F.lit("alias"), "facility_class": F.lit("colocation")})


SITES = (
    dict(source_id="way/1", name="Equinix SV1", operator_raw="Equinix", lat=37.4, lon=-121.95, address="11 Great Oaks Boulevard", footprint_sqm=5000.0),
    dict(source="peeringdb", source_id="101", name="Equinix San Jose (SV1)", operator_raw="Equinix", lat=37.4001, lon=-121.9501, address="11 Great Oaks Blvd", pdb_net_count=44.0),
    dict(source="peeringdb", source_id="102", name="CoreSite - Santa Clara (SV3)", operator_raw="CoreSite", lat=37.38, lon=-121.98, address="2901 Coronado Drive"),
    dict(source="peeringdb", source_id="103", name="CoreSite - Santa Clara (SV7)", operator_raw="CoreSite", lat=37.3802, lon=-121.9803, address="3032 Coronado Drive"),
    dict(source="epa_nei", source_id="9", name=None, operator_raw=None, lat=None, lon=None),
)


def test_resolve(spark):
    facilities, links, review = R.resolve(records(spark, *SITES))
    got = {r["source_list"]: r for r in facilities.collect()}
    assert facilities.count() == 3
    both = got["osm,peeringdb"]
    assert (both["name"], both["n_sources"], both["lat"], both["pdb_net_count"]) == ("Equinix San Jose (SV1)", 2, 37.4, 44.0)
    assert both["facility_id"].startswith("equinix-san-jose-sv1-")
    assert links.join(facilities, "facility_id", "left_anti").isEmpty() and links.count() == 4
    assert review.isEmpty()


def test_resolve_empty(spark):
    facilities, links, review = R.resolve(records(spark))
    assert facilities.isEmpty() and links.isEmpty() and review.isEmpty()


def test_equal_ids_are_numbered_everywhere(spark):
    twice = [dict(source_id=f"n/{i}", name="Same", lat=10.0, lon=20.0, state=s) for i, s in enumerate(("CA", "TX"))]
    facilities, links, _ = R.resolve(records(spark, *twice))
    ids = sorted(r[0] for r in facilities.select("facility_id").collect())
    assert ids[0].endswith("-0") and ids[1].endswith("-1") and sorted(r[0] for r in links.select("facility_id").collect()) == ids


def merge_in_order(edges: pd.DataFrame, bans: pd.DataFrame) -> pd.DataFrame:
    """Best edge first: two clusters become one unless a cannot-link pair stands between them."""
    owner: dict[str, str] = {}
    members: dict[str, set[str]] = {}
    against: dict[str, set[str]] = {}
    for p, q in zip(bans["i"], bans["j"]):
        against.setdefault(p, set()).add(q)
        against.setdefault(q, set()).add(p)
    for i, j in edges.sort_values(["score", "i", "j"], ascending=[False, True, True])[["i", "j"]].itertuples(index=False):
        a, b = owner.setdefault(i, i), owner.setdefault(j, j)
        if a == b:
            continue
        one, two = members.setdefault(a, {a}), members.setdefault(b, {b})
        if any(against.get(v, set()) & two for v in one):
            continue
        keep, gone = (a, b) if a < b else (b, a)
        members[keep] = one | two
        for v in members.pop(gone):
            owner[v] = keep
    return pd.DataFrame({"v": list(owner), "cluster": list(owner.values())}, dtype="object")


@pytest.mark.parametrize("seed", range(2))
def test_merging_in_rounds_against_best_first(spark, seed):
    rng = random.Random(seed)
    names = [f"v{i:02}" for i in range(14)]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    edges = [(a, b, rng.choice((0.8, 0.9, 0.75, rng.random()))) for a, b in rng.sample(pairs, 24)]
    bans = rng.sample(pairs, 12)
    want = merge_in_order(pd.DataFrame(edges, columns=["i", "j", "score"]), pd.DataFrame(bans, columns=["i", "j"]))
    groups = {frozenset(g["v"]) for _, g in want.groupby("cluster") if len(g) > 1}
    e, b = spark.createDataFrame(edges, "i string, j string, score double"), spark.createDataFrame(bans, "i string, j string")
    got = R.constrained_clusters(e, b, Scratch(spark, "t")).toPandas()
    assert set(got["v"]) == {v for i, j, _ in edges for v in (i, j)}
    assert {frozenset(g["v"]) for _, g in got.groupby("cluster") if len(g) > 1} == groups


@pytest.mark.parametrize("bound", (1_000_000, 3))
def test_a_star_is_merged_in_few_tables(spark, monkeypatch, bound):
    monkeypatch.setattr(R, "GROUP_PAIRS", bound, raising=False)
    edges = [("a", f"s{k:02}", 0.99 - k / 100) for k in range(12)] + [("x", "y", 0.9), ("y", "z", 0.8)]
    bans = [("s03", "s07"), ("x", "z"), ("a", "x")]
    scratch = Scratch(spark, "t")
    got = R.constrained_clusters(spark.createDataFrame(edges, "i string, j string, score double"), spark.createDataFrame(bans, "i string, j string"), scratch)
    assert rows(got, "v", "cluster") == sorted([("a", "a"), ("x", "x"), ("y", "x"), ("z", "z"), *[(f"s{k:02}", "s07" if k == 7 else "a") for k in range(12)]])
    if bound > 3:
        assert scratch.n <= 12
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join") <= 4


def test_estimates(spark):
    fac = spark.createDataFrame([("f1", "colocation", 2016, 10000.0, 3.0), ("f2", "unknown", None, 43850.0, 30.0), ("f3", "unknown", None, None, 2.0), ("f4", "unknown", None, 10000.0, 900.0)], "facility_id string, facility_class string, year_built int, footprint_sqft double, building_levels double")
    gross = power.gross_area(fac)
    assert rows(gross, "facility_id", "est_gross_sqft", "est_gross_sqft_min", "partial_occupancy")[:2] == [("f1", 30000.0, 30000.0, False), ("f2", 131550.0, 43850.0, True)]
    area = {r["facility_id"]: r for r in power.area_estimates(gross).collect()}
    assert set(area) == {"f1", "f2", "f4"} and area["f1"]["it_load_mw"] == pytest.approx(30000 * 0.6 * 240 / 1e6)
    assert all(r["ci_low_mw"] <= r["it_load_mw"] <= r["ci_high_mw"] for r in area.values())
    links = spark.createDataFrame([("f1", "epa_nei", "10"), ("f2", "epa_nei", "11"), ("f2", "osm", "10")], "facility_id string, source string, source_id string")
    inventory = spark.createDataFrame([("10", 10, 2, 3000.0), ("11", 0, 0, 0.0)], "source_id string, n_generator_units int, n_units_rated int, rated_kw_sum double")
    fleet = power.fleet_estimates(fac, links, inventory).collect()
    assert len(fleet) == 1 and fleet[0]["generator_nameplate_mw"] == pytest.approx(19.8) and fleet[0]["it_load_mw"] == pytest.approx(19.8 / 1.3 * 0.85)
    eight = power.fleet_estimates(fac.where("facility_id = 'f3'").withColumn("facility_id", F.lit("f1")), links.limit(1), spark.createDataFrame([("10", 8, 0, 0.0)], inventory.schema)).first()
    assert (eight["it_load_mw"], eight["ci_low_mw"], eight["ci_high_mw"]) == pytest.approx((10.9846154, 3.009, 13.5381818))
    cited = spark.createDataFrame([("f1", 10.0, "it_load"), ("f2", 10.0, "critical_load"), ("f3", 14.5, "total_facility"), ("f4", 0.0, "it_load")], "facility_id string, stated_value_mw double, basis string").join(fac, "facility_id").withColumn("source_url", F.lit("u"))
    assert [r[0] for r in power.attested_estimates(cited).orderBy("facility_id").select(F.round("it_load_mw", 6)).collect()] == [10.0, 8.5, 10.0]


def test_precedence_agreement_totals(spark):
    est = spark.createDataFrame([("f1", "C_area", 5.0, 4.0, 6.0, 30.0), ("f1", "A_attested", 12.0, None, 13.0, 90.0), ("f1", "B_generator", 10.0, 8.0, 11.0, 60.0), ("f2", "B_generator", 20.0, 1.0, 30.0, 100.0), ("f2", "C_area", 10.0, 1.0, 30.0, 100.0)], "facility_id string, method string, it_load_mw double, ci_low_mw double, ci_high_mw double, annual_gwh double")
    best = {r["facility_id"]: r for r in power.best_estimates(est).collect()}
    assert (best["f1"]["power_tier"], best["f1"]["best_power_mw"], best["f1"]["power_ci_low_mw"], best["f1"]["n_power_methods"]) == ("A_attested", 12.0, 8.0, 3)
    got = {r["pair"]: (r["n_facilities"], r["median_ratio"]) for r in power.tier_agreement(est).collect()}
    assert got["B_generator vs C_area"] == (2, 0.5)
    fac = spark.createDataFrame([("a", 100.0, 90.0, 110.0, 15000.0, "A_attested"), ("b", 10.0, 9.0, 11.0, 0.0, "C_area"), ("c", 10.0, 9.0, 11.0, 0.0, None), ("d", None, None, None, None, None)], "facility_id string, best_power_mw double, power_ci_low_mw double, power_ci_high_mw double, est_annual_gwh double, power_tier string")
    report = power.reconcile(fac, 18.0, 12.0, 26.0)
    assert report.first()["bottom_up_annual_twh"] == 15.0 and report.first()["within_anchor_range"]
    assert rows(power.calibrate(fac, report, True), "facility_id", "best_power_mw") == rows(fac, "facility_id", "best_power_mw")
    outside = power.reconcile(fac, 30.0, 20.0, 40.0)
    moved = {r["facility_id"]: r["best_power_mw"] for r in power.calibrate(fac, outside, True).collect()}
    assert moved == {"a": 100.0, "b": 20.0, "c": 20.0, "d": None}
    assert {r["best_power_mw"] for r in power.calibrate(fac, outside, False).collect()} == {100.0, 10.0, None}


def test_contracts(spark):
    boxes = F.col("lon").between(-125, -66)
    fac = spark.createDataFrame([("a", "x", 40.0, -100.0, 5.0, "B_generator", 1, 4.0, 6.0), ("a", "x", 51.5, -0.1, 3000.0, "Z", 0, 9.0, 6.0)], "facility_id string, name string, lat double, lon double, best_power_mw double, power_tier string, n_sources int, power_ci_low_mw double, power_ci_high_mw double")
    found = {r["rule"]: r["violations"] for r in violations(fac, facility_rules(boxes), unique="facility_id").collect()}
    assert {k for k, n in found.items() if n} == {"inside_a_jurisdiction", "power_range", "tier_known", "sources_counted", "interval_ordered", "facility_id_unique"}
    est = spark.createDataFrame([("A_attested", "it", "{}", 5.0, 4.0, 6.0, None), ("A_attested", "it", "{}", 5.0, 4.0, 6.0, "u"), ("D", None, None, 5.0, 7.0, 6.0, None)], "method string, basis string, assumptions_json string, it_load_mw double, ci_low_mw double, ci_high_mw double, source_url string")
    got = {r["rule"]: r["violations"] for r in violations(est, power_rules()).collect()}
    assert got == {"method_known": 1, "basis_present": 1, "assumptions_present": 1, "load_range": 0, "interval_ordered": 1, "attested_has_url": 1}
    assert {r["violations"] for r in violations(est.limit(0), power_rules()).collect()} == {0}


def test_conform(spark):
    df = spark.createDataFrame([("osm", "1", "37.5", "2;3", None)], "source string, source_id string, lat string, building_levels string, extra string")
    got = conform(df)
    assert got.columns == [f.name for f in RECORD.fields] and got.first()["lat"] == 37.5 and got.first()["building_levels"] is None and got.first()["is_building"] is False
    assert empty_records(spark).isEmpty() and publish(df, ["source", "missing"]).columns == ["source", "missing"]


def test_figures(spark):
    df = spark.createDataFrame([(f"k{i:02}", float(i % 7), float((i * 5) % 11), i) for i in range(40)], "k string, x double, y double, n int")
    share = {r["k"]: r for r in analytics.running_share(df, "x", "k").collect()}
    order = sorted(share.values(), key=lambda r: (-r["x"], r["k"]))
    assert [r["rank"] for r in order] == list(range(1, 41)) and order[-1]["cumulative_share"] == pytest.approx(1)
    pdf = df.toPandas()
    assert analytics.spearman(df, "x", "y").first()["rho"] == pytest.approx(pdf["x"].rank().corr(pdf["y"].rank()))
    assert analytics.spearman(df.limit(3), "x", "y").first()["rho"] is None
    years = spark.createDataFrame([(2010, 2012), (2010, None), (2013, 2013)], "a int, b int")
    assert rows(analytics.cumulative_by_year(years, ("a", "b"))) == [(2010, 2, 0), (2011, 2, 0), (2012, 2, 1), (2013, 3, 2)]
    assert analytics.cumulative_by_year(years.limit(0), ("a", "b")).isEmpty()


def test_evidence(spark):
    fac = spark.createDataFrame([("f1", "Equinix Silicon Valley", "Equinix"), ("f2", "Vantage Valley Campus", None)], "facility_id string, name string, operator string")
    over = spark.createDataFrame([("VALLEY", "equinix", 5.0), ("valley", None, 7.0)], "name_contains string, operator_contains string, mw double")
    assert rows(evidence.by_phrase(fac, over), "facility_id", "mw") == [("f1", 5.0), ("f1", 7.0), ("f2", 7.0)]
    filed = spark.createDataFrame([(1, "Silicon Valley expansion"), (2, "nothing here"), (3, None)], "filing_id int, title string")
    assert rows(evidence.by_title(fac, filed)) == [(1, "f1", 2)]
    layers = spark.createDataFrame([("PGE", "Pacific", "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0))"), ("PWR", "Power and Water Resource Pooling Authority", "POLYGON ((0 0, 9 0, 9 9, 0 9, 0 0))"), ("SVP", None, "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))")], "utility string, utility_name string, geometry string")
    at = spark.createDataFrame([("a", 1.0, 1.0), ("b", 5.0, 5.0), ("c", 50.0, 5.0)], "facility_id string, lat double, lon double")
    assert rows(evidence.serving_territories(at, layers, dims.overlays(spark))) == [("a", "SVP", "PGE,SVP"), ("b", "PGE", "PGE"), ("c", None, None)]


def test_sources(spark, tmp_path):
    folder = tmp_path / "osm" / "CA" / "2031-01-01"
    folder.mkdir(parents=True)
    ring = [dict(lat=a, lon=b) for a, b in ((37.4, -121.95), (37.4, -121.949), (37.401, -121.949), (37.401, -121.95))]
    elements = [dict(type="way", id=1, geometry=ring, tags={"building": "yes", "operator": "Equinix", "start_date": "2016", "building:levels": "2"}), dict(type="node", id=2, lat=1.0, lon=2.0, tags={"name": "N"}), dict(type="relation", id=3, tags={})]
    (folder / "overpass.json").write_text(json.dumps({"elements": elements}))
    read = osm.read_snapshots(spark, str(tmp_path / "osm"))
    assert {(r["file_state"], r["snapshot"]) for r in read.collect()} == {("CA", "2031-01-01")}
    got = {r["source_id"]: r for r in osm.to_records(osm.latest_snapshot(read)).collect()}
    assert set(got) == {"way/1", "node/2"} and got["way/1"]["name"] == "Equinix" and got["way/1"]["is_building"] and got["way/1"]["year_built"] == 2016.0
    assert got["way/1"]["lat"] == pytest.approx(37.4005) and got["way/1"]["geometry_wkt"].startswith("POLYGON ((-121.95 37.4,")
    assert 'nwr(area.a)["telecom"="data_center"];' in osm.query_text("ca")

    folder = tmp_path / "pdb" / "US" / "2031-01-01"
    folder.mkdir(parents=True)
    (folder / "fac.json").write_text(json.dumps([dict(id=5, name="A", org_name="O", address1="1 X", address2="", zipcode="95112", status="ok", latitude=37.0, longitude=-121.0, net_count=4), dict(id=6, status="deleted", latitude=1.0, longitude=1.0), dict(id=7, name="no place")]))
    got = peeringdb.to_records(peeringdb.read_snapshots(spark, str(tmp_path / "pdb"))).collect()
    assert [(r["source_id"], r["state"], r["address"], r["pdb_net_count"]) for r in got] == [("5", "CA", "1 X", 4.0)] and json.loads(got[0]["raw_json"])["aka"] is None

    folder = tmp_path / "nei" / "CA" / "2031-01-01"
    folder.mkdir(parents=True)
    header = ",".join(nei.COLUMNS)
    unit = lambda f, u, lat, what, scc, name="Site": f"{f},,{name},518210,{lat},-121,1 A St,Town,95112,{u},x,{what},,{scc}"
    (folder / "units.csv").write_text("\n".join([header, unit("1", "a", "37", "1500 KW GENERATOR", ""), unit("1", "b", "37", "BOILER", ""), unit("1", "c", "37", "", "20100102"), unit("2", "a", "", "X", "")]) + "\n")
    made, inventory = nei.to_records(nei.read_extracts(spark, str(tmp_path / "nei")))
    assert rows(inventory, "source_id", "n_generator_units", "n_units_total", "n_units_rated", "rated_kw_sum") == [("1", 2, 3, 1, 1500.0)]
    assert made.first()["operator_raw"] is None and made.first()["state"] == "CA"
    raw = nei.read_extracts(spark, str(tmp_path / "nei")).unionByName(nei.read_extracts(spark, str(tmp_path / "nei")))
    assert nei.region_extract(raw, ["CA"]).count() == 4 and nei.region_extract(raw, ["TX"]).isEmpty()

    (tmp_path / "ref.csv").write_text("# note\nname,n\na,1\n# more\nb,2\n")
    assert rows(tables.read_reference(spark, str(tmp_path / "ref.csv"), "name string, n int")) == [("a", 1), ("b", 2)]
    layer = {"features": [{"properties": {"Acronym": " ", "Utility": "Big", "Type": "POU"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1.5, 0], [1, -1e-3], [0, 0]]]}}]}
    (tmp_path / "t.geojson").write_text(json.dumps(layer))
    got = territories.read_territories(spark, str(tmp_path / "t.geojson")).first()
    assert got["utility"] == "Big" and got["geometry"].replace(", ", ",").startswith("POLYGON ((0 0,1.5 0,1 -")


def test_filings(spark):
    page = "<html><table><tr><th>h</th></tr><tr><td>1</td><td>EIR</td><td>City</td><td>2020</td><td>New Data Center</td><td>z</td></tr><tr><td>2</td></tr><tr><td>3</td><td>a</td><td>b</td><td>c</td><td>Bridge</td></tr></table><table><tr><td>9</td></tr></table></html>"
    pages = spark.createDataFrame([("Office", "2020-01", page), ("Power", "2020-01", page), ("Office", "2020-02", None), ("Office", "2020-03", "<p>none")], "development_type string, window_start string, html string")
    assert rows(filings.discover(pages), "sch_number", "title", "development_type") == [("1", "New Data Center", "Power")]
    detail = spark.createDataFrame([("1", "t", "u", "<p>critical load of <b>50 MW</b></p><script>9 MW load</script>")], "sch_number string, title string, source_url string, html string")
    assert rows(filings.harvest(detail), "value_mw", "basis") == [(50.0, "critical_load")]
    assert [tuple(map(str, r)) for r in filings.month_windows(spark, "2020-01-01", "2020-03-10").collect()] == [("2020-01-01", "2020-01-31"), ("2020-02-01", "2020-02-29"), ("2020-03-01", "2020-03-10")]


def test_history(spark):
    data = [("way", 1, 2, "2016-05-01T00:00:00Z", "u2", 8, {"telecom": "data_center", "start_date": "2010"}), ("way", 1, 1, "2014-05-01T00:00:00Z", "u1", 7, {}), ("way", 2, 1, "soon", None, 1, {"start_date": "C18"})]
    got = history.summarise(spark.createDataFrame(data, "type string, id int, version int, timestamp string, user string, changeset int, tags map<string, string>"))
    assert rows(got, "source_id", "n_versions", "created_year", "datacenter_tagged_year") == [("way/1", 2, 2014, 2016), ("way/2", 1, None, None)]
    assert rows(history.start_date_validation(got), "source_id", "error_years") == [("way/1", 4)]


def test_client(tmp_path):
    calls, naps = [], []

    def opener(request, timeout):
        calls.append(request.full_url)
        if len(calls) == 1:
            raise urllib.error.HTTPError(request.full_url, 503, "busy", {}, None)
        if "missing" in request.full_url:
            raise urllib.error.HTTPError(request.full_url, 404, "no", {}, None)
        return io.BytesIO(b'{"a": 1}')

    client = http.CachedClient(tmp_path, spacing=0, opener=opener, sleep=naps.append)
    assert client.fetch_json("https://x.example/q", params={"a": 1}) == {"a": 1} and client.fetch_json("https://x.example/q", params={"a": 1}) == {"a": 1}
    assert len(calls) == 2 and naps == [2.0]
    with pytest.raises(urllib.error.HTTPError):
        client.fetch("https://x.example/missing")
    assert client.fetch_any(["https://x.example/missing", "https://y.example/"]) == b'{"a": 1}'
    with pytest.raises(RuntimeError):
        client.fetch_any(["https://x.example/missing"])


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("f1", 1.0, 2.0, "POLYGON ((0 0, 1 0, 1 1, 0 0))", 9.0), ("f2", None, 2.0, "POLYGON EMPTY", 9.0), ("f3", 1.0, 2.0, None, None)], "facility_id string, lat double, lon double, geometry_wkt string, footprint_sqft double")
    writers.write_table(df, str(tmp_path), "facilities", ["facility_id", "lat", "absent"])
    assert spark.read.parquet(f"{tmp_path}/facilities.parquet").columns == ["facility_id", "lat", "absent"] and spark.read.option("header", True).csv(f"{tmp_path}/facilities.csv").count() == 3
    points = [json.loads(r[0]) for r in writers.point_features(df, ["facility_id"]).collect()]
    assert [p["properties"]["facility_id"] for p in points] == ["f1", "f3"] and points[0]["geometry"]["coordinates"] == [2.0, 1.0]
    shapes = [json.loads(r[0]) for r in writers.footprint_features(df, ["facility_id"]).collect()]
    assert len(shapes) == 1 and shapes[0]["geometry"]["type"] == "Polygon"
    assert not writers.write_features(writers.footprint_features(df.limit(0), ["facility_id"]), str(tmp_path), "none")
    made = writers.package_description("n", "t", {"facilities": df}, [{"title": "osm"}], {"lat": "north"})
    assert made["resources"][0]["schema"]["fields"][1] == {"name": "lat", "type": "number", "description": "north"}


def test_stream(spark, tmp_path):
    from siteweave.streaming import feed

    schema = "id string, version int, delivered timestamp"
    for n, data in enumerate(([("a", 1, "2031-01-01"), ("b", 1, "2031-01-01"), ("a", 1, "2031-01-01")], [("a", 2, "2031-01-02"), ("c", 1, "2031-01-02")])):
        spark.createDataFrame(data, "id string, version int, d string").selectExpr("id", "version", "cast(d as timestamp) AS delivered").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{n}")
    stream = feed.read_feed(spark, f"{tmp_path}/in", schema, files_per_batch=1)
    once = feed.deduplicated(stream, ["id", "version"], "delivered")
    query = feed.upsert_latest(once, f"{tmp_path}/out", ["id"], "version", f"{tmp_path}/check")
    query.awaitTermination(120)
    batches = len(list((tmp_path / "check" / "commits").glob("[0-9]*")))
    assert rows(feed.latest(spark, f"{tmp_path}/out", batches), "id", "version") == [("a", 2), ("b", 1), ("c", 1)]
    assert feed.deliveries_by_window(spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in"), "delivered", ["id"]).count() == 4


def test_range_lookup_beyond_the_broadcast_bound(spark, monkeypatch):
    from siteweave.operators import lookups

    ranges = spark.createDataFrame([(1, 3, "a"), (5, 9, "b")], "low int, high int, name string")
    df = spark.createDataFrame([(i,) for i in (None, 0, 1, 3, 4, 5, 9, 10)], "x int")
    want = rows(lookups.range_lookup(df, F.col("x"), ranges, "low", "high", "name", "got"))
    assert want == sorted([(None, None), (0, None), (1, "a"), (3, "a"), (4, None), (5, "b"), (9, "b"), (10, None)], key=repr)
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 1)
    assert rows(lookups.range_lookup(df, F.col("x"), ranges, "low", "high", "name", "got")) == want
