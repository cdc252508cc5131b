"""Queries and verbs over the whole of their input."""

import gzip
import json
import random

import pytest

from conftest import rows
from siteweave import cli
from siteweave.operators import evidence
from siteweave.schemas import FACILITY_COLUMNS, POWER_COLUMNS
from siteweave.sources import nei


@pytest.mark.parametrize("bound", (8, 2))
def test_by_title_against_brute_force(spark, monkeypatch, bound):
    monkeypatch.setattr(evidence, "SUBSET_WORDS", bound)
    rng = random.Random(5)
    vocabulary = [f"word{c}" for c in "abcdefghij"]
    names = {f"f{i:02}": rng.sample(vocabulary, rng.randint(0, 4)) for i in range(40)}
    titles = {i: rng.sample(vocabulary, rng.randint(0, 7)) for i in range(60)}
    want = []
    for i, words in titles.items():
        best = min((-len(set(words) & set(held)), f) for f, held in names.items())
        if best[0]:
            want.append((i, best[1], -best[0]))
    facilities = spark.createDataFrame([(f, "the " + " - ".join(w).upper()) for f, w in names.items()], "facility_id string, name string")
    filings = spark.createDataFrame([(i, ", ".join(w + w[:1])) for i, w in titles.items()], "filing_id int, title string")
    assert rows(evidence.by_title(facilities, filings)) == sorted(want, key=repr)


def test_text_overlap_takes_texts_of_any_length(spark, tmp_path):
    import __spark_entry__

    spark.createDataFrame([("f1", "Silicon Valley")], "facility_id string, name string").write.parquet(f"{tmp_path}/facilities.parquet")
    spark.createDataFrame([(1, "x " * 500 + "in Silicon Valley"), (2, "Valley"), (3, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert rows(__spark_entry__.queries()["text_overlap"](spark, str(tmp_path))) == [(1, "f1", 2), (2, "f1", 1)]


def test_build_reads_territories_overrides_and_filings(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cli, "build_session", lambda **_: spark)
    raw = tmp_path / "raw"

    def put(name, text):
        (raw / name).parent.mkdir(parents=True, exist_ok=True)
        (raw / name).write_bytes(gzip.compress(text.encode()) if name.endswith("gz") else text.encode())

    node = lambda i, lat, lon, name, **tags: dict(type="node", id=i, lat=lat, lon=lon, tags={"name": name, "telecom": "data_center", "operator": "Equinix", **tags})
    put("osm/CA/2031-01-01/o.json", json.dumps({"elements": [node(1, 37.4, -121.95, "Silicon Valley Data Center"), node(2, 34.0, -118.2, "Vantage Harbor Data Center")]}))
    put("osm/TX/2031-01-01/o.json", json.dumps({"elements": [node(3, 32.8, -96.8, "Silicon Harbor Valley Expansion Data Center", **{"addr:state": "TX"})]}))
    put("peeringdb/US/2031-01-01/f.json", "[]")
    put("epa_nei/CA/2031-01-01/u.csv", ",".join(nei.COLUMNS) + "\n")
    ring = [[-123, 36], [-90, 36], [-90, 38], [-123, 38], [-123, 36]]
    layer = {"features": [{"properties": {"Acronym": "PGE", "Utility": "Big", "Type": "IOU"}, "geometry": {"type": "Polygon", "coordinates": [ring]}}]}
    put("cec_gis/2031-01-01/t.geojson.gz", json.dumps(layer))
    put("reference/manual_overrides.csv", "# note\nmatch_name,match_operator,basis,value_mw,source_url,retrieved_at,quote\nharbor,,it_load,30,https://x/1,2031-01-01,q\nharbor,,it_load,40,https://x/2,2031-01-01,q\nharbor,,it_load,50,,,\n")
    put("ceqanet/2031-01-01/search/s.json", json.dumps(dict(development_type="Office", window_start="2031-01-01", html="<table><tr></tr><tr><td>77</td><td>EIR</td><td>City</td><td>x</td><td>Silicon Valley Data Center Expansion</td></tr></table>")))
    put("ceqanet/2031-01-01/detail/d.json", json.dumps(dict(sch_number="77", source_url="https://y/77", html="<p>critical load of 50 MW</p>")))
    out = str(tmp_path / "out")
    assert cli.main(["build", out, "--raw", str(raw)]) == 0
    got = {r["name"].split()[0] + (r["state"] or ""): r for r in spark.read.parquet(f"{out}/facilities.parquet").collect()}
    assert {k: (r["utility"], r["power_tier"]) for k, r in got.items()} == {"SiliconCA": ("PGE", "A_attested"), "VantageCA": (None, "A_attested"), "SiliconTX": (None, "A_attested")}
    assert got["VantageCA"]["best_power_mw"] == got["SiliconTX"]["best_power_mw"] == 30.0
    cited = spark.read.parquet(f"{out}/power_estimates.parquet")
    assert sorted(map(tuple, cited.select("stated_value_mw", "basis", "source_url", "retrieved_at").collect())) == [(30.0, "it_load", "https://x/1", "2031-01-01")] * 2 + [(40.0, "it_load", "https://x/2", "2031-01-01")] * 2 + [(50.0, "critical_load", "https://y/77", "2031-01-01")]


FACILITY = dict(facility_id="f", name="N", lat=37.4, lon=-121.95, best_power_mw=2.0, power_ci_low_mw=1.0, power_ci_high_mw=3.0, power_tier="C_area", n_sources=1)
ESTIMATE = dict(facility_id="f", method="C_area", basis="modelled", it_load_mw=2.0, ci_low_mw=1.0, ci_high_mw=3.0, assumptions_json="{}")


def put_table(spark, path, columns, row):
    kinds = {"lat": "double", "lon": "double", "n_sources": "int", "partial_occupancy": "boolean"}
    kind = lambda c: kinds.get(c, "double" if c.endswith(("_mw", "_gwh", "_sqft", "_reported")) else "string")
    spark.createDataFrame([tuple(row.get(c) for c in columns)], ", ".join(f"{c} {kind(c)}" for c in columns)).write.mode("overwrite").parquet(path)


def test_validate_reads_both_tables_and_all_rules(spark, tmp_path, monkeypatch):
    import __spark_entry__

    monkeypatch.setattr(cli, "build_session", lambda **_: spark)
    outcome = []
    for facility, estimate in (({}, {}), ({}, {"method": "guess"}), ({}, {"basis": None}), ({}, {"ci_low_mw": 9.0}), ({"name": None}, {})):
        put_table(spark, f"{tmp_path}/facilities.parquet", FACILITY_COLUMNS, FACILITY | facility)
        put_table(spark, f"{tmp_path}/power_estimates.parquet", POWER_COLUMNS, ESTIMATE | estimate)
        outcome.append(cli.main(["validate", str(tmp_path)]))
    assert outcome == [0, 1, 1, 1, 1]
    put_table(spark, f"{tmp_path}/facilities.parquet", FACILITY_COLUMNS, FACILITY | dict(facility_id=None, name=None, lat=91.0, lon=-181.0, power_tier="x", power_ci_low_mw=9.0))
    got = dict(rows(__spark_entry__.queries()["facility_violations"](spark, str(tmp_path))))
    assert {r for r, n in got.items() if n} == {"facility_id_present", "name_present", "lat_range", "lon_range", "inside_a_jurisdiction", "tier_known", "interval_ordered"}
