"""The whole build by jurisdiction, on planted records with a known result."""

import json

from pyspark.sql import functions as F

from conftest import rows
from siteweave.operators import lookups
from siteweave.plans import build as plan
from siteweave.schemas import RECORD
from siteweave.sources import nei, osm

INVENTORY = "source string, source_id string, name string, lat double, lon double, n_generator_units int, n_units_total int, n_units_rated int, rated_kw_sum double"


def records(spark, *given):
    names = [f.name for f in RECORD.fields]
    base = dict(source="osm", is_building=False, raw_json="{}", source_url="u")
    return spark.createDataFrame([tuple((base | r).get(n) for n in names) for r in given], RECORD)


def test_boxes_of_ones_own(spark):
    boxes = [("AA", (0.0, 0.0, 10.0, 10.0)), ("BB", (9.0, 0.0, 12.0, 5.0)), ("AA", (50.0, 0.0, 60.0, 10.0))]
    df = spark.createDataFrame([("AA", 1.0, 1.0), ("AA", 1.0, 55.0), ("BB", 1.0, 1.0), ("BB", 1.0, 9.5), ("CC", 1.0, 1.0), (None, 1.0, 1.0), ("AA", None, 1.0), (None, 1.0, 9.5), (None, 70.0, 9.5)], "s string, lat double, lon double")
    got = df.select(lookups.in_own_boxes(F.col("s"), F.col("lat"), F.col("lon"), boxes).alias("own"), lookups.smallest_box(F.col("lat"), F.col("lon"), boxes).alias("small")).collect()
    assert [r["own"] for r in got] == [True, True, False, True, False, False, False, False, False]
    assert [r["small"] for r in got] == ["AA", "AA", "AA", "BB", "AA", "AA", None, "BB", None]


def test_mapped_sites_without_a_state_meet_records_with_one(spark):
    sv = dict(lat=37.3700, lon=-121.9200)
    given = records(
        spark,
        dict(source_id="way/1", name="Equinix SV1", operator_raw="Equinix", **sv),
        dict(source="peeringdb", source_id="1", name="Equinix SV1 San Jose", operator_raw="Equinix, Inc.", state="CA", **sv),
        dict(source_id="way/2", name="Digital Realty Dallas", operator_raw="Digital Realty", lat=32.8, lon=-96.8, state="Texas"),
        dict(source="peeringdb", source_id="2", name="Digital Realty Dallas", operator_raw="Digital Realty", lat=32.8001, lon=-96.8, postcode="75201"),
        # Said to be in one jurisdiction, found in another.
        dict(source="peeringdb", source_id="3", name="Cologix Elsewhere", operator_raw="Cologix", state="CA", lat=35.2, lon=-80.8),
        dict(source_id="way/4", name="Nowhere", operator_raw="Cologix", lat=0.5, lon=0.5),
        dict(source_id="way/5", name="Honolulu Data Center", operator_raw="Cologix", lat=21.3, lon=-157.85),
    )
    built = plan.build(given, spark.createDataFrame([], INVENTORY))
    got = {(r["state"], r["source_list"]): (r["name"], r["n_sources"]) for r in built.facilities.collect()}
    assert got == {("CA", "osm,peeringdb"): ("Equinix SV1 San Jose", 2), ("TX", "osm,peeringdb"): ("Digital Realty Dallas", 2), ("HI", "osm"): ("Honolulu Data Center", 1)}
    assert rows(built.excluded, "source_id", "exclusion_rule") == [("3", "outside_state"), ("way/4", "outside_state")]
    # No facility is missing from the summary.
    assert rows(built.summary, "state", "facilities", "multi_source") == [("CA", 1, 1), ("HI", 1, 0), ("TX", 1, 1)]


def test_latest_snapshot_of_each_jurisdiction(spark, tmp_path):
    element = lambda i: dict(type="node", id=i, lat=40.0, lon=-83.0, tags={"name": f"n{i}", "telecom": "data_center"})
    for state, day, i in (("OH", "2031-01-01", 1), ("OH", "2031-01-03", 2), ("CA", "2031-01-02", 3)):
        folder = tmp_path / "osm" / state / day
        folder.mkdir(parents=True)
        (folder / "o.json").write_text(json.dumps({"elements": [element(i)]}))
        folder = tmp_path / "nei" / state / day
        folder.mkdir(parents=True)
        (folder / "u.csv").write_text(",".join(nei.COLUMNS) + "\n" + ",".join([str(i), "Co", "Site", "518210", "40", "-83", *[""] * 8]) + "\n")
    elements = osm.latest_snapshot(osm.read_snapshots(spark, f"{tmp_path}/osm"), within="file_state")
    assert rows(osm.to_records(elements), "source_id", "state") == [("node/2", "OH"), ("node/3", "CA")]
    units = osm.latest_snapshot(nei.read_extracts(spark, f"{tmp_path}/nei"), within="state")
    assert rows(units, "eis_facility_id", "state") == [("2", "OH"), ("3", "CA")]


def test_fetch_writes_what_the_build_reads(spark, tmp_path):
    import io

    from siteweave.sources import fetch, peeringdb
    from siteweave.sources.http import CachedClient

    asked = []

    def opener(request, timeout):
        asked.append(request.full_url)
        if "overpass-api.de" in request.full_url:
            raise OSError("down")
        page = {"data": [dict(id=1, name="A", status="ok", latitude=40.0, longitude=-83.0, country="US")]}
        elements = {"elements": [dict(type="node", id=9, lat=40.0, lon=-83.0, tags={"telecom": "data_center"})]}
        return io.BytesIO(json.dumps(page if "peeringdb" in request.full_url else elements).encode())

    client = CachedClient(tmp_path / "cache", attempts=1, opener=opener, sleep=lambda s: None)
    fetch.fetch_elements(client, tmp_path / "raw", ["oh"], "2031-01-01")
    fetch.fetch_registry(client, tmp_path / "raw", "2031-01-01")
    n = len(asked)
    fetch.fetch_elements(client, tmp_path / "raw", ["OH"], "2031-01-01")
    assert len(asked) == n == 3
    assert rows(osm.to_records(osm.read_snapshots(spark, f"{tmp_path}/raw/osm")), "source_id", "state") == [("node/9", "OH")]
    assert rows(peeringdb.to_records(peeringdb.read_snapshots(spark, f"{tmp_path}/raw/peeringdb")), "source_id") == [("1",)]


def test_national_figures_and_map(spark, tmp_path, monkeypatch):
    from siteweave import cli
    from siteweave.schemas import FACILITY_COLUMNS, POWER_COLUMNS
    from test_whole_jobs import ESTIMATE, FACILITY, put_table

    monkeypatch.setattr(cli, "build_session", lambda **_: spark)
    put_table(spark, f"{tmp_path}/facilities.parquet", ["state", *FACILITY_COLUMNS], FACILITY | dict(state="CA", est_annual_gwh=15000.0, source_list="osm,peeringdb"))
    put_table(spark, f"{tmp_path}/power_estimates.parquet", POWER_COLUMNS, ESTIMATE)
    for verb in ("national", "charts", "map"):
        assert cli.main([verb, str(tmp_path)]) == 0
    got = spark.read.json(f"{tmp_path}/national/reconciliation.json").first()
    assert (got["bottom_up_annual_twh"], got["within_anchor_range"], got["top_down_anchor_twh"]) == (15.0, True, 18.0)
    described = json.loads("\n".join(r[0] for r in spark.read.text(f"{tmp_path}/national/datapackage.json").collect()))
    assert described["sources"] == [{"title": "peeringdb"}, {"title": "osm"}]
    assert {f["name"]: f.get("description") for f in described["resources"][0]["schema"]["fields"]}["facilities"]
    assert spark.read.parquet(f"{tmp_path}/figures/map_points.parquet").count() == 1 and spark.read.parquet(f"{tmp_path}/figures/completeness.parquet").count() == 10


def test_aliases_come_from_the_file_where_there_is_one(spark, tmp_path):
    from siteweave import dims

    (tmp_path / "reference").mkdir()
    (tmp_path / "reference" / "operator_aliases.csv").write_text("# note\ncanonical,alias\nOne Body,Shared Name\nOther Body,Shared Name\nOther Body,Equinix\n")
    listed = plan.read_evidence(spark, str(tmp_path))["aliases"]
    names = spark.createDataFrame([("shared name inc",), ("Equinix",), ("other body",), ("Digital Realty",)], "raw string")
    own = lookups.resolve_operators(names, "raw", dims.operator_aliases(spark, listed), dims.unattributed(spark))
    assert rows(own, "raw", "operator", "operator_confidence") == [("Digital Realty", "Digital Realty", "unresolved"), ("Equinix", "Other Body", "alias"), ("other body", "Other Body", "alias"), ("shared name inc", "One Body", "alias")]
    fixed = lookups.resolve_operators(names, "raw", dims.operator_aliases(spark), dims.unattributed(spark))
    assert {r["raw"]: r["operator_confidence"] for r in fixed.collect()}["Digital Realty"] == "alias"
