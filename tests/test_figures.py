"""Figures on degenerate tables, and every query against its SQL."""

import glob
import math
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siteweave.plans import figures
from siteweave.schemas import FACILITY_COLUMNS

SCHEMA = ", ".join(
    f"{c} {'double' if c in ('lat', 'lon', 'footprint_sqft', 'best_power_mw', 'power_ci_low_mw', 'power_ci_high_mw', 'est_annual_gwh', 'pdb_net_count') else 'boolean' if c == 'partial_occupancy' else 'int' if c in ('n_sources', 'year_built', 'n_power_methods') else 'string'}"
    for c in FACILITY_COLUMNS
)


def facilities(spark, n, **known):
    base = dict(facility_id="f", name="N", lat=1.0, lon=2.0, n_sources=1, source_list="osm", facility_class="unknown")
    return spark.createDataFrame([tuple((base | known | {"facility_id": f"f{i}"}).get(c) for c in FACILITY_COLUMNS) for i in range(n)], SCHEMA)


ESTIMATES = "facility_id string, method string, it_load_mw double"
POWER = dict(best_power_mw=2.0, power_ci_low_mw=1.0, power_ci_high_mw=3.0, power_tier="C_area", est_annual_gwh=17.5)


@pytest.mark.parametrize(
    ("n", "known", "want"),
    [
        (0, {}, set()),
        (2, {}, {"evidence_composition", "completeness", "map_points"}),
        (2, POWER, {"evidence_composition", "completeness", "map_points", "top_operators", "rank_size"}),
        (2, {"utility": "PGE"}, {"evidence_composition", "completeness", "map_points", "load_by_utility"}),
    ],
)
def test_which_figures(spark, n, known, want):
    got = figures.all_figures(facilities(spark, n, **known), spark.createDataFrame([], ESTIMATES))
    assert set(got) == want
    for df in got.values():
        df.collect()


def test_operator_label_and_points(spark):
    got = figures.all_figures(facilities(spark, 1, **POWER), spark.createDataFrame([], ESTIMATES))
    assert got["top_operators"].first()["operator"] == "Operator not established"
    point = got["map_points"].first()
    assert point["size"] == figures.MARKER_MAX and "2.0 MW (1.0 to 3.0)" in point["label"] and point["layer"] == "C_area"
    bare = figures.map_points(facilities(spark, 1)).first()
    assert bare["size"] == figures.MARKER_MIN and "no estimate" in bare["label"]


def test_timeline(spark):
    history = spark.createDataFrame([("way/1", "a", "2010", 2014, 2016, 3), ("way/2", "b", "1999", 2015, None, 1), ("way/3", "c", None, 2016, None, 1)], "source_id string, name string, start_date_tag string, created_year int, datacenter_tagged_year int, n_versions int")
    got = figures.all_figures(facilities(spark, 1), spark.createDataFrame([], ESTIMATES), history)
    assert {"start_date_validation", "timeline", "timeline_error"} <= set(got)
    assert got["timeline_error"].first()["worst"] == "way/2" and got["timeline"].count() == 3


DATA = "/root/testdata/sf0.001"


def _norm(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return None
    if isinstance(x, bool) or not isinstance(x, (int, float)):
        return str(x)
    return round(float(x), 6)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")
def test_queries_against_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__

    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries)
    wrong = []
    for name, text in sql.items():
        df = queries[name](spark, DATA)
        columns = sorted(df.columns)
        got = Counter(tuple(_norm(x) for x in r) for r in df.select(*[F.col(c).cast("timestamp_ntz") if t == "timestamp" else F.col(c) for c, t in ((c, dict(df.dtypes)[c]) for c in columns)]).collect())
        relation = con.sql(text)
        assert sorted(relation.columns) == columns, name
        order = [relation.columns.index(c) for c in columns]
        want = Counter(tuple(_norm(r[k]) for k in order) for r in relation.fetchall())
        if got != want:
            wrong.append((name, list((got - want))[:2], list((want - got))[:2]))
    assert not wrong
