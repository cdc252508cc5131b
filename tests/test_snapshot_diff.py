"""Snapshot comparison against a row-by-row version in plain Python."""

import random
from datetime import date, datetime

from pyspark.sql import functions as F

from conftest import rows
from siteweave.operators.snapshot_diff import canonical_rows, snapshot_changes

SCHEMA = "d DATE, key STRING, version INT, name STRING, lat DOUBLE, lon DOUBLE, tags MAP<STRING, STRING>, list ARRAY<STRING>, ring ARRAY<STRUCT<lat: DOUBLE, lon: DOUBLE>>, `row` STRING"
D1, D2, D3 = date(2031, 1, 1), date(2031, 2, 1), date(2031, 3, 1)
RING = [(1.0, 2.0), (1.0, 3.0), (2.0, 3.0)]


def made(spark, data):
    df = spark.createDataFrame([(*r, "extra") for r in data], SCHEMA)
    return canonical_rows(df, "s", F.col("key"), "d", F.col("version"), F.lit(None).cast("timestamp"), ("key", "version", "row"), ("lat", "lon"))


def base(d, key, version=1, name="a", lat=1.0, lon=2.0, tags=None, items=None, ring=None):
    return (d, key, version, name, lat, lon, tags, items, ring)


CASES = [
    (dict(name="a"), dict(name="b"), True),
    (dict(name=" a "), dict(name="a"), False),
    (dict(name=None), dict(name="  "), False),
    (dict(lat=1.0), dict(lat=1.0000004), False),
    (dict(lat=1.0), dict(lat=1.000001), True),
    (dict(lat=None), dict(lat=float("nan")), False),
    (dict(lat=None), dict(lat=0.0), True),
    (dict(tags={"x": "1", "y": ""}), dict(tags={"x": " 1"}), False),
    (dict(tags={"x": "1"}), dict(tags={"x": "2"}), True),
    (dict(items=["b", "a"]), dict(items=["a", "b"]), False),
    (dict(items=None), dict(items=[]), False),
    (dict(items=["a"]), dict(items=["a", "a"]), True),
    (dict(ring=RING), dict(ring=RING[::-1]), False),
    (dict(ring=RING), dict(ring=[(1.0, 2.0), (1.0, 3.0), (2.0, 3.1)]), True),
    (dict(ring=RING), dict(ring=None), True),
]


def test_what_counts_as_changed(spark):
    data = [base(d, f"k{n}", **case[side]) for n, case in enumerate(CASES) for side, d in enumerate((D1, D2))]
    got = rows(snapshot_changes(made(spark, data)), "key", "change")
    assert got == sorted((f"k{n}", "changed") for n, (_, _, changed) in enumerate(CASES) if changed)


def test_versions_repeats_and_returns(spark):
    data = [base(D1, "k", 1, "old"), base(D1, "k", 2, "new"), base(D1, "k", 2, "new"), base(D2, "k", 1, "new"), base(D1, "gone"), base(D3, "gone"), base(D2, "late"), base(D3, "k", 5, "new"), base(D3, "late"), base(D2, None), (None, "k", 1, "x", 1.0, 1.0, None, None, None)]
    got = rows(snapshot_changes(made(spark, data)), "key", "snap", "change")
    assert got == sorted([("gone", D2, "removed"), ("gone", D3, "added"), ("late", D2, "added")], key=repr)


def test_empty_and_single(spark):
    assert rows(snapshot_changes(made(spark, []))) == []
    assert rows(snapshot_changes(made(spark, [base(D1, "a"), base(D1, "b")]))) == []


def test_against_brute_force_at_every_tree_height(spark):
    rng = random.Random(7)
    state = {f"k{i}": rng.randrange(4) for i in range(150)}
    data, want, dates = [], set(), (D1, D2, D3)
    previous = None
    for d in dates:
        data += [base(d, k, name=str(v)) for k, v in state.items()]
        if previous is not None:
            want |= {(k, d, "added") for k in state.keys() - previous.keys()} | {(k, d, "removed") for k in previous.keys() - state.keys()} | {(k, d, "changed") for k in state.keys() & previous.keys() if state[k] != previous[k]}
        previous = dict(state)
        for k in rng.sample(sorted(state), 12):
            state[k] = rng.randrange(4)
        for k in rng.sample(sorted(state), 5):
            del state[k]
        state[f"n{d}"] = 1
    for bits in (1, 6, 8):
        got = {tuple(r) for r in snapshot_changes(made(spark, data), leaf_bits=bits).select("key", "snap", "change").collect()}
        assert got == want


def test_mixed_times(spark):
    from siteweave.functions.keys import any_timestamp

    df = spark.createDataFrame([("2030-01-01T01:44:39Z",), ("2030-01-01T02:44:39+01:00",), ("2030-01-01 01:44:39",), ("1893462279",), ("soon",), (None,)], "t string")
    got = [r[0] for r in df.select(any_timestamp(F.col("t"))).collect()]
    assert got[:4] == [datetime(2030, 1, 1, 1, 44, 39)] * 4 and got[4:] == [None, None]
