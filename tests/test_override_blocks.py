"""Overrides beyond the bound of a broadcast."""

from conftest import rows
from siteweave.operators import evidence


def test_by_phrase_beyond_the_broadcast_bound(spark, monkeypatch):
    facilities = spark.createDataFrame([("f1", "Silicon Valley", "Equinix"), ("f2", "Vantage Valley", None)], "facility_id string, name string, operator string")
    overrides = spark.createDataFrame([("VALLEY", "equinix", 1), ("valley", None, 2), ("silicon", None, 3), ("none", None, 4), ("vantage", None, 5)], "name_contains string, operator_contains string, n int")
    want = [("f1", 1), ("f1", 2), ("f1", 3), ("f2", 2), ("f2", 5)]
    monkeypatch.setattr(evidence, "BROADCAST_ROWS", 2)
    assert rows(evidence.by_phrase(facilities, overrides), "facility_id", "n") == want
