import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from siteweave.session import build_session

    session = build_session("tests", "local[4]", shuffle_partitions=4, spark__driver__memory="3g", spark__ui__showConsoleProgress="false", spark__sql__adaptive__coalescePartitions__initialPartitionNum="4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)
