"""Snapshots of the public interfaces into the raw folders that the build reads. Runs on the driver, off the data path."""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path

from siteweave.sources.http import CachedClient
from siteweave.sources.osm import MIRRORS, query_text

REGISTRY_URL = "https://www.peeringdb.com/api/fac"
# Fixed value: facilities that one request returns at most.
PAGE = 5_000


def fetch_elements(client: CachedClient, raw: str | Path, states: Sequence[str], day: str) -> list[Path]:
    """One file of mapped elements for each jurisdiction, from the first mirror that answers; what is stored already is kept."""
    out = []
    for state in states:
        path = Path(raw) / "osm" / state.upper() / day / "elements.json"
        if not path.exists():
            content = client.fetch_any(MIRRORS, data={"data": query_text(state)})
            json.loads(content)
            _store(path, content)
        out.append(path)
    return out


def fetch_registry(client: CachedClient, raw: str | Path, day: str, country: str = "US") -> Path:
    """All facilities of a country, page by page, as one array."""
    path = Path(raw) / "peeringdb" / country / day / "facilities.json"
    if not path.exists():
        rows: list[dict] = []
        while True:
            page = client.fetch_json(REGISTRY_URL, params={"country": country, "limit": PAGE, "skip": len(rows)})["data"]
            rows += page
            if len(page) < PAGE:
                break
        _store(path, json.dumps(rows).encode())
    return path


def _store(path: Path, content: bytes) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_suffix(".part")
    part.write_bytes(content)
    part.replace(path)
