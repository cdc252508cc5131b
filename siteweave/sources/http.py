"""A cached client for the public interfaces: one request a second, retries with backoff, mirrors. Off the data path; nothing here runs on executors."""

from __future__ import annotations

import hashlib
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Sequence
from pathlib import Path


class CachedClient:
    """Responses by a digest of the request below ``folder``; ``opener`` and ``sleep`` can be replaced in tests."""

    def __init__(self, folder: str | Path, spacing: float = 1.0, attempts: int = 4, timeout: float = 180.0, opener: Callable | None = None, sleep: Callable[[float], None] = time.sleep) -> None:
        self.folder, self.spacing, self.attempts, self.timeout = Path(folder), spacing, attempts, timeout
        self.open, self.sleep = opener or urllib.request.urlopen, sleep
        self.last = float("-inf")

    def fetch(self, url: str, params: dict | None = None, data: dict | None = None, refresh: bool = False) -> bytes:
        """The body, from the cache or the network; server errors and 429 are retried, other errors are raised."""
        full = url + ("?" + urllib.parse.urlencode(params) if params else "")
        body = urllib.parse.urlencode(data).encode() if data else None
        name = hashlib.sha256(full.encode() + b"\0" + (body or b"")).hexdigest()
        stored = self.folder / name[:2] / name
        if stored.exists() and not refresh:
            return stored.read_bytes()
        content = self._request(full, body)
        stored.parent.mkdir(parents=True, exist_ok=True)
        part = stored.with_suffix(".part")
        part.write_bytes(content)
        part.replace(stored)
        return content

    def fetch_json(self, url: str, **kwargs):
        return json.loads(self.fetch(url, **kwargs))

    def fetch_any(self, urls: Sequence[str], **kwargs) -> bytes:
        """The first mirror that answers; RuntimeError with all errors if none does."""
        errors = []
        for url in urls:
            try:
                return self.fetch(url, **kwargs)
            except (OSError, RuntimeError) as error:
                errors.append(f"{url}: {error}")
        raise RuntimeError("; ".join(errors))

    def _request(self, url: str, body: bytes | None) -> bytes:
        wait, got = 2.0, b""
        for attempt in range(1, self.attempts + 1):
            pause = self.last + self.spacing - time.monotonic()
            if pause > 0:
                self.sleep(pause)
            self.last = time.monotonic()
            headers = {"Range": f"bytes={len(got)}-"} if got else {}
            try:
                with self.open(urllib.request.Request(url, data=body, headers=headers), timeout=self.timeout) as answer:
                    if got and getattr(answer, "status", 200) != 206:
                        got = b""
                    while chunk := answer.read(1 << 20):
                        got += chunk
                    return got
            except urllib.error.HTTPError as error:
                if error.code != 429 and error.code < 500 or attempt == self.attempts:
                    raise
                after = (error.headers or {}).get("Retry-After", "")
                delay = min(120.0, float(after)) if after.isdigit() else wait
            except OSError:
                if attempt == self.attempts:
                    raise
                delay = wait
            self.sleep(delay)
            wait = min(45.0, wait * 2)
        raise RuntimeError(f"no answer from {url}")
