"""A module's named queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable


class Catalogue:
    def __init__(self) -> None:
        self.queries: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None) -> Callable:
        """Registers a query under its function's name, with its SQL if it has one."""

        def add(f: Callable) -> Callable:
            self.queries[f.__name__] = f
            if sql:
                self.sql[f.__name__] = sql
            return f

        return add
