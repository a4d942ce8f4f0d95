"""A module's queries and their SQL, filled by a decorator."""

from __future__ import annotations

from collections.abc import Callable


class Plans:
    def __init__(self):
        self.queries: dict[str, Callable] = {}
        self.oracles: dict[str, str] = {}

    def __call__(self, sql: str | None = None) -> Callable:
        """Register the function below under its own name, with the DuckDB SQL that must agree with it."""

        def add(f: Callable) -> Callable:
            self.queries[f.__name__] = f
            if sql:
                self.oracles[f.__name__] = sql
            return f

        return add
