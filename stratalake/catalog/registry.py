"""Registration of queries next to the SQL they must equal."""

from __future__ import annotations

from collections.abc import Callable


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable] = {}
        self.oracle: dict[str, str] = {}

    def query(self, sql: str | None = None) -> Callable:
        """Decorator; the function's name is the query's name."""

        def add(fn: Callable) -> Callable:
            self.queries[fn.__name__] = fn
            if sql is not None:
                self.oracle[fn.__name__] = sql
            return fn

        return add
