"""Registration of a query with its oracle."""

from __future__ import annotations

from collections.abc import Callable


class Registry:
    def __init__(self):
        self.queries: dict[str, Callable] = {}
        self.oracles: dict[str, str] = {}

    def query(self, oracle: str | None = None):
        """Registers a function (spark, sf_dir) under its name, and the DuckDB SQL that gives the same rows."""

        def register(function):
            self.queries[function.__name__] = function
            if oracle:
                self.oracles[function.__name__] = oracle
            return function

        return register
