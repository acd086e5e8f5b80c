"""How plan modules register a query with its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from lexledger.plans.adapters import Views, duck


def registrar() -> tuple[dict, dict[str, str], Callable, dict[str, str]]:
    """(queries, oracles, decorator, the oracles with views in braces). The decorated function gets the Views of the
    input folder."""
    queries, oracles, sources = {}, {}, {}

    def query(sql: str | None = None):
        def add(f: Callable[[Views], DataFrame]):
            queries[f.__name__] = lambda spark, sf_dir: f(Views(spark, sf_dir))
            if sql:
                oracles[f.__name__], sources[f.__name__] = duck(sql), sql
            return f

        return add

    return queries, oracles, query, sources
