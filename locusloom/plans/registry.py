"""Registry of queries: name, function over ``Inputs``, and oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from .fixtures import Inputs, with_views

Query = Callable[[Inputs], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name. Views in braces in ``oracle`` become CTEs."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = with_views(oracle)
        return function

    return register
