"""All registered queries: a Spark callable and, where SQL can say it, a check."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


class Query(NamedTuple):
    run: QueryFn
    check: str | None = None


def registry() -> dict[str, Query]:
    from chirrup.plans import activity, collection, corpus, events, learning

    out: dict[str, Query] = {}
    for module in (activity, collection, events, corpus, learning):
        for name, query in module.QUERIES.items():
            if name in out:
                raise ValueError(f"query registered twice: {name}")
            out[name] = query
    return out
