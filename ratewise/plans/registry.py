"""Registry of named queries: a Spark callable ``(spark, sf_dir) -> DataFrame`` and, where SQL
can state the result, the DuckDB text that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from ..sources.fixtures import reviews_sql

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def oracle(sql: str, text: bool = False) -> str:
    """Prefix ``sql`` with the reviews CTE. ``sql`` may start with its own ``WITH``."""
    body = sql.strip()
    head = f"WITH reviews AS ({reviews_sql(text)})"
    if body[:4].upper() == "WITH":
        out = f"{head},\n{body[4:].lstrip()}"
    else:
        out = f"{head}\n{body}"
    # DuckDB 2.0 fails on some materialised CTEs over dictionary-encoded strings; inline them.
    return _CTE.sub(r"\1 AS NOT MATERIALIZED (", out)


_CTE = re.compile(r"\b(\w+) AS \((?=\s*SELECT\b)", re.IGNORECASE)


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register
