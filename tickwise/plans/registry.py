"""Single place that lists the registered queries and their oracles."""

from __future__ import annotations

from tickwise.plans.catalog import QUERIES
from tickwise.plans.oracle import ORACLE_SQL
from tickwise.plans.stream_catalog import STREAM_ORACLES, STREAM_QUERIES


def all_queries() -> dict:
    return {**QUERIES, **STREAM_QUERIES}


def all_oracles() -> dict:
    return {**ORACLE_SQL, **STREAM_ORACLES}
