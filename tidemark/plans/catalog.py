"""All registered queries over the reference's own operators, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import blocks, changes, digests, html, lookups, paged, records, reports, runs, scalars, scans, states, trees, validation, variants  # noqa: F401  they enter their queries
from .registry import ORACLE, QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
