"""Registered queries of the support-operations library and their SQL."""

from __future__ import annotations

from .plans import oracles
from .plans import queries as plans


def queries() -> dict:
    return plans.queries()


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
