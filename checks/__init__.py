"""Registered queries over derived tables, with the SQL to compare them with."""

from __future__ import annotations


def all_queries():
    from checks import (  # noqa: F401
        etl_queries,
        master_queries,
        operation_queries,
        quality_queries,
    )

    from checks.registry import QUERIES

    return QUERIES
