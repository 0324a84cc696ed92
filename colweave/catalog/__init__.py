"""The registered queries and their SQL twins."""

from colweave.catalog.oracle import oracle_sql
from colweave.catalog.registry import queries

__all__ = ["oracle_sql", "queries"]
