"""Named queries over the given tables, with their SQL counterparts."""

from .registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
