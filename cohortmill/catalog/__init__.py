"""The operators bound to the shared test tables, as named queries with SQL to check them."""

from .oracle import oracle_sql
from .queries import QUERIES

__all__ = ["QUERIES", "oracle_sql"]
