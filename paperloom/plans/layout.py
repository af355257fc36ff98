"""The layout queries and their SQL."""

from .oracles import oracle_sql
from .queries import queries

__all__ = ["oracle_sql", "queries"]
