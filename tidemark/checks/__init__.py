from tidemark.checks.oracle import oracle_sql
from tidemark.checks.queries import queries

__all__ = ["oracle_sql", "queries"]
