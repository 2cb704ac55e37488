"""All queries and their DuckDB SQL."""

from __future__ import annotations

from . import further_oracle, further_queries, more_oracle, more_queries, oracle  # noqa: F401  (the modules of queries register them)
from .queries import QUERIES

SQL: dict[str, str] = {**oracle.SQL, **more_oracle.SQL, **further_oracle.SQL}

__all__ = ["QUERIES", "SQL"]
