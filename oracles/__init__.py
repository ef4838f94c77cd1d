"""Independent DuckDB SQL for every registered query."""

from .compose import oracle_sql

__all__ = ["oracle_sql"]
