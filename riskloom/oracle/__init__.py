"""Independent DuckDB SQL for every registered query (the correctness oracle)."""

from riskloom.oracle.reports_sql import SQL  # noqa: F401
