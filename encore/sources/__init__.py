"""Sources and sinks: Parquet scans (inferred or declared schema), sinks, views."""

from encore.sources.tables import (head_rows, profile, read_table, register, run_sql,
                                   union_all, union_distinct, write_table)

__all__ = ["head_rows", "profile", "read_table", "register", "run_sql", "union_all",
           "union_distinct", "write_table"]
