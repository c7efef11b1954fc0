"""DuckDB twins of the registered queries, used only for checking."""
