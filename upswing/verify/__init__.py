"""Independent SQL (DuckDB dialect) for checking the Spark results."""
