"""DuckDB statements the Spark results are compared with."""
