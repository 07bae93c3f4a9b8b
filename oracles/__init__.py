"""DuckDB texts that state, independently of Spark, what each query must return."""
