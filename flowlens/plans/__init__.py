"""Query catalog over the driver tables, DuckDB oracle SQL, plan checks."""
