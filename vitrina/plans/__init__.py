"""Query plans: test feeds, the registered query catalog, the DuckDB oracle, jobs."""
