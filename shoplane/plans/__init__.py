"""Pipeline entry points and the cross-engine (DuckDB) reference SQL."""
