"""Registered queries, their DuckDB counterparts, and the pipeline."""
