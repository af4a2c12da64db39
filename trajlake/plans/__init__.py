"""Bindings: derived inputs from the driver tables, registered queries, DuckDB twins, batch report job."""
