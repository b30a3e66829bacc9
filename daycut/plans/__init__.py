"""Reports, load/landing jobs, SQL views, and the registered queries with
their oracles."""
