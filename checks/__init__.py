"""Views over the test tables and their DuckDB counterparts, for the driver's checks."""
