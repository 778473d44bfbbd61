"""The queries that are checked against a second engine, on the shared test tables."""
