"""Column functions; each one is a plain Spark expression unless it says otherwise."""
