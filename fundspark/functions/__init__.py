"""Column functions: pure Catalyst expressions, no Python UDF."""
