"""Column functions, all built from Spark expressions."""
