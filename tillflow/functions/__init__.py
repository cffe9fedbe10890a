"""Column functions; every one is built from stock Spark expressions."""
