"""Column-level functions; all of them are native Spark expressions."""
