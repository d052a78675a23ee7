"""Column functions: every one returns a native Spark expression."""
