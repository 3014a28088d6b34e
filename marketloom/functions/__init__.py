"""Column -> Column functions; all built-in expressions, no Python UDFs."""
