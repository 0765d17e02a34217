"""Column expressions and category rule sets (native Spark expressions only)."""
