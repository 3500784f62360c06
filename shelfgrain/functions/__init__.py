"""Column expressions. All are native Spark expressions except the HTML and JSON tree readers."""
