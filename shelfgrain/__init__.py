"""Commerce product and review processing as Spark DataFrame functions."""
