"""Analytics operators written as plain Spark DataFrame jobs."""
