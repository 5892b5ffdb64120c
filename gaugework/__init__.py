"""Fleet, retail and tax analytics as plain Spark DataFrame jobs."""
