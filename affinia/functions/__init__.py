"""Column expressions. All are JVM built-ins; none is a Python UDF."""
