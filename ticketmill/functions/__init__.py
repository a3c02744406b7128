"""Column expressions. All are built-in Spark functions, so plans stay in the JVM."""
