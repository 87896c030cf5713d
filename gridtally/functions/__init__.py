"""Column expressions. All are Spark built-ins, so no row leaves the JVM."""
