"""Column helpers. Each takes and returns Spark columns, so everything stays in the JVM."""
