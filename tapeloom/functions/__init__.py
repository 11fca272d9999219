"""Column expressions: pure functions from Columns to Columns, all of them run inside the JVM."""
