"""Column expressions: everything here maps columns to a column, inside the JVM."""
