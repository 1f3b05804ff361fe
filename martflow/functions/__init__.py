"""Column functions: each takes and returns a Column, so all of them stay in the JVM."""
