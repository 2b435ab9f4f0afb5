"""Column expressions: each takes and returns a ``Column``; all stay in the JVM."""
