"""Column expressions and small DataFrame building blocks; nothing here leaves the JVM."""
