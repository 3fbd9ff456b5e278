"""Column builders; nothing here leaves the JVM."""
