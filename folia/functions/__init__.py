"""Column expressions: text, boxes and digests; all run inside the JVM."""
