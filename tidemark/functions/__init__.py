"""Column-level functions; all run inside the JVM."""
