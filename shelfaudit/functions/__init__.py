"""Column-level helpers (JVM built-ins only, no Python UDFs)."""
