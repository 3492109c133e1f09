"""Column functions: each returns an expression that stays inside the JVM."""
