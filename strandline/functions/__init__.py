"""Column functions; all of them are built from JVM expressions."""
