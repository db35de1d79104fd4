"""Column-level feature functions (JVM expressions, whole-stage codegen friendly)."""
