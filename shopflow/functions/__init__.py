"""Column-level helpers (all JVM-side built-ins, inside whole-stage codegen)."""
