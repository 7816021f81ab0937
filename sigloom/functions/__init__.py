"""Column expressions: all of them run in the JVM, inside whole-stage code generation."""
