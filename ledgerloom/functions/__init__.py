"""Column functions built from JVM-side expressions, and the few Arrow-batched ones that SQL cannot express."""
