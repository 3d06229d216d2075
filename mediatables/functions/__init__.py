"""Column expressions: they compose into any select/where and stay in the JVM."""
