"""Column -> Column building blocks. Everything here stays inside the JVM."""
