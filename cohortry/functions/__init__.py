"""Column expressions. Everything here stays in the JVM; there is no Python UDF in the library."""
