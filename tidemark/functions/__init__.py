"""Column expressions shared by the layers; all of them stay in the JVM."""
