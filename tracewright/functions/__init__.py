"""Column functions that operators are composed of; all run inside the JVM."""
