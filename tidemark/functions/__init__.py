"""Column expressions (JVM built-ins only) shared by every operator."""
