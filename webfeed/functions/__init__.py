"""Column expressions: manifest parsing and hit-column typing."""
