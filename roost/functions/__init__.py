"""Column expressions: geometry and local time."""
