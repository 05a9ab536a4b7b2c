"""Column expressions: text in, typed values out. No Python runs per row."""
